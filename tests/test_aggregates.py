import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from loanloom.functions.missing import is_not_member, nan_to_null
from loanloom.operators import aggregates as agg
from loanloom.operators import applicants
from loanloom.sources.schemas import TABLE_SCHEMAS


def child(spark, data, schema, spec, extras=None):
    df = spark.createDataFrame(data, schema)
    return {
        r["k"]: r.asDict() for r in agg.aggregate_children(df, "k", spec, "t", extras).collect()
    }


def test_all_missing_sum_is_zero(spark):
    out = child(
        spark,
        [(1, None), (1, None)],
        "k int, x double",
        {"x": ["sum", "mean", "size", "min", "std"]},
    )
    assert out[1] == {
        "k": 1, "T_X_SUM": 0.0, "T_X_MEAN": None, "T_X_SIZE": 2, "T_X_MIN": None, "T_X_STD": None,
    }


def test_std_of_one_row_is_null(spark):
    out = child(spark, [(1, 2.0), (2, 1.0), (2, 4.0)], "k int, x double", {"x": ["std"]})
    assert out[1]["T_X_STD"] is None
    assert out[2]["T_X_STD"] == pytest.approx(4.5**0.5)


def test_missing_key_is_left_out(spark):
    out = child(spark, [(None, 1.0), (1, 2.0)], "k int, x double", {"x": ["max"]})
    assert list(out) == [1]


def test_conditional_count_without_a_match_is_null(spark):
    out = child(
        spark,
        [(1, "A"), (1, None), (2, "B")],
        "k int, s string",
        {},
        {"n": agg.count_when(F.col("s") == "A"), "r": agg.rate_when(F.col("s") == "A")},
    )
    assert (out[1]["n"], out[1]["r"]) == (1, 0.5)
    assert (out[2]["n"], out[2]["r"]) == (None, None)


def test_missing_status_counts_as_outside_the_set(spark):
    out = child(
        spark,
        [(1, None), (1, "0"), (1, "C"), (1, "3")],
        "k int, s string",
        {},
        {"dpd": agg.rate_when(is_not_member(F.col("s"), ["0", "C", "X"]))},
    )
    assert out[1]["dpd"] == 0.5


def test_payment_ratio_and_lateness(spark):
    schema = TABLE_SCHEMAS["installments_payments.csv"]
    data = [
        (1, 1, 1.0, 1, -10.0, -5.0, 0.0, 5.0),
        (1, 1, 1.0, 2, -10.0, -12.0, 10.0, 5.0),
        (1, 1, 1.0, 3, -10.0, None, None, 5.0),
    ]
    out = applicants.aggregate_installments(spark.createDataFrame(data, schema)).first()
    assert out["INST_PAYMENT_RATIO"] == 0.5
    assert out["INST_DAYS_PAST_DUE"] == 5.0
    assert out["INST_LATE_PAYMENT_RATE"] == pytest.approx(1 / 3)
    assert out["INST_COUNT"] == 3
    assert len(out) == 21


def test_unmatched_grandchild_contributes_nothing(spark):
    links = spark.createDataFrame([(10, 1), (11, 1), (12, 2)], "l int, k int")
    rows = spark.createDataFrame(
        [(10, -1, "0"), (10, -2, "1"), (11, -3, None), (99, -9, "0")], "l int, m int, s string"
    )
    out = agg.aggregate_grandchildren(
        rows,
        links,
        "l",
        "k",
        {"m": ["mean", "min", "max", "size", "sum"]},
        "bb",
        {"zero": F.col("s") == "0", "closed": F.col("s") == "C"},
    ).collect()
    assert [r["k"] for r in out] == [1]
    r = out[0].asDict()
    assert (r["BB_M_MEAN"], r["BB_M_MIN"], r["BB_M_MAX"]) == (-2.0, -3, -1)
    assert (r["BB_M_SIZE"], r["BB_M_SUM"]) == (3, -6)
    assert r["zero"] == pytest.approx(1 / 3) and r["closed"] is None


def test_repeated_links_count_like_the_plain_join(spark):
    links = spark.createDataFrame([(10, 1), (10, 1), (10, 2), (11, 1)], "l int, k int")
    rows = spark.createDataFrame([(10, 4), (10, None), (11, 1)], "l int, m int")
    out = agg.aggregate_grandchildren(rows, links, "l", "k", {"m": ["mean", "size"]}, "t")
    plain = (
        rows.join(links, "l")
        .groupBy("k")
        .agg(F.avg("m").alias("T_M_MEAN"), F.count(F.lit(1)).alias("T_M_SIZE"))
    )
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, plain.collect()))


def test_grandchild_rejects_what_it_cannot_combine(spark):
    df = spark.createDataFrame([(1, 1)], "l int, k int")
    with pytest.raises(ValueError, match="std"):
        agg.aggregate_grandchildren(df, df, "l", "k", {"k": ["std"]}, "t")


def test_column_counts_of_the_four_children(spark):
    def empty(name):
        return spark.createDataFrame([], TABLE_SCHEMAS[name])

    counts = [
        len(applicants.aggregate_bureau(empty("bureau.csv"), empty("bureau_balance.csv")).columns),
        len(
            applicants.aggregate_previous_applications(empty("previous_application.csv")).columns
        ),
        len(applicants.aggregate_pos_cash(empty("POS_CASH_balance.csv")).columns),
        len(applicants.aggregate_installments(empty("installments_payments.csv")).columns),
    ]
    assert [c - 1 for c in counts] == [34, 32, 16, 20]


def test_unique_key_checks(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,), (None,)], "k int")
    assert [tuple(r) for r in agg.duplicate_keys(df, "k").collect()] == [(2, 2)]
    with pytest.raises(ValueError, match="not unique"):
        agg.require_unique_key(df, "k")
    agg.require_unique_key(df.distinct(), "k")
    with pytest.raises(AssertionError):
        agg.require_same_rows(3, 4)


def test_nan_counts_as_missing(spark):
    df = nan_to_null(spark.createDataFrame([(1.0,), (float("nan"),)], "x double"))
    assert df.agg(F.avg("x")).first()[0] == 1.0
    assert agg.null_rates(df).first()["null_rate"] == 0.5


def test_hot_key_is_combined_before_the_shuffle(spark):
    df = spark.range(1000).select(F.lit(1).alias("k"), F.col("id").cast("double").alias("x"))
    out = agg.aggregate_children(df, "k", {"x": ["mean", "sum", "std"]}, "t")
    text = plan_text(out)
    assert text.index("partial_") < text.index("Exchange") or "partial_avg" in text
    assert "Python" not in text
