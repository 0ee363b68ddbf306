import math

import pytest
from pyspark.sql import functions as F

from loanloom.operators import features


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_sentinel_becomes_null_and_input_stays(spark):
    df = spark.createDataFrame(
        [(100, 1), (365243, 2), (-500, 3)], "DAYS_EMPLOYED int, OTHER_COL int"
    )
    out = features.SentinelImputer().transform(df)
    assert rows(out, "DAYS_EMPLOYED", "OTHER_COL") == [(100, 1), (None, 2), (-500, 3)]
    assert rows(df, "DAYS_EMPLOYED")[1] == (365243,)


def test_sentinel_without_the_column(spark):
    df = spark.createDataFrame([(1,), (2,)], "A int")
    assert features.SentinelImputer().transform(df).columns == ["A"]


def test_unemployed_flag(spark):
    df = spark.createDataFrame([(100.0,), (None,), (-500.0,)], "DAYS_EMPLOYED double")
    out = features.IsUnemployedFlagger().transform(df)
    assert rows(out, "IS_UNEMPLOYED") == [(0,), (1,), (0,)]
    assert "IS_UNEMPLOYED" not in df.columns
    absent = spark.createDataFrame([(1,)], "A int")
    assert rows(features.IsUnemployedFlagger().transform(absent), "IS_UNEMPLOYED") == [(0,)]


def test_ratios(spark):
    df = spark.createDataFrame(
        [(100000.0, 50000.0, 5000.0, -1000.0, -10000.0), (0.0, 0.0, 100.0, None, -15000.0)],
        "AMT_CREDIT double, AMT_INCOME_TOTAL double, AMT_ANNUITY double,"
        " DAYS_EMPLOYED double, DAYS_BIRTH double",
    )
    first, second = features.RatioFeatureCreator().transform(df).collect()
    assert first["CREDIT_INCOME_RATIO"] == pytest.approx(100000 / 50001)
    assert second["CREDIT_INCOME_RATIO"] == 0.0
    assert first["CREDIT_TERM"] == pytest.approx(5000 / 100001)
    assert second["ANNUITY_INCOME_RATIO"] == pytest.approx(100.0)
    assert first["DAYS_EMPLOYED_RATIO"] == pytest.approx(-1000 / -10001)
    assert second["DAYS_EMPLOYED_RATIO"] is None
    assert first["AGE_YEARS"] == pytest.approx(10000 / 365)


def test_ratio_with_a_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(5.0, -1.0)], "AMT_CREDIT double, AMT_INCOME_TOTAL double")
    assert features.add_ratios(df).first()["CREDIT_INCOME_RATIO"] is None


def test_external_scores(spark):
    df = spark.createDataFrame(
        [(0.5, 0.4, 0.6), (None, 0.5, None), (None, None, None)],
        "EXT_SOURCE_1 double, EXT_SOURCE_2 double, EXT_SOURCE_3 double",
    )
    a, b, c = features.ExternalSourceAggregator().transform(df).collect()
    assert a["EXT_SOURCE_MEAN"] == pytest.approx(0.5)
    assert a["EXT_SOURCE_STD"] == pytest.approx(0.1)
    assert b["EXT_SOURCE_MEAN"] == pytest.approx(0.5)
    assert b["EXT_SOURCE_STD"] is None
    assert c["EXT_SOURCE_MEAN"] is None
    assert [r["EXT_SOURCE_MISSING_COUNT"] for r in (a, b, c)] == [0, 2, 3]


def test_weekday_cycle(spark):
    df = spark.createDataFrame(
        [("MONDAY",), ("SUNDAY",), ("Wednesday",), ("holiday",), (None,)],
        "WEEKDAY_APPR_PROCESS_START string",
    )
    out = features.CyclicalEncoder().transform(df).collect()
    assert out[0]["WEEKDAY_SIN"] == pytest.approx(0.0)
    assert out[0]["WEEKDAY_COS"] == pytest.approx(1.0)
    assert out[2]["WEEKDAY_SIN"] == pytest.approx(math.sin(2 * math.pi * 2 / 7))
    assert out[3]["WEEKDAY_SIN"] is None and out[4]["WEEKDAY_COS"] is None
    for r in out[:3]:
        assert -1 <= r["WEEKDAY_SIN"] <= 1 and -1 <= r["WEEKDAY_COS"] <= 1


def test_weekday_cycle_takes_numbers(spark):
    df = spark.createDataFrame([(3,)], "WEEKDAY_APPR_PROCESS_START int")
    out = features.add_weekday_cycle(df).first()
    assert out["WEEKDAY_SIN"] == pytest.approx(math.sin(2 * math.pi * 3 / 7))


def test_drop_columns(spark):
    df = spark.createDataFrame([(1, 3, 5), (2, 4, 6)], "A int, B int, C int")
    assert features.DropColumns(columnsToDrop=["B", "D"]).transform(df).columns == ["A", "C"]


def test_dropped_list_has_38_names():
    assert len(set(features.DROPPED_COLUMNS)) == 38


def test_planned_imputation(spark):
    df = spark.createDataFrame(
        [(None, None, None, None, "N", None), (2.0, 5.0, 0.3, 7.0, "Y", "Clerk")],
        "BUREAU_LOAN_COUNT double, BUREAU_DAYS_CREDIT_MEAN double, EXT_SOURCE_1 double,"
        " OWN_CAR_AGE double, FLAG_OWN_CAR string, OCCUPATION_TYPE string",
    )
    a, b = features.add_planned_imputation(df).collect()
    assert (a["BUREAU_HAS_HISTORY"], b["BUREAU_HAS_HISTORY"]) == (0, 1)
    assert (a["EXT_SOURCE_1_IS_NULL"], b["EXT_SOURCE_1_IS_NULL"]) == (1, 0)
    assert a["BUREAU_LOAN_COUNT"] == 0.0 and a["BUREAU_DAYS_CREDIT_MEAN"] is None
    assert a["OWN_CAR_AGE"] == 0.0 and a["OCCUPATION_TYPE"] == "Missing"


def test_ratio_without_a_denominator_is_zero_and_without_a_numerator_a_gap(spark):
    df = spark.createDataFrame(
        [(1.0, -1.0, None, 5.0), (2.0, None, None, 5.0), (None, 4.0, None, None), (3.0, 2.0, 1.0, 5.0)],
        "AMT_CREDIT double, AMT_INCOME_TOTAL double, AMT_ANNUITY double, AMT_GOODS_PRICE double",
    )
    made = features.add_planned_features(features.add_ratios(df))
    out = features.add_planned_imputation(made).collect()
    assert [r["CREDIT_INCOME_RATIO"] for r in out] == [0.0, 0.0, None, 1.0]
    assert [r["ANNUITY_INCOME_RATIO"] for r in out] == [0.0, 0.0, None, pytest.approx(1 / 3)]
    assert [r["CREDIT_GOODS_RATIO"] for r in out] == [0.2, 0.4, 0.0, 0.6]


def test_housing_gaps_are_flagged(spark):
    df = spark.createDataFrame([(None, 1.0), (0.5, None)], "COMMONAREA_AVG double, FLOORSMAX_AVG double")
    out = features.add_planned_imputation(df)
    assert [r["COMMONAREA_AVG_IS_NULL"] for r in out.collect()] == [1, 0]
    assert "FLOORSMAX_AVG_IS_NULL" not in out.columns


def test_planned_features(spark):
    df = spark.createDataFrame(
        [(0.5, 0.4, 0.2, 3.0, 4.0), (None, 0.4, 0.2, 1.0, None)],
        "EXT_SOURCE_1 double, EXT_SOURCE_2 double, EXT_SOURCE_3 double,"
        " BUREAU_ACTIVE_LOAN_COUNT double, BUREAU_LOAN_COUNT double",
    )
    a, b = features.add_planned_features(df).collect()
    assert a["EXT_SOURCE_PRODUCT"] == pytest.approx(0.04)
    assert (a["EXT_SOURCE_MIN"], b["EXT_SOURCE_MIN"]) == (0.2, 0.2)
    assert b["EXT_SOURCE_PRODUCT"] is None
    assert a["BUREAU_ACTIVE_RATIO"] == pytest.approx(0.75) and b["BUREAU_ACTIVE_RATIO"] is None
    assert "INCOME_PER_PERSON" not in features.add_planned_features(df).columns


def test_stages_survive_saving(spark, tmp_path):
    from pyspark.ml import PipelineModel

    chain = PipelineModel(
        stages=[features.SentinelImputer(), features.DropColumns(columnsToDrop=["B"])]
    )
    chain.write().save(str(tmp_path / "chain"))
    loaded = PipelineModel.load(str(tmp_path / "chain"))
    df = spark.createDataFrame([(365243, 1)], "DAYS_EMPLOYED int, B int")
    out = loaded.transform(df)
    assert out.columns == ["DAYS_EMPLOYED"] and out.where(F.col("DAYS_EMPLOYED").isNull()).count()
