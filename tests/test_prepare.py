import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from loanloom.operators import prepare
from loanloom.sources.stores import load_stages, save_stages


def test_scaling_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (10.0, 5.0)], "x double, c double")
    fitted = prepare.scaling(df, ["x", "c"])
    assert fitted["x"] == (pytest.approx(4.0), pytest.approx(12.5**0.5))
    assert fitted["c"] == (5.0, 1.0)
    assert [r["c"] for r in prepare.scale(df, fitted).collect()] == [0.0] * 4


def test_scaling_of_one_row(spark):
    assert prepare.scaling(spark.createDataFrame([(3.0,)], "x double"), ["x"]) == {"x": (3.0, 1.0)}


def test_mode_takes_the_smallest_on_a_tie(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "s string")
    modes, codes = prepare.fit_categories(df, ["s"])
    assert modes == {"s": "a"}
    assert {(r["value"], r["code"]) for r in codes.collect()} == {("a", 0.0), ("b", 1.0)}
    assert prepare.impute_modes(df, modes).where("s = 'a'").count() == 3


def test_unseen_category_is_minus_one_in_every_column(spark):
    df = spark.createDataFrame([("a", "z"), ("q", "x"), ("b", "y")], "s string, t string")
    fitted = spark.createDataFrame([("a", "u"), ("b", "v"), (None, "w"), ("a", "x")], "s string, t string")
    _, codes = prepare.fit_categories(fitted, ["s", "t"])
    out = prepare.ordinal_encode(df, codes, {"s": "s", "t": "t"})
    assert sorted(tuple(r) for r in out.collect()) == [(-1.0, 3.0), (0.0, -1.0), (1.0, -1.0)]


def test_column_with_many_categories(spark):
    df = spark.range(20_000).select(F.col("id").cast("string").alias("s")).repartition(7)
    modes, codes = prepare.fit_categories(df, ["s"])
    assert modes == {"s": "0"}
    expected = {v: float(i) for i, v in enumerate(sorted(str(n) for n in range(20_000)))}
    assert {r["value"]: r["code"] for r in codes.collect()} == expected


def raw(spark):
    return spark.createDataFrame(
        [
            (1, 0, 365243, -10000, "MONDAY", 1.0, "b", None, None),
            (2, 1, -100, -12000, "friday", 3.0, "a", None, None),
            (3, 0, -200, -14000, None, None, None, None, None),
            (4, 1, None, -16000, "SUNDAY", 9.0, "b", None, None),
        ],
        "SK_ID_CURR int, TARGET int, DAYS_EMPLOYED int, DAYS_BIRTH int,"
        " WEEKDAY_APPR_PROCESS_START string, AMT_CREDIT double, CODE_GENDER string,"
        " all_null double, no_text string",
    )


def test_chain_output_names_and_order(spark):
    model = prepare.fit_pipeline(raw(spark), "TARGET", ["SK_ID_CURR"], keep=["CODE_GENDER"])
    names = prepare.get_feature_names(model)
    assert names == [
        "num__DAYS_BIRTH",
        "num__AMT_CREDIT",
        "num__IS_UNEMPLOYED",
        "num__DAYS_EMPLOYED_RATIO",
        "num__AGE_YEARS",
        "num__WEEKDAY_SIN",
        "num__WEEKDAY_COS",
        "cat__CODE_GENDER",
    ]
    out = model.transform(raw(spark))
    assert out.columns == ["TARGET", "SK_ID_CURR", "CODE_GENDER", "features"]
    values = {r["SK_ID_CURR"]: r["x"] for r in out.select("SK_ID_CURR", vector_to_array("features").alias("x")).collect()}
    # the gap takes the median 3; codes are a = 0, b = 1, the gap takes the mode b
    assert values[3][1] == pytest.approx((3 - 4) / 9**0.5)
    assert [values[i][-1] for i in (1, 2, 3, 4)] == [1.0, 0.0, 1.0, 1.0]
    assert all(v is not None for x in values.values() for v in x)


def test_save_load_transform(spark, tmp_path):
    model = prepare.fit_pipeline(raw(spark), "TARGET", ["SK_ID_CURR"])
    save_stages(model, str(tmp_path / "m"))
    save_stages(model, str(tmp_path / "m"))
    assert prepare.same_output(model, load_stages(str(tmp_path / "m")), raw(spark).limit(100))
    other = prepare.fit_pipeline(raw(spark).where("SK_ID_CURR < 4"), "TARGET", ["SK_ID_CURR"])
    assert not prepare.same_output(model, other, raw(spark))
    with pytest.raises(FileNotFoundError):
        load_stages(str(tmp_path / "none"))


def test_planned_features_are_optional(spark):
    model = prepare.fit_pipeline(raw(spark), "TARGET", ["SK_ID_CURR"], planned=True)
    assert "num__EMPLOYMENT_YEARS" in prepare.get_feature_names(model)


def test_new_rows_may_lack_the_label(spark):
    model = prepare.fit_pipeline(raw(spark), "TARGET", ["SK_ID_CURR"])
    assert model.transform(raw(spark).drop("TARGET")).columns == ["SK_ID_CURR", "features"]


def _joins(plan):
    """Joins in a logical plan."""
    children = [plan.children().apply(i) for i in range(plan.children().size())]
    return [plan] * (plan.nodeName() == "Join") + [j for c in children for j in _joins(c)]


def test_numbers_pass_the_joins_of_the_codes_as_one_column(spark):
    """A column per feature would make every join copy rows of that width."""
    rows = raw(spark).select("*", *[F.col("AMT_CREDIT").alias(f"n{i}") for i in range(120)])
    model = prepare.fit_pipeline(rows, "TARGET", ["SK_ID_CURR"])
    out = model.transform(rows)
    joins = _joins(out._jdf.queryExecution().optimizedPlan())
    assert joins and all(j.output().size() < 20 for j in joins)
    columns = model.stages[-1].prepared_columns(prepare.PipelineModel(model.stages[:-1]).transform(rows))
    names = prepare.get_feature_names(model)
    expected = {r["SK_ID_CURR"]: [r[n] for n in names] for r in columns.collect()}
    assert {r["SK_ID_CURR"]: list(r["features"].toArray()) for r in out.collect()} == expected


def test_a_feature_that_is_no_number_is_an_error(spark):
    model = prepare.fit_pipeline(raw(spark), "TARGET", ["SK_ID_CURR"])
    bad = raw(spark).withColumn("AMT_CREDIT", F.lit(float("nan")))
    with pytest.raises(Exception, match="NaN"):
        model.transform(bad).collect()


def test_values_of_overlapping_groups_are_read_once(spark, monkeypatch):
    """Training sets of folds share most rows: a value is counted once for all of them,
    and they find what a fit of each alone finds."""
    rng = random.Random(8)
    nan = float("nan")
    rows = [
        (
            i % 4 if i < 3000 else 3,
            rng.choice([None, nan, rng.gauss(5.0, 2.0), rng.gauss(0.0, 1e6)]),
            float(i) if i % 4 == 2 and i < 3000 else None,
            rng.randrange(3),
            7.5 if i % 2 else None,
            None,
        )
        for i in range(9000)
    ]
    names = ["a", "one_part", "few", "constant", "empty"]
    df = spark.createDataFrame(
        rows, "part int, a double, one_part double, few int, constant double, empty double"
    )
    members = [[1, 2], [0, 2], [0, 1], [0, 1, 2]]  # groups of each part; part 3 is in all
    seen = []

    def watched(values, *rest):
        seen.append(values.count())
        return long_quantiles(values, *rest)

    long_quantiles = prepare.long_quantiles
    monkeypatch.setattr(prepare, "long_quantiles", watched)
    together = prepare.fit_numbers(df, names, "part", members)
    present = sum(v is not None and v == v for row in rows for v in row[1:])
    assert seen == [present]
    for g, fit in enumerate(together):
        parts = [p for p, groups in enumerate(members) if g in groups]
        (alone,) = prepare.fit_numbers(df.where(F.col("part").isin(parts)), names)
        assert fit.medians == alone.medians
        assert set(fit.scaling) == set(alone.scaling)
        for c in fit.scaling:
            assert fit.scaling[c] == pytest.approx(alone.scaling[c], rel=1e-9)
    assert "empty" not in together[0].medians and "one_part" not in together[2].medians
