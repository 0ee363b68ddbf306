import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from loanloom.operators import histograms, profile, quantiles, sampling


def test_median_of_an_even_count(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "x double")
    assert quantiles.exact_quantiles(df, ["x"], [0.5]) == {"x": [2.5]}


def test_column_without_values(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "x double, z double")
    assert quantiles.exact_quantiles(df, ["x", "z"], [0.0, 1.0]) == {
        "x": [1.0, 2.0],
        "z": [None, None],
    }


@pytest.mark.parametrize("picked", [2000, 0, 10])
def test_quantiles_equal_numpy(spark, monkeypatch, picked):
    """Also when rounds go on until a bracket holds one value."""
    monkeypatch.setattr(quantiles, "PICKED_ROWS", picked)
    rng = random.Random(3)
    a = [rng.gauss(0, 1) for _ in range(5000)]
    b = [float(rng.randrange(6)) for _ in range(5000)]
    c = [10.0 ** rng.randint(-300, 300) * rng.choice([-1, 1]) for _ in range(5000)]
    df = spark.createDataFrame(list(zip(a, b, c, strict=True)), "a double, b double, c double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]
    found = quantiles.exact_quantiles(df.repartition(6), ["a", "b", "c"], probs)
    assert found["a"] == pytest.approx(np.quantile(a, probs))
    assert found["b"] == pytest.approx(np.quantile(b, probs))
    assert found["c"] == pytest.approx(np.quantile(c, probs))


def test_values_that_are_no_numbers(spark):
    values = [1.0, float("nan"), float("inf"), 2.0, float("-inf"), None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    found = quantiles.exact_quantiles(df, ["x"], [0.0, 0.5, 1.0])["x"]
    assert found == [float("-inf"), 1.5, float("inf")]


def test_quantiles_have_one_path_and_no_whole_column_in_a_task(spark):
    """Every job groups by (bracket, bin); nothing is sketched or ranked whole."""
    import inspect

    from loanloom.operators import bins, prefix

    for module in (quantiles, bins, prefix):
        assert "percentile_approx" not in inspect.getsource(module)
    assert "Window" not in inspect.getsource(quantiles) + inspect.getsource(bins)


def applicants(spark, n=1000):
    return spark.range(n).select("id", (F.col("id") % 13 == 0).cast("int").alias("y"))


def test_sample_is_repeatable_and_fixed_in_size(spark):
    df = applicants(spark)
    a = {r["id"] for r in sampling.hash_sample(df, "id", 50).collect()}
    b = {r["id"] for r in sampling.hash_sample(df.repartition(9), "id", 50).collect()}
    other = {r["id"] for r in sampling.hash_sample(df, "id", 50, seed=7).collect()}
    assert a == b and len(a) == 50 and a != other
    assert sampling.hash_sample(df, "id", 5000).count() == 1000


@pytest.mark.parametrize("digits", [1, 3])
def test_sample_is_what_a_whole_sort_gives(spark, monkeypatch, digits):
    monkeypatch.setattr(sampling, "STEP_DIGITS", digits)
    df = spark.range(3000).withColumn("x", F.col("id") * 2).repartition(7)
    for n in (0, 1, 7, 500, 2999, 3000, 4000):
        sorted_ = df.orderBy(sampling.hash_order(F.col("id"), 42), "id").limit(n)
        assert sorted(map(tuple, sampling.hash_sample(df, "id", n).collect())) == sorted(map(tuple, sorted_.collect()))
    hashes = df.select(sampling.hash_order(F.col("id"), 42).alias("hash"))
    last = sampling._prefix_of_rank(hashes, 50)
    assert 50 <= hashes.where(F.substring("hash", 1, len(last)) <= last).count() <= 100


def test_sample_of_equal_ids(spark):
    df = spark.createDataFrame([(1,)] * 40 + [(2,), (None,)], "id int").repartition(5)
    assert sampling.hash_sample(df, "id", 10).count() == 10
    assert sampling.hash_sample(df, "id", 41).count() == 41


def test_complete_sample_ignores_gaps(spark):
    df = spark.range(100).select("id", F.when(F.col("id") % 4 == 0, F.lit(1.0)).alias("x"))
    out = sampling.complete_sample(df, "id", ["x"], 10_000)
    assert out.count() == 25


@pytest.mark.parametrize("digits", [1, 4])
def test_split_keeps_class_shares(spark, digits):
    df = applicants(spark)
    train, test = sampling.stratified_split(df, "id", "y", 0.2, digits=digits)
    positives = df.where("y = 1").count()
    assert test.where("y = 1").count() == int(0.2 * positives + 0.5)
    assert test.where("y = 0").count() == int(0.2 * (1000 - positives) + 0.5)
    assert train.count() + test.count() == 1000
    assert train.join(test, "id").count() == 0


def test_split_does_not_depend_on_the_prefix_length(spark):
    df = applicants(spark)
    sides = [
        {r["id"] for r in sampling.stratified_split(df, "id", "y", digits=d)[1].collect()}
        for d in (1, 4)
    ]
    assert sides[0] == sides[1]


def test_folds_cover_all_rows_evenly(spark):
    out = sampling.stratified_folds(applicants(spark), "id", "y", 5)
    counts = {(r["y"], r["fold"]): r["count"] for r in out.groupBy("y", "fold").count().collect()}
    for y in (0, 1):
        sizes = [counts[(y, f)] for f in range(5)]
        assert max(sizes) - min(sizes) <= 1
    assert out.where("fold is null").count() == 0


def test_class_smaller_than_the_folds(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "id int, y int")
    out = sampling.stratified_folds(df, "id", "y", 5)
    assert out.count() == 3 and out.where("fold between 0 and 4").count() == 3


def test_assignment_moves_no_rows(spark):
    plan = plan_text(sampling.stratified_folds(applicants(spark), "id", "y", 5))
    assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_parts_follow_their_shares(spark):
    out = sampling.stratified_parts(applicants(spark), "id", "y", [0.2, 0.3, 0.5])
    sizes = {r["part"]: r["count"] for r in out.groupBy("part").count().collect()}
    assert sizes[0] == pytest.approx(200, abs=2) and sizes[1] == pytest.approx(300, abs=2)


def test_label_with_many_values(spark):
    df = spark.range(1500).withColumn("y", F.col("id") % 500)
    out = sampling.stratified_folds(df, "id", "y", 3)
    assert {(r["y"], r["fold"], r["count"]) for r in out.groupBy("y", "fold").count().collect()} == {
        (y, f, 1) for y in range(500) for f in range(3)
    }


def test_row_without_a_class_has_no_fold(spark):
    df = spark.createDataFrame([(1, 0), (2, None), (3, 0)], "id int, y int")
    out = {r["id"]: r["fold"] for r in sampling.stratified_folds(df, "id", "y", 2).collect()}
    assert out[2] is None and {out[1], out[3]} == {0, 1}


def test_histogram_equals_numpy(spark):
    rng = random.Random(5)
    x = [round(rng.uniform(0, 3), 1) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in x], "x double")
    counts, edges = np.histogram(x, bins=30)
    got = {r["bin"]: r["count"] for r in histograms.histogram(df, ["x"], 30).collect()}
    assert [got.get(i, 0) for i in range(30)] == counts.tolist()
    density = np.histogram(x, bins=30, density=True)[0]
    got = {r["bin"]: r["density"] for r in histograms.histogram(df, ["x"], 30).collect()}
    assert [got.get(i, 0.0) for i in range(30)] == pytest.approx(density.tolist())


def test_histogram_of_a_constant_and_of_nothing(spark):
    df = spark.createDataFrame([(5.0, None), (5.0, None)], "x double, z double")
    out = histograms.histogram(df, ["x", "z"], 10).collect()
    counts = np.histogram([5.0, 5.0], bins=10)[0].tolist()
    assert [(r["feature"], r["bin"], r["count"]) for r in out] == [("x", counts.index(2), 2)]
    assert histograms.histogram(df, ["z"], 10).count() == 0


def test_class_histogram_counts_add_up(spark):
    rng = random.Random(6)
    df = spark.createDataFrame(
        [(rng.gauss(0, 5), rng.randrange(2)) for _ in range(500)], "x double, y int"
    )
    out = histograms.label_histograms(df, ["x"], "y", 20, (0.01, 0.99))
    got = {r["label"]: r["n"] for r in out.groupBy("label").agg(F.sum("count").alias("n")).collect()}
    want = {r["y"]: r["count"] for r in df.groupBy("y").count().collect()}
    assert got == want


def test_correlation_with_gaps_and_constants(spark):
    data = [(1.0, 2.0, 5.0, 0), (2.0, None, 5.0, 1), (4.0, 6.0, 5.0, 1), (3.0, 1.0, 5.0, 0)]
    df = spark.createDataFrame(data, "a double, b double, same double, y int")
    found = {r[0]: r[1] for r in profile.label_correlations(df, "y").collect()}
    assert found["a"] == pytest.approx(np.corrcoef([1, 2, 4, 3], [0, 1, 1, 0])[0, 1])
    assert found["b"] == pytest.approx(np.corrcoef([2, 6, 1], [0, 1, 0])[0, 1])
    assert found["same"] is None


def test_sentinel_rates(spark):
    df = spark.createDataFrame([(9, 1), (9, 0), (1, 1), (None, 0)], "d int, y int")
    out = profile.sentinel_analysis(df, "d", 9, "y").first().asDict()
    assert out == {
        "sentinel_count": 2,
        "sentinel_pct": 50.0,
        "sentinel_label_rate": 50.0,
        "other_label_rate": 50.0,
    }


def test_top_values_break_ties_by_name(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "s string")
    out = [tuple(r) for r in profile.top_values(df, ["s"], 2).orderBy("rank").collect()]
    assert out == [("s", 1, "a", 2), ("s", 2, "b", 2)]


def test_column_profile_parts(spark):
    df = spark.createDataFrame([(1.0, "a"), (0.0, None)], "x double, s string")
    parts = profile.column_profile(df)
    assert set(parts) == {"nulls", "distinct", "numeric", "top_values"}
    assert parts["numeric"].first()["zeros"] == 1
    exact = {r[0]: r[1] for r in profile.column_profile(df)["distinct"].collect()}
    assert exact == {"x": 2, "s": 1}
