import random

import pytest
from pyspark.sql import functions as F

from loanloom.operators import drift, leakage
from loanloom.plans.audit import run_audit


def brute_stump_auc(values, labels):
    """Depth-1 Gini split by trying every cut."""
    best = None
    for cut in sorted(set(values))[:-1]:
        left = [y for v, y in zip(values, labels, strict=True) if v <= cut]
        right = [y for v, y in zip(values, labels, strict=True) if v > cut]
        score = sum(
            (sum(s) ** 2 + (len(s) - sum(s)) ** 2) / len(s) for s in (left, right)
        )
        if best is None or score > best[0] + 1e-12:
            best = (score, left, right)
    if best is None:
        return 0.5
    _, left, right = best
    p, n = sum(labels), len(labels) - sum(labels)
    auc = 0.5 * (1 + sum(right) / p - (len(right) - sum(right)) / n)
    return max(auc, 1 - auc)


def test_flags(spark):
    data = [(float(i), float(-i), 7.0, int(i >= 50)) for i in range(100)]
    df = spark.createDataFrame(data, "perfect double, inverted double, same double, y int")
    out = {r["feature"]: (r["auc"], r["flag"]) for r in leakage.single_feature_auc(df, "y").collect()}
    assert out == {
        "perfect": (1.0, "LEAK"),
        "inverted": (1.0, "LEAK"),
        "same": (0.5, "OK"),
    }


@pytest.mark.parametrize(("bins", "heavy"), [(4, 2), (16, 4), (1024, 32)])
def test_bounds_lose_no_split(spark, bins, heavy):
    """Few bins, bins cut again, outliers, ties and gaps."""
    rng = random.Random(6)
    labels = [int(rng.random() < 0.4) for _ in range(300)]
    columns = {
        "outlier": [10.0**9 if i == 0 else rng.gauss(y * 0.5, 1) for i, y in enumerate(labels)],
        "step": [float(rng.randrange(3) + 3 * y) for y in labels],
        "peak": [float(i % 50) + (0.5 if 20 < i % 50 < 24 and y else 0.0) for i, y in enumerate(labels)],
        "gaps": [None if rng.random() < 0.5 else rng.expovariate(1 + y) for y in labels],
    }
    data = list(zip(*columns.values(), labels, strict=True))
    df = spark.createDataFrame(data, "outlier double, step double, peak double, gaps double, y int")
    out = {
        r["feature"]: r["auc"]
        for r in leakage.single_feature_auc(df.repartition(3), "y", bins=bins, heavy=heavy).collect()
    }
    for c, values in columns.items():
        filled = [-999.0 if v is None else v for v in values]
        assert out[c] == pytest.approx(brute_stump_auc(filled, labels), abs=1e-6)


def test_only_counts_are_shuffled(spark):
    """Few bins are looked into; of the others, only their counts are."""
    df = spark.range(20_000).select(
        F.when(F.col("id") < 9000, 1).otherwise(0).cast("bigint").alias("pos"),
        F.posexplode(F.array(F.col("id").cast("double"), F.pmod(F.hash("id"), F.lit(5000)).cast("double"))).alias("column", "v"),
    )
    cells, _ = leakage.split_cells(df)
    looked = cells.where("open").agg(F.sum("n")).first()[0] or 0
    assert cells.agg(F.sum("n")).first()[0] == 40_000 and looked < 4_000


def test_nan_is_missing_and_nothing_gives_nothing(spark):
    df = spark.createDataFrame([(float("nan"), 1), (None, 1), (1.0, 0), (2.0, 0)], "x double, y int")
    assert leakage.single_feature_auc(df, "y").first()["auc"] == 1.0
    assert leakage.single_feature_auc(df.limit(0), "y").collect() == []


def test_audit_equals_brute_force(spark):
    rng = random.Random(2)
    labels = [int(rng.random() < 0.3) for _ in range(200)]
    columns = {
        "noise": [float(rng.randrange(30)) for _ in labels],
        "hint": [y * 0.8 + rng.gauss(0, 1) for y in labels],
        "gaps": [None if rng.random() < 0.4 else rng.gauss(y, 2) for y in labels],
    }
    data = list(zip(*columns.values(), labels, strict=True))
    df = spark.createDataFrame(data, "noise double, hint double, gaps double, y int")
    out = {
        r["feature"]: r["auc"]
        for r in leakage.single_feature_auc(df, "y", rows_per_range=9, min_ranges=4).collect()
    }
    for name, values in columns.items():
        filled = [-999.0 if v is None else v for v in values]
        assert out[name] == pytest.approx(brute_stump_auc(filled, labels), abs=1e-6)


def test_audit_run_reports_and_writes(spark, tmp_path):
    df = spark.createDataFrame(
        [(i, i % 2, float(i % 2), float(i % 3)) for i in range(60)],
        "SK_ID_CURR int, TARGET int, leak double, ok double",
    )
    passed, findings, flags = run_audit(df, str(tmp_path / "audit"))
    assert not passed
    assert [r["feature"] for r in findings.orderBy(F.desc("auc")).collect()][0] == "leak"
    assert {r["flag"]: r["features"] for r in flags.collect()} == {"LEAK": 1, "OK": 1}
    stored = spark.read.option("header", True).csv(str(tmp_path / "audit"))
    assert stored.columns == ["feature", "auc", "flag"] and stored.count() == 2
    assert run_audit(df.drop("leak"))[0]


def window(spark, shift, n=1000):
    return spark.range(n).select(
        (F.col("id") + shift).cast("double").alias("x"),
        F.when(F.col("id") % 4 == 0, "a").when(F.col("id") % 4 == 1, "b").alias("s"),
    )


def test_same_window_has_no_drift(spark):
    old = window(spark, 0)
    out = {r["feature"]: r["psi"] for r in drift.psi_drift(old, old, ["x"], ["s"]).collect()}
    assert out == {"x": pytest.approx(0.0), "s": pytest.approx(0.0)}


def test_shift_raises_an_alert(spark):
    old, new = window(spark, 0), window(spark, 600)
    out = {r["feature"]: r["alert"] for r in drift.psi_drift(old, new, ["x"], ["s"]).collect()}
    assert out == {"x": True, "s": False}


def test_new_category_counts_against_the_smallest_share(spark):
    old = spark.createDataFrame([("a",)] * 10, "s string")
    new = spark.createDataFrame([("a",)] * 5 + [("z",)] * 5, "s string")
    rows = {r["bin"]: r for r in drift.psi_table(old, new, [], ["s"]).collect()}
    assert rows["z"]["reference_share"] == 1e-4 and rows["z"]["current_share"] == 0.5


def test_profile_of_two_days_is_that_of_one_pass(spark):
    old, new = window(spark, 0), window(spark, 300)
    edges = drift.reference_edges(old, ["x"])
    days = [old.where("x % 2 < 1"), old.where("NOT x % 2 < 1"), old.limit(0)]
    merged = drift.merge_profiles(*[drift.window_profile(d, edges, ["s"]) for d in days])
    whole = drift.window_profile(old, edges, ["s"])
    assert sorted(map(str, merged.collect())) == sorted(map(str, whole.collect()))
    assert drift.profile_edges(merged) == edges
    mine = {(r["feature"], r["bin"]): r["contribution"] for r in drift.profile_psi_table(merged, new, ["s"]).collect()}
    direct = {(r["feature"], r["bin"]): r["contribution"] for r in drift.psi_table(old, new, ["x"], ["s"]).collect()}
    assert mine == pytest.approx(direct)


def test_profiles_with_other_edges_are_refused(spark):
    old, new = window(spark, 0), window(spark, 300)
    profiles = [drift.window_profile(w, drift.reference_edges(w, ["x"]), ["s"]) for w in (old, new)]
    with pytest.raises(ValueError, match="different edges: x"):
        drift.merge_profiles(*profiles)
