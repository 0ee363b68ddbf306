import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from loanloom.operators import ranking
from loanloom.operators.prefix import assign_range, range_edges, running_totals

SMALL = {"rows_per_range": 7, "min_ranges": 5}


def scored(spark, pairs):
    return spark.createDataFrame([(float(p), y) for p, y in pairs], "p double, y int")


def brute_auc(pairs):
    pos = [p for p, y in pairs if y]
    neg = [p for p, y in pairs if not y]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    return wins / (len(pos) * len(neg))


def brute_ap(pairs):
    total, area, seen = sum(y for _, y in pairs), 0.0, 0.0
    for t in sorted({p for p, _ in pairs}, reverse=True):
        chosen = [y for p, y in pairs if p >= t]
        recall = sum(chosen) / total
        area += (recall - seen) * sum(chosen) / len(chosen)
        seen = recall
    return area


def random_pairs(seed, n=300, distinct=40):
    rng = random.Random(seed)
    return [(rng.randrange(distinct) / distinct, int(rng.random() < 0.3)) for _ in range(n)]


def test_hand_computed_metrics(spark):
    df = scored(spark, [(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1)])
    out = ranking.ranking_metrics(df, "p", "y").first()
    assert out["average_precision"] == pytest.approx(0.8333333)
    assert out["roc_auc"] == pytest.approx(0.75)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_metrics_equal_brute_force_over_many_ranges(spark, seed):
    pairs = random_pairs(seed)
    out = ranking.ranking_metrics(scored(spark, pairs), "p", "y", **SMALL).first()
    assert out["roc_auc"] == pytest.approx(brute_auc(pairs))
    assert out["average_precision"] == pytest.approx(brute_ap(pairs))
    assert out["size"] == len(pairs)


def test_metrics_do_not_depend_on_row_order_or_edges(spark):
    df = scored(spark, random_pairs(9))
    one = ranking.ranking_metrics(df.repartition(7), "p", "y").first()
    two = ranking.ranking_metrics(df.orderBy("y"), "p", "y", **SMALL).first()
    assert one["roc_auc"] == pytest.approx(two["roc_auc"])
    assert one["average_precision"] == pytest.approx(two["average_precision"])


def test_reversed_score_gives_the_complement(spark):
    df = scored(spark, random_pairs(4)).withColumn("q", 1 - F.col("p"))
    a = ranking.roc_auc(df, "p", "y").first()[0]
    b = ranking.roc_auc(df, "q", "y").first()[0]
    assert a + b == pytest.approx(1.0)


def test_one_class_gives_null(spark):
    out = ranking.ranking_metrics(scored(spark, [(0.1, 0), (0.2, 0)]), "p", "y").first()
    assert out["roc_auc"] is None and out["average_precision"] is None
    assert out["positive_rate"] == 0.0


def test_groups_are_judged_apart(spark):
    a, b = random_pairs(5), [(p * 100, y) for p, y in random_pairs(6)]
    df = spark.createDataFrame(
        [("a", float(p), y) for p, y in a] + [("b", float(p), y) for p, y in b],
        "g string, p double, y int",
    )
    out = {r["g"]: r["roc_auc"] for r in ranking.roc_auc(df, "p", "y", ["g"]).collect()}
    assert out["a"] == pytest.approx(brute_auc(a))
    assert out["b"] == pytest.approx(brute_auc(b))


def test_curve_ends_at_precision_one(spark):
    curve = ranking.pr_curve(scored(spark, random_pairs(7)), "p", "y", **SMALL).collect()
    ends = [r for r in curve if r["threshold"] is None]
    assert len(ends) == 1 and (ends[0]["precision"], ends[0]["recall"]) == (1.0, 0.0)
    assert len(curve) == len({p for p, _ in random_pairs(7)}) + 1
    assert max(r["recall"] for r in curve) == 1.0


def test_best_f1_takes_the_lowest_threshold_on_a_tie(spark):
    # F1 is 2/3 at 0.9 (1 of 1, recall 1/2) and at 0.2 (2 of 4, recall 1)
    df = scored(spark, [(0.9, 1), (0.5, 0), (0.4, 0), (0.2, 1)])
    out = ranking.best_f1_threshold(df, "p", "y").first()
    assert out["threshold"] == 0.2 and out["f1"] == pytest.approx(2 / 3)


def test_optimal_threshold_equals_brute_force(spark):
    pairs = random_pairs(8)
    costs = []
    for t in ranking.SWEEP_THRESHOLDS:
        fn = sum(1 for p, y in pairs if y and p < t)
        fp = sum(1 for p, y in pairs if not y and p >= t)
        costs.append(10.0 * fn + fp)
    out = ranking.find_optimal_threshold(scored(spark, pairs), "p", "y").first()
    assert out["cost"] == min(costs)
    assert out["threshold"] == ranking.SWEEP_THRESHOLDS[costs.index(min(costs))]
    sweep = ranking.cost_sweep(scored(spark, pairs), "p", "y").orderBy("threshold").collect()
    assert [r["cost"] for r in sweep] == costs


def test_sweep_keeps_every_threshold_for_few_scores(spark):
    sweep = ranking.cost_sweep(scored(spark, [(0.5, 1)]), "p", "y").orderBy("threshold").collect()
    assert len(sweep) == 99
    assert [r["cost"] for r in sweep] == [0.0] * 50 + [10.0] * 49
    assert sweep[-1]["precision"] == 0.0


def test_thresholds_are_the_published_grid():
    assert ranking.SWEEP_THRESHOLDS[23] == 0.24000000000000002
    assert len(ranking.SWEEP_THRESHOLDS) == 99


def test_reliability_bin_edges(spark):
    df = scored(spark, [(0.0, 0), (0.1, 0), (0.10001, 1), (1.0, 1)])
    out = {r["bin"]: r["size"] for r in ranking.reliability_bins(df, "p", "y").collect()}
    assert out == {0: 2, 1: 1, 9: 1}


def test_threshold_metrics_are_zero_when_undefined(spark):
    out = ranking.threshold_metrics(scored(spark, [(0.1, 0), (0.2, 0)]), "p", "y", 0.9).first()
    assert (out["precision"], out["recall"], out["f1"]) == (0.0, 0.0, 0.0)


def test_confusion_and_cost(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0), (0, 0)], "y int, g int")
    assert ranking.confusion_matrix(df, "y", "g").first().asDict() == {
        "tn": 2, "fp": 1, "fn": 1, "tp": 1,
    }
    assert ranking.misclassification_cost(df, "y", "g").first()["cost"] == 11.0


def test_fold_summary_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "m double")
    out = ranking.fold_summary(df, ["m"]).first()
    assert (out["m_mean"], out["m_std"]) == (4.0, pytest.approx(12.5**0.5))


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_equal_a_plain_sum(spark, descending):
    rng = random.Random(11)
    data = [(rng.choice("ab"), float(rng.randrange(50)), rng.randrange(9)) for _ in range(400)]
    df = spark.createDataFrame(data, "g string, k double, v int")
    out = running_totals(df, "k", ["v"], ["g"], descending, **SMALL).collect()
    for r in out:
        same = [v for g, k, v in data if g == r["g"]]
        upto = [
            v
            for g, k, v in data
            if g == r["g"] and (k >= r["k"] if descending else k <= r["k"])
        ]
        assert r["run_v"] == sum(upto) and r["total_v"] == sum(same)
    assert len(out) == len({(g, k) for g, k, _ in data})


def test_one_hot_score_does_not_break_the_ranges(spark):
    pairs = [(0.5, i % 2) for i in range(300)] + random_pairs(12, 150)
    out = ranking.ranking_metrics(scored(spark, pairs), "p", "y", **SMALL).first()
    assert out["roc_auc"] == pytest.approx(brute_auc(pairs))


def test_ranges_share_the_rows(spark):
    df = spark.range(10000).select((F.col("id") / 7.0).alias("k"))
    edges = range_edges(df, "k", rows_per_range=1000)
    assert len(edges) == 9
    counts = [r["count"] for r in assign_range(df, "k", edges, "r").groupBy("r").count().collect()]
    assert len(counts) == 10 and max(counts) < 1100


def test_no_row_goes_through_a_single_partition(spark):
    df = spark.range(1000).select(
        (F.col("id") / 3.0).alias("p"), (F.col("id") % 2).alias("y"), (F.col("id") % 3).alias("g")
    )
    steps = ranking.score_steps(df, "p", "y", ["g"])
    assert "SinglePartition" not in plan_text(steps)
    assert "Python" not in plan_text(steps)
