"""Exact ranking metrics of a score against a 0/1 label.

All of them read the running totals of positives and negatives by falling
score; equal scores are one step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pyspark.ml.feature import Bucketizer

from loanloom.functions.scalars import ratio, zero_if_undefined
from loanloom.operators.prefix import running_totals

# The swept thresholds, their costs and the calibration bins.
SWEEP_THRESHOLDS = [0.01 + 0.01 * i for i in range(99)]
FALSE_NEGATIVE_COST = 10
FALSE_POSITIVE_COST = 1
RELIABILITY_BINS = 10


def _labelled(df: DataFrame, score: str, label: str, groups: list[str]) -> DataFrame:
    positive = F.col(label).cast("double") == 1.0
    return df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).select(
        *groups,
        F.col(score).cast("double").alias("score"),
        positive.cast("bigint").alias("pos"),
        (~positive).cast("bigint").alias("neg"),
    )


def score_steps(
    df: DataFrame, score: str, label: str, groups: list[str] | None = None, **ranges
) -> DataFrame:
    """Per distinct score, from high to low: positives and negatives at it,
    at or above it (``run_``) and in all (``total_``)."""
    groups = groups or []
    return running_totals(
        _labelled(df, score, label, groups),
        "score",
        ["pos", "neg"],
        groups,
        descending=True,
        **ranges,
    )


def _metrics() -> list[Column]:
    pos, neg = F.sum("pos"), F.sum("neg")
    hits, misses = F.col("run_pos").cast("double"), F.col("run_neg").cast("double")
    # the pairs in right order, counted from the negatives and from the
    # positives: with both running counts in use, the two inputs of the running
    # totals have the same columns and share one shuffle
    from_negatives = F.col("neg") * (hits - F.col("pos") / 2.0)
    from_positives = F.col("pos") * (F.col("total_neg") - misses + F.col("neg") / 2.0)
    pairs = F.sum(from_negatives + from_positives) / 2.0
    both = (pos > 0) & (neg > 0)
    return [
        (pos + neg).alias("size"),
        ratio(pos, pos + neg).alias("positive_rate"),
        F.when(both, ratio(pairs, pos.cast("double") * neg)).alias("roc_auc"),
        F.when(both, ratio(F.sum(F.col("pos") * hits / (hits + misses)), pos)).alias(
            "average_precision"
        ),
    ]


def ranking_metrics(
    df: DataFrame, score: str, label: str, groups: list[str] | None = None, **ranges
) -> DataFrame:
    """Size, positive rate, ROC-AUC (ties by trapezoid) and average precision
    (step rule) per group; both metrics are NULL for a single class."""
    steps = score_steps(df, score, label, groups, **ranges)
    return steps.groupBy(*(groups or [])).agg(*_metrics())


def roc_auc(df: DataFrame, score: str, label: str, groups: list[str] | None = None) -> DataFrame:
    return ranking_metrics(df, score, label, groups).select(*(groups or []), "roc_auc")


def average_precision(
    df: DataFrame, score: str, label: str, groups: list[str] | None = None
) -> DataFrame:
    return ranking_metrics(df, score, label, groups).select(
        *(groups or []), "average_precision"
    )


def pr_curve(
    df: DataFrame, score: str, label: str, groups: list[str] | None = None, **ranges
) -> DataFrame:
    """(threshold, precision, recall) per distinct score, plus the end point
    (NULL, 1, 0) of every group."""
    groups = groups or []
    steps = score_steps(df, score, label, groups, **ranges)
    point = F.struct(
        F.col("score").alias("threshold"),
        ratio(F.col("run_pos"), F.col("run_pos") + F.col("run_neg")).alias("precision"),
        ratio(F.col("run_pos"), F.col("total_pos")).alias("recall"),
    )
    end = F.struct(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    highest = (F.col("run_pos") == F.col("pos")) & (F.col("run_neg") == F.col("neg"))
    rows = F.when(highest, F.array(point, end)).otherwise(F.array(point))
    return steps.select(*groups, F.inline(rows))


def best_f1_threshold(
    df: DataFrame, score: str, label: str, groups: list[str] | None = None, **ranges
) -> DataFrame:
    """Per group the threshold with the highest F1, the lowest one on a tie,
    with precision, recall and F1 there."""
    groups = groups or []
    steps = score_steps(df, score, label, groups, **ranges)
    precision = ratio(F.col("run_pos"), F.col("run_pos") + F.col("run_neg"))
    recall = zero_if_undefined(ratio(F.col("run_pos"), F.col("total_pos")))
    f1 = zero_if_undefined(ratio(2.0 * precision * recall, precision + recall))
    best = F.min(
        F.struct(
            (-f1).alias("loss"),
            F.col("score").alias("threshold"),
            precision.alias("precision"),
            recall.alias("recall"),
        )
    )
    return steps.groupBy(*groups).agg(best.alias("b")).select(
        *groups,
        F.coalesce("b.threshold", F.lit(0.5)).alias("threshold"),
        "b.precision",
        "b.recall",
        F.abs("b.loss").alias("f1"),
    )


def confusion_counts(label: Column, predicted: Column) -> list[Column]:
    truth, guess = label.cast("double") == 1.0, predicted.cast("double") == 1.0
    return [
        F.count_if(~truth & ~guess).alias("tn"),
        F.count_if(~truth & guess).alias("fp"),
        F.count_if(truth & ~guess).alias("fn"),
        F.count_if(truth & guess).alias("tp"),
    ]


def confusion_matrix(
    df: DataFrame, label: str, predicted: str, groups: list[str] | None = None
) -> DataFrame:
    return df.groupBy(*(groups or [])).agg(*confusion_counts(F.col(label), F.col(predicted)))


def _decision_scores() -> list[Column]:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return [
        zero_if_undefined(ratio(tp, tp + fp)).alias("precision"),
        zero_if_undefined(ratio(tp, tp + fn)).alias("recall"),
        zero_if_undefined(ratio(2 * tp, 2 * tp + fp + fn)).alias("f1"),
    ]


def threshold_metrics(
    df: DataFrame,
    score: str,
    label: str,
    threshold: float | str = 0.5,
    groups: list[str] | None = None,
) -> DataFrame:
    """Precision, recall and F1 of ``score >= threshold`` (0 when undefined).
    ``threshold`` may name a column."""
    cut = F.col(threshold) if isinstance(threshold, str) else F.lit(float(threshold))
    guess = (F.col(score) >= cut).cast("int")
    counts = (
        df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(*(groups or []))
        .agg(*confusion_counts(F.col(label), guess))
    )
    return counts.select("*", *_decision_scores())


def misclassification_cost(
    df: DataFrame,
    label: str,
    predicted: str,
    fn_cost: float = FALSE_NEGATIVE_COST,
    fp_cost: float = FALSE_POSITIVE_COST,
) -> DataFrame:
    return confusion_matrix(df, label, predicted).select(
        (F.col("fn") * float(fn_cost) + F.col("fp") * float(fp_cost)).alias("cost")
    )


def cost_sweep(
    df: DataFrame,
    score: str,
    label: str,
    fn_cost: float = FALSE_NEGATIVE_COST,
    fp_cost: float = FALSE_POSITIVE_COST,
    thresholds: list[float] | None = None,
) -> DataFrame:
    """Cost and decision scores at every threshold.

    Each row is counted once, in the band between two thresholds; the sweep then
    adds up at most ``len(thresholds) + 1`` band rows.
    """
    cuts = sorted(thresholds or SWEEP_THRESHOLDS)
    banded = Bucketizer(
        splits=[float("-inf"), *cuts, float("inf")], inputCol="score", outputCol="band"
    ).transform(_labelled(df, score, label, []))
    counted = banded.groupBy(F.col("band").cast("bigint").alias("band")).agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
    )
    bands = df.sparkSession.range(len(cuts) + 1).withColumnRenamed("id", "band")
    filled = bands.join(counted, "band", "left").na.fill(0, ["pos", "neg"])
    whole = Window.partitionBy(F.lit(0))
    above = whole.orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, 0)
    values = F.array(*[F.lit(t) for t in cuts])
    counts = filled.select(
        "band",
        F.sum("pos").over(above).alias("tp"),
        F.sum("neg").over(above).alias("fp"),
        F.sum("pos").over(whole).alias("all_pos"),
    ).where("band > 0")
    fn = F.col("all_pos") - F.col("tp")
    return counts.select(
        F.element_at(values, F.col("band").cast("int")).alias("threshold"),
        (fn * float(fn_cost) + F.col("fp") * float(fp_cost)).alias("cost"),
        "tp",
        "fp",
        fn.alias("fn"),
    ).select("*", *_decision_scores())


def find_optimal_threshold(
    df: DataFrame,
    score: str,
    label: str,
    fn_cost: float = FALSE_NEGATIVE_COST,
    fp_cost: float = FALSE_POSITIVE_COST,
) -> DataFrame:
    """The cheapest threshold, the lowest one on a tie, with its scores."""
    return (
        cost_sweep(df, score, label, fn_cost, fp_cost)
        .orderBy("cost", "threshold")
        .limit(1)
    )


def reliability_bins(
    df: DataFrame,
    score: str,
    label: str,
    groups: list[str] | None = None,
    bins: int = RELIABILITY_BINS,
) -> DataFrame:
    """Mean score and positive share in equal bins, closed on the right; empty
    bins are absent."""
    groups = groups or []
    step = 1.0 / bins
    number = sum(
        ((F.col("score") > F.lit(i * step)).cast("int") for i in range(1, bins)), F.lit(0)
    )
    return (
        _labelled(df, score, label, groups)
        .groupBy(*groups, number.alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("size"),
            F.avg("score").alias("mean_score"),
            F.avg("pos").alias("positive_rate"),
        )
    )


def fold_summary(df: DataFrame, metrics: list[str]) -> DataFrame:
    """Mean and population deviation of fold metrics."""
    return df.agg(
        *[
            f(m).alias(f"{m}_{name}")
            for m in metrics
            for name, f in (("mean", F.avg), ("std", F.stddev_pop))
        ]
    )
