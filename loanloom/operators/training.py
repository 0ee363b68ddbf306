"""Model fitting: balanced logistic regression, two tree families, seeded
search, cross-validation and the choice of a champion.

The preparation is fitted inside each training fold, and a fold's prepared
rows are cached once for all models tried on it. Scores of all folds are judged
together by the grouped metrics in ``ranking``.
"""

from __future__ import annotations

import math
import random
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from functools import reduce
from multiprocessing.pool import ThreadPool
from statistics import mean, stdev

from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.operators.newton import NewtonLogistic
from loanloom.operators.prepare import FEATURES, ColumnPreparation, build_pipeline, get_feature_names
from loanloom.operators.ranking import (
    best_f1_threshold,
    fold_summary,
    ranking_metrics,
)
from loanloom.operators.sampling import stratified_folds
from loanloom.session import cut_lineage, drop_tables, ensure_checkpoint_dir

WEIGHT = "_weight"
SCORE = "score"


class PositiveScore(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Second entry of the probability vector as a plain column."""

    outputCol = Param(Params._dummy(), "outputCol", "score column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, outputCol: str = SCORE):
        super().__init__()
        self._setDefault(outputCol=SCORE)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        score = vector_to_array("probability")[1]
        return dataset.withColumn(self.getOrDefault(self.outputCol), score)


class AveragePrecisionEvaluator(Evaluator, DefaultParamsReadable, DefaultParamsWritable):
    """Step-rule average precision of a score column, for model selection."""

    scoreCol = Param(Params._dummy(), "scoreCol", "score column", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, scoreCol: str = SCORE, labelCol: str = "TARGET"):
        super().__init__()
        self._setDefault(scoreCol=SCORE, labelCol="TARGET")
        self._set(**self._input_kwargs)

    def _evaluate(self, dataset: DataFrame) -> float:
        score, label = self.getOrDefault(self.scoreCol), self.getOrDefault(self.labelCol)
        found = ranking_metrics(dataset, score, label).first()
        value = found["average_precision"] if found else None
        return 0.0 if value is None else value

    def isLargerBetter(self) -> bool:
        return True


@dataclass(frozen=True)
class ClassCounts:
    negatives: int
    positives: int

    @property
    def rows(self) -> int:
        return self.negatives + self.positives


def class_counts(df: DataFrame, label: str) -> ClassCounts:
    y = F.col(label).cast("double")
    seen = df.agg(F.count_if(y == 0.0).alias("neg"), F.count_if(y == 1.0).alias("pos")).first()
    if not seen["neg"] or not seen["pos"]:
        raise ValueError(f"{label} needs rows of both classes")
    return ClassCounts(seen["neg"], seen["pos"])


def balanced_weight(df: DataFrame, label: str, counts: ClassCounts) -> DataFrame:
    """rows / (2 · rows of the class)."""
    positive = F.lit(counts.rows / (2.0 * counts.positives))
    negative = F.lit(counts.rows / (2.0 * counts.negatives))
    return df.withColumn(WEIGHT, F.when(F.col(label) == 1, positive).otherwise(negative))


def positive_weight(df: DataFrame, label: str, counts: ClassCounts) -> DataFrame:
    """Positives weigh negatives / positives, negatives weigh 1."""
    ratio = F.lit(counts.negatives / counts.positives)
    return df.withColumn(WEIGHT, F.when(F.col(label) == 1, ratio).otherwise(F.lit(1.0)))


@dataclass(frozen=True)
class Family:
    """A kind of model: how to weigh rows, build it, and draw its parameters."""

    name: str
    weigh: Callable[[DataFrame, str, ClassCounts], DataFrame]
    build: Callable[[str, ClassCounts, dict], Estimator]
    draw: Callable[[random.Random], dict] | None = None
    #: The parameter that says how many trees a model has.
    trees: str | None = None


def _logistic(label: str, counts: ClassCounts, params: dict) -> Estimator:
    # the penalty of a summed loss with C = 1, for a loss that is averaged
    return NewtonLogistic(
        featuresCol=FEATURES,
        labelCol=label,
        weightCol=WEIGHT,
        **{"regParam": 1.0 / counts.rows, **params},
    )


def _boosted(label: str, counts: ClassCounts, params: dict) -> Estimator:
    return GBTClassifier(
        featuresCol=FEATURES, labelCol=label, weightCol=WEIGHT, seed=42, **params
    )


def _forest(label: str, counts: ClassCounts, params: dict) -> Estimator:
    return RandomForestClassifier(
        featuresCol=FEATURES, labelCol=label, weightCol=WEIGHT, seed=42, **params
    )


def _log_uniform(rng: random.Random, low: float, high: float) -> float:
    return math.exp(rng.uniform(math.log(low), math.log(high)))


# Fixed values in the two draws: the searched ranges.
def draw_boosted(rng: random.Random, trees: tuple[int, int] = (100, 1000)) -> dict:
    leaves = rng.randint(20, 300)
    return {
        "maxDepth": math.ceil(math.log2(leaves)),
        "minInstancesPerNode": rng.randint(10, 100),
        "stepSize": _log_uniform(rng, 0.01, 0.3),
        "featureSubsetStrategy": f"{rng.uniform(0.5, 1.0):.6f}",
        "subsamplingRate": rng.uniform(0.5, 1.0),
        "maxIter": rng.randint(*trees),
    }


def draw_forest(rng: random.Random, trees: tuple[int, int] = (100, 1000)) -> dict:
    return {
        "maxDepth": rng.randint(3, 10),
        "minInstancesPerNode": rng.randint(1, 10),
        "featureSubsetStrategy": f"{rng.uniform(0.5, 1.0):.6f}",
        "subsamplingRate": rng.uniform(0.5, 1.0),
        "numTrees": rng.randint(*trees),
    }


LOGISTIC = Family("logistic", balanced_weight, _logistic)
BOOSTED = Family("boosted", positive_weight, _boosted, draw_boosted, "maxIter")
FOREST = Family("forest", positive_weight, _forest, draw_forest, "numTrees")


@contextmanager
def cached(
    df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK
) -> Iterator[DataFrame]:
    df = df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


def dealt(df: DataFrame) -> DataFrame:
    """Rows in at most as many partitions as the cluster has cores. At each level of
    each tree a partition moves its statistics of all nodes, so more partitions only
    move more of them; a fit moves the same whatever the number of rows."""
    return df.coalesce(df.sparkSession.sparkContext.defaultParallelism)


#: Bytes that a tree fit keeps for a row: the number of the bin of each feature, and
#: label, weight, prediction and sample beside them. A vector holds doubles.
BIN_BYTES, ROW_BYTES, VECTOR_BYTES = 4, 250, 8


def storage_bytes(spark: SparkSession) -> int:
    """Memory for kept rows on all executors; the driver's counts only where it is
    its own executor."""
    driver = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().blockManagerId().hostPort()
    found, entries = {}, spark._jsc.sc().getExecutorMemoryStatus().iterator()
    while entries.hasNext():
        entry = entries.next()
        found[entry._1()] = entry._2()._1()
    return sum(m for place, m in found.items() if place != driver) or found[driver]


def fits_at_once(spark: SparkSession, sizes: list[tuple[int, int]], parallelism: int) -> int:
    """As many tree fits as have room in memory for the binned rows that they read at
    each level of each tree, from 1 to ``parallelism``. Fits without room push out each
    other's rows, to read and decode them from disk at each level. ``sizes`` are rows
    and features of the tables to fit on."""
    own = max(rows * (BIN_BYTES * features + ROW_BYTES) for rows, features in sizes)
    return max(1, min(parallelism, storage_bytes(spark) * 4 // 5 // own))


def vectors_level(spark: SparkSession, sizes: list[tuple[int, int]], parallelism: int) -> StorageLevel:
    """Where vectors of training rows are kept: a fit reads them a few times in all, so
    they leave the memory to binned rows unless there is room for both."""
    vectors = sum(rows * (VECTOR_BYTES * features + ROW_BYTES) for rows, features in sizes)
    binned = max(rows * (BIN_BYTES * features + ROW_BYTES) for rows, features in sizes)
    room = storage_bytes(spark) * 4 // 5 >= vectors + parallelism * binned
    return StorageLevel.MEMORY_AND_DISK if room else StorageLevel.DISK_ONLY


def fit_model(
    df: DataFrame,
    family: Family,
    label: str,
    params: dict | None = None,
    beside: list[str] | None = None,
    keep: list[str] | None = None,
    drop: list[str] | None = None,
) -> PipelineModel:
    """Preparation, model and score column as one fitted chain over raw rows."""
    preparation = build_pipeline(drop, [label, *(beside or [])], keep).fit(df)
    counts = class_counts(df, label)
    weighed, level = family.weigh(preparation.transform(df), label, counts), StorageLevel.MEMORY_AND_DISK
    if family.trees:
        weighed = dealt(weighed)
        level = vectors_level(df.sparkSession, [(counts.rows, len(get_feature_names(preparation)))], 1)
    with cached(weighed, level) as train:
        model = family.build(label, counts, params or {}).fit(train)
    return PipelineModel(stages=[*preparation.stages, model, PositiveScore()])


@dataclass
class CrossValidation:
    """Out-of-fold scores and the metrics of every fold."""

    scores: DataFrame
    folds: DataFrame

    @property
    def summary(self) -> DataFrame:
        return fold_summary(
            self.folds, ["auc_pr", "auc_roc", "f1", "precision", "recall"]
        )


@dataclass
class PreparedFold:
    """Training and left-out rows of a fold as feature vectors; the preparation
    was fitted on the training rows. The left-out rows are stored; the training rows
    are prepared when they are read, so a search keeps them while it fits."""

    fold: int
    counts: ClassCounts
    train: DataFrame
    valid: DataFrame
    features: int = 0


def _sizes(folds: list[PreparedFold]) -> list[tuple[int, int]]:
    return [(f.counts.rows, f.features) for f in folds]


def prepare_folds(
    df: DataFrame,
    id_col: str,
    label: str,
    folds: int = 5,
    drop: list[str] | None = None,
    seed: int = 42,
) -> list[PreparedFold]:
    """The rows of every fold, prepared. Steps that learn nothing run once; what
    the preparations learn comes from the same passes for all folds. Each row's vector
    is stored once, in the fold that leaves it out; the training rows of a fold are
    most of all rows, and are prepared from the one table that all folds share."""
    numbered = stratified_folds(df, id_col, label, folds, seed, "fold")
    *steps, columns = build_pipeline(drop, [id_col, label, "fold"]).getStages()
    plain = cut_lineage(Pipeline(stages=steps).fit(numbered).transform(numbered))
    assert isinstance(columns, ColumnPreparation)
    others = [[g for g in range(folds) if g != fold] for fold in range(folds)]
    models = columns.fit_groups(plain.where("fold IS NOT NULL"), "fold", others)
    seen = {
        r["fold"]: (r["neg"], r["pos"])
        for r in plain.groupBy("fold")
        .agg(
            F.count_if(F.col(label).cast("double") == 0.0).alias("neg"),
            F.count_if(F.col(label).cast("double") == 1.0).alias("pos"),
        )
        .collect()
    }

    def prepared(fold: int) -> PreparedFold:
        counts = ClassCounts(*(sum(seen[g][i] for g in others[fold] if g in seen) for i in (0, 1)))
        if not counts.negatives or not counts.positives:
            raise ValueError(f"{label} needs rows of both classes")
        held = F.col("fold") == fold
        train, valid = (models[fold].transform(plain.where(c)) for c in (~held, held))
        features = len(models[fold].feature_names)
        return PreparedFold(fold, counts, train, cut_lineage(valid), features)

    with ThreadPool(folds) as pool:
        return pool.map(prepared, range(folds))


def cross_validate(
    df: DataFrame,
    family: Family,
    id_col: str,
    label: str,
    folds: int = 5,
    params: dict | None = None,
    drop: list[str] | None = None,
    seed: int = 42,
    parallelism: int = 5,
) -> CrossValidation:
    """Fit on all folds but one and score the one left out, for every fold.
    ``parallelism`` folds share the cluster at a time."""

    def score_fold(part: PreparedFold) -> DataFrame:
        with cached(family.weigh(part.train, label, part.counts)) as train:
            model = family.build(label, part.counts, params or {}).fit(train)
        scored = PositiveScore().transform(model.transform(part.valid))
        return scored.select(
            id_col, F.col(label).cast("int").alias(label), F.lit(part.fold).alias("fold"), SCORE
        )

    parts = prepare_folds(df, id_col, label, folds, drop, seed)
    with ThreadPool(parallelism) as pool:
        scored = pool.map(score_fold, parts)
    scores = cut_lineage(reduce(DataFrame.unionByName, scored))
    return CrossValidation(scores, fold_metrics(scores, label))


def fold_metrics(scores: DataFrame, label: str, fold_col: str = "fold") -> DataFrame:
    """Per fold: average precision, ROC-AUC, and precision, recall and F1 at
    the fold's own best threshold."""
    ranked = ranking_metrics(scores, SCORE, label, [fold_col])
    best = best_f1_threshold(scores, SCORE, label, [fold_col])
    return ranked.join(best, fold_col).select(
        fold_col,
        "size",
        F.col("average_precision").alias("auc_pr"),
        F.col("roc_auc").alias("auc_roc"),
        "threshold",
        "precision",
        "recall",
        "f1",
    )


#: Numbers of trees at which trials are compared, and one of how many goes on.
RUNGS = (10, 30, 100, 300, 1000)
GOES_ON = 3


@dataclass
class Trial:
    """A parameter set, with the number of trees that was best, the average
    precision of its folds there and their mean. ``drawn`` is the number of trees
    drawn, ``rungs`` the means at the numbers that were tried."""

    family: str
    params: dict
    auc_pr: float
    folds: list[float] = field(default_factory=list)
    drawn: int | None = None
    rungs: dict[int, float] = field(default_factory=dict)


def draw_trials(family: Family, trials: int, seed: int = 42, **ranges) -> list[dict]:
    """A seeded list of parameter sets; the same seed draws the same list."""
    rng = random.Random(seed)
    return [family.draw(rng, **ranges) for _ in range(trials)]


def fold_scores(
    folds: list[PreparedFold],
    family: Family,
    candidates: dict[int, dict],
    label: str,
    parallelism: int,
) -> dict[int, list[float]]:
    """Average precision of every parameter set on every fold. Each fit writes the
    scores of the rows left out, and all are judged in one job."""
    spark = folds[0].train.sparkSession
    base = f"{ensure_checkpoint_dir(spark)}/scores-{uuid.uuid4().hex}"
    paths = []

    def fit(part: tuple[int, PreparedFold]) -> str:
        number, fold = part
        model = family.build(label, fold.counts, candidates[number]).fit(fold.train)
        scored = PositiveScore().transform(model.transform(fold.valid))
        path = f"{base}/{number}-{fold.fold}"
        scored.select(
            F.lit(number).alias("trial"), F.lit(fold.fold).alias("fold"), F.col(label).alias("y"), SCORE
        ).write.parquet(path)
        return path

    # the longest fits first
    order = sorted(candidates, key=lambda i: -candidates[i].get("maxDepth", 0))
    with ThreadPool(fits_at_once(spark, _sizes(folds), parallelism)) as pool:
        paths = pool.map(fit, [(i, f) for i in order for f in folds], chunksize=1)
    judged = ranking_metrics(spark.read.parquet(*paths), SCORE, "y", ["trial", "fold"])
    found = {(r["trial"], r["fold"]): r["average_precision"] for r in judged.collect()}
    drop_tables(spark, base)
    return {i: [found.get((i, f.fold)) or 0.0 for f in folds] for i in candidates}


def _raised(before: list[float], after: list[float]) -> bool:
    """Is the mean gain over the folds more than its standard error?"""
    if len(before) < 2:
        return not before or after[0] > before[0]
    gains = [b - a for a, b in zip(before, after, strict=True)]
    return mean(gains) > stdev(gains) / math.sqrt(len(gains))


def staged_search(
    folds: list[PreparedFold],
    family: Family,
    candidates: list[dict],
    label: str,
    parallelism: int = 8,
    rungs: tuple[int, ...] = RUNGS,
    goes_on: int = GOES_ON,
) -> list[Trial]:
    """The trials, best first, by mean average precision over the folds.

    A boosted model of 1,000 trees begins with those of the model of 100, and a
    forest of 100 is a smaller sample of the same, so trials are compared with few
    trees first: at each rung one in ``goes_on`` goes on to more trees, unless the
    last rung gave it nothing. A trial counts with the number of trees at which it
    was best, never more than it drew; so no fit is longer than it has to be, and
    the many that are no good are short.
    """
    level = vectors_level(folds[0].train.sparkSession, _sizes(folds), parallelism)
    weighed = [
        replace(f, train=dealt(family.weigh(f.train, label, f.counts)).persist(level))
        for f in folds
    ]
    trials = [
        Trial(family.name, dict(p), -1.0, drawn=p[family.trees]) for p in candidates
    ]
    alive = set(range(len(trials)))
    try:
        for rung in sorted(rungs):
            size = {i: min(rung, trials[i].drawn) for i in alive}
            asked = {i: {**candidates[i], family.trees: size[i]} for i in alive}
            if not asked:
                break
            found = fold_scores(weighed, family, asked, label, parallelism)
            better = set()
            for i, scores in found.items():
                trial, score = trials[i], mean(scores)
                trial.rungs[size[i]] = score
                if _raised(trial.folds, scores):
                    better.add(i)
                if score > trial.auc_pr:
                    trial.auc_pr, trial.folds = score, scores
                    trial.params = asked[i]
            first = sorted(alive, key=lambda i: (-trials[i].rungs[size[i]], i))
            first = first[: math.ceil(len(first) / goes_on)]
            alive = {i for i in first if i in better and size[i] < trials[i].drawn}
    finally:
        for f in weighed:
            f.train.unpersist()
    return sorted(trials, key=lambda t: -t.auc_pr)


def search(
    df: DataFrame,
    family: Family,
    candidates: list[dict],
    id_col: str,
    label: str,
    folds: int = 5,
    drop: list[str] | None = None,
    seed: int = 42,
    parallelism: int = 8,
    rungs: tuple[int, ...] = RUNGS,
) -> list[Trial]:
    """``staged_search`` on the folds of ``df``."""
    prepared = prepare_folds(df, id_col, label, folds, drop, seed)
    return staged_search(prepared, family, candidates, label, parallelism, rungs)


def pick_champion(first: list[Trial], second: list[Trial]) -> Trial:
    """The better of two searches; the first family wins a tie."""
    return first[0] if first[0].auc_pr >= second[0].auc_pr else second[0]


def with_calibration(model: PipelineModel, calibrator) -> PipelineModel:
    return PipelineModel(stages=[*model.stages, calibrator])


def unfitted(label: str, family: Family, counts: ClassCounts, params: dict, drop=None) -> Pipeline:
    """The same chain unfitted, for use with Spark's own model selection; rows
    must already carry their weight column."""
    steps = build_pipeline(drop, [label, WEIGHT]).getStages()
    return Pipeline(stages=[*steps, family.build(label, counts, params), PositiveScore()])
