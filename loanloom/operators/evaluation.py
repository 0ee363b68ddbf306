"""Judging a fitted model: calibration, subgroups, attributions, scoring."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.functions.scalars import at_least, hash_order
from loanloom.operators.isotonic import isotonic_blocks
from loanloom.operators.prepare import FEATURES, get_feature_names
from loanloom.operators.quality import ColumnRule, split_valid
from loanloom.operators.ranking import ranking_metrics
from loanloom.operators.sampling import hash_sample
from loanloom.operators.training import SCORE, PositiveScore
from loanloom.session import cut_lineage

CALIBRATED = "probability_of_default"
MEMBERSHIPS = "_memberships"


def fit_calibration(
    df: DataFrame,
    score: str,
    label: str,
    output: str = CALIBRATED,
) -> IsotonicRegressionModel:
    """Isotonic regression of the label on the score, of all rows. Equal scores are
    merged into one weighted point, points are pooled in the cluster, and Spark's
    own model is made of the ends of the blocks that are left."""
    merged = (
        df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(score).cast("double").alias("_score"))
        .agg(
            F.sum(F.col(label).cast("double")).alias("_total"),
            F.count(F.lit(1)).cast("double").alias("_rows"),
        )
    )
    blocks = cut_lineage(isotonic_blocks(cut_lineage(merged), "_score", "_total", "_rows"))
    # either end of a block with half of its weight; one point twice is one point
    ends = blocks.select(
        F.explode(F.array("low", "high")).alias(score),
        F.col("value").alias("_rate"),
        (F.col("weight") / 2).alias("_rows"),
    )
    return IsotonicRegression(
        featuresCol=score, labelCol="_rate", weightCol="_rows", predictionCol=output
    ).fit(ends)


@dataclass(frozen=True)
class Subgroup:
    group: str
    category: str
    member: Column


def default_subgroups(df: DataFrame) -> list[Subgroup]:
    """Gender, age band and contract type, for the columns that exist."""
    # Categories, age limits and the length of a year.
    groups = []
    if "CODE_GENDER" in df.columns:
        groups += [Subgroup("Gender", g, F.col("CODE_GENDER") == g) for g in ("M", "F")]
    if "DAYS_BIRTH" in df.columns:
        age = -F.col("DAYS_BIRTH") / F.lit(365.25)
        groups += [
            Subgroup("Age", "Young (<30)", age < 30),
            Subgroup("Age", "Middle (30-50)", (age >= 30) & (age < 50)),
            Subgroup("Age", "Senior (>=50)", age >= 50),
        ]
    if "NAME_CONTRACT_TYPE" in df.columns:
        groups += [
            Subgroup("Contract", c, F.col("NAME_CONTRACT_TYPE") == c)
            for c in ("Cash loans", "Revolving loans")
        ]
    return groups


def add_memberships(
    df: DataFrame, subgroups: list[Subgroup], output: str = MEMBERSHIPS
) -> DataFrame:
    """The (group, category) pairs of every row as one array column."""
    pairs = [
        F.when(
            s.member,
            F.struct(F.lit(s.group).alias("group"), F.lit(s.category).alias("category")),
        )
        for s in subgroups
    ]
    empty = "array<struct<group: string, category: string>>"
    return df.withColumn(output, F.array_compact(F.array(*pairs)).cast(empty))


def membership_metrics(
    df: DataFrame, score: str, label: str, memberships: str = MEMBERSHIPS
) -> DataFrame:
    """Ranking metrics per (group, category), in one job."""
    rows = df.select(F.col(score).alias(SCORE), F.col(label).alias("_y"), F.inline(memberships))
    return ranking_metrics(rows, SCORE, "_y", ["group", "category"])


def subgroup_metrics(
    df: DataFrame, score: str, label: str, subgroups: list[Subgroup]
) -> DataFrame:
    """Size, positive rate, ROC-AUC and average precision per subgroup; empty
    subgroups are absent."""
    return membership_metrics(add_memberships(df, subgroups), score, label)


def _classifier(model: PipelineModel):
    for stage in model.stages:
        if hasattr(stage, "numClasses"):
            return stage
    raise ValueError("the chain holds no classifier")


def prepared(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Rows with the feature vector, before the classifier."""
    for stage in model.stages:
        if hasattr(stage, "numClasses"):
            break
        df = stage.transform(df)
    return df


def linear_contributions(model: PipelineModel, df: DataFrame, id_col: str) -> DataFrame:
    """(id, feature, contribution) of a logistic model: coefficient times the
    distance of the feature from its mean over ``df``."""
    classifier = _classifier(model)
    if not isinstance(classifier, LogisticRegressionModel):
        raise TypeError("contributions need a logistic model")
    rows = prepared(model, df).select(id_col, FEATURES)
    means = rows.agg(Summarizer.mean(F.col(FEATURES)).alias("m")).first()["m"].toArray()
    weights = classifier.coefficients.toArray()
    names = get_feature_names(model)
    shift = F.array(*[F.lit(float(m)) for m in means])
    slope = F.array(*[F.lit(float(w)) for w in weights])
    label = F.array(*[F.lit(n) for n in names])
    exploded = rows.select(id_col, F.posexplode(vector_to_array(FEATURES)).alias("i", "x"))
    place = F.col("i") + 1
    return exploded.select(
        id_col,
        F.element_at(label, place).alias("feature"),
        ((F.col("x") - F.element_at(shift, place)) * F.element_at(slope, place)).alias(
            "contribution"
        ),
    )


def permutation_importance(
    model: PipelineModel, df: DataFrame, id_col: str, label: str, n_sample: int = 2000, seed: int = 42
) -> DataFrame:
    """(feature, importance): fall of the average precision on a fixed-size
    sample when one feature takes the values of other rows. All features are
    scored in one job; only the sample is prepared."""
    sample = cut_lineage(prepared(model, hash_sample(df, id_col, n_sample, seed)))
    base = sample.select(
        F.col(id_col).alias("id"), F.col(label).alias("y"), vector_to_array(FEATURES).alias("x")
    )
    numbered = base.withColumn(
        "here", F.row_number().over(Window.orderBy(hash_order(F.col("id"), seed + 1), "id"))
    )
    donors = base.select(
        F.row_number()
        .over(Window.orderBy(hash_order(F.col("id"), seed + 2), "id"))
        .alias("here"),
        F.col("x").alias("donor"),
    )
    names = get_feature_names(model)
    # numbering leaves the sample in one partition; it is dealt before it is multiplied
    cores = df.sparkSession.sparkContext.defaultParallelism
    paired = numbered.join(donors, "here").repartition(cores, "here").select(
        "id", "y", "x", "donor", F.explode(F.sequence(F.lit(0), F.lit(len(names)))).alias("j")
    )
    # j = number of features marks the untouched rows
    mixed = F.transform(
        "x",
        lambda v, i: F.when(i == F.col("j"), F.element_at("donor", i + 1)).otherwise(v),
    )
    rows = paired.select("j", "y", array_to_vector(mixed).alias(FEATURES))
    scored = PositiveScore().transform(_classifier(model).transform(rows))
    # scored once; the metrics read it several times
    scored = cut_lineage(scored.select("j", "y", SCORE))
    judged = ranking_metrics(scored, SCORE, "y", ["j"]).select("j", "average_precision")
    by_feature = {r["j"]: r["average_precision"] or 0.0 for r in judged.collect()}
    whole = by_feature.get(len(names), 0.0)
    found = [(n, float(whole - by_feature.get(j, 0.0))) for j, n in enumerate(names)]
    return df.sparkSession.createDataFrame(found, "feature string, importance double")


def top_attributions(
    model: PipelineModel,
    df: DataFrame,
    id_col: str,
    label: str,
    k: int = 10,
    n_sample: int = 2000,
    seed: int = 42,
) -> DataFrame:
    """The k features that move the score most on a fixed-size sample."""
    if isinstance(_classifier(model), LogisticRegressionModel):
        # a fixed number of rows, looked for once
        sample = cut_lineage(hash_sample(df, id_col, n_sample, seed))
        found = (
            linear_contributions(model, sample, id_col)
            .groupBy("feature")
            .agg(F.avg(F.abs("contribution")).alias("importance"))
        )
    else:
        found = permutation_importance(model, df, id_col, label, n_sample, seed)
    return found.orderBy(F.desc("importance"), "feature").limit(k)


def outcome_examples(
    model: PipelineModel,
    df: DataFrame,
    id_col: str,
    label: str,
    threshold: float = 0.5,
    n_sample: int = 2000,
    seed: int = 42,
) -> DataFrame:
    """(outcome, id, feature, contribution) for one true positive, one true
    negative and one false positive of the sample: the lowest id of each."""
    # a fixed number of rows, looked for once
    sample = cut_lineage(hash_sample(df, id_col, n_sample, seed))
    guess = F.col(SCORE) >= threshold
    truth = F.col(label) == 1
    outcome = (
        F.when(truth & guess, "TP").when(~truth & ~guess, "TN").when(~truth & guess, "FP")
    )
    chosen = (
        model.transform(sample)
        .select(id_col, outcome.alias("outcome"))
        .where("outcome is not null")
        .groupBy("outcome")
        .agg(F.min(id_col).alias(id_col))
    )
    return linear_contributions(model, sample, id_col).join(F.broadcast(chosen), id_col).select(
        "outcome", id_col, "feature", "contribution"
    )


def score_batch(
    model: PipelineModel,
    rows: DataFrame,
    id_col: str,
    threshold: float,
    contract: list[ColumnRule] | None = None,
    probability: str = CALIBRATED,
) -> tuple[DataFrame, DataFrame | None]:
    """(id, probability, decision) for valid rows, and the rejected rows with
    their errors when a contract is given."""
    rejected = None
    if contract is not None:
        rows, rejected = split_valid(rows, contract)
    scored = model.transform(rows).select(
        id_col, F.col(probability), at_least(F.col(probability), threshold).alias("decision")
    )
    return scored, rejected
