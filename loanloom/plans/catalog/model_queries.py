"""Queries that fit models.

What a fit finds has no SQL counterpart; what must hold of it has: sizes of the
folds, the sum of contributions, which rows are scored or rejected, equal scores
of a stored model, and isotonic values of a score with few levels.

The applicants are customers; the features are all columns of the wide table; the
label is a negative balance. Fits and searches run with the operators' own folds,
ranges and parameters; a search tries ``TRIALS`` parameter sets of each family.
"""

from __future__ import annotations

import json
import uuid

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.operators import evaluation, newton, prepare, training
from loanloom.operators import quality as q
from loanloom.operators.ranking import cost_sweep, find_optimal_threshold
from loanloom.operators.sampling import hash_sample, stratified_folds, stratified_parts
from loanloom.plans import modelling
from loanloom.plans.catalog.base import comparable, query, table
from loanloom.plans.catalog.credit_view import loan_sql, loan_table
from loanloom.plans.catalog.wide import AGGREGATES, MAIN_COLUMNS, TEXT_COLUMNS, wide
from loanloom.session import cut_lineage, ensure_checkpoint_dir
from loanloom.sources.stores import load_registered, load_stages, register_model, save_stages

ID, LABEL = "SK_ID_CURR", "TARGET"


def applicants(spark: SparkSession, folder: str) -> DataFrame:
    """The wide table, stored once because every fit reads it several times."""
    return cut_lineage(wide(spark, folder))


@query("T1 T2 R7 A27")
def logistic_cv(spark: SparkSession, folder: str) -> DataFrame:
    found = training.cross_validate(applicants(spark, folder), training.LOGISTIC, ID, LABEL)
    return comparable(found.folds, ["fold", "size"])


_FOLDS_SQL = f"""WITH {loan_sql("application_train")}, shuffled AS (
  SELECT SK_ID_CURR, CAST(TARGET AS INTEGER) AS y, row_number() OVER (PARTITION BY TARGET
      ORDER BY md5(CAST(SK_ID_CURR AS VARCHAR) || '-42'), SK_ID_CURR) AS place,
    count(*) OVER (PARTITION BY TARGET) AS n FROM application_train)"""


@query(
    "T1 T2 R7",
    f"""{_FOLDS_SQL}, f AS (SELECT *, CAST({" + ".join(
        f"CAST(place > n * {i} // 5 AS INTEGER)" for i in range(1, 5))} AS INTEGER) AS fold
      FROM shuffled)
    SELECT fold, count(*) AS "size", CAST(sum(y) AS BIGINT) AS positives, min(SK_ID_CURR) AS low,
      max(SK_ID_CURR) AS high, true AS once, true AS agrees FROM f GROUP BY fold""",
)
def out_of_fold_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Every row is scored once, in its own fold, and the area under the curve of
    a fold is the one that the mean ranks of its positive rows give."""
    found = training.cross_validate(applicants(spark, folder), training.LOGISTIC, ID, LABEL)
    scores = found.scores.select(ID, LABEL, "fold", training.SCORE)
    once = scores.count() == scores.select(ID).distinct().count()
    in_fold = Window.partitionBy("fold")
    ties = Window.partitionBy("fold", training.SCORE)
    place = F.rank().over(in_fold.orderBy(training.SCORE)) + (F.count(F.lit(1)).over(ties) - 1) / 2
    ranked = scores.select("fold", LABEL, place.alias("place")).groupBy("fold")
    ranked = ranked.agg(
        F.sum(F.col("place") * F.col(LABEL)).alias("sum"),
        F.sum(LABEL).alias("p"),
        F.count(F.lit(1)).alias("n"),
    )
    p, n = F.col("p"), F.col("n")
    area = (F.col("sum") - p * (p + 1) / 2) / (p * (n - p))
    agrees = ranked.select("fold", area.alias("area")).join(found.folds, "fold")
    agrees = agrees.select("fold", (F.abs(F.col("area") - F.col("auc_roc")) < 1e-9).alias("agrees"))
    sizes = scores.groupBy("fold").agg(
        F.count(F.lit(1)).alias("size"),
        F.sum(LABEL).cast("bigint").alias("positives"),
        F.min(ID).alias("low"),
        F.max(ID).alias("high"),
    )
    return sizes.withColumn("once", F.lit(once)).join(agrees, "fold")


@query(
    "T1 T2",
    f"""WITH {loan_sql("application_train")}, n AS (SELECT count(*) AS n, sum(TARGET) AS p
      FROM application_train)
    SELECT i AS "at", 0.0e0 AS gradient, n AS "rows", CAST(p AS BIGINT) AS positives
    FROM n, range(0, 133) AS t(i)""",
)
def logistic_gradient(spark: SparkSession, folder: str) -> DataFrame:
    """The gradient of the penalised loss at the fitted coefficients, per row and
    in order of the features, the intercept last: it fixes every coefficient,
    because the objective has one minimum."""
    rows, model = _fitted(spark, folder)
    counts = training.class_counts(rows, LABEL)
    fitted = evaluation._classifier(model)
    ready = training.balanced_weight(evaluation.prepared(model, rows), LABEL, counts)
    ready = training.PositiveScore().transform(fitted.transform(ready))
    error = F.col(training.WEIGHT) * (F.col(training.SCORE) - F.col(LABEL))
    values = F.concat(vector_to_array(prepare.FEATURES), F.array(F.lit(1.0)))
    sums = ready.select(F.posexplode(F.transform(values, lambda x: x * error)).alias("at", "v"))
    sums = sums.groupBy("at").agg(F.sum("v").alias("v"))
    penalty = F.element_at(
        F.array(*[F.lit(float(c)) for c in [*fitted.coefficients, 0.0]]), F.col("at") + 1
    )
    gradient = F.round((F.col("v") + penalty) / counts.rows, 6) + 0.0
    return sums.select(
        F.col("at").cast("bigint").alias("at"),
        gradient.alias("gradient"),
        F.lit(counts.rows).cast("bigint").alias("rows"),
        F.lit(counts.positives).cast("bigint").alias("positives"),
    )


@query("T2 R4 A25 S15")
def baseline_run(spark: SparkSession, folder: str) -> DataFrame:
    """Cross-validated baseline: summary and pooled confusion counts."""
    run = modelling.train_baseline(applicants(spark, folder), ID, LABEL)
    counts = run.confusion.first().asDict()
    row = {**run.summary, "threshold": run.threshold, **{k: float(v) for k, v in counts.items()}}
    return spark.createDataFrame([(k, float(v)) for k, v in row.items()], "name string, value double")


#: Parameter sets tried of each family; folds and ranges are the operators' own.
TRIALS = 3


@query(
    "T3 T4 T5 T6 T7",
    f"""{_FOLDS_SQL}, f AS (SELECT *, CAST({" + ".join(
        f"CAST(place > n * {i} // 5 AS INTEGER)" for i in range(1, 5))} AS INTEGER) AS fold
      FROM shuffled), sizes AS (SELECT fold, count(*) AS "size", CAST(sum(y) AS BIGINT) AS positives
      FROM f GROUP BY fold)
    SELECT family, CAST(place AS INTEGER) AS place, fold, "size", positives, true AS scored,
      true AS mean_of_folds, true AS trees_drawn, true AS best_of_rungs, true AS best_first,
      true AS champion_best, true AS refit
    FROM sizes, (VALUES ('boosted'), ('forest')) AS a(family), range(1, {TRIALS} + 1) AS b(place)""",
)
def boosted_champion(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold of a search: each trial has a score for each fold, which are
    those of the stratified folds; it counts with the mean of them, at the best of
    the rungs it reached and with no more trees than it drew from the searched range;
    trials are sorted; the champion is the better family's first, the first family's
    on a tie, and its refit has the number of trees that was best."""
    applied = applicants(spark, folder)
    run = modelling.train_champion(applied, ID, LABEL, trials=TRIALS)
    numbered = stratified_folds(applied, ID, LABEL, 5, 42, "fold")
    sizes = numbered.groupBy("fold").agg(
        F.count(F.lit(1)).alias("size"), F.sum(LABEL).cast("bigint").alias("positives")
    )
    first = {f: next(t for t in run.trials if t.family == f) for f in ("boosted", "forest")}
    wins = "boosted" if first["boosted"].auc_pr >= first["forest"].auc_pr else "forest"
    trees = {"boosted": "maxIter", "forest": "numTrees"}
    model = run.model.stages[-2]
    rows = []
    for family, name in trees.items():
        own = [t for t in run.trials if t.family == family]
        for place, t in enumerate(own, 1):
            for fold, score in enumerate(t.folds):
                rows.append(
                    (
                        family,
                        place,
                        fold,
                        0.0 < score <= 1.0,
                        abs(t.auc_pr - sum(t.folds) / len(t.folds)) < 1e-12,
                        100 <= t.drawn <= 1000 and t.params[name] <= t.drawn,
                        t.rungs[t.params[name]] == max(t.rungs.values()) == t.auc_pr,
                        place == 1 or own[place - 2].auc_pr >= t.auc_pr,
                        run.champion is first[wins],
                        model.getNumTrees == run.champion.params[trees[run.champion.family]],
                    )
                )
    names = "scored mean_of_folds trees_drawn best_of_rungs best_first champion_best refit".split()
    schema = "family string, place int, fold int, " + ", ".join(f"{n} boolean" for n in names)
    return spark.createDataFrame(rows, schema).join(F.broadcast(sizes), "fold")


def _fitted(spark: SparkSession, folder: str):
    rows = applicants(spark, folder)
    return rows, training.fit_model(rows, training.LOGISTIC, LABEL, None, [ID])


def _fitted_on_part(spark: SparkSession, folder: str):
    """Rows to score, rows to calibrate on, and a model fitted on the rest."""
    rows = applicants(spark, folder)
    parts = cut_lineage(stratified_parts(rows, ID, LABEL, [0.2, 0.2, 0.6]))
    train = parts.where("part = 2").drop("part")
    model = training.fit_model(train, training.LOGISTIC, LABEL, None, [ID])
    return parts.where("part = 0").drop("part"), parts.where("part = 1").drop("part"), model


@query("E1")
def isotonic_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Calibrated scores of rows that neither fit has seen."""
    rows, calibration, model = _fitted_on_part(spark, folder)
    calibrator = evaluation.fit_calibration(
        model.transform(calibration), training.SCORE, LABEL
    )
    scored = model.transform(rows).select(ID, LABEL, training.SCORE)
    return calibrator.transform(scored).select(
        ID, training.SCORE, evaluation.CALIBRATED
    )


@query(
    "E1",
    """WITH s AS (SELECT l_discount * 10.0 AS score, CAST(l_returnflag = 'R' AS INTEGER) AS y
      FROM lineitem),
    level AS (SELECT score, sum(y) AS pos, count(*) AS n,
      row_number() OVER (ORDER BY score) AS i FROM s GROUP BY score),
    span AS (SELECT a.i AS lo, b.i AS hi, (SELECT sum(pos) / CAST(sum(n) AS DOUBLE) FROM level
      WHERE i BETWEEN a.i AND b.i) AS mean FROM level a JOIN level b ON a.i <= b.i),
    below AS (SELECT l.i, span.lo, min(span.mean) AS least FROM level l
      JOIN span ON span.lo <= l.i AND span.hi >= l.i GROUP BY ALL)
    SELECT round(score, 6) + 0.0 AS score, round(max(least), 6) + 0.0 AS calibrated
    FROM level JOIN below USING (i) GROUP BY score""",
)
def isotonic_levels(spark: SparkSession, folder: str) -> DataFrame:
    """Isotonic values of a score with 11 levels: the largest over the lower
    ends of the least means of the ranges that hold the level."""
    rows = table(spark, folder, "lineitem").select(
        (F.col("l_discount") * 10.0).alias("score"), (F.col("l_returnflag") == "R").cast("int").alias("y")
    )
    calibrator = evaluation.fit_calibration(rows, "score", "y", "calibrated")
    return comparable(calibrator.transform(rows.select("score").distinct()))


@query(
    "E1",
    """WITH level AS (SELECT floor(l_extendedprice / 50) AS score,
        count(*) FILTER (WHERE l_returnflag = 'R') AS pos, count(*) AS n FROM lineitem GROUP BY 1),
    step AS (SELECT score, row_number() OVER w AS i, sum(pos) OVER w AS p, sum(n) OVER w AS n
      FROM level WINDOW w AS (ORDER BY score)),
    edge AS (SELECT i, p, n FROM step UNION ALL SELECT 0, 0, 0),
    least AS (SELECT a.i AS lo, b.i AS hi, min((b.p - a.p) / CAST(b.n - a.n AS DOUBLE)) OVER (
        PARTITION BY a.i ORDER BY b.i DESC ROWS UNBOUNDED PRECEDING) AS m
      FROM edge a JOIN edge b ON a.i < b.i)
    SELECT round(score, 6) + 0.0 AS score, round(max(m), 6) + 0.0 AS calibrated
    FROM step JOIN least ON hi = i GROUP BY score""",
)
def isotonic_many_levels(spark: SparkSession, folder: str) -> DataFrame:
    """The same for a score with a few thousand levels, pooled in many ranges."""
    rows = table(spark, folder, "lineitem").select(
        F.floor(F.col("l_extendedprice") / 50).cast("double").alias("score"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
    )
    calibrator = evaluation.fit_calibration(rows, "score", "y", "calibrated")
    return comparable(calibrator.transform(rows.select("score").distinct()))


@query("E2 E1 K7 R5 R6 A28 S10")
def evaluation_run(spark: SparkSession, folder: str) -> DataFrame:
    run = modelling.run_evaluation(applicants(spark, folder))
    rows = [(k, float(v)) for k, v in run.metrics.items() if v is not None]
    return spark.createDataFrame(rows, "name string, value double")


@query(
    "E2 S10",
    "SELECT 10 AS fn_cost, 1 AS fp_cost, true AS same, true AS cheapest",
)
def threshold_record(spark: SparkSession, folder: str) -> DataFrame:
    """The stored record of a threshold against the run that it came from: the
    same figures, and no threshold of the sweep is cheaper on the rows that it
    was chosen on."""
    path = f"{ensure_checkpoint_dir(spark)}/thresholds/{uuid.uuid4().hex}"
    run = modelling.run_evaluation(applicants(spark, folder), threshold_path=path)
    same = F.lit(True)
    names = {"optimal_threshold": "threshold", "precision": "precision", "recall": "recall", "f1": "f1"}
    for column, metric in names.items():
        same = same & F.col(column).eqNullSafe(F.lit(run.metrics[metric]).cast("double"))
    calibration = run.calibration.select(LABEL, evaluation.CALIBRATED)
    costs = cost_sweep(calibration, evaluation.CALIBRATED, LABEL)
    least = costs.agg(F.min("cost")).first()[0]
    chosen = costs.where(F.abs(F.col("threshold") - run.metrics["threshold"]) < 1e-9).first()
    record = spark.read.json(path)
    return record.select(
        F.col("fn_cost").cast("int").alias("fn_cost"),
        F.col("fp_cost").cast("int").alias("fp_cost"),
        same.alias("same"),
        F.lit(chosen["cost"] == least).alias("cheapest"),
    )


@query("E3 K1")
def attribution_top10(spark: SparkSession, folder: str) -> DataFrame:
    rows, model = _fitted(spark, folder)
    return evaluation.top_attributions(model, rows, ID, LABEL)


@query(
    "E3",
    f"""WITH {loan_sql("application_train")} SELECT SK_ID_CURR, 132 AS features, true AS same
    FROM application_train""",
)
def contribution_sums(spark: SparkSession, folder: str) -> DataFrame:
    """The contributions of a row add up to its margin above the mean margin."""
    rows, model = _fitted(spark, folder)
    score = F.col(training.SCORE)
    margin = F.log(score / (1 - score))
    scored = model.transform(rows).select(ID, margin.alias("margin"))
    sums = evaluation.linear_contributions(model, rows, ID).groupBy(ID)
    sums = sums.agg(F.sum("contribution").alias("total"), F.count(F.lit(1)).cast("int").alias("features"))
    mean = scored.agg(F.avg("margin").alias("mean"))
    near = F.abs(F.col("margin") - F.col("mean") - F.col("total")) < 1e-6 * (1 + F.abs("margin"))
    # one row beside each: the mean
    return sums.join(scored, ID).withColumn("mean", mean.scalar()).select(ID, "features", near.alias("same"))


@query("E3")
def permutation_top10(spark: SparkSession, folder: str) -> DataFrame:
    rows = applicants(spark, folder)
    model = training.fit_model(rows, training.BOOSTED, LABEL, None, [ID])
    return evaluation.top_attributions(model, rows, ID, LABEL)


@query("E4")
def outcome_examples(spark: SparkSession, folder: str) -> DataFrame:
    rows, model = _fitted(spark, folder)
    return evaluation.outcome_examples(model, rows, ID, LABEL)


# Fixed values of a small model that SQL can compute: (mean, spread), coefficient.
_KNOWN = {"AMT_INCOME_TOTAL": ((45000.0, 16384.0), 1.0), "DAYS_BIRTH": ((-16000.0, 4096.0), -0.5)}
_PLACED = {c: f"((CAST({c} AS DOUBLE) - ({m})) / {s})" for c, ((m, s), _) in _KNOWN.items()}


def _known_model(spark: SparkSession) -> PipelineModel:
    fitted = {
        "numeric": list(_KNOWN),
        "categorical": [],
        "medians": {c: m for c, ((m, _), _) in _KNOWN.items()},
        "scaling": {c: at for c, (at, _) in _KNOWN.items()},
        "modes": {},
    }
    columns = prepare.ColumnPreparationModel(fitted=json.dumps(fitted), passThrough=[ID, LABEL])
    slopes = np.array([slope for _, slope in _KNOWN.values()])
    logistic = newton.fixed_model(spark, slopes, 0.0, prepare.FEATURES, LABEL)
    return PipelineModel(stages=[columns, logistic, training.PositiveScore()])


@query(
    "E4",
    f"""WITH {loan_sql("application_train")}, s AS (SELECT SK_ID_CURR, TARGET AS y,
      {", ".join(f"{x} AS {c}" for c, x in _PLACED.items())} FROM application_train
      ORDER BY md5(CAST(SK_ID_CURR AS VARCHAR) || '-42'), SK_ID_CURR LIMIT 2000),
    judged AS (SELECT *, ({" + ".join(f"{slope} * {c}" for c, (_, slope) in _KNOWN.items())}) >= 0
      AS guess FROM s),
    chosen AS (SELECT CASE WHEN y = 1 AND guess THEN 'TP' WHEN y = 0 AND NOT guess THEN 'TN'
        WHEN y = 0 AND guess THEN 'FP' END AS outcome, min(SK_ID_CURR) AS SK_ID_CURR
      FROM judged GROUP BY 1 HAVING outcome IS NOT NULL)
    """
    + " UNION ALL ".join(
        f"""SELECT outcome, SK_ID_CURR, 'num__{c}' AS feature,
        round(({c} - (SELECT avg({c}) FROM s)) * ({slope}), 6) + 0.0 AS contribution
        FROM chosen JOIN s USING (SK_ID_CURR)"""
        for c, (_, slope) in _KNOWN.items()
    ),
)
def examples_of_known_model(spark: SparkSession, folder: str) -> DataFrame:
    """One row of each outcome with its contributions, of a model with given
    coefficients, whose scores SQL can compute."""
    rows = loan_table(spark, folder, "application_train")
    rows = rows.select(ID, F.col(LABEL).cast("int").alias(LABEL), *_KNOWN)
    found = evaluation.outcome_examples(_known_model(spark), rows, ID, LABEL)
    return comparable(found, [ID])


@query(
    "E2 E1 S14 T8 A28",
    f"""{_FOLDS_SQL}, unseen AS (SELECT s.*, count(*) OVER (PARTITION BY y) AS m FROM shuffled s
      WHERE place <= floor(0.4e0 * n + 0.5)),
    test AS (SELECT a.* FROM application_train a JOIN unseen USING (SK_ID_CURR)
      WHERE place <= floor(0.5e0 * m + 0.5)),
    g AS (SELECT 'Gender' AS "group", CODE_GENDER AS category FROM test WHERE CODE_GENDER IN ('M', 'F')
      UNION ALL SELECT 'Contract', NAME_CONTRACT_TYPE FROM test
      UNION ALL SELECT 'Age', CASE WHEN -DAYS_BIRTH / 365.25 < 30 THEN 'Young (<30)'
        WHEN -DAYS_BIRTH / 365.25 < 50 THEN 'Middle (30-50)' ELSE 'Senior (>=50)' END FROM test)
    SELECT "group", category, count(*) AS "size", true AS same_scores, true AS beats_cost_of_none
    FROM g GROUP BY ALL""",
)
def stored_champion_evaluation(spark: SparkSession, folder: str) -> DataFrame:
    """A forest is stored, loaded by name and judged on rows that it has not seen:
    sizes of the subgroups, whether the loaded model scores as the fitted one, and
    whether its threshold costs no more than rejecting or accepting every row."""
    rows = applicants(spark, folder)
    parts = cut_lineage(stratified_parts(rows, ID, LABEL, [0.4, 0.6]))
    unseen = parts.where("part = 0").drop("part")
    params = {"numTrees": 100, "maxDepth": 6, "subsamplingRate": 0.8, "featureSubsetStrategy": "sqrt"}
    fitted = training.fit_model(parts.where("part = 1").drop("part"), training.FOREST, LABEL, params, [ID])
    store = f"{ensure_checkpoint_dir(spark)}/champions/{uuid.uuid4().hex}"
    register_model(fitted, store, "champion", uuid.uuid4().hex, spark)
    loaded = load_registered(spark, store, "champion")
    run = modelling.run_evaluation(unseen, model=loaded, shares=(0.5, 0.5, 0.0))
    score = F.round(training.SCORE, 9)
    both = [m.transform(unseen).select(ID, score) for m in (fitted, loaded)]
    same = both[0].exceptAll(both[1]).isEmpty()
    calibration = run.calibration.agg(
        F.count_if(F.col(LABEL) == 1).alias("bad"), F.count_if(F.col(LABEL) == 0).alias("good")
    ).first()
    chosen = cost_sweep(
        run.calibration, evaluation.CALIBRATED, LABEL, thresholds=[run.metrics["threshold"]]
    ).first()["cost"]
    cheap = chosen <= min(10 * calibration["bad"], calibration["good"])
    return run.subgroups.select(
        "group", "category", "size", F.lit(same).alias("same_scores"), F.lit(cheap).alias("beats_cost_of_none")
    )


@query("B1 Q14")
def batch_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Valid rows with probability and decision, rejected rows with reasons. The
    threshold is the cheapest one on the calibration rows."""
    rows, calibration, model = _fitted_on_part(spark, folder)
    known = cut_lineage(model.transform(calibration).select(ID, LABEL, training.SCORE))
    calibrator = evaluation.fit_calibration(known, training.SCORE, LABEL)
    chosen = find_optimal_threshold(calibrator.transform(known), evaluation.CALIBRATED, LABEL)
    threshold = chosen.first()["threshold"]
    scored, rejected = evaluation.score_batch(
        training.with_calibration(model, calibrator), rows, ID, threshold, _SCORED_CONTRACT
    )
    return scored.withColumn("reasons", F.lit("")).unionByName(
        rejected.select(ID, F.concat_ws("; ", "errors").alias("reasons")),
        allowMissingColumns=True,
    )


_SCORED_CONTRACT = [
    q.ColumnRule(ID, T.IntegerType(), rules=[q.greater_than(0)]),
    q.ColumnRule("AMT_CREDIT", T.FloatType(), rules=[q.greater_than(0)]),
]


@query(
    "B1 Q14 K7",
    f"""{_FOLDS_SQL}, held AS (SELECT SK_ID_CURR FROM shuffled WHERE place <= floor(0.2e0 * n + 0.5))
    SELECT SK_ID_CURR, concat_ws('; ',
        CASE WHEN SK_ID_CURR <= 0 THEN 'SK_ID_CURR: greater_than(0)' END,
        CASE WHEN AMT_CREDIT IS NULL THEN 'AMT_CREDIT: not_nullable' END,
        CASE WHEN AMT_CREDIT <= 0 THEN 'AMT_CREDIT: greater_than(0)' END) AS reasons,
      SK_ID_CURR > 0 AND coalesce(AMT_CREDIT, 0) > 0 AS scored
    FROM application_train JOIN held USING (SK_ID_CURR)""",
)
def scored_or_rejected(spark: SparkSession, folder: str) -> DataFrame:
    """Each held-out row is scored, with a probability and the decision that
    follows from it, or rejected with its reasons."""
    rows, calibration, model = _fitted_on_part(spark, folder)
    calibrator = evaluation.fit_calibration(model.transform(calibration), training.SCORE, LABEL)
    threshold = 0.5
    scored, rejected = evaluation.score_batch(
        training.with_calibration(model, calibrator), rows, ID, threshold, _SCORED_CONTRACT
    )
    p = F.col(evaluation.CALIBRATED)
    right = p.between(0, 1) & (F.col("decision").cast("boolean") == (p >= threshold))
    return scored.select(ID, F.lit("").alias("reasons"), right.alias("scored")).unionByName(
        rejected.select(ID, F.concat_ws("; ", "errors").alias("reasons"), F.lit(False).alias("scored"))
    )


#: Numeric columns, their aggregates and the derived features, then the texts.
_PREPARED = [
    *[
        f"num__{c}"
        for c in [
            *[c for c in MAIN_COLUMNS if c not in [*TEXT_COLUMNS, ID, LABEL, "DAYS_EMPLOYED"]],
            *AGGREGATES,
            "IS_UNEMPLOYED",
            "CREDIT_INCOME_RATIO",
            "ANNUITY_INCOME_RATIO",
            "CREDIT_TERM",
            "DAYS_EMPLOYED_RATIO",
            "AGE_YEARS",
            "EXT_SOURCE_MEAN",
            "EXT_SOURCE_STD",
            "EXT_SOURCE_MISSING_COUNT",
            "WEEKDAY_SIN",
            "WEEKDAY_COS",
        ]
    ],
    *[f"cat__{c}" for c in TEXT_COLUMNS if c != "WEEKDAY_APPR_PROCESS_START"],
]


@query(
    "M5 M6 S12 S13",
    "SELECT * FROM (VALUES " + ", ".join(f"('{c}', true)" for c in _PREPARED)
    + ") AS t(feature, same)",
)
def preparation_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Does a saved and loaded preparation give the same features?"""
    rows = applicants(spark, folder)
    model = prepare.fit_pipeline(rows, LABEL, [ID])
    path = f"{ensure_checkpoint_dir(spark)}/preparation-{uuid.uuid4().hex}"
    save_stages(model, path)
    sample = cut_lineage(hash_sample(rows, ID, 100))
    same = prepare.same_output(model, load_stages(path), sample)
    names = prepare.get_feature_names(model)
    return spark.createDataFrame([(n, same) for n in names], "feature string, same boolean")
