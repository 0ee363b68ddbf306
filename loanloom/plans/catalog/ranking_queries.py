"""Queries on ranking metrics, thresholds, splits, leakage and drift."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.operators import drift, evaluation, leakage, prefix, ranking, sampling
from loanloom.plans.audit import run_audit
from loanloom.plans.catalog.base import comparable, query, rounded, table
from loanloom.plans.catalog.credit_view import loan_sql, loan_table
from loanloom.session import ensure_checkpoint_dir
from loanloom.sources.tables import read_table, write_table

ID, LABEL = "SK_ID_CURR", "TARGET"
_APP = f"WITH {loan_sql('application_train')}"


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with a nearly continuous and a tied score; the label is "returned".
    The continuous score is missing on line 7."""
    return table(spark, folder, "lineitem").select(
        F.when(F.col("l_linenumber") < 7, F.col("l_extendedprice") / 105000.0).alias("fine"),
        (F.col("l_discount") * 10.0).alias("tied"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        "l_linestatus",
        "l_quantity",
    )


_SCORED = """scored AS (SELECT
  CASE WHEN l_linenumber < 7 THEN l_extendedprice / 105000e0 END AS fine,
  l_discount * 10e0 AS tied, CAST(l_returnflag = 'R' AS INTEGER) AS y, l_linestatus, l_quantity
  FROM lineitem)"""


def _steps(score: str, group: str = "0") -> str:
    """Running counts by falling score, as every ranking metric needs them."""
    return f"""
    s AS (SELECT {group} AS g, {score} AS score, CAST(sum(y) AS DOUBLE) AS pos,
        CAST(sum(1 - y) AS DOUBLE) AS neg
      FROM scored WHERE {score} IS NOT NULL GROUP BY 1, 2),
    steps AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
        sum(pos) OVER (PARTITION BY g) AS p, sum(neg) OVER (PARTITION BY g) AS n
      FROM s WINDOW w AS (PARTITION BY g ORDER BY score DESC))"""


_AUC = "round(sum(neg * (tp + tp - pos) / 2) / (max(p) * max(n)), 6)"
_AP = "round(sum(pos * tp / (tp + fp)) / max(p), 6)"


@query(
    "R0",
    f"""WITH {_SCORED}, s AS (SELECT l_linestatus, fine, sum(y) AS y, sum(l_quantity) AS q
      FROM scored WHERE fine IS NOT NULL GROUP BY ALL)
    SELECT l_linestatus, round(fine, 6) AS fine, CAST(y AS BIGINT) AS y,
      q AS l_quantity, CAST(sum(y) OVER w AS BIGINT) AS run_y, sum(q) OVER w AS run_l_quantity,
      CAST(sum(y) OVER (PARTITION BY l_linestatus) AS BIGINT) AS total_y,
      sum(q) OVER (PARTITION BY l_linestatus) AS total_l_quantity
    FROM s WINDOW w AS (PARTITION BY l_linestatus ORDER BY fine)""",
)
def running_totals(spark: SparkSession, folder: str) -> DataFrame:
    found = prefix.running_totals(
        _scored(spark, folder), "fine", ["y", "l_quantity"], ["l_linestatus"]
    )
    return found.withColumn("fine", F.round("fine", 6))


@query(
    "R1",
    f"WITH {_SCORED}, {_steps('fine', 'l_linestatus')} SELECT g AS l_linestatus, {_AUC} AS roc_auc"
    " FROM steps GROUP BY g",
)
def roc_auc(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(ranking.roc_auc(_scored(spark, folder), "fine", "y", ["l_linestatus"]))


@query(
    "R2",
    f"WITH {_SCORED}, {_steps('tied', 'l_linestatus')} SELECT g AS l_linestatus,"
    f" {_AP} AS average_precision FROM steps GROUP BY g",
)
def average_precision(spark: SparkSession, folder: str) -> DataFrame:
    found = ranking.average_precision(_scored(spark, folder), "tied", "y", ["l_linestatus"])
    return comparable(found)


@query(
    "R3",
    f"""WITH {_SCORED}, {_steps("fine")}
    SELECT round(score, 6) AS threshold, round(tp / (tp + fp), 6) AS precision,
      round(tp / p, 6) AS recall FROM steps
    UNION ALL SELECT NULL, 1.0, 0.0""",
)
def pr_curve(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(ranking.pr_curve(_scored(spark, folder), "fine", "y"))


_F1_SQL = """c AS (SELECT *, tp / (tp + fp) AS pr, tp / p AS re FROM steps),
    f AS (SELECT *, coalesce(2 * pr * re / nullif(pr + re, 0), 0) AS f1 FROM c),
    best AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY f1 DESC, score) AS place FROM f)
    SELECT {0} round(score, 6) AS threshold, round(pr, 6) AS precision, round(re, 6) AS recall,
      round(f1, 6) AS f1 FROM best WHERE place = 1"""


@query("R4 T2", f"WITH {_SCORED}, {_steps('tied', 'l_linestatus')}, {_F1_SQL.format('g AS l_linestatus,')}")
def best_f1_threshold(spark: SparkSession, folder: str) -> DataFrame:
    found = ranking.best_f1_threshold(_scored(spark, folder), "tied", "y", ["l_linestatus"])
    return comparable(found)


_SWEEP = f"""WITH {_SCORED}, t AS (SELECT 1e-2 + 1e-2 * i AS threshold FROM range(99) r(i)),
    d AS (SELECT threshold, count(*) FILTER (y = 1 AND fine >= threshold) AS tp,
      count(*) FILTER (y = 0 AND fine >= threshold) AS fp,
      count(*) FILTER (y = 1 AND fine < threshold) AS fn
      FROM scored CROSS JOIN t GROUP BY threshold)
    SELECT round(threshold, 6) AS threshold, CAST(fn * 10 + fp AS DOUBLE) AS cost, tp, fp, fn,
      round(coalesce(tp / CAST(nullif(tp + fp, 0) AS DOUBLE), 0), 6) AS precision,
      round(coalesce(tp / CAST(nullif(tp + fn, 0) AS DOUBLE), 0), 6) AS recall,
      round(coalesce(2 * tp / CAST(nullif(2 * tp + fp + fn, 0) AS DOUBLE), 0), 6) AS f1
    FROM d"""


@query("R5 A26", _SWEEP)
def cost_threshold_sweep(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(ranking.cost_sweep(_scored(spark, folder), "fine", "y"), ["tp", "fp", "fn"])


@query("R5", f"SELECT * FROM ({_SWEEP}) ORDER BY cost, threshold LIMIT 1")
def optimal_threshold(spark: SparkSession, folder: str) -> DataFrame:
    found = ranking.find_optimal_threshold(_scored(spark, folder), "fine", "y")
    return comparable(found, ["tp", "fp", "fn"])


_EDGES = " + ".join(f"CAST(fine > CAST({i * 0.1!r} AS DOUBLE) AS INTEGER)" for i in range(1, 10))


@query(
    "R6",
    f"""WITH {_SCORED} SELECT l_linestatus, {_EDGES} AS bin, count(*) AS size,
      {rounded("avg(fine)")} AS mean_score, {rounded("avg(y)")} AS positive_rate
    FROM scored WHERE fine IS NOT NULL GROUP BY ALL""",
)
def reliability_bins(spark: SparkSession, folder: str) -> DataFrame:
    found = ranking.reliability_bins(_scored(spark, folder), "fine", "y", ["l_linestatus"])
    return comparable(found, ["bin", "size"])


_COUNTS = """count(*) FILTER (y = 0 AND NOT guess) AS tn, count(*) FILTER (y = 0 AND guess) AS fp,
      count(*) FILTER (y = 1 AND NOT guess) AS fn, count(*) FILTER (y = 1 AND guess) AS tp"""


@query(
    "R8 X12",
    f"""WITH {_SCORED}, d AS (SELECT l_linestatus, {_COUNTS}
      FROM (SELECT *, fine >= 0.5 AS guess FROM scored WHERE fine IS NOT NULL) GROUP BY ALL)
    SELECT l_linestatus, tn, fp, fn, tp, round(tp / CAST(tp + fp AS DOUBLE), 6) AS precision,
      round(tp / CAST(tp + fn AS DOUBLE), 6) AS recall,
      round(2 * tp / CAST(2 * tp + fp + fn AS DOUBLE), 6) AS f1 FROM d""",
)
def threshold_metrics(spark: SparkSession, folder: str) -> DataFrame:
    found = ranking.threshold_metrics(_scored(spark, folder), "fine", "y", 0.5, ["l_linestatus"])
    return comparable(found, ["tn", "fp", "fn", "tp"])


@query(
    "A25",
    f"WITH {_SCORED} SELECT l_linestatus, {_COUNTS}"
    " FROM (SELECT *, l_quantity > 25 AS guess FROM scored) GROUP BY l_linestatus",
)
def confusion_matrix(spark: SparkSession, folder: str) -> DataFrame:
    rows = _scored(spark, folder).withColumn("guess", (F.col("l_quantity") > 25).cast("int"))
    return ranking.confusion_matrix(rows, "y", "guess", ["l_linestatus"])


@query(
    "A26",
    f"""WITH {_SCORED} SELECT CAST(10 * count(*) FILTER (y = 1 AND l_quantity <= 25)
      + count(*) FILTER (y = 0 AND l_quantity > 25) AS DOUBLE) AS cost FROM scored""",
)
def misclassification_cost(spark: SparkSession, folder: str) -> DataFrame:
    rows = _scored(spark, folder).withColumn("guess", (F.col("l_quantity") > 25).cast("int"))
    return ranking.misclassification_cost(rows, "y", "guess")


@query(
    "A27",
    f"""WITH {_SCORED}, f AS (SELECT l_quantity, avg(y) AS rate, avg(fine) AS score FROM scored
      GROUP BY l_quantity)
    SELECT round(avg(rate), 6) AS rate_mean, round(stddev_pop(rate), 6) AS rate_std,
      round(avg(score), 6) AS score_mean, round(stddev_pop(score), 6) AS score_std FROM f""",
)
def fold_summary(spark: SparkSession, folder: str) -> DataFrame:
    rows = _scored(spark, folder).groupBy("l_quantity").agg(
        F.avg("y").alias("rate"), F.avg("fine").alias("score")
    )
    return comparable(ranking.fold_summary(rows, ["rate", "score"]))


_AGE = "(-DAYS_BIRTH / 365.25e0)"


@query(
    "A28 X13",
    f"""{_APP}, grouped AS (
      SELECT 'Gender' AS "group", CODE_GENDER AS category, * FROM application_train
        WHERE CODE_GENDER IN ('M', 'F')
      UNION ALL SELECT 'Age', CASE WHEN {_AGE} < 30 THEN 'Young (<30)'
        WHEN {_AGE} < 50 THEN 'Middle (30-50)' ELSE 'Senior (>=50)' END, * FROM application_train
      UNION ALL SELECT 'Contract', NAME_CONTRACT_TYPE, * FROM application_train),
    scored AS (SELECT concat_ws(': ', "group", category) AS who, CAST(EXT_SOURCE_3 AS DOUBLE) AS score,
      CAST(TARGET AS INTEGER) AS y FROM grouped),
    {_steps("score", "who")}
    SELECT g AS subgroup, CAST(sum(pos + neg) AS BIGINT) AS size,
      round(sum(pos) / sum(pos + neg), 6) AS positive_rate, {_AUC} AS roc_auc,
      {_AP} AS average_precision FROM steps GROUP BY g""",
)
def subgroup_metrics(spark: SparkSession, folder: str) -> DataFrame:
    rows = loan_table(spark, folder, "application_train")
    found = evaluation.subgroup_metrics(
        rows, "EXT_SOURCE_3", LABEL, evaluation.default_subgroups(rows)
    )
    named = found.select(
        F.concat_ws(": ", "group", "category").alias("subgroup"),
        "size",
        "positive_rate",
        "roc_auc",
        "average_precision",
    )
    return comparable(named, ["size"])


_SHUFFLED = """shuffled AS (SELECT c_custkey, CAST(c_acctbal < 0 AS INTEGER) AS y,
  row_number() OVER (PARTITION BY c_acctbal < 0
    ORDER BY md5(CAST(c_custkey AS VARCHAR) || '-42'), c_custkey) AS place,
  count(*) OVER (PARTITION BY c_acctbal < 0) AS n FROM customer)"""


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        "c_custkey", (F.col("c_acctbal") < 0).cast("int").alias("y")
    )


@query(
    "K7",
    f"""WITH {_SHUFFLED} SELECT c_custkey, y,
      CASE WHEN place <= floor(0.2e0 * n + 0.5) THEN 'test' ELSE 'train' END AS side
    FROM shuffled""",
)
def stratified_split(spark: SparkSession, folder: str) -> DataFrame:
    train, test = sampling.stratified_split(_customers(spark, folder), "c_custkey", "y", 0.2)
    return train.withColumn("side", F.lit("train")).unionByName(
        test.withColumn("side", F.lit("test"))
    )


@query(
    "K8",
    f"""WITH {_SHUFFLED} SELECT c_custkey, y, CAST({" + ".join(
        f"CAST(place > n * {i} // 5 AS INTEGER)" for i in range(1, 5))} AS INTEGER) AS fold
    FROM shuffled""",
)
def stratified_folds(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.stratified_folds(_customers(spark, folder), "c_custkey", "y", 5)


_AUDITED = [
    "CNT_CHILDREN",
    "AMT_INCOME_TOTAL",
    "AMT_CREDIT",
    "AMT_ANNUITY",
    "AMT_GOODS_PRICE",
    "DAYS_BIRTH",
    "DAYS_EMPLOYED",
    "DAYS_REGISTRATION",
    "OWN_CAR_AGE",
    "CNT_FAM_MEMBERS",
    "REGION_RATING_CLIENT",
    "EXT_SOURCE_1",
    "EXT_SOURCE_2",
    "EXT_SOURCE_3",
    "balance",
]
_AUDIT_SQL = f"""{_APP}, source AS (SELECT a.*, c_acctbal AS balance, 1 AS same
      FROM application_train a JOIN customer ON SK_ID_CURR = c_custkey),
    long AS ({" UNION ALL ".join(
        f"SELECT '{c}' AS feature, coalesce(CAST({c} AS DOUBLE), -999) AS v,"
        " CAST(TARGET AS INTEGER) AS y FROM source" for c in [*_AUDITED, "same"])}),
    s AS (SELECT feature, v, CAST(sum(y) AS DOUBLE) AS pos, CAST(count(*) AS DOUBLE) AS n
      FROM long GROUP BY ALL),
    steps AS (SELECT feature, v, sum(pos) OVER w AS lp, sum(n) OVER w AS ln,
        sum(pos) OVER (PARTITION BY feature) AS p, sum(n) OVER (PARTITION BY feature) AS m
      FROM s WINDOW w AS (PARTITION BY feature ORDER BY v)),
    sides AS (SELECT *, p - lp AS rp, m - ln AS rn FROM steps),
    judged AS (SELECT *, CASE WHEN rn > 0 THEN
        (lp * lp + (ln - lp) * (ln - lp)) / ln + (rp * rp + (rn - rp) * (rn - rp)) / rn
      END AS purity FROM sides),
    best AS (SELECT *, row_number() OVER (PARTITION BY feature
      ORDER BY purity DESC NULLS LAST, v) AS place FROM judged),
    auc AS (SELECT feature, CASE WHEN purity IS NULL THEN 0.5
      ELSE 0.5 * (1 + rp / p - (rn - rp) / (m - p)) END AS a FROM best WHERE place = 1),
    audit AS (SELECT feature, round(greatest(a, 1 - a), 6) AS auc,
      CASE WHEN greatest(a, 1 - a) > 0.8 THEN 'LEAK' WHEN greatest(a, 1 - a) > 0.7
        THEN 'INVESTIGATE' ELSE 'OK' END AS flag FROM auc)"""


def _audited_rows(spark: SparkSession, folder: str) -> DataFrame:
    balance = table(spark, folder, "customer").select(
        F.col("c_custkey").cast("int").alias(ID), F.col("c_acctbal").alias("balance")
    )
    rows = loan_table(spark, folder, "application_train").join(balance, ID)
    return rows.withColumn("same", F.lit(1))


def _audit(spark: SparkSession, folder: str) -> DataFrame:
    """Every numeric column but the id."""
    return leakage.single_feature_auc(_audited_rows(spark, folder), LABEL, exclude=[ID])


@query("L1 L2 P9 X9 X11", f"{_AUDIT_SQL} SELECT * FROM audit")
def leakage_audit(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(_audit(spark, folder))


@query("L3", f"{_AUDIT_SQL} SELECT flag, count(*) AS features FROM audit GROUP BY flag")
def leakage_flags(spark: SparkSession, folder: str) -> DataFrame:
    return leakage.flag_counts(_audit(spark, folder))


@query(
    "L3 S9",
    f"""{_AUDIT_SQL} SELECT feature, auc, flag,
      (SELECT count(*) = 0 FROM audit WHERE flag = 'LEAK') AS passed FROM audit""",
)
def audit_gate(spark: SparkSession, folder: str) -> DataFrame:
    """The gate's verdict beside the findings as they stand in its CSV file."""
    path = f"{ensure_checkpoint_dir(spark)}/audit/{uuid.uuid4().hex}"
    passed, _, _ = run_audit(_audited_rows(spark, folder), path)
    stored = spark.read.csv(path, header=True, schema="feature string, auc double, flag string")
    return comparable(stored).withColumn("passed", F.lit(passed))


def _windows(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Events before and after the middle of January; views have no value."""
    rows = table(spark, folder, "events").select(
        "ts",
        "event_type",
        F.when(F.col("event_type") != "view", F.col("value")).alias("value"),
        (F.col("user_id") % 17).alias("cohort"),
    )
    return rows.where("ts < '2024-01-16'"), rows.where("ts >= '2024-01-16'")


_PSI_SQL = """WITH e AS (SELECT ts < TIMESTAMP '2024-01-16' AS old, event_type,
      CASE WHEN event_type <> 'view' THEN value END AS value,
      CAST(user_id % 17 AS DOUBLE) AS cohort FROM events),
    q AS (SELECT list_distinct(quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]))
        AS ve, list_distinct(quantile_cont(cohort, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]))
        AS ce FROM e WHERE old),
    b AS (SELECT 'value' AS feature, CAST(len(list_filter(ve, lambda x: x <= value)) AS VARCHAR) AS bin,
        old FROM e, q WHERE value IS NOT NULL
      UNION ALL SELECT 'cohort', CAST(len(list_filter(ce, lambda x: x <= cohort)) AS VARCHAR), old FROM e, q
      UNION ALL SELECT 'event_type', event_type, old FROM e),
    c AS (SELECT feature, bin, CAST(count(*) FILTER (old) AS DOUBLE) AS r,
      CAST(count(*) FILTER (NOT old) AS DOUBLE) AS n FROM b GROUP BY ALL),
    s AS (SELECT feature, bin, greatest(r / sum(r) OVER w, 1e-4) AS reference_share,
      greatest(n / sum(n) OVER w, 1e-4) AS current_share
      FROM c WINDOW w AS (PARTITION BY feature)),
    t AS (SELECT *, (current_share - reference_share) * ln(current_share / reference_share)
      AS contribution FROM s)"""


@query(
    "D1",
    f"""{_PSI_SQL} SELECT feature, round(sum(contribution), 6) AS psi,
      sum(contribution) > 0.2 AS alert FROM t GROUP BY feature""",
)
def psi_drift(spark: SparkSession, folder: str) -> DataFrame:
    old, new = _windows(spark, folder)
    return comparable(drift.psi_drift(old, new, ["value", "cohort"], ["event_type"]))


@query(
    "D1",
    f"""{_PSI_SQL} SELECT feature, bin, round(reference_share, 6) AS reference_share,
      round(current_share, 6) AS current_share, round(contribution, 9) + 0.0 AS contribution
    FROM t""",
)
def psi_bins(spark: SparkSession, folder: str) -> DataFrame:
    old, new = _windows(spark, folder)
    found = drift.psi_table(old, new, ["value", "cohort"], ["event_type"])
    shares = comparable(found, ["contribution"])
    return shares.withColumn("contribution", F.round("contribution", 9) + F.lit(0.0))


@query(
    "D1 S7 S8",
    f"""{_PSI_SQL} SELECT feature, round(sum(contribution), 6) AS psi,
      sum(contribution) > 0.2 AS alert FROM t GROUP BY feature""",
)
def psi_from_stored_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Two halves of the reference window are profiled, added up and stored; the
    current window is scored against the table that is read back."""
    old, new = _windows(spark, folder)
    edges = drift.reference_edges(old, ["value", "cohort"])
    halves = [old.where(f"ts {op} '2024-01-08'") for op in ("<", ">=")]
    merged = drift.merge_profiles(*[drift.window_profile(h, edges, ["event_type"]) for h in halves])
    path = f"{ensure_checkpoint_dir(spark)}/profiles/{uuid.uuid4().hex}"
    write_table(merged, path)
    table_ = drift.profile_psi_table(read_table(spark, path), new, ["event_type"])
    return comparable(drift.drift_alerts(table_))
