"""Queries on feature steps and on the fitted preparation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.functions.columns import numeric_columns, split_label
from loanloom.operators import features, prepare
from loanloom.plans.catalog.base import comparable, query, rounded
from loanloom.plans.catalog.credit_view import loan_sql, loan_table
from loanloom.plans.catalog.wide import AGGREGATES, WIDE_SQL, wide

ID, LABEL = "SK_ID_CURR", "TARGET"
_APP = f"WITH {loan_sql('application_train')}"


def _applicants(spark: SparkSession, folder: str) -> DataFrame:
    return loan_table(spark, folder, "application_train")


@query(
    "F1 X5",
    f"{_APP} SELECT SK_ID_CURR, nullif(DAYS_EMPLOYED, 365243) AS DAYS_EMPLOYED"
    " FROM application_train",
)
def sentinel_to_null(spark: SparkSession, folder: str) -> DataFrame:
    rows = _applicants(spark, folder).select(ID, "DAYS_EMPLOYED")
    return features.SentinelImputer().transform(rows)


@query(
    "F2 X6",
    f"""{_APP} SELECT SK_ID_CURR, CAST(DAYS_EMPLOYED = 365243 AS INTEGER) AS IS_UNEMPLOYED
    FROM application_train""",
)
def null_flag(spark: SparkSession, folder: str) -> DataFrame:
    rows = features.SentinelImputer().transform(_applicants(spark, folder))
    return features.IsUnemployedFlagger().transform(rows).select(ID, "IS_UNEMPLOYED")


def _ratio(a: str, b: str) -> str:
    return rounded(f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)")


@query(
    "F3 X1 X2",
    f"""{_APP} SELECT SK_ID_CURR,
      {_ratio("AMT_CREDIT", "AMT_INCOME_TOTAL + 1")} AS CREDIT_INCOME_RATIO,
      {_ratio("AMT_ANNUITY", "AMT_INCOME_TOTAL + 1")} AS ANNUITY_INCOME_RATIO,
      {_ratio("AMT_ANNUITY", "AMT_CREDIT + 1")} AS CREDIT_TERM,
      {_ratio("DAYS_EMPLOYED", "DAYS_BIRTH - 1")} AS DAYS_EMPLOYED_RATIO,
      {rounded("abs(DAYS_BIRTH) / 365e0")} AS AGE_YEARS
    FROM application_train""",
)
def guarded_ratios(spark: SparkSession, folder: str) -> DataFrame:
    made = features.RatioFeatureCreator().transform(_applicants(spark, folder))
    return comparable(made.select(ID, *features.RATIO_INPUTS, "AGE_YEARS"), [ID])


@query(
    "F4 X7",
    f"""{_APP}, l AS (SELECT SK_ID_CURR, CAST(x AS DOUBLE) AS x FROM application_train,
      LATERAL (SELECT unnest([EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3]) AS x))
    SELECT SK_ID_CURR, {rounded("avg(x)")} AS EXT_SOURCE_MEAN,
      {rounded("stddev_samp(x)")} AS EXT_SOURCE_STD,
      CAST(count(*) - count(x) AS INTEGER) AS EXT_SOURCE_MISSING_COUNT
    FROM l GROUP BY SK_ID_CURR""",
)
def rowwise_stats(spark: SparkSession, folder: str) -> DataFrame:
    made = features.ExternalSourceAggregator().transform(_applicants(spark, folder))
    names = ["EXT_SOURCE_MEAN", "EXT_SOURCE_STD", "EXT_SOURCE_MISSING_COUNT"]
    return comparable(made.select(ID, *names), [ID, "EXT_SOURCE_MISSING_COUNT"])


@query(
    "F5 X3 X4",
    f"""{_APP}, d AS (SELECT SK_ID_CURR, CASE upper(WEEKDAY_APPR_PROCESS_START)
      WHEN 'MONDAY' THEN 0 WHEN 'TUESDAY' THEN 1 WHEN 'WEDNESDAY' THEN 2 WHEN 'THURSDAY' THEN 3
      WHEN 'FRIDAY' THEN 4 WHEN 'SATURDAY' THEN 5 WHEN 'SUNDAY' THEN 6 END AS n
      FROM application_train)
    SELECT SK_ID_CURR, {rounded("sin(2 * pi() * n / 7)")} AS WEEKDAY_SIN,
      {rounded("cos(2 * pi() * n / 7)")} AS WEEKDAY_COS FROM d""",
)
def cyclical_weekday(spark: SparkSession, folder: str) -> DataFrame:
    made = features.CyclicalEncoder().transform(_applicants(spark, folder))
    return comparable(made.select(ID, "WEEKDAY_SIN", "WEEKDAY_COS"), [ID])


@query(
    "F6 P1 P2 P3",
    f"""{_APP} SELECT SK_ID_CURR, CODE_GENDER, NAME_INCOME_TYPE FROM application_train""",
)
def drop_columns(spark: SparkSession, folder: str) -> DataFrame:
    rows = _applicants(spark, folder).select(
        ID, "CODE_GENDER", "NAME_INCOME_TYPE", "DAYS_EMPLOYED", "WEEKDAY_APPR_PROCESS_START"
    )
    dropped = [c for c in features.DROPPED_COLUMNS if c != ID]
    return features.DropColumns(columnsToDrop=dropped).transform(rows)


@query(
    "P3",
    f"""{_APP} SELECT CODE_GENDER, count(*) AS "rows", CAST(sum(TARGET) AS BIGINT) AS positives
    FROM application_train GROUP BY CODE_GENDER""",
)
def label_split(spark: SparkSession, folder: str) -> DataFrame:
    """Features and label apart, met again by position of the id."""
    rows = _applicants(spark, folder).select(ID, LABEL, "CODE_GENDER")
    inputs, _ = split_label(rows, LABEL)
    _, label = split_label(rows.withColumn(LABEL, F.struct(LABEL, ID)), LABEL)
    met = inputs.join(label.select(f"{LABEL}.*"), ID)
    return met.groupBy("CODE_GENDER").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(LABEL).cast("bigint").alias("positives")
    )


_PLANNED_SQL = f"""
  {_ratio("AMT_CREDIT", "AMT_GOODS_PRICE")} AS CREDIT_GOODS_RATIO,
  {_ratio("AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS + 1")} AS INCOME_PER_PERSON,
  {rounded("abs(nullif(DAYS_EMPLOYED, 365243)) / 365e0")} AS EMPLOYMENT_YEARS,
  {_ratio("DAYS_REGISTRATION", "DAYS_BIRTH")} AS REGISTRATION_AGE_RATIO,
  {rounded("CAST(EXT_SOURCE_1 AS DOUBLE) * EXT_SOURCE_2 * EXT_SOURCE_3")} AS EXT_SOURCE_PRODUCT,
  {rounded("least(EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3)")} AS EXT_SOURCE_MIN,
  {_ratio("BUREAU_ACTIVE_LOAN_COUNT", "BUREAU_LOAN_COUNT")} AS BUREAU_ACTIVE_RATIO,
  {_ratio("BUREAU_AMT_CREDIT_SUM_DEBT_SUM", "BUREAU_AMT_CREDIT_SUM_SUM")}
    AS BUREAU_CREDIT_UTILIZATION,
  {_ratio("PREV_REFUSED_COUNT", "PREV_LOAN_COUNT")} AS PREV_REFUSAL_RATIO"""
_PLANNED = [
    "CREDIT_GOODS_RATIO",
    "INCOME_PER_PERSON",
    "EMPLOYMENT_YEARS",
    "REGISTRATION_AGE_RATIO",
    "EXT_SOURCE_PRODUCT",
    "EXT_SOURCE_MIN",
    "BUREAU_ACTIVE_RATIO",
    "BUREAU_CREDIT_UTILIZATION",
    "PREV_REFUSAL_RATIO",
]


@query("F9", f"{WIDE_SQL} SELECT SK_ID_CURR, {_PLANNED_SQL} FROM wide")
def planned_features(spark: SparkSession, folder: str) -> DataFrame:
    made = features.add_planned_features(wide(spark, folder))
    return comparable(made.select(ID, *_PLANNED), [ID])


def _defined(numerator: str, denominator: str) -> str:
    """0 where the denominator is 0 or missing, else the ratio or its gap."""
    return (
        f"CASE WHEN coalesce({denominator}, 0) = 0 THEN 0e0"
        f" ELSE {_ratio(numerator, denominator)} END"
    )


_ZERO_FILLED = [
    c for c in AGGREGATES if c.endswith(("_COUNT", "_SUM", "_SIZE")) or c == "BB_DPD_RATE"
]
_HISTORY_FLAGS = {
    "BUREAU": "BUREAU_LOAN_COUNT",
    "PREV": "PREV_LOAN_COUNT",
    "POS": "POS_LOAN_COUNT",
    "INST": "INST_COUNT",
}
_IMPUTED_RATIOS = {
    "CREDIT_INCOME_RATIO": ("AMT_CREDIT", "AMT_INCOME_TOTAL + 1"),
    "ANNUITY_INCOME_RATIO": ("AMT_ANNUITY", "AMT_INCOME_TOTAL + 1"),
    "CREDIT_TERM": ("AMT_ANNUITY", "AMT_CREDIT + 1"),
    "DAYS_EMPLOYED_RATIO": ("nullif(DAYS_EMPLOYED, 365243)", "DAYS_BIRTH - 1"),
    "CREDIT_GOODS_RATIO": ("AMT_CREDIT", "AMT_GOODS_PRICE"),
    "INCOME_PER_PERSON": ("AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS + 1"),
    "REGISTRATION_AGE_RATIO": ("DAYS_REGISTRATION", "DAYS_BIRTH"),
    "BUREAU_ACTIVE_RATIO": ("BUREAU_ACTIVE_LOAN_COUNT", "BUREAU_LOAN_COUNT"),
    "BUREAU_CREDIT_UTILIZATION": (
        "BUREAU_AMT_CREDIT_SUM_DEBT_SUM",
        "BUREAU_AMT_CREDIT_SUM_SUM",
    ),
    "PREV_REFUSAL_RATIO": ("PREV_REFUSED_COUNT", "PREV_LOAN_COUNT"),
}


@query(
    "F10",
    f"""{WIDE_SQL} SELECT SK_ID_CURR, CAST(EXT_SOURCE_1 IS NULL AS INTEGER) AS EXT_SOURCE_1_IS_NULL,
      {", ".join(f'CAST({c} IS NOT NULL AS INTEGER) AS {p}_HAS_HISTORY'
                 for p, c in _HISTORY_FLAGS.items())},
      coalesce(OCCUPATION_TYPE, 'Missing') AS OCCUPATION_TYPE,
      {rounded("CASE WHEN OWN_CAR_AGE IS NULL AND FLAG_OWN_CAR = 'N' THEN 0 ELSE OWN_CAR_AGE END")}
        AS OWN_CAR_AGE,
      {", ".join(f"{_defined(a, b)} AS {c}" for c, (a, b) in _IMPUTED_RATIOS.items())},
      {", ".join(f"{rounded(f'coalesce({c}, 0)')} AS {c}" for c in _ZERO_FILLED)},
      BUREAU_DAYS_CREDIT_MEAN
    FROM wide""",
)
def planned_imputation(spark: SparkSession, folder: str) -> DataFrame:
    """All rules of the plan on the wide table; the mean of the history columns
    keeps its gaps."""
    rows = features.add_ratios(features.sentinel_to_null(wide(spark, folder)))
    made = features.add_planned_imputation(features.add_planned_features(rows))
    flags = ["EXT_SOURCE_1_IS_NULL", *[f"{p}_HAS_HISTORY" for p in _HISTORY_FLAGS]]
    names = [*flags, "OCCUPATION_TYPE", "OWN_CAR_AGE", *_IMPUTED_RATIOS, *_ZERO_FILLED]
    return comparable(made.select(ID, *names, "BUREAU_DAYS_CREDIT_MEAN"), [ID, *flags], exact=["_MEAN"])


_FILLED = ["AMT_CREDIT", "AMT_ANNUITY", "OWN_CAR_AGE", "EXT_SOURCE_1", "EXT_SOURCE_3"]


def _median(c: str) -> str:
    return f"(SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM application_train)"


def _imputed(c: str) -> str:
    return f"coalesce(CAST({c} AS DOUBLE), {_median(c)})"


@query(
    "M1",
    f"""{_APP} SELECT SK_ID_CURR, {", ".join(f"{rounded(_imputed(c))} AS {c}" for c in _FILLED)}
    FROM application_train""",
)
def median_impute(spark: SparkSession, folder: str) -> DataFrame:
    rows = _applicants(spark, folder).select(ID, *_FILLED)
    return comparable(prepare.impute_medians(rows, prepare.column_medians(rows, _FILLED)), [ID])


_SCALED = ["AMT_INCOME_TOTAL", "AMT_GOODS_PRICE", "DAYS_BIRTH", "EXT_SOURCE_3"]


@query(
    "M2",
    f"""{_APP}, f AS (SELECT SK_ID_CURR, {", ".join(f"{_imputed(c)} AS {c}" for c in _SCALED)},
      5.0 AS SAME FROM application_train)
    SELECT SK_ID_CURR, {", ".join(
        rounded(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()") + f" AS {c}"
        for c in _SCALED)}, CAST(0 AS DOUBLE) AS SAME FROM f""",
)
def standard_scale(spark: SparkSession, folder: str) -> DataFrame:
    rows = _applicants(spark, folder).select(ID, *_SCALED, F.lit(5.0).alias("SAME"))
    filled = prepare.impute_medians(rows, prepare.column_medians(rows, _SCALED))
    fitted = prepare.scaling(filled, [*_SCALED, "SAME"])
    return comparable(prepare.scale(filled, fitted), [ID])


_TEXTS = ["NAME_EDUCATION_TYPE", "OCCUPATION_TYPE", "CODE_GENDER"]


def _mode(c: str) -> str:
    return (
        f"(SELECT {c} FROM application_train WHERE {c} IS NOT NULL GROUP BY {c}"
        f" ORDER BY count(*) DESC, {c} LIMIT 1)"
    )


@query(
    "M3",
    f"""{_APP} SELECT SK_ID_CURR, {", ".join(f"coalesce({c}, {_mode(c)}) AS {c}" for c in _TEXTS)}
    FROM application_train""",
)
def mode_impute(spark: SparkSession, folder: str) -> DataFrame:
    rows = _applicants(spark, folder).select(ID, *_TEXTS)
    modes, _ = prepare.fit_categories(rows, _TEXTS)
    return prepare.impute_modes(rows, modes)


def _code(c: str, seen: str) -> str:
    """Position of a value among the sorted distinct values of the fitted rows."""
    return (
        f"CAST(CASE WHEN {c} IN (SELECT {c} FROM {seen}) THEN (SELECT count(DISTINCT s.{c})"
        f" FROM {seen} s WHERE s.{c} < t.{c}) ELSE -1 END AS DOUBLE)"
    )


@query(
    "M4",
    f"""{_APP}, seen AS (SELECT * FROM application_train WHERE NAME_INCOME_TYPE <> 'MACHINERY'
      AND CODE_GENDER <> 'XNA')
    SELECT SK_ID_CURR, {_code("NAME_INCOME_TYPE", "seen")} AS NAME_INCOME_TYPE,
      {_code("CODE_GENDER", "seen")} AS CODE_GENDER
    FROM application_train t""",
)
def ordinal_encode(spark: SparkSession, folder: str) -> DataFrame:
    names = ["NAME_INCOME_TYPE", "CODE_GENDER"]
    rows = _applicants(spark, folder).select(ID, *names)
    seen = rows.where("NAME_INCOME_TYPE <> 'MACHINERY' AND CODE_GENDER <> 'XNA'")
    _, codes = prepare.fit_categories(seen, names)
    return prepare.ordinal_encode(rows, codes, {c: c for c in names})


_CHAIN_NUMERIC = {
    "AMT_INCOME_TOTAL": "CAST(AMT_INCOME_TOTAL AS DOUBLE)",
    "EXT_SOURCE_1": "CAST(EXT_SOURCE_1 AS DOUBLE)",
    "IS_UNEMPLOYED": "CAST(DAYS_EMPLOYED = 365243 AS DOUBLE)",
    "DAYS_EMPLOYED_RATIO": "nullif(DAYS_EMPLOYED, 365243) / CAST(DAYS_BIRTH - 1 AS DOUBLE)",
    "AGE_YEARS": "abs(DAYS_BIRTH) / 365e0",
}


@query(
    "F7 F8 M5 M6",
    f"""{_APP}, raw AS (SELECT SK_ID_CURR, CODE_GENDER,
      {", ".join(f"{e} AS {c}" for c, e in _CHAIN_NUMERIC.items())} FROM application_train),
    filled AS (SELECT SK_ID_CURR, CODE_GENDER, {", ".join(
        f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM raw)) AS {c}"
        for c in _CHAIN_NUMERIC)} FROM raw)
    SELECT SK_ID_CURR, {", ".join(
        rounded(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()") + f' AS "num__{c}"'
        for c in _CHAIN_NUMERIC)},
      {_code("CODE_GENDER", "raw")} AS "cat__CODE_GENDER"
    FROM filled t""",
)
def prepared_features(spark: SparkSession, folder: str) -> DataFrame:
    """The whole fitted chain, one column per feature."""
    rows = _applicants(spark, folder).select(
        ID, LABEL, "AMT_INCOME_TOTAL", "EXT_SOURCE_1", "DAYS_BIRTH", "DAYS_EMPLOYED", "CODE_GENDER"
    )
    model = prepare.fit_pipeline(rows, LABEL, [ID])
    steps, fitted = model.stages[:-1], model.stages[-1]
    for step in steps:
        rows = step.transform(rows)
    wanted = [f"num__{c}" for c in _CHAIN_NUMERIC] + ["cat__CODE_GENDER"]
    return comparable(fitted.prepared_columns(rows).select(ID, *wanted), [ID])


@query(
    "P4",
    f"""{_APP} SELECT unnest(['CNT_CHILDREN', 'AMT_INCOME_TOTAL', 'AMT_CREDIT', 'AMT_ANNUITY',
      'AMT_GOODS_PRICE', 'DAYS_BIRTH', 'DAYS_EMPLOYED', 'DAYS_REGISTRATION', 'OWN_CAR_AGE',
      'CNT_FAM_MEMBERS', 'REGION_RATING_CLIENT', 'EXT_SOURCE_1', 'EXT_SOURCE_2',
      'EXT_SOURCE_3']) AS "column", (SELECT count(*) FROM application_train) AS "rows" """,
)
def columns_by_type(spark: SparkSession, folder: str) -> DataFrame:
    rows = _applicants(spark, folder)
    names = numeric_columns(rows, [ID, LABEL])
    counted = rows.agg(F.count(F.lit(1)).alias("rows"))
    return counted.select(F.explode(F.array(*[F.lit(n) for n in names])).alias("column"), "rows")
