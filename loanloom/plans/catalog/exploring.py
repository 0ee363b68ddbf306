"""Queries on profiles, histograms, samples and tails."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.functions.columns import categorical_columns
from loanloom.operators import histograms, profile, quantiles, sampling
from loanloom.operators.aggregates import null_rates as column_null_rates
from loanloom.plans.catalog.base import comparable, query, rounded, table
from loanloom.plans.catalog.credit_view import COLUMNS, loan_sql, loan_table
from loanloom.plans.exploration import CATEGORY_COLUMNS
from loanloom.plans.exploration import summary as explore_summary

ID, LABEL = "SK_ID_CURR", "TARGET"
_APP = f"WITH {loan_sql('application_train')}"
_GAPPED = list(COLUMNS["application_train"])
_NUMERIC = [
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
]


def _applicants(spark: SparkSession, folder: str) -> DataFrame:
    return loan_table(spark, folder, "application_train")


def _returned(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with the label "returned"; the price is missing on line 7."""
    return table(spark, folder, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("returned"),
        "l_quantity",
        F.when(F.col("l_linenumber") < 7, F.col("l_extendedprice")).alias("price"),
    )


_RETURNED = """returned_view AS (
  SELECT CAST(l_returnflag = 'R' AS INTEGER) AS returned, l_quantity,
    CASE WHEN l_linenumber < 7 THEN l_extendedprice END AS price FROM lineitem)"""


@query(
    "A16",
    """SELECT o_orderstatus, count(*) AS "count",
      round(count(*) / CAST((SELECT count(*) FROM orders) AS DOUBLE), 6) AS share
    FROM orders GROUP BY o_orderstatus""",
)
def label_shares(spark: SparkSession, folder: str) -> DataFrame:
    found = profile.value_shares(table(spark, folder, "orders"), "o_orderstatus")
    return comparable(found, ["count"])


def _null_rates_sql(columns: list[str], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {rounded(f'avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)')}"
        f" AS null_rate FROM {source}"
        for c in columns
    )


@query("A17 K1", f"{_APP} {_null_rates_sql(_GAPPED, 'application_train')}")
def null_rates(spark: SparkSession, folder: str) -> DataFrame:
    rates = column_null_rates(_applicants(spark, folder).select(_GAPPED))
    return comparable(profile.top(rates, "null_rate", "column", 40))


@query(
    "A17",
    f"""{_APP}, r AS ({_null_rates_sql(_GAPPED, "application_train")})
    SELECT count(*) FILTER (null_rate > 0.50) AS above_50,
      count(*) FILTER (null_rate > 0.20) AS above_20,
      count(*) FILTER (null_rate > 0.05) AS above_05 FROM r""",
)
def null_rate_summary(spark: SparkSession, folder: str) -> DataFrame:
    return profile.null_rate_summary(column_null_rates(_applicants(spark, folder).select(_GAPPED)))


def _correlation_sql(columns: list[str]) -> str:
    one = (
        "SELECT '{c}' AS \"column\", round(covar_pop(x, y) / nullif(stddev_pop(x)"
        " * stddev_pop(y), 0), 6) + 0.0 AS correlation FROM (SELECT CAST({c} AS DOUBLE) AS x,"
        " CAST(TARGET AS DOUBLE) AS y FROM application_train WHERE {c} IS NOT NULL)"
    )
    return " UNION ALL ".join(one.format(c=c) for c in columns)


@query(
    "A18 P4",
    f"""{_APP} {_correlation_sql(_NUMERIC)}
    UNION ALL SELECT 'CONSTANT' AS "column", CAST(NULL AS DOUBLE) AS correlation""",
)
def label_correlation(spark: SparkSession, folder: str) -> DataFrame:
    rows = _applicants(spark, folder).withColumn("CONSTANT", F.lit(1))
    return comparable(profile.label_correlations(rows, LABEL, exclude=[ID]))


@query(
    "K2",
    f"""{_APP}, r AS ({_correlation_sql(_NUMERIC)}),
      low AS (SELECT * FROM r ORDER BY correlation, "column" LIMIT 15),
      high AS (SELECT * FROM r ORDER BY correlation DESC, "column" DESC LIMIT 15)
    SELECT * FROM low UNION ALL SELECT * FROM high""",
)
def topk_tails(spark: SparkSession, folder: str) -> DataFrame:
    found = profile.label_correlations(_applicants(spark, folder), LABEL, _NUMERIC)
    return comparable(profile.both_tails(found, "correlation", "column"))


@query(
    "K3",
    f"""{_APP}, r AS ({_correlation_sql(_NUMERIC)})
    SELECT max_by("column", correlation) AS largest, max(correlation) AS largest_value,
      min_by("column", correlation) AS smallest, min(correlation) AS smallest_value FROM r""",
)
def extreme_correlations(spark: SparkSession, folder: str) -> DataFrame:
    found = profile.label_correlations(_applicants(spark, folder), LABEL, _NUMERIC)
    return comparable(profile.extremes(found, "correlation", "column"))


@query(
    "A19 K4 P12",
    f"{_APP} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {c} AS category, count(*) AS size,"
        f" round(avg(CAST(TARGET AS DOUBLE)), 6) AS label_rate FROM application_train"
        f" WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in CATEGORY_COLUMNS
        if c != "NAME_FAMILY_STATUS"
    ),
)
def label_rate_by_category(spark: SparkSession, folder: str) -> DataFrame:
    rows = _applicants(spark, folder)
    return comparable(profile.label_rate_by_category(rows, LABEL, CATEGORY_COLUMNS), ["size"])


@query(
    "A20",
    f"""{_APP} SELECT count(*) FILTER (DAYS_EMPLOYED = 365243) AS sentinel_count,
      round(count(*) FILTER (DAYS_EMPLOYED = 365243) / CAST(count(*) AS DOUBLE) * 100, 6)
        AS sentinel_pct,
      round(avg(CAST(TARGET AS DOUBLE)) FILTER (DAYS_EMPLOYED = 365243) * 100, 6)
        AS sentinel_label_rate,
      round(avg(CAST(TARGET AS DOUBLE)) FILTER (DAYS_EMPLOYED <> 365243) * 100, 6)
        AS other_label_rate
    FROM application_train""",
)
def sentinel_analysis(spark: SparkSession, folder: str) -> DataFrame:
    rows = _applicants(spark, folder)
    found = profile.sentinel_analysis(rows, "DAYS_EMPLOYED", 365243, LABEL)
    return comparable(found, ["sentinel_count"])


@query(
    "A21",
    f"WITH {_RETURNED} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({p} AS DOUBLE) AS prob,"
        f" round(quantile_cont({c}, {p}), 6) AS value FROM returned_view"
        for c in ("l_quantity", "price")
        for p in (0.01, 0.25, 0.5, 0.99)
    ),
)
def exact_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    rows = _returned(spark, folder)
    found = quantiles.quantile_table(rows, ["l_quantity", "price"], [0.01, 0.25, 0.5, 0.99])
    return comparable(found)


def _histogram_sql(source: str, bins: int) -> str:
    """Bins of ``source(feature, label, value, low, high)``."""
    return f"""
    binned AS (
      SELECT feature, label, value, low, high, (high - low) / {bins} AS width,
        CAST(least(floor((value - low) / (high - low) * {bins}), {bins - 1}) AS INTEGER) AS raw
      FROM {source}),
    placed AS (
      SELECT feature, label, low, width,
        CAST(raw - CASE WHEN value < low + raw * width THEN 1 ELSE 0 END
          + CASE WHEN value >= low + (raw + 1) * width AND raw < {bins - 1} THEN 1 ELSE 0 END
          AS INTEGER) AS bin
      FROM binned),
    counted AS (
      SELECT feature, label, bin, low, width, count(*) AS n FROM placed GROUP BY ALL)
    SELECT feature, label, bin, round(low + bin * width, 6) AS bin_low,
      round(low + (bin + 1) * width, 6) AS bin_high, n AS "count",
      round(n / (sum(n) OVER (PARTITION BY feature, label) * width), 6) AS density
    FROM counted"""


_LONG_RETURNED = """long AS (
  SELECT 'l_quantity' AS feature, returned AS label, l_quantity AS value FROM returned_view
  UNION ALL
  SELECT 'price', returned, price FROM returned_view WHERE price IS NOT NULL)"""


@query(
    "A22 A29",
    f"""WITH {_RETURNED}, {_LONG_RETURNED}, ranged AS (
      SELECT *, min(value) OVER (PARTITION BY feature, label) AS low,
        max(value) OVER (PARTITION BY feature, label) AS high FROM long),
    {_histogram_sql("ranged", 50)}""",
)
def label_histograms(spark: SparkSession, folder: str) -> DataFrame:
    rows = _returned(spark, folder)
    found = histograms.label_histograms(rows, ["l_quantity", "price"], "returned", 50)
    return comparable(found, ["label", "bin", "count"])


@query(
    "A23 X10",
    f"""WITH {_RETURNED}, {_LONG_RETURNED}, limits AS (
      SELECT feature, label, quantile_cont(value, 0.01) AS low,
        quantile_cont(value, 0.99) AS high FROM long GROUP BY feature, label),
    clipped AS (
      SELECT feature, label, least(greatest(value, low), high) AS value, low, high
      FROM long JOIN limits USING (feature, label)),
    {_histogram_sql("clipped", 50)}""",
)
def quantile_clip_histogram(spark: SparkSession, folder: str) -> DataFrame:
    rows = _returned(spark, folder)
    found = histograms.label_histograms(
        rows, ["l_quantity", "price"], "returned", 50, (0.01, 0.99)
    )
    return comparable(found, ["label", "bin", "count"])


@query(
    "A22",
    f"""{_APP}, long AS (
      SELECT 'all' AS feature, 0 AS label, CAST(DAYS_EMPLOYED AS DOUBLE) AS value
      FROM application_train
      UNION ALL
      SELECT 'without_sentinel', 0, CAST(DAYS_EMPLOYED AS DOUBLE) FROM application_train
      WHERE DAYS_EMPLOYED <> 365243),
    ranged AS (
      SELECT *, min(value) OVER (PARTITION BY feature) AS low,
        max(value) OVER (PARTITION BY feature) AS high FROM long),
    h AS (WITH {_histogram_sql("ranged", 100)})
    SELECT feature, bin, bin_low, bin_high, "count", density FROM h""",
)
def equal_width_histogram(spark: SparkSession, folder: str) -> DataFrame:
    days = F.col("DAYS_EMPLOYED")
    found = histograms.histogram(
        _applicants(spark, folder),
        {"all": days, "without_sentinel": F.when(days != 365243, days)},
        100,
    )
    return comparable(found, ["bin", "count"])


@query(
    "A24",
    f"{_APP} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS present,
        count(*) - count({c}) AS missing, count(*) FILTER ({c} = 0) AS zeros,
        {rounded(f"avg(CAST({c} AS DOUBLE))", 4)} AS mean,
        {rounded(f"stddev_samp(CAST({c} AS DOUBLE))", 4)} AS std,
        {rounded(f"min({c})", 4)} AS min, {rounded(f"max({c})", 4)} AS max,
        """
        + ", ".join(
            f"{rounded(f'quantile_cont(CAST({c} AS DOUBLE), {p})', 4)} AS p{int(p * 100):02d}"
            for p in (0.05, 0.25, 0.5, 0.75, 0.95)
        )
        + " FROM application_train"
        for c in _NUMERIC
    ),
)
def column_profile(spark: SparkSession, folder: str) -> DataFrame:
    found = profile.numeric_profile(_applicants(spark, folder), _NUMERIC)
    return comparable(found, ["present", "missing", "zeros"], digits=4)


#: All text columns of the applicants.
_TEXTS = [
    "NAME_CONTRACT_TYPE",
    "CODE_GENDER",
    "NAME_INCOME_TYPE",
    "NAME_EDUCATION_TYPE",
    "FLAG_OWN_CAR",
    "OCCUPATION_TYPE",
    "WEEKDAY_APPR_PROCESS_START",
]


@query(
    "A24",
    f"{_APP} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS \"distinct\" FROM application_train"
        for c in [*_TEXTS, *_NUMERIC]
    ),
)
def distinct_profile(spark: SparkSession, folder: str) -> DataFrame:
    rows = _applicants(spark, folder)
    return profile.distinct_values(rows, [*categorical_columns(rows), *_NUMERIC])


@query(
    "A24",
    f"""{_APP}, long AS ({" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c} AS value FROM application_train" for c in _TEXTS)}),
    counted AS (SELECT "column", value, count(*) AS "count" FROM long
      WHERE value IS NOT NULL GROUP BY ALL),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY "column"
      ORDER BY "count" DESC, value) AS INTEGER) AS rank FROM counted)
    SELECT "column", rank, value, "count" FROM ranked WHERE rank <= 3""",
)
def top_values(spark: SparkSession, folder: str) -> DataFrame:
    rows = _applicants(spark, folder)
    return profile.top_values(rows, categorical_columns(rows), 3)


@query(
    "A24",
    """WITH long AS (
      SELECT 'l_partkey' AS "column", CAST(l_partkey AS VARCHAR) AS value FROM lineitem
      UNION ALL SELECT 'l_extendedprice', CAST(CAST(l_extendedprice AS DECIMAL(12, 2)) AS VARCHAR) FROM lineitem
      UNION ALL SELECT 'l_shipdate', CAST(CAST(l_shipdate AS DATE) AS VARCHAR) FROM lineitem),
    counted AS (SELECT "column", value, count(*) AS "count" FROM long
      WHERE value IS NOT NULL GROUP BY ALL),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY "column"
      ORDER BY "count" DESC, value) AS INTEGER) AS rank FROM counted)
    SELECT "column", rank, value, "count" FROM ranked WHERE rank <= 10""",
)
def top_line_values(spark: SparkSession, folder: str) -> DataFrame:
    """Columns with many values, where most cells need no count."""
    rows = table(spark, folder, "lineitem").select(
        "l_partkey",
        F.col("l_extendedprice").cast("decimal(12,2)").alias("l_extendedprice"),
        F.col("l_shipdate").cast("date").alias("l_shipdate"),
    )
    return profile.top_values(rows, rows.columns, 10)


@query(
    "K5 S2 K6",
    """SELECT l_id, l_quantity FROM (
      SELECT CAST(l_orderkey * 1000 + l_linenumber AS BIGINT) AS l_id,
        max(l_quantity) AS l_quantity FROM lineitem GROUP BY 1)
    ORDER BY md5(CAST(l_id AS VARCHAR) || '-42'), l_id LIMIT 5000""",
)
def hash_sample(spark: SparkSession, folder: str) -> DataFrame:
    rows = (
        table(spark, folder, "lineitem")
        .groupBy((F.col("l_orderkey") * 1000 + F.col("l_linenumber")).alias("l_id"))
        .agg(F.max("l_quantity").alias("l_quantity"))
    )
    return sampling.hash_sample(rows, "l_id", 5000)


@query(
    "K10 P8",
    f"""{_APP} SELECT SK_ID_CURR, CAST(TARGET AS INTEGER) AS TARGET,
      {rounded("EXT_SOURCE_1")} AS EXT_SOURCE_1, {rounded("EXT_SOURCE_2")} AS EXT_SOURCE_2,
      {rounded("EXT_SOURCE_3")} AS EXT_SOURCE_3
    FROM application_train WHERE EXT_SOURCE_1 IS NOT NULL AND EXT_SOURCE_2 IS NOT NULL
      AND EXT_SOURCE_3 IS NOT NULL
    ORDER BY md5(CAST(SK_ID_CURR AS VARCHAR) || '-42'), SK_ID_CURR LIMIT 10000""",
)
def complete_sample(spark: SparkSession, folder: str) -> DataFrame:
    scores = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]
    rows = _applicants(spark, folder).select(ID, F.col(LABEL).cast("int").alias(LABEL), *scores)
    return comparable(sampling.complete_sample(rows, ID, scores, 10_000), [ID, LABEL])


@query(
    "K9",
    f"""{_APP}, r AS ({_null_rates_sql(_GAPPED, "application_train")})
    SELECT "column" FROM r WHERE null_rate > 0.05 AND null_rate < 0.80
    ORDER BY null_rate DESC, "column" LIMIT 30""",
)
def partly_missing_columns(spark: SparkSession, folder: str) -> DataFrame:
    names = profile.columns_partly_missing(_applicants(spark, folder).select(_GAPPED))
    return spark.createDataFrame([(n,) for n in names], "column string")


_MISSING = f"""{_APP}, r AS ({_null_rates_sql(_GAPPED, "application_train")}),
    partly AS (SELECT list("column") AS names FROM (SELECT "column" FROM r
      WHERE null_rate > 0.05 AND null_rate < 0.80 ORDER BY null_rate DESC, "column" LIMIT 30)),
    flagged AS (SELECT SK_ID_CURR, concat_ws(',', {", ".join(
        f"CASE WHEN {c} IS NULL AND list_contains(names, '{c}') THEN '{c}' END" for c in _GAPPED)})
        AS missing FROM application_train, partly)"""


def _partly_missing(rows: DataFrame) -> list[str]:
    found = set(profile.columns_partly_missing(rows.select(_GAPPED)))
    return [c for c in _GAPPED if c in found]


@query("K9 X6", f"{_MISSING} SELECT missing, count(*) AS \"rows\" FROM flagged GROUP BY missing")
def missing_patterns(spark: SparkSession, folder: str) -> DataFrame:
    """Patterns over all columns that the table misses in part."""
    rows = _applicants(spark, folder)
    columns = _partly_missing(rows)
    return profile.missing_names(profile.missing_patterns(rows, columns), columns)


@query(
    "K9",
    f"""{_MISSING} SELECT SK_ID_CURR, missing FROM flagged
    ORDER BY md5(CAST(SK_ID_CURR AS VARCHAR) || '-42'), SK_ID_CURR LIMIT 5000""",
)
def missing_matrix(spark: SparkSession, folder: str) -> DataFrame:
    rows = _applicants(spark, folder)
    columns = _partly_missing(rows)
    return profile.missing_names(profile.missing_matrix(rows, ID, columns), columns)


@query(
    "S11 A15 K1",
    f"""{_APP}, r AS ({_null_rates_sql(_GAPPED, "application_train")}),
    k AS ({_correlation_sql(_NUMERIC)}),
    t AS (SELECT string_agg("column", ', ' ORDER BY abs(correlation) DESC) AS names FROM
      (SELECT * FROM k ORDER BY abs(correlation) DESC LIMIT 3))
    SELECT count(*) AS "rows", 23 AS "columns",
      round(100 - avg(CAST(TARGET AS DOUBLE)) * 100, 6) AS label_0_pct,
      round(avg(CAST(TARGET AS DOUBLE)) * 100, 6) AS label_1_pct,
      (SELECT count(*) FROM r WHERE null_rate > 0.5) AS null_above_50,
      (SELECT count(*) FROM r WHERE null_rate > 0.2) AS null_above_20,
      (SELECT names FROM t) AS top_features,
      count(*) FILTER (DAYS_EMPLOYED = 365243) AS sentinel_count,
      round(count(*) FILTER (DAYS_EMPLOYED = 365243) / CAST(count(*) AS DOUBLE) * 100, 6)
        AS sentinel_pct,
      round(avg(CAST(TARGET AS DOUBLE)) FILTER (DAYS_EMPLOYED = 365243) * 100, 6)
        AS sentinel_label_rate,
      round(avg(CASE WHEN EXT_SOURCE_2 IS NULL THEN 100.0 ELSE 0.0 END), 6)
        AS ext_source_2_null_pct
    FROM application_train""",
)
def exploration_summary(spark: SparkSession, folder: str) -> DataFrame:
    found = explore_summary(_applicants(spark, folder))
    found = found.withColumn("top_features", F.array_join("top_features", ", "))
    counts = ["rows", "columns", "null_above_50", "null_above_20", "sentinel_count"]
    return comparable(found, counts)
