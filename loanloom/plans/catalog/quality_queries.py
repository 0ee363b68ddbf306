"""Queries on typed reading, expectations, contract and rejected rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.operators import quality as q
from loanloom.plans.catalog.base import comparable, query, rounded, table
from loanloom.plans.catalog.credit_view import loan_sql, loan_table
from loanloom.plans.validation import validate
from loanloom.sources import csv_tables

ID = "SK_ID_CURR"
_APP = f"WITH {loan_sql('application_train')}"


def _order_text(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as the text of a CSV file, with several tokens for missing."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("key"),
        F.when(F.col("o_orderkey") % 10 == 0, "NA")
        .otherwise((F.col("o_totalprice") > 200000).cast("int").cast("string"))
        .alias("large"),
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(F.col("o_orderkey") % 7 == 0, "nan")
        .otherwise((F.col("o_custkey") / 4).cast("string"))
        .alias("quarter"),
        (F.col("o_custkey") * 3).cast("string").alias("triple"),
        F.when(F.col("o_orderkey") % 9 == 0, "<NA>")
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("gapped"),
    )


_ORDER_SCHEMA = T.StructType(
    [
        T.StructField("key", T.IntegerType()),
        T.StructField("large", T.ByteType()),
        T.StructField("status", T.StringType()),
        T.StructField("quarter", T.FloatType()),
    ]
)


@query(
    "S1 S4 P11",
    """SELECT CAST(o_orderkey AS INTEGER) AS "key",
      CAST(CASE WHEN o_orderkey % 10 > 0 THEN CAST(o_totalprice > 200000 AS INTEGER) END
        AS TINYINT) AS large,
      CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status,
      CAST(CASE WHEN o_orderkey % 7 > 0 THEN o_custkey / 4e0 END AS FLOAT) AS quarter,
      CAST(o_custkey * 3 AS BIGINT) AS triple,
      CASE WHEN o_orderkey % 9 > 0 THEN CAST(o_custkey AS DOUBLE) END AS gapped
    FROM orders""",
)
def typed_text(spark: SparkSession, folder: str) -> DataFrame:
    text = _order_text(spark, folder)
    extra = csv_tables.infer_extra_columns(text, _ORDER_SCHEMA)
    schema = T.StructType(_ORDER_SCHEMA.fields + extra.fields)
    return csv_tables.apply_schema(text, schema, null_integers=True)


@query(
    "S1",
    """SELECT * FROM (VALUES ('key', CAST(0 AS BIGINT)),
      ('large', (SELECT count(*) FROM orders WHERE o_totalprice > 300000)),
      ('status', 0), ('quarter', (SELECT count(*) FROM orders WHERE o_orderstatus = 'F')))
      AS t("column", failures)""",
)
def cast_failures(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    text = orders.select(
        F.col("o_orderkey").cast("string").alias("key"),
        F.when(F.col("o_totalprice") > 300000, "300").otherwise("12").alias("large"),
        F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderstatus") == "F", "1,5").otherwise("1.5").alias("quarter"),
    )
    return csv_tables.cast_failures(text, _ORDER_SCHEMA)


@query(
    "S6",
    """SELECT 'orders' AS "table", count(*) AS "rows", true AS has_bytes FROM orders
    UNION ALL SELECT 'lineitem', count(*), true FROM lineitem""",
)
def table_summary(spark: SparkSession, folder: str) -> DataFrame:
    scans = {n: spark.read.parquet(f"{folder}/{n}.parquet") for n in ("orders", "lineitem")}
    found = csv_tables.file_summary(scans)
    return found.select("table", "rows", (F.col("bytes") > 0).alias("has_bytes"))


def _checks() -> list[q.Expectation]:
    """The application checks on columns that the view has, with limits that
    some of them fail."""
    return [
        q.column_exists(ID),
        q.column_exists("NO_SUCH_COLUMN"),
        q.not_null(ID),
        q.not_null("AMT_CREDIT"),
        q.unique(ID),
        q.unique("DAYS_BIRTH"),
        q.mean_between("TARGET", 0.05, 0.15),
        q.mean_between("REGION_RATING_CLIENT", 0.0, 1.0),
        q.in_set("TARGET", [0, 1]),
        q.in_set("CODE_GENDER", ["M", "F"]),
        q.between("AMT_INCOME_TOTAL", low=0, strict=True),
        q.between("DAYS_BIRTH", high=-7300, strict=True),
        q.between("OWN_CAR_AGE", low=0, high=18),
        q.not_null("EXT_SOURCE_2", mostly=0.90),
        q.not_null("EXT_SOURCE_1", mostly=0.90),
        q.not_null("NO_SUCH_COLUMN", mostly=0.99),
        q.row_count_between(1, 10_000_000_000),
        q.column_count_between(100, 130),
    ]


def _row_check_sql(number: int, name: str, column: str, failing: str, mostly: float = 1.0, nulls=False):
    considered = "count(*)" if nulls else f"count({column})"
    bad = f"count(*) FILTER ({failing})"
    percent = rounded(f"{bad} / CAST(nullif({considered}, 0) AS DOUBLE) * 100")
    return (
        f"SELECT {number} AS number, '{name}' AS expectation, '{column}' AS \"column\","
        f" ({considered} - {bad}) >= {mostly} * {considered} AS success,"
        f" CAST(NULL AS DOUBLE) AS observed_value, count(*) AS element_count,"
        f" {bad} AS unexpected_count, {percent} AS unexpected_percent FROM application_train"
    )


def _plain_sql(number: int, name: str, column: str, success: str, observed="NULL", elements="NULL"):
    column = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
    observed = "CAST(NULL AS DOUBLE)" if observed == "NULL" else rounded(observed)
    return (
        f"SELECT {number}, '{name}', {column}, {success}, {observed},"
        f" CAST({elements} AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE)"
        " FROM application_train"
    )


def _unique_sql(number: int, column: str) -> str:
    bad = (
        f"coalesce((SELECT sum(n) FROM (SELECT count(*) AS n FROM application_train"
        f" GROUP BY {column} HAVING count(*) > 1)), 0)"
    )
    return (
        f"SELECT {number}, 'unique', '{column}', {bad} = 0, CAST(NULL AS DOUBLE), count(*),"
        f" CAST({bad} AS BIGINT), {rounded(f'{bad} / CAST(count({column}) AS DOUBLE) * 100')}"
        " FROM application_train"
    )


_EXPECTATION_SQL = " UNION ALL ".join(
    [
        _row_check_sql(3, "not_null", ID, f"{ID} IS NULL", nulls=True),
        _plain_sql(1, "column_exists", ID, "true") + " LIMIT 1",
        _plain_sql(2, "column_exists", "NO_SUCH_COLUMN", "false") + " LIMIT 1",
        _row_check_sql(4, "not_null", "AMT_CREDIT", "AMT_CREDIT IS NULL", nulls=True),
        _unique_sql(5, ID),
        _unique_sql(6, "DAYS_BIRTH"),
        _plain_sql(
            7, "mean_between", "TARGET", "avg(TARGET) BETWEEN 0.05 AND 0.15", "avg(TARGET)",
            "count(*)",
        ),
        _plain_sql(
            8, "mean_between", "REGION_RATING_CLIENT",
            "avg(REGION_RATING_CLIENT) BETWEEN 0 AND 1", "avg(REGION_RATING_CLIENT)", "count(*)",
        ),
        _row_check_sql(9, "in_set", "TARGET", "TARGET NOT IN (0, 1)"),
        _row_check_sql(10, "in_set", "CODE_GENDER", "CODE_GENDER NOT IN ('M', 'F')"),
        _row_check_sql(11, "between", "AMT_INCOME_TOTAL", "AMT_INCOME_TOTAL <= 0"),
        _row_check_sql(12, "between", "DAYS_BIRTH", "DAYS_BIRTH >= -7300"),
        _row_check_sql(13, "between", "OWN_CAR_AGE", "OWN_CAR_AGE < 0 OR OWN_CAR_AGE > 18"),
        _row_check_sql(14, "not_null", "EXT_SOURCE_2", "EXT_SOURCE_2 IS NULL", 0.90, True),
        _row_check_sql(15, "not_null", "EXT_SOURCE_1", "EXT_SOURCE_1 IS NULL", 0.90, True),
        _plain_sql(16, "not_null", "NO_SUCH_COLUMN", "false") + " LIMIT 1",
        _plain_sql(17, "row_count_between", "", "count(*) >= 1", "count(*)"),
        _plain_sql(18, "column_count_between", "", "false", "23") + " LIMIT 1",
    ]
)


def _bracketed(sql: str) -> str:
    return " UNION ALL ".join(f"({part})" for part in sql.split(" UNION ALL "))


@query("Q3 Q4 Q5 Q6 Q7 Q8 Q9 Q10 Q11 Q12", f"{_APP} {_bracketed(_EXPECTATION_SQL)}")
def quality_expectations(spark: SparkSession, folder: str) -> DataFrame:
    found = q.check_expectations(loan_table(spark, folder, "application_train"), _checks())
    return comparable(found, ["number", "element_count", "unexpected_count"])


_CONTRACT = [
    q.ColumnRule(ID, T.IntegerType(), unique=True, rules=[q.greater_than(0)]),
    q.ColumnRule("DAYS_BIRTH", T.IntegerType(), unique=True, rules=[q.less_than(-8000)]),
    q.ColumnRule("AMT_CREDIT", T.DoubleType(), rules=[q.greater_than(0), q.at_least(100000)]),
    q.ColumnRule("CODE_GENDER", T.StringType(), rules=[q.member(["M", "F"])]),
    q.ColumnRule("EXT_SOURCE_3", T.FloatType(), nullable=True, rules=[q.in_range(0.0, 0.75)]),
    q.ColumnRule("NO_SUCH_COLUMN", T.StringType()),
]


def _violation_sql(column: str, check: str, failing: str, case: str | None = None) -> str:
    case = case or f"CAST({column} AS VARCHAR)"
    return (
        f"SELECT '{column}' AS \"column\", '{check}' AS \"check\", {case} AS failure_case,"
        f" count(*) AS \"rows\" FROM application_train WHERE {failing} GROUP BY {column}"
    )


_VIOLATIONS = " UNION ALL ".join(
    [
        _violation_sql(ID, "greater_than(0)", f"{ID} <= 0"),
        _violation_sql("DAYS_BIRTH", "less_than(-8000)", "DAYS_BIRTH >= -8000"),
        _violation_sql("AMT_CREDIT", "not_nullable", "AMT_CREDIT IS NULL"),
        _violation_sql("AMT_CREDIT", "greater_than_or_equal_to(100000)", "AMT_CREDIT < 100000"),
        _violation_sql("CODE_GENDER", "isin([''M'', ''F''])", "CODE_GENDER NOT IN ('M', 'F')"),
        _violation_sql("EXT_SOURCE_3", "in_range(0.0, 0.75)", "EXT_SOURCE_3 > 0.75"),
        f"""SELECT 'DAYS_BIRTH', 'unique', CAST(DAYS_BIRTH AS VARCHAR), count(*)
        FROM application_train GROUP BY DAYS_BIRTH HAVING count(*) > 1""",
        "SELECT 'AMT_CREDIT', 'dtype(double)', 'float', CAST(1 AS BIGINT)",
        "SELECT 'NO_SUCH_COLUMN', 'column_in_dataframe', 'NO_SUCH_COLUMN', 1",
    ]
)


@query("Q1 Q2", f"{_APP} {_VIOLATIONS}")
def contract_violations(spark: SparkSession, folder: str) -> DataFrame:
    return q.contract_violations(loan_table(spark, folder, "application_train"), _CONTRACT)


@query(
    "Q1 Q13",
    f"""{_APP}, v AS ({_VIOLATIONS}) SELECT "column", "check", CAST(sum("rows") AS BIGINT) AS "rows",
      count(*) AS cases FROM v GROUP BY ALL""",
)
def contract_summary(spark: SparkSession, folder: str) -> DataFrame:
    rows = loan_table(spark, folder, "application_train")
    return q.contract_summary(q.contract_violations(rows, _CONTRACT))


_ROW_CONTRACT = [r for r in _CONTRACT if r.name != "NO_SUCH_COLUMN"]


@query(
    "Q1 Q6 Q8 Q12 Q13",
    f"""{_APP}, v AS ({_VIOLATIONS}), r AS ({_bracketed(_EXPECTATION_SQL)}),
    f AS (SELECT "column", "check", sum("rows") AS n FROM v GROUP BY ALL)
    SELECT (SELECT count(*) = 0 FROM v) AS contract_passed,
      (SELECT count(*) = 0 FROM r WHERE NOT success) AS expectations_passed,
      (SELECT count(*) FROM f) AS failed_checks,
      (SELECT count(*) FROM r WHERE NOT success) AS failed_expectations,
      'contract: ' || (SELECT string_agg("column" || ' ' || "check" || ' (' || CAST(n AS BIGINT)
          || ' rows)', '; ' ORDER BY "column", "check") FROM f)
        || chr(10) || 'expectations: ' || (SELECT count(*) FROM r WHERE NOT success) || ' failed: '
        || (SELECT string_agg(expectation || '(' || coalesce("column", '') || ')', ', '
            ORDER BY number) FROM (SELECT * FROM r WHERE NOT success ORDER BY number LIMIT 5))
        AS message""",
)
def validation_gate(spark: SparkSession, folder: str) -> DataFrame:
    """The gate itself: both layers, its verdict and its message."""
    rows = loan_table(spark, folder, "application_train")
    found = validate(rows, _CONTRACT, _checks(), raise_on_failure=False)
    verdict = (
        found.contract_passed,
        found.expectations_passed,
        contract_summary(spark, folder).count(),
        found.results.where("NOT success").count(),
        found.message,
    )
    return spark.createDataFrame(
        [verdict],
        "contract_passed boolean, expectations_passed boolean, failed_checks bigint,"
        " failed_expectations bigint, message string",
    )


_BROKEN_CONTRACT = [
    q.ColumnRule(ID, T.IntegerType(), unique=True, rules=[q.greater_than(0)]),
    q.ColumnRule("AMT_CREDIT", T.FloatType(), rules=[q.greater_than(0)]),
    q.ColumnRule("CODE_GENDER", T.StringType(), rules=[q.member(["M", "F"])]),
    q.ColumnRule("GONE", T.StringType()),
]


def _broken(spark: SparkSession, folder: str) -> DataFrame:
    """A number that came as text, and a column that did not come."""
    rows = loan_table(spark, folder, "application_train")
    text = F.when(F.col("DAYS_BIRTH") % 2 == 0, "abc")
    return rows.select(ID, text.alias("AMT_CREDIT"), "CODE_GENDER")


@query(
    "Q1 Q2",
    f"""{_APP} SELECT 'AMT_CREDIT' AS "column", 'dtype(float)' AS "check",
      'string' AS failure_case, CAST(1 AS BIGINT) AS "rows"
    UNION ALL SELECT 'GONE', 'column_in_dataframe', 'GONE', 1
    UNION ALL {_violation_sql(ID, "greater_than(0)", f"{ID} <= 0")}
    UNION ALL SELECT 'AMT_CREDIT', 'not_nullable', NULL, count(*) FROM application_train
      WHERE DAYS_BIRTH % 2 <> 0
    UNION ALL SELECT 'CODE_GENDER', 'isin([''M'', ''F''])', CODE_GENDER, count(*)
      FROM application_train WHERE CODE_GENDER NOT IN ('M', 'F') GROUP BY CODE_GENDER""",
)
def broken_contract(spark: SparkSession, folder: str) -> DataFrame:
    return q.contract_violations(_broken(spark, folder), _BROKEN_CONTRACT)


@query(
    "Q6 Q7 Q8 Q12",
    """SELECT * FROM (VALUES (1, 'between', false), (2, 'mean_between', false),
      (3, 'in_set', false), (4, 'not_null', false), (5, 'in_set', false), (6, 'unique', true))
      AS t(number, expectation, success)""",
)
def broken_expectations(spark: SparkSession, folder: str) -> DataFrame:
    checks = [
        q.between("AMT_CREDIT", 0),
        q.mean_between("AMT_CREDIT", 0, 1),
        q.in_set("AMT_CREDIT", [1, 2]),
        q.not_null("AMT_CREDIT"),
        q.in_set("CODE_GENDER", [1]),
        q.unique(ID),
    ]
    found = q.check_expectations(_broken(spark, folder), checks)
    return found.select("number", "expectation", "success")


@query(
    "Q14",
    f"""{_APP} SELECT SK_ID_CURR, concat_ws('; ',
      CASE WHEN SK_ID_CURR <= 0 THEN 'SK_ID_CURR: greater_than(0)' END,
      CASE WHEN DAYS_BIRTH % 2 <> 0 THEN 'AMT_CREDIT: not_nullable' END,
      'AMT_CREDIT: dtype(float)',
      CASE WHEN CODE_GENDER NOT IN ('M', 'F') THEN 'CODE_GENDER: isin([''M'', ''F''])' END,
      'GONE: column_in_dataframe') AS errors FROM application_train""",
)
def broken_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    _, rejected = q.split_valid(_broken(spark, folder), _BROKEN_CONTRACT)
    return rejected.select(ID, F.concat_ws("; ", "errors").alias("errors"))


@query(
    "Q14",
    f"""{_APP}, e AS (SELECT SK_ID_CURR, concat_ws('; ',
      CASE WHEN SK_ID_CURR <= 0 THEN 'SK_ID_CURR: greater_than(0)' END,
      CASE WHEN DAYS_BIRTH >= -8000 THEN 'DAYS_BIRTH: less_than(-8000)' END,
      CASE WHEN AMT_CREDIT IS NULL THEN 'AMT_CREDIT: not_nullable' END,
      CASE WHEN AMT_CREDIT <= 0 THEN 'AMT_CREDIT: greater_than(0)' END,
      CASE WHEN AMT_CREDIT < 100000 THEN 'AMT_CREDIT: greater_than_or_equal_to(100000)' END,
      CASE WHEN CODE_GENDER NOT IN ('M', 'F') THEN 'CODE_GENDER: isin([''M'', ''F''])' END,
      CASE WHEN EXT_SOURCE_3 > 0.75 THEN 'EXT_SOURCE_3: in_range(0.0, 0.75)' END) AS errors
      FROM application_train)
    SELECT SK_ID_CURR, errors FROM e""",
)
def row_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    rows = loan_table(spark, folder, "application_train")
    valid, rejected = q.split_valid(rows, _ROW_CONTRACT)
    return rejected.select(ID, F.concat_ws("; ", "errors").alias("errors")).unionByName(
        valid.select(ID, F.lit("").alias("errors"))
    )
