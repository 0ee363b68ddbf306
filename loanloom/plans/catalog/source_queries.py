"""Queries that write a table to the shared folder and read it back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.operators import aggregates as agg
from loanloom.operators import quality as q
from loanloom.operators import training
from loanloom.plans.catalog.base import comparable, query, rounded, table
from loanloom.plans.catalog.credit_view import loan_sql, loan_table
from loanloom.plans.catalog.model_queries import ID, LABEL, applicants
from loanloom.session import ensure_checkpoint_dir
from loanloom.sources import csv_tables, stores, tables

BALANCE = "bureau_balance.csv"


def _folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark)}/sources/{uuid.uuid4().hex}"


def _balance_files(spark: SparkSession, folder: str) -> str:
    target = _folder(spark)
    tables.write_csv(loan_table(spark, folder, "bureau_balance"), f"{target}/{BALANCE}")
    return target


@query(
    "S1 S3 S4 S9",
    f"""WITH {loan_sql("bureau_balance")} SELECT SK_ID_BUREAU, MONTHS_BALANCE, STATUS,
      count(*) AS "rows" FROM bureau_balance GROUP BY ALL""",
)
def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    rows = csv_tables.load_table(spark, _balance_files(spark, folder), BALANCE)
    return rows.groupBy(rows.columns).agg(F.count(F.lit(1)).alias("rows"))


@query(
    "S2",
    "SELECT least(count(*), 1000) AS \"rows\" FROM lineitem",
)
def row_limited_scan(spark: SparkSession, folder: str) -> DataFrame:
    rows = csv_tables.load_table(spark, _balance_files(spark, folder), BALANCE, nrows=1000)
    return rows.agg(F.count(F.lit(1)).alias("rows"))


@query(
    "S5 S1",
    f"""WITH {loan_sql("application_train")} SELECT SK_ID_CURR, CODE_GENDER,
      {rounded("AMT_CREDIT")} AS AMT_CREDIT, false AS labelled FROM application_train""",
)
def unlabelled_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Applicants to be scored: the declared columns without the label."""
    target = _folder(spark)
    rows = loan_table(spark, folder, "application_train").drop(LABEL)
    tables.write_csv(rows, f"{target}/application_test.csv")
    found = csv_tables.load_table(spark, target, "application_test.csv")
    found = found.withColumn("labelled", F.lit(LABEL in found.columns))
    return comparable(found.select(ID, "CODE_GENDER", "AMT_CREDIT", "labelled"), [ID])


@query("S7 S8", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def parquet_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    target = _folder(spark)
    tables.write_table(table(spark, folder, "orders"), target)
    return tables.read_table(spark, target).select("o_orderkey", "o_totalprice", "o_orderstatus")


@query(
    "S10 Q12",
    f"""WITH {loan_sql("application_train")} SELECT CAST(1 AS BIGINT) AS number,
      'not_null' AS expectation, count(*) AS element_count,
      count(*) - count(EXT_SOURCE_1) AS unexpected_count,
      {rounded("(count(*) - count(EXT_SOURCE_1)) / CAST(count(*) AS DOUBLE) * 100")}
        AS unexpected_percent
    FROM application_train""",
)
def json_report(spark: SparkSession, folder: str) -> DataFrame:
    target = _folder(spark)
    rows = loan_table(spark, folder, "application_train")
    tables.write_json(q.check_expectations(rows, [q.not_null("EXT_SOURCE_1")]), target)
    return spark.read.json(target).select(
        "number",
        "expectation",
        "element_count",
        "unexpected_count",
        F.round("unexpected_percent", 6).alias("unexpected_percent"),
    )


@query(
    "J5",
    """SELECT count(*) AS before, count(*) AS after FROM customer""",
)
def rows_kept_by_join(spark: SparkSession, folder: str) -> DataFrame:
    """Left-joining one row per key keeps the row count; the check raises else."""
    main = table(spark, folder, "customer").withColumnRenamed("c_custkey", "o_custkey")
    child = agg.aggregate_children(
        table(spark, folder, "orders"), "o_custkey", {"o_totalprice": ["max"]}, "ORD"
    )
    agg.require_unique_key(child, "o_custkey")
    joined = agg.left_join_all(main, [child], "o_custkey")
    before, after = main.count(), joined.count()
    agg.require_same_rows(before, after)
    return spark.createDataFrame([(before, after)], "before bigint, after bigint")


@query(
    "S14 S15 T8",
    """SELECT run, kind, name, CASE WHEN kind = 'metric' THEN CAST(n AS DOUBLE) END AS number,
      CASE WHEN kind = 'param' THEN version END AS text, true AS same_scores
    FROM (VALUES ('first', '1'), ('second', '2')) AS r(run, version),
      (VALUES ('param', 'version'), ('metric', 'rows')) AS k(kind, name),
      (SELECT count(*) AS n FROM customer)""",
)
def model_registry(spark: SparkSession, folder: str) -> DataFrame:
    """Register two versions, load the newest, and read the run log."""
    root = _folder(spark)
    rows = applicants(spark, folder)
    model = training.fit_model(rows, training.LOGISTIC, LABEL, None, [ID])
    for run in ("first", "second"):
        version = stores.register_model(model, f"{root}/models", "champion", run, spark)
        stores.log_run(
            spark, f"{root}/runs", run, {"version": version}, {"rows": rows.count()}
        )
    loaded = stores.load_registered(spark, f"{root}/models", "champion")
    kept = loaded.transform(rows).select(F.round(training.SCORE, 9).alias("s"))
    first = model.transform(rows).select(F.round(training.SCORE, 9).alias("s"))
    same = kept.exceptAll(first).isEmpty()
    return stores.read_runs(spark, f"{root}/runs").select(
        "run", "kind", "name", "number", "text", F.lit(same).alias("same_scores")
    )
