"""From the seven source tables to one wide row per applicant."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from loanloom.functions.columns import cast_numeric_to_float
from loanloom.operators.aggregates import (
    left_join_all,
    require_same_rows,
    shape_and_null_rate,
)
from loanloom.operators.applicants import (
    aggregate_bureau,
    aggregate_installments,
    aggregate_pos_cash,
    aggregate_previous_applications,
)
from loanloom.sources.csv_tables import load_table
from loanloom.sources.schemas import APPLICANT_ID
from loanloom.sources.tables import delete_table, publish_table, read_table, write_table


def wide_table(tables: dict[str, DataFrame], as_float32: bool = True) -> DataFrame:
    """The application table with the aggregates of its child tables. Each child
    holds one row per applicant by then, so rows cannot multiply."""
    children = [
        aggregate_bureau(tables["bureau.csv"], tables["bureau_balance.csv"]),
        aggregate_previous_applications(tables["previous_application.csv"]),
        aggregate_pos_cash(tables["POS_CASH_balance.csv"]),
        aggregate_installments(tables["installments_payments.csv"]),
    ]
    if as_float32:
        children = [cast_numeric_to_float(c, [APPLICANT_ID]) for c in children]
    return left_join_all(tables["application_train.csv"], children, APPLICANT_ID)


def build_wide_table(
    spark: SparkSession,
    folder: str,
    output: str,
    extra_schemas: dict[str, StructType] | None = None,
) -> DataFrame:
    """Read the CSV tables, write the wide table beside its place, check its row
    count against the application table, and only then put it in place of an
    older one. Returns shape and null rate."""
    needed = [
        "application_train.csv",
        "bureau.csv",
        "bureau_balance.csv",
        "previous_application.csv",
        "POS_CASH_balance.csv",
        "installments_payments.csv",
    ]
    stored = extra_schemas or {}
    tables = {n: load_table(spark, folder, n, None, stored.get(n)) for n in needed}
    fresh = f"{output.rstrip('/')}.{uuid.uuid4().hex}"
    write_table(wide_table(tables), fresh, "errorifexists")
    try:
        require_same_rows(
            tables["application_train.csv"].count(), read_table(spark, fresh).count()
        )
    except Exception:
        delete_table(spark, fresh)
        raise
    publish_table(spark, fresh, output)
    return shape_and_null_rate(read_table(spark, output))


def load_wide_table(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path)
