"""Loan tables and the wide row stored by applicant.

Tables stored in buckets of the applicant key meet without a shuffle, so the wide
row can be built again and again for the price of the scans. The wide row is kept
as groups of columns, each narrow enough for code generation, and a reader joins
only the groups whose columns it names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.functions.columns import cast_numeric_to_float
from loanloom.operators.aggregates import left_join_all, size
from loanloom.operators.applicants import (
    aggregate_bureau,
    aggregate_installments,
    aggregate_pos_cash,
    aggregate_previous_applications,
)
from loanloom.session import cut_lineage, delete_at_end, ensure_checkpoint_dir
from loanloom.sources.schemas import APPLICANT_ID

#: Columns of a group, the key included. Spark generates code up to 100.
GROUP_COLUMNS = 90
#: A key with this many times the rows of an even bucket is not bucketed.
HOT_KEY = 4


def has_hot_key(df: DataFrame, key: str, buckets: int) -> bool:
    """Whether one key owns far more rows than an even bucket would hold. Counted
    with one row per key and task, so the answer itself is not skewed."""
    found = (
        df.groupBy(key)
        .agg(size().alias("rows"))
        .agg(F.max("rows").alias("largest"), F.sum("rows").alias("total"))
        .first()
    )
    return bool(found["total"]) and found["largest"] * buckets > HOT_KEY * found["total"]


def store_by_key(df: DataFrame, key: str, buckets: int, folder: str | None = None) -> DataFrame:
    """Write ``df`` in buckets of ``key``, sorted inside, one file a bucket, and
    return the table. A bucket is read by one task; a table in which one key
    owns many buckets' worth of rows is therefore written without buckets, and its
    aggregates combine before a shuffle as usual. Without a folder the table lies
    in the checkpoint folder and goes when the session ends."""
    spark = df.sparkSession
    name = f"stored_{uuid.uuid4().hex}"
    path = f"{folder or ensure_checkpoint_dir(spark)}/{name}"
    if has_hot_key(df, key, buckets):
        writer = df.write
    else:
        writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    writer = writer.option("compression", "zstd")
    writer.option("path", path).format("parquet").saveAsTable(name)
    if folder is None:
        delete_at_end(spark, path)
    return spark.table(name)


def store_tables(
    tables: dict[str, DataFrame], buckets: int, folder: str | None = None
) -> dict[str, DataFrame]:
    """The loan tables by applicant. Rows of child tables without an applicant
    count nowhere and are left out; monthly status gets its loan's applicant, a row
    for each loan it belongs to. What comes back has the names it went in with."""
    loans = tables["bureau.csv"].select("SK_ID_BUREAU", APPLICANT_ID)
    keyed = dict(tables)
    # both sides grow with the applicants: dealt by loan at any size, and once: the
    # joined rows are read to count keys and to be dealt by applicant
    keyed["bureau_balance.csv"] = cut_lineage(
        tables["bureau_balance.csv"].join(loans.hint("merge"), "SK_ID_BUREAU")
    )
    stored = {}
    for name, df in keyed.items():
        if APPLICANT_ID not in df.columns:
            stored[name] = df
            continue
        if not name.startswith("application"):
            df = df.where(F.col(APPLICANT_ID).isNotNull())
        stored[name] = store_by_key(df, APPLICANT_ID, buckets, folder)
    return stored


def column_groups(tables: dict[str, DataFrame], as_float32: bool = True) -> dict[str, DataFrame]:
    """The wide row as groups of at most ``GROUP_COLUMNS`` columns, the key in
    each: the applications in as many as they need, then one a child table."""
    main = tables["application_train.csv"]
    rest = [c for c in main.columns if c != APPLICANT_ID]
    step = GROUP_COLUMNS - 1
    groups = {
        f"application_{i // step}": main.select(APPLICANT_ID, *rest[i : i + step])
        for i in range(0, max(len(rest), 1), step)
    }
    children = {
        "bureau": aggregate_bureau(tables["bureau.csv"], tables["bureau_balance.csv"]),
        "previous": aggregate_previous_applications(tables["previous_application.csv"]),
        "pos": aggregate_pos_cash(tables["POS_CASH_balance.csv"]),
        "installments": aggregate_installments(tables["installments_payments.csv"]),
    }
    if as_float32:
        children = {n: cast_numeric_to_float(c, [APPLICANT_ID]) for n, c in children.items()}
    return groups | children


def store_groups(
    groups: dict[str, DataFrame], buckets: int, folder: str | None = None
) -> dict[str, DataFrame]:
    return {n: store_by_key(g, APPLICANT_ID, buckets, folder) for n, g in groups.items()}


def read_columns(groups: dict[str, DataFrame], columns: list[str] | None = None) -> DataFrame:
    """One row per applicant with the named columns, all of them by default. Only
    groups that hold a named column are joined to the first. Applicant ids must be
    present and unique, as the contract demands."""
    names = list(groups)
    if columns is not None:
        unknown = set(columns) - {c for g in groups.values() for c in g.columns}
        if unknown:
            raise ValueError(f"no group holds {sorted(unknown)}")
        wanted = {*columns, APPLICANT_ID}
        groups = {
            n: g.select(*[c for c in g.columns if c in wanted])
            for n, g in groups.items()
            if n == names[0] or (set(g.columns) & set(columns)) - {APPLICANT_ID}
        }
    first, *others = groups.values()
    wide = left_join_all(first, others, APPLICANT_ID)
    return wide.select(*columns) if columns is not None else wide


def group_null_rates(groups: dict[str, DataFrame]) -> DataFrame:
    """(column, null_rate) of the wide row, a group at a time: what a child table
    lacks for an applicant counts as missing, without any wide join."""
    names = list(groups)
    rows = groups[names[0]].agg(size().alias("rows"))
    parts = []
    for name, group in groups.items():
        if not name.startswith("application"):
            group = group.join(groups[names[0]].select(APPLICANT_ID), APPLICANT_ID, "left_semi")
        present = [
            F.struct(F.lit(c).alias("column"), F.count(F.col(f"`{c}`")).alias("present"))
            for c in group.columns
            if c != APPLICANT_ID or name == names[0]
        ]
        parts.append(group.agg(F.array(*present).alias("s")).select(F.inline("s")))
    counted = parts[0]
    for part in parts[1:]:
        counted = counted.unionByName(part)
    total = rows.scalar()
    return counted.select(
        "column",
        F.when(total > 0, (total - F.col("present")) / total.cast("double")).alias("null_rate"),
    )
