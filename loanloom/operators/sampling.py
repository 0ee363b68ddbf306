"""Repeatable samples, splits and folds from hashed row ids.

The hash of ``id-seed`` gives every row a fixed place in a shuffled order, so a
result does not change with partitioning, retries or engine. Splits and folds
need only the hash values at their borders: those are looked up first, a row per
class, and each row is then assigned by comparing its own hash with them. Ids
must be unique.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.functions.columns import drop_incomplete
from loanloom.functions.scalars import hash_order
from loanloom.session import cut_lineage

#: Rows that share a hash prefix, on average, at most.
ROWS_PER_PREFIX = 100_000


#: Hexadecimal digits of the hash by which rows are counted at once.
STEP_DIGITS = 3


def _prefix_of_rank(hashes: DataFrame, n: int) -> str | None:
    """A hash prefix up to which there are at least n rows, and at most n more
    than that; none if all rows are fewer. Each step counts the rows by the next
    digits, 4,096 groups at most."""
    known, before = "", 0
    while len(known) < 32:
        digits = F.substring("hash", len(known) + 1, STEP_DIGITS).alias("digits")
        inside = hashes.where(F.col("hash").startswith(known))
        counts = sorted(inside.groupBy(digits).count().collect())
        for found, rows in counts:
            if before + rows >= n:
                break
            before += rows
        else:
            return None
        known += found
        if rows <= n:
            break
    return known


def hash_sample(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly n rows (all, if fewer), the same ones on every run. Rows are counted
    by hash prefix first, so that the last step sorts the n rows and no more than n
    others, however many partitions there are."""
    if n <= 0:
        return df.limit(0)
    hashes = df.select(hash_order(F.col(id_col), seed).alias("hash"))
    last = _prefix_of_rank(hashes, n)
    if last is None:
        return df
    place = hash_order(F.col(id_col), seed)
    rows = df.where(F.substring(place, 1, len(last)) <= F.lit(last))
    return rows.orderBy(hash_order(F.col(id_col), seed), id_col).limit(n)


def complete_sample(
    df: DataFrame, id_col: str, columns: list[str], n: int, seed: int = 42
) -> DataFrame:
    """Sample among the rows that have all ``columns``."""
    return hash_sample(drop_incomplete(df, columns), id_col, n, seed)


def _border_hashes(
    df: DataFrame, id_col: str, label: str, seed: int, ranks: Column, digits: int | None
) -> DataFrame:
    """(label, borders): per class the hash at each of ``ranks``, an array over
    the class's row count ``total``; NULL for rank 0. First the class is counted
    by hash prefix, then only the prefixes that hold a border are ranked. A
    table with one row per class, stored, so that its size is known."""
    keyed = df.where(F.col(label).isNotNull()).select(
        F.col(label).alias("label"), hash_order(F.col(id_col), seed).alias("hash")
    )
    if digits is None:
        rows = df.select(label).count()
        digits = max(2, math.ceil(math.log(max(1, rows / ROWS_PER_PREFIX), 16)))
    prefixed = keyed.withColumn("prefix", F.substring("hash", 1, digits))
    counts = cut_lineage(prefixed.groupBy("label", "prefix").agg(F.count(F.lit(1)).alias("rows")))
    in_class = Window.partitionBy("label")
    before = in_class.orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    cells = counts.select(
        "label",
        "prefix",
        "rows",
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"),
        F.sum("rows").over(in_class).alias("total"),
    )
    totals = counts.groupBy("label").agg(F.sum("rows").alias("total"))
    wanted = totals.select("label", F.posexplode(ranks).alias("border", "rank"))
    cells = cells.select("label", "prefix", "rows", "before", F.posexplode(ranks).alias("border", "rank"))
    inside = (F.col("rank") > F.col("before")) & (F.col("rank") <= F.col("before") + F.col("rows"))
    cells = cut_lineage(
        cells.where(inside).select("label", "prefix", "border", (F.col("rank") - F.col("before")).alias("place"))
    )
    order = Window.partitionBy("label", "prefix").orderBy("hash")
    ranked = prefixed.join(cells.select("label", "prefix").distinct(), ["label", "prefix"], "left_semi")
    ranked = ranked.withColumn("place", F.row_number().over(order))
    found = ranked.join(cells, ["label", "prefix", "place"]).select("label", "border", "hash")
    borders = wanted.join(found, ["label", "border"], "left").groupBy("label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("border", "hash"))), lambda x: x["hash"]).alias("borders")
    )
    return cut_lineage(borders)


def _numbered(
    df: DataFrame, id_col: str, label: str, seed: int, borders: DataFrame, output: str
) -> DataFrame:
    """Adds how many borders of its class a row's hash lies beyond; NULL without
    a class. The hash is bound to a lambda variable, so it is computed once."""
    named = borders.select(F.col("label").alias("_class"), F.col("borders").alias("_borders"))

    def passed(place: Column) -> Column:
        beyond = F.filter("_borders", lambda h: h.isNull() | (place > h))
        return F.when(F.col("_borders").isNotNull(), F.size(beyond))

    number = F.transform(F.array(hash_order(F.col(id_col), seed)), passed)[0]
    joined = df.join(named, df[label] == named["_class"], "left")
    return joined.withColumn(output, number).drop("_class", "_borders")


def stratified_parts(
    df: DataFrame,
    id_col: str,
    label: str,
    shares: list[float],
    seed: int = 42,
    output: str = "part",
    digits: int | None = None,
) -> DataFrame:
    """Number the rows 0, 1, … by consecutive shares of each class in hash
    order. A border after share s of n rows lies at rank round-half-up(s·n)."""
    cumulative = [sum(shares[: i + 1]) for i in range(len(shares) - 1)]
    ranks = F.array(*[F.floor(F.lit(s) * F.col("total") + 0.5).cast("long") for s in cumulative])
    borders = _border_hashes(df, id_col, label, seed, ranks, digits)
    return _numbered(df, id_col, label, seed, borders, output)


def stratified_split(
    df: DataFrame,
    id_col: str,
    label: str,
    test_share: float = 0.2,
    seed: int = 42,
    digits: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(train, test) with the class shares of the whole."""
    parts = stratified_parts(
        df, id_col, label, [test_share, 1.0 - test_share], seed, "_part", digits
    )
    return (
        parts.where("_part = 1").drop("_part"),
        parts.where("_part = 0").drop("_part"),
    )


def stratified_folds(
    df: DataFrame,
    id_col: str,
    label: str,
    folds: int = 5,
    seed: int = 42,
    output: str = "fold",
    digits: int | None = None,
) -> DataFrame:
    """Fold numbers 0 … folds-1; within a class the fold sizes differ by at
    most one row."""
    ranks = F.transform(F.sequence(F.lit(1), F.lit(folds - 1)), lambda i: F.expr("total") * i)
    ranks = F.transform(ranks, lambda r: F.floor(r / F.lit(folds)).cast("long"))
    if folds < 2:
        ranks = F.array().cast("array<long>")
    borders = _border_hashes(df, id_col, label, seed, ranks, digits)
    return _numbered(df, id_col, label, seed, borders, output)
