"""Running totals in key order without a single-task sort.

Rows are reduced to one per distinct key, keys are cut into ranges at edges found
by counting, each range is summed in its own window, and the totals of the ranges
before it are added. The edges only balance the work; any edges give the same
totals. No range holds more than its share of all rows, unless it is one key,
and a key is a single row by then.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanloom.operators.bins import LARGEST, Bracket, bounds, count_bins, finite, long_values

#: Bins per expected range in a counting round.
FINE = 8


def range_edges(
    df: DataFrame, key: str, rows_per_range: int = 1_000_000, min_ranges: int = 8
) -> list[float]:
    """Values of ``key`` that cut it into ranges of at most ``rows_per_range``
    rows and of at most a ``min_ranges``-th of them, but for ranges of one key.
    Bins with too many rows are counted again in finer ones, so the number of
    edges follows the number of rows. They are read to the driver once, so every
    use in a plan sees the same edges."""
    values = long_values(df, F.array(finite(F.col(key))), 1)
    (whole,) = bounds(values, 1)
    if not whole.rows:
        return []
    most = max(1, min(rows_per_range, math.ceil(whole.rows / min_ranges)))
    leaves, heavy, step = [], [whole], 0
    while heavy:
        brackets = [
            Bracket(0, b.low, b.high, step % 2 == 1, FINE * math.ceil(b.rows / most)) for b in heavy
        ]
        heavy = []
        for bins in count_bins(values, brackets):
            for b in bins:
                (heavy if b.rows > most and b.low < b.high else leaves).append(b)
        step += 1
    edges, rows = [], 0
    for b in sorted(leaves, key=lambda b: b.low):
        if rows and rows + b.rows > most:
            edges.append(b.low)
            rows = 0
        rows += b.rows
    return [e for e in edges if abs(e) < LARGEST]


def assign_range(df: DataFrame, key: str, edges: list[float], output: str) -> DataFrame:
    """Number of edges at or below the key (binary search in the JVM). The
    number is never NULL, so a join on it adds no filter that would keep Spark
    from reusing a shuffle."""
    if not edges:
        return df.withColumn(output, F.lit(0))
    ranged = Bucketizer(
        splits=[-math.inf, *edges, math.inf], inputCol=key, outputCol=output
    ).transform(df)
    return ranged.withColumn(output, F.coalesce(F.col(output).cast("int"), F.lit(0)))


def running_totals(
    df: DataFrame,
    key: str,
    sums: list[str],
    groups: list[str] | None = None,
    descending: bool = False,
    rows_per_range: int = 1_000_000,
    min_ranges: int = 8,
) -> DataFrame:
    """One row per (groups, key) with the sums of that key, their running totals
    up to and including it (``run_x``) and their group totals (``total_x``).

    ``key`` is numeric; rows without a key or a group value are left out.
    """
    groups = groups or []
    present = [F.col(c).isNotNull() for c in [key, *groups]]
    rows = df.select(*groups, F.col(key).cast("double").alias(key), *sums)
    for condition in present:
        rows = rows.where(condition)
    edges = range_edges(rows, key, rows_per_range, min_ranges)
    by_key = rows.groupBy(*groups, key).agg(*[F.sum(c).alias(c) for c in sums])
    ranged = assign_range(by_key, key, edges, "_range")

    order = F.col(key).desc() if descending else F.col(key).asc()
    inside = (
        Window.partitionBy(*groups, "_range")
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = ranged.select("*", *[F.sum(c).over(inside).alias(f"run_{c}") for c in sums])

    range_order = F.col("_range").desc() if descending else F.col("_range").asc()
    group_rows = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    before = group_rows.orderBy(range_order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(*groups, "_range")
        .agg(*[F.sum(c).alias(c) for c in sums])
        .select(
            *groups,
            "_range",
            *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_before_{c}") for c in sums],
            *[F.sum(c).over(group_rows).alias(f"total_{c}") for c in sums],
        )
    )
    return local.join(offsets, [*groups, "_range"]).select(
        *groups,
        key,
        *sums,
        *[(F.col(f"run_{c}") + F.col(f"_before_{c}")).alias(f"run_{c}") for c in sums],
        *[f"total_{c}" for c in sums],
    )
