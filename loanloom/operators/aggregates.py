"""Per-key aggregates with exact null rules.

Everything one table contributes to a key is written as one ``agg`` call, so
rows are combined on the map side and a key that owns a large share of the rows
reaches the shuffle as one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.functions.columns import aggregate_name
from loanloom.functions.scalars import ratio


def mean_of(column: Column, dtype: T.DataType | None = None) -> Column:
    """Mean over present values. Decimal sums are exact, so their mean is the
    exact sum divided once, whatever order the rows arrive in."""
    if isinstance(dtype, T.DecimalType):
        return ratio(F.sum(column), F.count(column))
    return F.avg(column)


def sum_of(column: Column) -> Column:
    """Sum over present values; 0 when there are none."""
    return F.coalesce(F.sum(column), F.lit(0))


def size() -> Column:
    """Rows, with missing values counted."""
    return F.count(F.lit(1))


def count_when(condition: Column) -> Column:
    """Rows that meet the condition; NULL (not 0) when none do."""
    return F.sum(F.when(condition, F.lit(1)))


def rate_when(condition: Column) -> Column:
    """Share of rows that meet the condition; NULL when none do."""
    return ratio(count_when(condition), size())


def mean_when(condition: Column, column: Column) -> Column:
    return F.avg(F.when(condition, column))


def mean_guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """Mean of row ratios over rows with a positive denominator."""
    return F.avg(F.when(denominator > 0, ratio(numerator, denominator)))


def distinct_count(column: Column) -> Column:
    return F.count_distinct(column)


def distinct_per_key(
    df: DataFrame, keys: list[str], column: str, output: str | None = None
) -> DataFrame:
    """One row per key with the exact number of distinct present values of a
    whole-number column; 0 where there are none.

    A value marks one bit of the 64-bit word it lies in. Words are or-ed on the
    map side and again after the shuffle, and their bits are counted: the counts of
    parts can be merged, values that lie close share a row, and a key that owns a
    large share of the rows is spread by word. A null key is a key."""
    output = output or f"{column}_distinct"
    value = F.col(column).cast("long")
    words = df.groupBy(*keys, F.shiftright(value, 6).alias("_word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, CAST(CAST(`{column}` AS BIGINT) & 63 AS INT))")).alias(
            "_bits"
        )
    )
    return words.groupBy(*keys).agg(
        F.coalesce(F.sum(F.bit_count("_bits")), F.lit(0)).cast("long").alias(output)
    )


def _expand(df: DataFrame, spec: dict[str, list[str]], prefix: str) -> list[Column]:
    build = {
        "min": lambda c, t: F.min(c),
        "max": lambda c, t: F.max(c),
        "mean": mean_of,
        "sum": lambda c, t: sum_of(c),
        "std": lambda c, t: F.stddev_samp(c),
        "size": lambda c, t: size(),
        "nunique": lambda c, t: distinct_count(c),
    }
    return [
        build[fn](F.col(name), df.schema[name].dataType).alias(
            aggregate_name(prefix, name, fn)
        )
        for name, functions in spec.items()
        for fn in functions
    ]


def aggregate_children(
    df: DataFrame,
    key: str,
    spec: dict[str, list[str]],
    prefix: str,
    extras: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per key: ``spec`` maps columns to functions and names the results
    PREFIX_COLUMN_FUNCTION; ``extras`` are further named aggregates. Rows without
    a key are left out."""
    named = [c.alias(name) for name, c in (extras or {}).items()]
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(
        *_expand(df, spec, prefix), *named
    )


def aggregate_grandchildren(
    rows: DataFrame,
    links: DataFrame,
    link: str,
    key: str,
    spec: dict[str, list[str]],
    prefix: str,
    rates: dict[str, Column] | None = None,
) -> DataFrame:
    """Aggregate rows that reach ``key`` through a ``link`` table.

    ``rows`` are first reduced to one line per link, so the join moves links,
    not rows, and a link that owns a large share of the rows cannot skew it. A
    pair in ``links`` that occurs m times counts its rows m times, as the plain
    join would. Functions: mean, min, max, sum, size.
    """
    partial, final = [], []
    needed = {fn for fns in spec.values() for fn in fns}
    unknown = needed - {"mean", "min", "max", "sum", "size"}
    if unknown:
        raise ValueError(f"cannot combine {sorted(unknown)} from partial results")
    for name, functions in spec.items():
        value = F.col(name)
        if {"mean", "sum"} & set(functions):
            partial += [
                F.sum(value).alias(f"_sum_{name}"),
                F.count(value).alias(f"_n_{name}"),
            ]
        total = F.sum(F.col(f"_sum_{name}") * F.col("_pairs"))
        parts = {
            "mean": (
                None,
                ratio(total, F.sum(F.col(f"_n_{name}") * F.col("_pairs"))),
            ),
            "sum": (None, F.coalesce(total, F.lit(0))),
            "min": (F.min(value).alias(f"_min_{name}"), F.min(f"_min_{name}")),
            "max": (F.max(value).alias(f"_max_{name}"), F.max(f"_max_{name}")),
            "size": (None, F.sum(F.col("_rows") * F.col("_pairs"))),
        }
        for fn in functions:
            first, last = parts[fn]
            if first is not None:
                partial.append(first)
            final.append(last.alias(aggregate_name(prefix, name, fn)))
    rows_total = F.sum(F.col("_rows") * F.col("_pairs"))
    for i, (name, condition) in enumerate((rates or {}).items()):
        partial.append(F.count_if(condition).alias(f"_hits_{i}"))
        hits = F.sum(F.col(f"_hits_{i}") * F.col("_pairs"))
        final.append(F.when(hits > 0, ratio(hits, rows_total)).alias(name))
    per_link = rows.where(F.col(link).isNotNull()).groupBy(link).agg(
        F.count(F.lit(1)).alias("_rows"), *partial
    )
    pairs = (
        links.where(F.col(link).isNotNull() & F.col(key).isNotNull())
        .groupBy(link, key)
        .agg(F.count(F.lit(1)).alias("_pairs"))
    )
    return per_link.join(pairs, link).groupBy(key).agg(*final)


def left_join_all(main: DataFrame, others: list[DataFrame], key: str) -> DataFrame:
    """Left-join tables that hold one row per key. All sides are hashed on the
    same key, so ``main`` is shuffled once for the whole chain."""
    for other in others:
        main = main.join(other, key, "left")
    return main


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("rows"))
        .where("rows > 1")
    )


def require_unique_key(df: DataFrame, key: str) -> None:
    found = duplicate_keys(df, key).first()
    if found is not None:
        raise ValueError(f"{key} is not unique: {found[0]} occurs {found[1]} times")


def require_same_rows(before: int, after: int) -> None:
    if before != after:
        raise AssertionError(f"row count changed in a join: {before} before, {after} after")


def null_rates(df: DataFrame) -> DataFrame:
    """(column, null_rate) from one wide aggregate."""
    shares = [
        F.struct(
            F.lit(c).alias("column"),
            F.avg(F.col(f"`{c}`").isNull().cast("double")).alias("null_rate"),
        )
        for c in df.columns
    ]
    return df.agg(F.array(*shares).alias("s")).select(F.inline("s"))


def shape_and_null_rate(df: DataFrame) -> DataFrame:
    """Rows, columns and the mean of the column null rates."""
    shares = [F.avg(F.col(f"`{c}`").isNull().cast("double")) for c in df.columns]
    overall = sum(shares, F.lit(0.0)) / len(df.columns)
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        overall.alias("null_rate"),
    )
