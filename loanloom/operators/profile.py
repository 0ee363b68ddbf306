"""Profiling of a labelled table: shares, nulls, correlations, categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.functions.columns import categorical_columns, numeric_columns
from loanloom.functions.scalars import ratio
from loanloom.operators.aggregates import distinct_per_key, null_rates
from loanloom.operators.quantiles import exact_quantiles
from loanloom.operators.sampling import hash_sample
from loanloom.session import cut_lineage

#: Cells that values are counted in before single values are.
CELLS = 1 << 16


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Count and share of every value, missing values left out."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).count()
    total = counted.agg(F.sum("count").alias("total"))
    return counted.select(
        column, "count", ratio(F.col("count"), total.scalar()).alias("share")
    )


def null_rate_summary(rates: DataFrame) -> DataFrame:
    """How many columns lie above 50, 20 and 5 percent missing."""
    return rates.agg(
        F.count_if(F.col("null_rate") > 0.50).alias("above_50"),
        F.count_if(F.col("null_rate") > 0.20).alias("above_20"),
        F.count_if(F.col("null_rate") > 0.05).alias("above_05"),
    )


def top(df: DataFrame, value: str, name: str, k: int) -> DataFrame:
    """The k largest values; equal values go by name."""
    return df.orderBy(F.desc(value), name).limit(k)


def both_tails(df: DataFrame, value: str, name: str, k: int = 15) -> DataFrame:
    """The k smallest and the k largest values."""
    low = df.orderBy(F.asc(value), name).limit(k)
    high = df.orderBy(F.desc(value), F.desc(name)).limit(k)
    return low.unionByName(high)


def extremes(df: DataFrame, value: str, name: str) -> DataFrame:
    """Names of the largest and smallest value."""
    return df.agg(
        F.max_by(name, value).alias("largest"),
        F.max(value).alias("largest_value"),
        F.min_by(name, value).alias("smallest"),
        F.min(value).alias("smallest_value"),
    )


def _correlation(x: Column, y: Column) -> Column:
    """Pearson over complete pairs; NULL for a constant side."""
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def label_correlations(
    df: DataFrame, label: str, columns: list[str] | None = None, exclude: list[str] | None = None
) -> DataFrame:
    """(column, correlation) with the label for every numeric column."""
    names = columns or numeric_columns(df, [label, *(exclude or [])])
    y = F.col(label).cast("double")
    found = [
        F.struct(
            F.lit(c).alias("column"),
            _correlation(F.col(f"`{c}`").cast("double"), y).alias("correlation"),
        )
        for c in names
    ]
    return df.agg(F.array(*found).alias("s")).select(F.inline("s"))


def label_rate_by_category(df: DataFrame, label: str, columns: list[str]) -> DataFrame:
    """(feature, category, size, label_rate) for several text columns at once."""
    present = [c for c in columns if c in df.columns]
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category"))
            for c in present
        ]
    )
    return (
        df.select(F.col(label).cast("double").alias("_label"), F.inline(entries))
        .where("category is not null")
        .groupBy("feature", "category")
        .agg(F.count("_label").alias("size"), F.avg("_label").alias("label_rate"))
    )


def sentinel_analysis(df: DataFrame, column: str, sentinel, label: str) -> DataFrame:
    """Rows that hold the sentinel, their share, and the label rate in percent
    with and without it. A missing value counts as "without"."""
    marked = F.coalesce(F.col(column) == sentinel, F.lit(False))
    y = F.col(label).cast("double")
    return df.agg(
        F.count_if(marked).alias("sentinel_count"),
        (ratio(F.count_if(marked), F.count(F.lit(1))) * 100).alias("sentinel_pct"),
        (F.avg(F.when(marked, y)) * 100).alias("sentinel_label_rate"),
        (F.avg(F.when(~marked, y)) * 100).alias("other_label_rate"),
    )


def columns_partly_missing(
    df: DataFrame, low: float = 0.05, high: float = 0.80, k: int = 30
) -> list[str]:
    """Columns with a null rate strictly between the limits, highest first."""
    rates = null_rates(df).where((F.col("null_rate") > low) & (F.col("null_rate") < high))
    return [r["column"] for r in top(rates, "null_rate", "column", k).collect()]


def missing_matrix(
    df: DataFrame, id_col: str, columns: list[str], n: int = 5000, seed: int = 42
) -> DataFrame:
    """0/1 null flags of a fixed-size sample."""
    rows = hash_sample(df.select(id_col, *[c for c in columns if c != id_col]), id_col, n, seed)
    return rows.select(id_col, *[F.col(c).isNull().cast("int").alias(c) for c in columns])


def missing_patterns(df: DataFrame, columns: list[str]) -> DataFrame:
    """How often each combination of missing columns occurs in the whole table."""
    return df.groupBy(
        *[F.col(c).isNull().cast("int").alias(c) for c in columns]
    ).agg(F.count(F.lit(1)).alias("rows"))


def missing_names(df: DataFrame, columns: list[str], output: str = "missing") -> DataFrame:
    """The names of a row's missing columns, of ``columns`` and in their order,
    joined by commas, instead of one flag a column."""
    names = [F.when(F.col(c) == 1, F.lit(c)) for c in columns]
    return df.withColumn(output, F.concat_ws(",", *names)).drop(*columns)


def _as_text(df: DataFrame, columns: list[str]) -> DataFrame:
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")
            )
            for c in columns
        ]
    )
    return df.select(F.inline(entries)).where("value is not null")


def top_values(df: DataFrame, columns: list[str], k: int = 5) -> DataFrame:
    """The k most frequent values per column, equal ones by value; exact.

    Values are first counted by cell (their hash modulo ``CELLS``), so that at
    most ``CELLS`` rows a column leave a task. The values of the fullest cells are
    counted one by one; their k-th count is a lower bound of the true one. A value
    of a cell with fewer rows than that cannot be among the first k, so only the
    cells that reach the bound are counted as well."""
    values = _as_text(df, columns).withColumn(
        "cell", F.pmod(F.xxhash64("value"), F.lit(CELLS)).cast("int")
    )
    by_cell = values.groupBy("column", "cell").agg(F.count(F.lit(1)).alias("rows"))
    fullest = Window.partitionBy("column").orderBy(F.desc("rows"), "cell")
    cells = cut_lineage(by_cell.withColumn("place", F.row_number().over(fullest)))
    first = _count_in(values, cells.where(F.col("place") <= 4 * k))
    order = Window.partitionBy("column").orderBy(F.desc("count"), "value")
    first = first.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    bounds = (
        first.where(F.col("rank") == k).select("column", F.col("count").alias("bound"))
    )
    others = (
        cells.where(F.col("place") > 4 * k)
        .join(bounds, "column", "left")
        .where(F.col("rows") >= F.coalesce("bound", F.lit(0)))
    )
    return (
        first.drop("rank")
        .unionByName(_count_in(values, others))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("column", "rank", "value", "count")
    )


def _count_in(values: DataFrame, cells: DataFrame) -> DataFrame:
    """(column, value, count) of the values in the given cells."""
    chosen = values.join(cells.select("column", "cell"), ["column", "cell"], "left_semi")
    return chosen.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exact number of distinct present values per column; 0 where there are
    none. Whole numbers are marked in 64-bit words, so that up to 64 values reach
    the shuffle as one row; other values travel as text."""
    whole = [c for c in columns if isinstance(df.schema[c].dataType, T.IntegralType)]
    other = [c for c in columns if c not in whole]
    parts = []
    if whole:
        entries = F.array(
            *[
                F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("long").alias("value"))
                for c in whole
            ]
        )
        parts.append(
            distinct_per_key(df.select(F.inline(entries)), ["column"], "value", "distinct")
        )
    if other:
        entries = F.array(
            *[
                F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"))
                for c in other
            ]
        )
        parts.append(
            df.select(F.inline(entries))
            .groupBy("column", "value")
            .agg(F.lit(1).alias("one"))
            .groupBy("column")
            .agg(F.count("value").alias("distinct"))
        )
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def numeric_profile(
    df: DataFrame,
    columns: list[str] | None = None,
    probs: tuple[float, ...] = (0.05, 0.25, 0.5, 0.75, 0.95),
) -> DataFrame:
    """Count, missing, zeros, mean, deviation, bounds and quantiles per column."""
    names = columns or numeric_columns(df)
    quantiles = exact_quantiles(df, names, list(probs))
    entries = []
    for c in names:
        x = F.col(f"`{c}`").cast("double")
        fields = [
            F.lit(c).alias("column"),
            F.count(x).alias("present"),
            F.count_if(x.isNull()).alias("missing"),
            F.count_if(x == 0).alias("zeros"),
            F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("std"),
            F.min(x).alias("min"),
            F.max(x).alias("max"),
        ]
        for i, p in enumerate(probs):
            value = F.lit(quantiles[c][i]).cast("double")
            fields.append(value.alias(f"p{int(round(p * 100)):02d}"))
        entries.append(F.struct(*fields))
    return df.agg(F.array(*entries).alias("s")).select(F.inline("s"))


def column_profile(df: DataFrame, k: int = 5) -> dict[str, DataFrame]:
    """The parts of a profile report as tables: overview, numeric columns,
    distinct values and most frequent values, all of them exact."""
    parts = {"nulls": null_rates(df), "distinct": distinct_values(df, df.columns)}
    numbers, texts = numeric_columns(df), categorical_columns(df)
    if numbers:
        parts["numeric"] = numeric_profile(df, numbers)
    if texts:
        parts["top_values"] = top_values(df, texts, k)
    return parts
