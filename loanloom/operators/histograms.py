"""Equal-width histograms of many columns in one pass over the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.functions.scalars import clip
from loanloom.operators.quantiles import exact_quantiles


def bin_number(
    df: DataFrame, value: str, low: str, high: str, bins: int, output: str = "bin"
) -> DataFrame:
    """Adds the bin 0 … bins-1 of a value column within two bound columns; bins
    are closed on the left, the last one on both sides. Values on an edge as
    computed go by that edge."""
    v, lo, width = F.col(value), F.col(low), F.col("_width")
    raw = F.col("_raw")
    down = (v < lo + raw * width).cast("int")
    up = ((v >= lo + (raw + 1) * width) & (raw < bins - 1)).cast("int")
    share = (v - lo) / (F.col(high) - lo) * bins
    return (
        df.withColumn("_width", (F.col(high) - lo) / bins)
        .withColumn("_raw", F.least(F.floor(share), F.lit(bins - 1)).cast("int"))
        .withColumn(output, raw - down + up)
        .drop("_raw", "_width")
    )


def column_bounds(
    df: DataFrame, columns: dict[str, Column]
) -> dict[str, tuple[float, float]]:
    """Smallest and largest value per column, one row read to the driver."""
    names = list(columns)
    checks = []
    for i, n in enumerate(names):
        checks += [
            F.min(columns[n]).cast("double").alias(f"low{i}"),
            F.max(columns[n]).cast("double").alias(f"high{i}"),
        ]
    seen = df.agg(*checks).first()
    return {
        n: (seen[f"low{i}"], seen[f"high{i}"])
        for i, n in enumerate(names)
        if seen[f"low{i}"] is not None
    }


def histogram(
    df: DataFrame,
    columns: dict[str, Column] | list[str],
    bins: int = 50,
    bounds: dict[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """(feature, bin, bin_low, bin_high, count, density) of every filled bin."""
    if not isinstance(columns, dict):
        columns = {c: F.col(f"`{c}`") for c in columns}
    columns = {n: c.cast("double") for n, c in columns.items()}
    bounds = bounds or column_bounds(df, columns)
    entries = []
    for name, (low, high) in bounds.items():
        if low == high:
            low, high = low - 0.5, high + 0.5
        entries.append(
            F.struct(
                F.lit(name).alias("feature"),
                columns[name].alias("value"),
                F.lit(low).alias("low"),
                F.lit(high).alias("high"),
            )
        )
    if not entries:
        return df.sparkSession.createDataFrame(
            [],
            "feature string, bin int, bin_low double, bin_high double, count bigint,"
            " density double",
        )
    long = df.select(F.inline(F.array(*entries))).where("value is not null")
    counted = (
        bin_number(long, "value", "low", "high", bins)
        .groupBy("feature", "bin", "low", "high")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    # one row per named feature, so safe to broadcast
    totals = counted.groupBy("feature").agg(F.sum("count").alias("rows"))
    width = (F.col("high") - F.col("low")) / bins
    return counted.join(F.broadcast(totals), "feature").select(
        "feature",
        "bin",
        (F.col("low") + F.col("bin") * width).alias("bin_low"),
        (F.col("low") + (F.col("bin") + 1) * width).alias("bin_high"),
        "count",
        (F.col("count") / (F.col("rows") * width)).alias("density"),
    )


def label_histograms(
    df: DataFrame,
    columns: list[str],
    label: str,
    bins: int = 50,
    clip_probs: tuple[float, float] | None = None,
) -> DataFrame:
    """Histogram per column and class 0/1, each over its own range; with
    ``clip_probs`` the values are first limited to those class quantiles."""
    split = {
        f"{c}|{value}": F.when(F.col(label) == value, F.col(f"`{c}`").cast("double"))
        for c in columns
        for value in (0, 1)
    }
    if clip_probs:
        limits = exact_quantiles(df, split, list(clip_probs))
        split = {
            n: clip(column, limits[n][0], limits[n][1])
            for n, column in split.items()
            if limits[n][0] is not None
        }
        # clipping moves the outermost values onto the limits themselves
        bounds = {n: (limits[n][0], limits[n][1]) for n in split}
        found = histogram(df, split, bins, bounds)
    else:
        found = histogram(df, split, bins)
    parts = F.split("feature", r"\|")
    return found.select(
        F.element_at(parts, 1).alias("feature"),
        F.element_at(parts, -1).cast("int").alias("label"),
        *[c for c in found.columns if c != "feature"],
    )

