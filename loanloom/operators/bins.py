"""Counting rounds: how the values of a column lie within brackets.

Values are read in long form (column number, value) and brackets are a small table
beside them, so a plan is as long for two hundred columns as for two. A bracket is
cut into bins of equal width; one aggregate per round counts every bin of every
bracket and finds its smallest and largest value. All rounds are
grouped by (bracket, bin), so they combine on the map side and no task sees a
whole column; what reaches the driver is a row per bin. A bin's own bounds are
the next bracket, so each round at least parts the two ends of a bracket, and
every other round cuts by magnitude, which keeps far outliers from hiding the
rest in one bin.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 4096
LARGEST = 1.7976931348623157e308


@dataclass(frozen=True)
class Bracket:
    """Values of column number ``column`` from ``low`` to ``high``."""

    column: int
    low: float
    high: float
    by_magnitude: bool = False
    bins: int = BINS


@dataclass(frozen=True)
class Bin:
    """``parts`` are the rows of each part, where they are counted so; the bounds are
    those of all parts."""

    low: float
    high: float
    rows: int
    parts: tuple[int, ...] | None = None


def finite(value: Column) -> Column:
    """As double; NaN is missing, infinities are the largest numbers."""
    value = value.cast("double")
    limited = F.greatest(F.least(value, F.lit(LARGEST)), F.lit(-LARGEST))
    return F.when(value.isNotNull() & ~F.isnan(value), limited)


def long_values(
    df: DataFrame,
    values: Column,
    width: int,
    members: Column | None = None,
    part: Column | None = None,
) -> DataFrame:
    """(column, v) for every present entry of the array ``values`` of ``width``
    doubles. With ``members``, an array of group numbers, a row counts for each of
    its groups, and column c of group g has the number g * width + c. With ``part``,
    the number of the row's part stands beside each value."""
    number, beside = F.col("at"), [] if part is None else ["part"]
    more = [("members", members), ("part", part)]
    rows = df.select(values.alias("values"), *[c.alias(n) for n, c in more if c is not None])
    if members is not None:
        rows = rows.select("values", F.explode("members").alias("member"), *beside)
        number = F.col("member") * width + number
        rows = rows.select("member", *beside, F.posexplode("values").alias("at", "v"))
    else:
        rows = rows.select(*beside, F.posexplode("values").alias("at", "v"))
    return rows.where("v IS NOT NULL").select(number.cast("int").alias("column"), "v", *beside)


def bounds(values: DataFrame, n: int) -> list[Bin]:
    """Smallest and largest value and number of present values of ``n`` columns."""
    seen = values.groupBy("column").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count("v").alias("n"))
    found = [Bin(None, None, 0)] * n
    for r in seen.collect():
        found[r["column"]] = Bin(r["low"], r["high"], r["n"])
    return found


def _place(value: Column) -> Column:
    """A coordinate that never falls while the value grows; quarters, so that a
    difference cannot overflow."""
    by_magnitude = F.signum(value) * F.log1p(F.abs(value / 4) * F.lit(1e15))
    return F.when(F.col("by_magnitude"), by_magnitude).otherwise(value / 4)


def _bin_number() -> Column:
    value, low, high = (_place(F.col(c)) for c in ("v", "from", "to"))
    part = F.try_divide(value - low, high - low) * F.col("bins")
    number = F.floor(F.coalesce(part, F.lit(0.0)))
    number = F.greatest(F.least(number, F.col("bins") - 1), F.lit(0))
    # the two ends are apart whatever rounding does
    return F.when(F.col("v") >= F.col("to"), F.col("bins")).otherwise(number).cast("int")


def _within(values: DataFrame, brackets: list[Bracket]) -> DataFrame:
    """Values beside the brackets that hold them: a row per wanted rank or range,
    so the table is bounded by what the caller asks for."""
    rows = [(k, b.column, b.low, b.high, b.by_magnitude, b.bins) for k, b in enumerate(brackets)]
    table = values.sparkSession.createDataFrame(
        rows, "k int, column int, from double, to double, by_magnitude boolean, bins int"
    )
    held = values.join(F.broadcast(table), "column")
    return held.where((F.col("v") >= F.col("from")) & (F.col("v") <= F.col("to")))


def _counts(parts: int | None) -> list[Column]:
    """Rows, and rows of each part."""
    of_parts = [F.count_if(F.col("part") == p).alias(f"n{p}") for p in range(parts or 0)]
    return [F.count("v").alias("n"), *of_parts]


def _collected(counted: DataFrame, brackets: int, parts: int | None) -> list[list[Bin]]:
    """The rows of (k, low, high, counts) by bracket, in ascending order. They are
    read by column: a row object for each bin would take longer than the count."""
    read = counted.toArrow()
    k, low, high, n = (read.column(c).to_pylist() for c in ("k", "low", "high", "n"))
    own: list = [None] * len(k)
    if parts is not None:
        own = list(zip(*(read.column(f"n{p}").to_pylist() for p in range(parts)), strict=True))
    found: list[list[Bin]] = [[] for _ in range(brackets)]
    for at, *bin_ in zip(k, low, high, n, own, strict=True):
        found[at].append(Bin(*bin_))
    return [sorted(bins, key=lambda b: b.low) for bins in found]


def count_bins(
    values: DataFrame, brackets: list[Bracket], parts: int | None = None
) -> list[list[Bin]]:
    """The filled bins of each bracket in ascending order; one pass. Values that have
    a part below ``parts`` beside them are counted by part as well."""
    counted = (
        _within(values, brackets)
        .groupBy("k", _bin_number().alias("bin"))
        .agg(F.min("v").alias("low"), F.max("v").alias("high"), *_counts(parts))
    )
    return _collected(counted, len(brackets), parts)


def count_values(
    values: DataFrame, brackets: list[Bracket], parts: int | None = None
) -> list[list[Bin]]:
    """The same for each distinct value of narrow brackets."""
    counted = _within(values, brackets).groupBy("k", F.col("v").alias("low")).agg(*_counts(parts))
    return _collected(counted.withColumn("high", F.col("low")), len(brackets), parts)
