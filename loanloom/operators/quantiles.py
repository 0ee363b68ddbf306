"""Exact quantiles of many columns without sorting or collecting them.

Counting rounds narrow the bracket of each wanted rank until it holds a few
thousand rows or one value; then its distinct values are read and the rank is
picked. Each round is one aggregate for all columns and ranks. A built-in exact
percentile would hold all distinct values of a column in one task instead.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.operators.bins import LARGEST, Bin, Bracket, bounds, count_bins, count_values, finite, long_values

#: Rows of a bracket whose distinct values are read to the driver.
PICKED_ROWS = 2_000


@dataclass
class _Rank:
    """A wanted rank of a column, among the rows of some ``parts`` or of all. Of them
    ``below`` lie under its bracket; the bracket holds ``rows`` of any part."""

    column: int
    rank: int
    low: float
    high: float
    rows: int
    parts: tuple[int, ...] | None = None
    below: int = 0

    @property
    def narrow(self) -> bool:
        return self.low == self.high or self.rows <= PICKED_ROWS

    def of(self, held: Bin) -> int:
        return held.rows if self.parts is None else sum(held.parts[p] for p in self.parts)


def exact_quantiles(
    df: DataFrame, columns: dict[str, Column] | list[str], probs: list[float]
) -> dict[str, list[float | None]]:
    """Quantiles with linear interpolation between neighbours; missing values
    are skipped and a column without values gives ``None``."""
    if not isinstance(columns, dict):
        columns = {c: F.col(f"`{c}`") for c in columns}
    names = list(columns)
    if not names:
        return {}
    values = long_values(df, F.array(*[finite(c) for c in columns.values()]), len(names))
    found = long_quantiles(values, bounds(values, len(names)), probs)
    return dict(zip(names, found, strict=True))


def long_quantiles(
    values: DataFrame, whole: list[Bin], probs: list[float], groups: list[list[int]] | None = None
) -> list[list[float | None]]:
    """The same for numbered columns in long form, whose ``bounds`` are known. With
    ``groups``, lists of parts, for the columns of the first group, then of the
    second, and so on: groups overlap, but a value is read once for all of them. A
    bracket has the bounds of all parts, so that the groups share theirs."""
    n = len(whole) // len(groups or [[]])
    ranks: dict[tuple[int, int], _Rank] = {}
    for i, b in enumerate(whole):
        own = None if groups is None else tuple(groups[i // n])
        for p in probs if b.rows else ():
            place = (b.rows - 1) * p
            for rank in {math.floor(place), math.ceil(place)}:
                held = b.rows if b.parts is None else sum(b.parts)
                ranks[i, rank] = _Rank(i % n, rank, b.low, b.high, held, own)
    parts = None if groups is None else 1 + max((p for g in groups for p in g), default=-1)
    found = dict(zip(ranks, _values_at(values, list(ranks.values()), parts), strict=True))
    return [
        [_between(found, i, (b.rows - 1) * p) if b.rows else None for p in probs]
        for i, b in enumerate(whole)
    ]


def _between(found: dict[tuple[int, int], float], column: int, place: float) -> float:
    low, high = found[column, math.floor(place)], found[column, math.ceil(place)]
    return low if low == high else low + (high - low) * (place - math.floor(place))


def _values_at(values: DataFrame, ranks: list[_Rank], parts: int | None) -> list[float]:
    step = 0
    while open_ := [r for r in ranks if not r.narrow]:
        brackets = list(dict.fromkeys(Bracket(r.column, r.low, r.high, step % 2 == 1) for r in open_))
        bins = dict(zip(brackets, count_bins(values, brackets, parts), strict=True))
        for r in open_:
            for b in bins[Bracket(r.column, r.low, r.high, step % 2 == 1)]:
                rows = r.of(b)
                if r.below + rows > r.rank:
                    r.low, r.high, r.rows = b.low, b.high, b.rows
                    break
                r.below += rows
        step += 1
    open_ = [r for r in ranks if r.low != r.high]
    brackets = list(dict.fromkeys(Bracket(r.column, r.low, r.high) for r in open_))
    if brackets:
        read = dict(zip(brackets, count_values(values, brackets, parts), strict=True))
        for r in open_:
            below = r.below
            for b in read[Bracket(r.column, r.low, r.high)]:
                below += r.of(b)
                if below > r.rank:
                    r.low = r.high = b.low
                    break
    infinite = {LARGEST: math.inf, -LARGEST: -math.inf}
    return [infinite.get(r.low, r.low) for r in ranks]


def quantile_table(
    df: DataFrame, columns: dict[str, Column] | list[str], probs: list[float]
) -> DataFrame:
    """(column, prob, value) for a few columns and probabilities."""
    found = exact_quantiles(df, columns, probs)
    rows = [
        (name, float(p), value)
        for name, values in found.items()
        for p, value in zip(probs, values, strict=True)
    ]
    return df.sparkSession.createDataFrame(rows, "column string, prob double, value double")
