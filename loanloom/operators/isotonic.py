"""Isotonic regression of any number of points.

Pooling neighbours that violate the order gives the same blocks in whatever order it
is done. So points are pooled range by range in parallel, what is left is dealt into
ranges again, shifted by half a range, and so on until two rounds in a row pool
nothing: then every two neighbours have met and none violate the order. A task holds
one range; the driver sees how many blocks are left, and at the end the blocks
themselves, which are the fitted function.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.session import cut_lineage

#: Blocks of a range.
RANGE_BLOCKS = 1 << 16

_BLOCKS = "low double, high double, total double, weight double"
_NAMES = ["low", "high", "total", "weight"]


def pool(
    low: np.ndarray, high: np.ndarray, total: np.ndarray, weight: np.ndarray
) -> list[tuple[float, float, float, float]]:
    """Neighbouring blocks in ascending order, pooled until their means rise. Means
    are compared by cross products, exact for counts."""
    out: list[tuple[float, float, float, float]] = []
    for a, b, s, w in zip(low.tolist(), high.tolist(), total.tolist(), weight.tolist(), strict=True):
        while out and out[-1][2] * w >= s * out[-1][3]:
            before = out.pop()
            a, s, w = before[0], s + before[2], w + before[3]
        out.append((a, b, s, w))
    return out


def _pooled(numbered: DataFrame) -> DataFrame:
    """Blocks of each range (column ``range``), which come sorted, pooled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: int | None = None
        held: list[tuple[float, float, float, float]] = []

        def rows() -> pa.RecordBatch:
            columns = list(zip(*held, strict=True)) or [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, pa.float64()) for c in columns], _NAMES)

        for batch in batches:
            ranges = batch.column(0).to_numpy(zero_copy_only=False)
            parts = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(1, 5)]
            cuts = [0, *(np.flatnonzero(np.diff(ranges)) + 1).tolist(), len(ranges)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if ranges[a] != number:
                    yield rows()
                    number, held = ranges[a], []
                before = [np.array(c) for c in zip(*held, strict=True)] or [np.empty(0)] * 4
                # what is pooled already does not change but at its end
                joined = [np.concatenate([h, p[a:b]]) for h, p in zip(before, parts, strict=True)]
                held = pool(*joined)
        yield rows()

    return numbered.mapInArrow(run, _BLOCKS)


def _by_place(blocks: DataFrame, size: int, shift: int) -> tuple[DataFrame, int]:
    """Blocks sorted and dealt into ranges of ``size`` neighbours, and how many."""
    sorted_ = blocks.repartitionByRange("low").sortWithinPartitions("low")
    placed = sorted_.select(
        F.spark_partition_id().alias("part"),
        # its upper half names the partition, its lower 33 bits count the rows
        F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("nth"),
        *_NAMES,
    )
    placed = cut_lineage(placed)
    sizes = dict(placed.groupBy("part").count().collect())
    before, total = {}, 0
    for part in sorted(sizes):
        before[part] = total
        total += sizes[part]
    if not before:
        return placed.select(F.lit(0).cast("long").alias("range"), *_NAMES), 0
    offsets = F.create_map(*[F.lit(x) for item in before.items() for x in item])
    number = F.floor((offsets[F.col("part")] + F.col("nth") + shift) / size)
    return placed.select(number.cast("long").alias("range"), *_NAMES), total


def isotonic_blocks(
    points: DataFrame, score: str, total: str, weight: str, size: int = RANGE_BLOCKS
) -> DataFrame:
    """(low, high, value, weight): the blocks of the isotonic regression of points
    with distinct scores, the sum of their labels, and their weight."""
    blocks = points.select(
        F.col(score).cast("double").alias("low"),
        F.col(score).cast("double").alias("high"),
        F.col(total).cast("double").alias("total"),
        F.col(weight).cast("double").alias("weight"),
    ).where("low IS NOT NULL AND weight > 0")
    left, shift, settled = None, 0, 0
    while settled < 2:
        ranged, count = _by_place(blocks, size, shift)
        if count == left:
            settled += 1
        else:
            settled = 0
        left = count
        if settled == 2 or not count:
            blocks = ranged.select(_NAMES)
            break
        dealt = ranged.repartition("range").sortWithinPartitions("range", "low")
        blocks = cut_lineage(_pooled(dealt))
        if count + shift <= size:  # all were in one range
            break
        shift = size // 2 - shift
    return blocks.select("low", "high", (F.col("total") / F.col("weight")).alias("value"), "weight")
