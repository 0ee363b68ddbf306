"""Nearest neighbours by shifted space-filling curves.

Each of several orderings projects all vectors on its own random directions, lays
a grid over the projections whose lines stand at quantiles shifted by a random
amount, and numbers a vector by the place of its cell on a Hilbert curve. Ranges of
these numbers, cut at quantiles as well, are blocks. A query meets the rows of its
block and of ``window`` blocks on either side, in every ordering; what it meets is
ranked by true distances, and the best of all orderings are merged.

How many orderings and how wide a window: a bounded sample of queries is compared
with all rows, and the least work is taken that would have found ``recall`` of their
true neighbours. Vectors without structure need wide windows, clustered ones narrow
ones; the result has the same quality at every size.

Equal vectors are one class in the index. A class carries its ``k + 1`` smallest ids,
of which any query needs no more, so one vector that a third of all rows hold is
compared once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanloom.llm.arrays import mix, released
from loanloom.llm.scratch import Scratch
from loanloom.llm.vectors import matrix, usable

ORDERINGS = (4, 8, 16)
#: Directions of an ordering; with the bits of each they fill a 62-bit number.
DIRECTIONS = 31
KEY_BITS = 62
#: Bounds of the samples that the index is fitted on: vectors whose projections
#: place the grid lines, numbers that cut the blocks, and queries compared with
#: all rows.
GRID_SAMPLE = 8192
CUT_SAMPLE = 1 << 17
QUERY_SAMPLE = 256
#: Rows of a block at least, and blocks of an ordering at most.
BLOCK_ROWS = 256
MOST_BLOCKS = 1 << 14
#: Orderings whose copies of the vectors are shuffled at once.
AT_ONCE = 4


def hilbert_numbers(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on a Hilbert curve of grid cells (n, dims), each below 2^bits.

    Works from the highest bit down: a set bit of an axis mirrors the lower bits
    of the first axis, a clear one swaps them with the axis; Gray code then turns
    the transposed number into steps along the curve."""
    x = cells.astype(np.uint64).T.copy()
    dims = len(x)
    for b in range(bits - 1, 0, -1):
        bit, low = np.uint64(1 << b), np.uint64((1 << b) - 1)
        for axis in range(dims):
            high = (x[axis] & bit) != 0
            swapped = np.where(high, np.uint64(0), (x[0] ^ x[axis]) & low)
            x[0] ^= np.where(high, low, np.uint64(0)) ^ swapped
            x[axis] ^= swapped
    for axis in range(1, dims):
        x[axis] ^= x[axis - 1]
    turned = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, 0, -1):
        high = (x[-1] & np.uint64(1 << b)) != 0
        turned ^= np.where(high, np.uint64((1 << b) - 1), np.uint64(0))
    x ^= turned
    number = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, -1, -1):
        for axis in range(dims):
            number = (number << np.uint64(1)) | ((x[axis] >> np.uint64(b)) & np.uint64(1))
    return number


@dataclass
class Curves:
    """The orderings: directions (orderings, width, dims) and grid lines
    (orderings, dims, lines)."""

    directions: np.ndarray
    lines: np.ndarray
    bits: int

    @staticmethod
    def fit(sample: np.ndarray, orderings: int, seed: int) -> Curves:
        width = sample.shape[1]
        dims = min(DIRECTIONS, width)
        bits = min(8, KEY_BITS // dims)
        rng = np.random.default_rng(seed)
        directions = np.stack(
            [np.linalg.qr(rng.standard_normal((width, dims)))[0] for _ in range(orderings)]
        )
        n_lines = (1 << bits) - 1
        lines = np.empty((orderings, dims, n_lines))
        for t in range(orderings):
            projected = sample @ directions[t]
            for axis, shift in enumerate(rng.random(dims)):
                levels = (np.arange(n_lines) + shift) / (1 << bits) + 0.5 / (1 << bits)
                lines[t, axis] = np.quantile(projected[:, axis], levels)
        return Curves(directions, lines, bits)

    def first(self, orderings: int) -> Curves:
        return Curves(self.directions[:orderings], self.lines[:orderings], self.bits)

    def numbers(self, vectors: np.ndarray) -> np.ndarray:
        """(orderings, vectors)"""
        out = []
        for directions, lines in zip(self.directions, self.lines, strict=True):
            projected = vectors @ directions
            cells = [np.searchsorted(at, projected[:, axis]) for axis, at in enumerate(lines)]
            out.append(hilbert_numbers(np.stack(cells, axis=1), self.bits))
        return np.stack(out)


def tie_breaks(nodes: np.ndarray) -> np.ndarray:
    """Parts rows of one cell, so that no block grows with a crowded cell."""
    return mix(nodes.astype(np.uint64))


@dataclass
class Blocks:
    """Ends of the blocks of each ordering as (number, tie break) pairs."""

    numbers: np.ndarray
    ties: np.ndarray

    @staticmethod
    def fit(numbers: np.ndarray, ties: np.ndarray, n_blocks: int) -> Blocks:
        cuts = (np.arange(1, n_blocks) * numbers.shape[1]) // n_blocks
        at = [np.lexsort((ties, row))[cuts] for row in numbers]
        return Blocks(
            np.stack([row[i] for row, i in zip(numbers, at, strict=True)]),
            np.stack([ties[i] for i in at]),
        )

    @property
    def count(self) -> int:
        return self.numbers.shape[1] + 1

    def first(self, orderings: int) -> Blocks:
        return Blocks(self.numbers[:orderings], self.ties[:orderings])

    def find(self, numbers: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """The block of every row in every ordering."""
        out = np.empty(numbers.shape, np.int64)
        for t, (ends, breaks) in enumerate(zip(self.numbers, self.ties, strict=True)):
            low = np.searchsorted(ends, numbers[t], "left")
            high = np.searchsorted(ends, numbers[t], "right")
            out[t] = low
            # ends inside one cell: compare tie breaks
            for a, b in set(zip(low[low < high].tolist(), high[low < high].tolist(), strict=True)):
                rows = np.flatnonzero((low == a) & (high == b))
                out[t, rows] = a + np.searchsorted(breaks[a:b], ties[rows], "right")
        return out


@dataclass
class Index:
    curves: Curves
    blocks: Blocks
    window: int
    center: np.ndarray
    #: Share of the sampled queries' true neighbours that the windows hold.
    recall: float

    def place(self, vectors: np.ndarray, nodes: np.ndarray, some: slice) -> np.ndarray:
        """The block of every vector in some of the orderings."""
        curves = Curves(self.curves.directions[some], self.curves.lines[some], self.curves.bits)
        blocks = Blocks(self.blocks.numbers[some], self.blocks.ties[some])
        return blocks.find(curves.numbers(vectors), tie_breaks(nodes))


class Best:
    """The k nearest so far of some queries, by (distance, first id)."""

    def __init__(
        self,
        nodes: np.ndarray,
        vectors: np.ndarray,
        center: np.ndarray,
        k: int,
        far: np.ndarray | None = None,
    ) -> None:
        """``far``: distances within which k others of a query are known."""
        self._nodes, self._vectors, self._k = nodes, vectors, k
        self._center = center
        self._moved = vectors - center
        self._norms = (self._moved * self._moved).sum(axis=1)
        # square of the k-th distance, with room for rounding
        self._far = np.full(len(nodes), np.inf) if far is None else far * far * (1 + 1e-12)
        self._found = [np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64), np.empty(0, np.int64)]

    def add(self, nodes: np.ndarray, firsts: np.ndarray, vectors: np.ndarray) -> None:
        """A matrix product sorts out what is too far, with room for its rounding;
        the rest is measured on the vectors as they are."""
        moved = vectors - self._center
        norms = (moved * moved).sum(axis=1)
        rough = self._norms[:, None] + norms[None, :] - 2.0 * (self._moved @ moved.T)
        rough[self._nodes[:, None] == nodes[None, :]] = np.inf
        limit = self._far
        if len(nodes) > self._k:
            limit = np.minimum(limit, np.partition(rough, self._k - 1, axis=1)[:, self._k - 1])
        room = 1e-12 * (self._norms + norms.max(initial=0.0))
        query, row = np.nonzero((rough <= (limit + room)[:, None]) & np.isfinite(rough))
        if not len(query):
            return
        apart = self._vectors[query] - vectors[row]
        square = (apart * apart).sum(axis=1)
        new = [query, square, firsts[row], nodes[row]]
        query, square, first, node = (np.concatenate(p) for p in zip(self._found, new, strict=True))
        order = np.lexsort((node, first, square, query))
        query = query[order]
        nth = np.arange(len(query)) - np.searchsorted(query, query)
        keep = nth < self._k
        query, order, nth = query[keep], order[keep], nth[keep]
        self._found = [query, square[order], first[order], node[order]]
        full = nth == self._k - 1
        self._far[query[full]] = np.minimum(self._far[query[full]], self._found[1][full])

    def rows(self) -> pa.RecordBatch:
        query, square, first, node = self._found
        return pa.RecordBatch.from_arrays(
            [pa.array(self._nodes[query]), pa.array(node), pa.array(first), pa.array(np.sqrt(square))],
            ["query", "node", "first", "distance"],
        )


FOUND = "query long, node long, first long, distance double"


def _sampled(df: DataFrame, n: int, among: int) -> DataFrame:
    """About ``n`` of ``among`` rows, by a hash of their node; all if fewer."""
    place = F.pmod(F.xxhash64("node"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return df if among <= n else df.where(place < F.lit(n / among))


def _collected(df: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    rows = df.select("node", "vector").collect()
    vectors = np.array([r.vector for r in rows], np.float64).reshape(-1, width)
    return np.array([r.node for r in rows], np.int64), vectors


def _numbers(classes: DataFrame, curves: Curves) -> tuple[np.ndarray, np.ndarray]:
    """The curve numbers and tie breaks of the rows, on the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                numbers = curves.numbers(matrix(batch.column(1), curves.directions.shape[1]))
                ties = tie_breaks(batch.column(0).to_numpy())
                rows = np.ascontiguousarray(np.vstack([ties[None], numbers]).T)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r.tobytes() for r in rows], pa.binary())], ["numbers"]
                )

    rows = classes.select("node", "vector").mapInArrow(run, "numbers binary").collect()
    found = np.frombuffer(b"".join(bytes(r.numbers) for r in rows), np.uint64)
    found = found.reshape(-1, 1 + len(curves.directions))
    return np.ascontiguousarray(found[:, 1:].T), found[:, 0].copy()


def true_neighbours(
    classes: DataFrame, nodes: np.ndarray, vectors: np.ndarray, k: int
) -> DataFrame:
    """The k nearest classes of a bounded number of queries, from all classes: a
    task keeps the best of its rows."""
    center = vectors.mean(axis=0)

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(nodes, vectors, center, k)
        for batch in batches:
            if batch.num_rows:
                best.add(
                    batch.column(0).to_numpy(),
                    batch.column(1).to_numpy(),
                    matrix(batch.column(2), vectors.shape[1]),
                )
        yield best.rows()

    return nearest(classes.select("node", "first", "vector").mapInArrow(run, FOUND), k)


def nearest(found: DataFrame, k: int) -> DataFrame:
    """The k best of every query; Spark cuts each task's rows before it shuffles."""
    order = Window.partitionBy("query").orderBy("distance", "first", "node")
    return found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k)


def fit(
    classes: DataFrame,
    seekers: DataFrame,
    width: int,
    k: int,
    recall: float,
    orderings: tuple[int, ...] = ORDERINGS,
    seed: int = 7,
    block_rows: int = BLOCK_ROWS,
) -> Index:
    """Grid lines, block ends and window from bounded samples (see the module)."""
    rows, asked = classes.count(), seekers.count()
    _, grid = _collected(_sampled(classes, GRID_SAMPLE, rows), width)
    center = grid.mean(axis=0) if len(grid) else np.zeros(width)
    most = max(orderings)
    curves = Curves.fit(grid if len(grid) else np.zeros((1, width)), most, seed)
    n_blocks = max(1, min(MOST_BLOCKS, rows // max(block_rows, 4 * k)))
    if n_blocks == 1:
        nothing = np.empty((1, 0), np.uint64)
        return Index(curves.first(1), Blocks(nothing, nothing), 0, center, 1.0)
    blocks = Blocks.fit(*_numbers(_sampled(classes, CUT_SAMPLE, rows), curves), n_blocks)

    nodes, vectors = _collected(_sampled(seekers, QUERY_SAMPLE, asked), width)
    if not len(nodes):  # by chance none of many
        nodes, vectors = _collected(seekers.limit(QUERY_SAMPLE), width)
    true = true_neighbours(classes, nodes, vectors, k).select("query", "node").collect()
    wanted = classes.sparkSession.createDataFrame(
        [(n,) for n in sorted({r.node for r in true})], "node long"
    )
    other_nodes, others = _collected(classes.join(F.broadcast(wanted), "node"), width)
    ties, other_ties = tie_breaks(nodes), tie_breaks(other_nodes)
    mine = blocks.find(curves.numbers(vectors), ties)
    theirs = blocks.find(curves.numbers(others), other_ties)
    at = {n: i for i, n in enumerate(nodes.tolist())}
    other_at = {n: i for i, n in enumerate(other_nodes.tolist())}
    left, right = [at[r.query] for r in true], [other_at[r.node] for r in true]
    apart = np.abs(mine[:, left] - theirs[:, right])
    chosen = None
    for t in orderings:
        least = np.sort(apart[:t].min(axis=0))
        window = int(least[min(len(least) - 1, int(np.ceil(recall * len(least))) - 1)])
        work = t * min(n_blocks, 2 * window + 1)
        if chosen is None or work < chosen[0]:
            chosen = (work, t, window, float((least <= window).mean()))
    _, t, window, share = chosen
    return Index(curves.first(t), blocks.first(t), window, center, share)


def _spread(df: DataFrame, index: Index, some: slice, window: int, kind: int) -> DataFrame:
    """A copy of every row for each ordering and block that it goes to."""
    n_blocks, width = index.blocks.count, len(index.center)
    vector_kind = df.schema["vector"].dataType.simpleString()

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at = index.place(matrix(batch.column(2), width), batch.column(0).to_numpy(), some)
            for t, blocks in enumerate(at, some.start):
                for step in range(-window, window + 1):
                    block = blocks + step
                    rows = np.flatnonzero((block >= 0) & (block < n_blocks))
                    if not len(rows):
                        continue
                    copies = batch.take(pa.array(rows))
                    slot = (t * n_blocks + block[rows]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(slot), pa.array(np.full(len(rows), kind, np.int8)), *copies.columns],
                        ["slot", "kind", "node", "first", "vector", "far"],
                    )

    return df.select("node", "first", "vector", "far").mapInArrow(
        run, f"slot int, kind byte, node long, first long, vector {vector_kind}, far double"
    )


def _meet(rows: DataFrame, index: Index, k: int) -> DataFrame:
    """Compares the queries of a slot, which come first, with its rows as they
    stream by: a task holds the queries of one slot and one batch of rows."""
    center = index.center

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, best, waiting = -1, None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            slots = batch.column(0).to_numpy()
            kinds = batch.column(1).to_numpy()
            nodes, firsts = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            vectors = matrix(batch.column(4), len(center))
            far = batch.column(5).to_numpy()
            part = 2 * slots.astype(np.int64) + kinds
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if slots[a] != slot:
                    if best is not None:
                        yield best.rows()
                    slot, best, waiting = slots[a], None, []
                if kinds[a] == 0:
                    waiting.append((nodes[a:b], vectors[a:b], far[a:b]))
                    continue
                if best is None and waiting:
                    asked, at, reach = (np.concatenate(p) for p in zip(*waiting, strict=True))
                    best = Best(asked, at, center, k, reach)
                    waiting = []
                if best is not None:
                    best.add(nodes[a:b], firsts[a:b], vectors[a:b])
        if best is not None:
            yield best.rows()

    dealt = rows.repartition("slot").sortWithinPartitions("slot", "kind")
    return dealt.mapInArrow(run, FOUND)


def _classes(rows: DataFrame, k: int) -> DataFrame:
    """One row per distinct vector: its smallest ids, at most k + 1 of them."""
    distinct = rows.select("vector", "id").distinct()
    order = Window.partitionBy("vector").orderBy("id")
    least = distinct.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k + 1)
    grouped = least.groupBy("vector").agg(
        F.min("id").alias("first"), F.sort_array(F.collect_list("id")).alias("ids")
    )
    return grouped.withColumn("node", F.monotonically_increasing_id())


def search(
    vectors: DataFrame,
    asks: Column,
    k: int = 10,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    recall: float = 0.95,
    orderings: tuple[int, ...] = ORDERINGS,
    width: int | None = None,
    seed: int = 7,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """For every row that ``asks`` (a condition on the columns of ``vectors``), its
    k nearest other rows by Euclidean distance: query_id, rank int (from 1), id,
    score double. Fewer if there are fewer; ties go to the smaller id.

    Ids are whole numbers. Rows take no part whose id is null, or whose vector is
    null, all zero, holds a null, NaN or infinite component, or has not ``width``
    components (by default the most frequent number of the others; ties: the
    smaller). A repeated row counts once; rows of one id with different vectors are
    different rows, and each that asks gets its own list. Other columns are ignored,
    whatever their names. The distances returned are exact; that a neighbour is met
    at all has the measured probability of about ``recall``.

    Vectors are shuffled twice to find equal ones, and once an ordering, a few
    orderings at a time, which hand on only what is nearer than all found before. Blocks have like numbers of rows in any data; a task holds
    the queries of one block and streams its rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        vectors[id_column].cast("long").alias("id"),
        vectors[vector_column].alias("vector"),
        F.coalesce(asks, F.lit(False)).alias("asks"),
    )
    other_than_zero = F.exists(F.col("vector"), lambda x: x != 0)
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("vector")) & other_than_zero)
    if width is None:
        sizes = rows.groupBy(F.size("vector").alias("size")).count()
        usual = sizes.orderBy(F.desc("count"), "size").first()
        width = usual["size"] if usual else 0
    rows = rows.where(F.size("vector") == width)

    scratch = Scratch(spark, "hilbert")
    classes = scratch.store(_classes(rows, k), "classes")
    askers = rows.where("asks").select("id", "vector").distinct()
    askers = scratch.store(
        askers.join(classes.select("vector", "node"), "vector").select("id", "node"), "askers"
    )
    wanted = askers.select("node").distinct()
    seekers = scratch.store(classes.join(wanted, "node", "left_semi"), "seekers")
    if seekers.isEmpty():
        return _empty(spark, id_column)
    index = fit(classes, seekers, width, k, recall, orderings, seed, block_rows)

    # what is found in one ordering bounds what the next ones have to hand on
    met, rows = None, classes.withColumn("far", F.lit(0.0))
    asking = seekers.withColumn("far", F.lit(float("inf")))
    last = len(index.curves.directions)
    ends = sorted({*range(1, last, AT_ONCE), last})
    for begin, end in zip([0, *ends], ends, strict=False):
        some = slice(begin, end)
        both = _spread(rows, index, some, 0, 1).unionAll(
            _spread(asking, index, some, index.window, 0)
        )
        found = _meet(both, index, k)
        if met is not None:
            found = found.unionAll(met)
        best = found.groupBy("query", "node", "first").agg(F.min("distance").alias("distance"))
        met = scratch.store(nearest(best, k).select("query", "node", "first", "distance"), f"met{end}")
        far = met.groupBy("query").agg(F.max("distance").alias("last"), F.count("node").alias("n"))
        bound = F.when(F.col("n") == k, F.col("last")).otherwise(float("inf"))
        asking = seekers.join(far.select("query", bound.alias("far")), F.col("node") == F.col("query"), "left")
        asking = asking.withColumn("far", F.coalesce("far", F.lit(float("inf"))))
    met = met.drop("first")
    own = seekers.select(F.col("node").alias("query"), "node", F.lit(0.0).alias("distance"))
    listed = met.unionByName(own).join(classes.select("node", "ids"), "node")
    entries = F.transform("ids", lambda i: F.struct("distance", i.alias("id"), "node"))
    lists = listed.groupBy("query").agg(F.flatten(F.collect_list(entries)).alias("near"))
    lists = lists.select("query", F.slice(F.array_sort("near"), 1, k + 1).alias("near"))
    lists = scratch.store(lists, "lists")
    others = F.filter("near", lambda n: (n["id"] != F.col("id")) | (n["node"] != F.col("node")))
    results = askers.join(lists, askers.node == lists.query)
    return results.select(
        F.col("id").alias("query_id"), F.posexplode(F.slice(others, 1, k)).alias("at", "n")
    ).select(
        "query_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("n.id").alias(id_column),
        F.col("n.distance").alias("score"),
    )


def _empty(spark: SparkSession, id_column: str) -> DataFrame:
    return spark.createDataFrame([], f"query_id long, rank int, `{id_column}` long, score double")
