"""Packing of token sequences by minimum bin slack.

Documents longer than the capacity give full sequences and a rest. Rests are
packed task by task. Only the number of waiting rests of each length matters:
the longest one opens a sequence, a subset sum over the other lengths, held in
the bits of one integer per length, finds the sum closest to the capacity, and
backtracking gives how many of each length it takes. The same choice is used as
long as the counts allow. Where no sum meets the capacity, one more rest is cut
to fill the gap; so only the last sequence of a task is short, and it is cut by
its binary digits, as a power of two needs no padding.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from loanloom.llm.arrays import released
from loanloom.llm.tokens import KEPT_PIECES, piece_encoder

CAPACITY = 2048
#: Rests that wait before sequences are filled; bounds a task's memory.
WINDOW = 4096
#: Texts encoded at once.
GROUP = 512


def best_fill(counts: dict[int, int], ascending: list[int], capacity: int) -> dict[int, int]:
    """How many of each length to take so that their sum is as close to
    ``capacity`` as any choice that holds the longest; larger lengths first on
    equal sums. ``ascending`` are the lengths of ``counts``."""
    seed = ascending[-1]
    room = capacity - seed
    mask = (1 << (room + 1)) - 1
    lengths, reached, before = [], 1, []
    for at in range(bisect_right(ascending, room) - 1, -1, -1):
        length = ascending[at]
        lengths.append(length)
        before.append(reached)
        left = counts[length] - (length == seed)
        step = 1
        while left > 0:
            take = min(step, left)
            grown = reached | (reached << (length * take)) & mask
            if grown == reached and take == 1:
                break
            reached = grown
            left -= take
            step *= 2
        if reached >> room & 1:
            break
    at = reached.bit_length() - 1
    taken: dict[int, int] = defaultdict(int)
    taken[seed] += 1
    for length, was in zip(reversed(lengths), reversed(before), strict=True):
        while not was >> at & 1:
            taken[length] += 1
            at -= length
    return dict(taken)


class Packer:
    """Packs pieces (key, start, length); yields (key, start, length,
    sequence, offset). ``key`` is opaque."""

    def __init__(self, capacity: int = CAPACITY, window: int = WINDOW) -> None:
        self.capacity, self.window = capacity, window
        self.sequence = 0
        self._waiting: dict[int, deque] = {}
        self._counts: dict[int, int] = {}
        self._lengths: list[int] = []  # ascending
        self._n = 0

    def _emit(self, pieces: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for key, start, length in pieces:
            yield key, start, length, self.sequence, offset
            offset += length
        self.sequence += 1

    def full(self, key) -> Iterator[tuple]:
        """A piece that fills a sequence by itself."""
        return self._emit([(key, 0, self.capacity)])

    def add(self, key, length: int) -> Iterator[tuple]:
        """A rest, shorter than the capacity."""
        self._put(length, key, 0)
        if self._n >= self.window:
            yield from self._fill(self.window // 2)

    def _put(self, length: int, key, start: int) -> None:
        if length not in self._waiting:
            self._waiting[length] = deque()
            self._counts[length] = 0
            insort(self._lengths, length)
        self._waiting[length].append((key, start))
        self._counts[length] += 1
        self._n += 1

    def _take(self, length: int) -> tuple:
        key, start = self._waiting[length].popleft()
        self._counts[length] -= 1
        self._n -= 1
        if not self._counts[length]:
            del self._waiting[length], self._counts[length]
            self._lengths.pop(bisect_left(self._lengths, length))
        return key, start, length

    def _fill(self, leave: int) -> Iterator[tuple]:
        while self._n > leave:
            chosen = best_fill(self._counts, self._lengths, self.capacity)
            times = min(self._counts[l] // c for l, c in chosen.items())
            if sum(l * c for l, c in chosen.items()) < self.capacity:
                times = 1
            for _ in range(times):
                pieces = [self._take(l) for l, c in chosen.items() for _ in range(c)]
                yield from self._close(pieces)
                if leave and self._n <= leave:
                    break

    def _close(self, pieces: list[tuple]) -> Iterator[tuple]:
        slack = self.capacity - sum(p[2] for p in pieces)
        if slack and self._n:
            # no waiting rest fits into the gap, so the longest is longer than it
            key, start, length = self._take(self._lengths[-1])
            pieces.append((key, start, slack))
            self._put(length - slack, key, start + slack)
            slack = 0
        if not slack:
            yield from self._emit(pieces)
            return
        used = self.capacity - slack
        parts = [1 << b for b in reversed(range(used.bit_length())) if used >> b & 1]
        for part in parts:
            now = []
            while part:
                key, start, length = pieces[0]
                take = min(part, length)
                now.append((key, start, take))
                pieces[0] = (key, start + take, length - take)
                if take == length:
                    pieces.pop(0)
                part -= take
            yield from self._emit(now)

    def finish(self) -> Iterator[tuple]:
        yield from self._fill(0)


def pack(
    docs: DataFrame,
    tokenizer_file: str,
    end_id: int,
    capacity: int = CAPACITY,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
    kept_pieces: int = KEPT_PIECES,
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset and, with ``with_ids``, the ids (32-bit little-endian).

    A document is its ids and ``end_id``; a null or empty text is ``end_id``
    alone. Pieces of one sequence come from one task, so nothing is shuffled;
    sequence ids are unique and repeat when a task is run again. A null id is
    returned as it is, repeated rows are packed each, and other columns are
    ignored. A task holds at most ``WINDOW`` rests and one group of texts, and a worker
    two tables of ``kept_pieces`` encoded pieces, which save time alone.
    """
    rows = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = f"id {kind}, " + ", ".join(f"{n} long" for n in names[1:])
    if with_ids:
        schema += ", ids binary"
        names = [*names, "ids"]
    end = np.asarray([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(tokenizer_file, True, kept_pieces)
        packer = Packer(capacity)
        first = TaskContext.get().partitionId() << 33
        id_type = None

        def rows_of(placed: Iterator[tuple]) -> list[tuple]:
            out = []
            for (doc, total, base, ids), start, length, sequence, offset in placed:
                part = ids[4 * start : 4 * (start + length)]
                crc = zlib.crc32(part)
                row = (doc, base + start, length, crc, total, first + sequence, offset)
                out.append((*row, part) if with_ids else row)
            return out

        def table(out: list[tuple]) -> pa.RecordBatch:
            kinds = [id_type, *[pa.int64()] * 6, *([pa.binary()] if with_ids else [])]
            columns = zip(*out, strict=True) if out else [[] for _ in kinds]
            arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            id_type = batch.column(0).type
            column = pc.fill_null(batch.column(1), "")
            for at in range(0, len(column), GROUP):
                keys = batch.column(0).slice(at, GROUP).to_pylist()
                texts = column.slice(at, GROUP).to_pylist()
                out: list[tuple] = []
                for key, ids in zip(keys, encoder.encode(texts), strict=True):
                    ids += end
                    total, base = len(ids) // 4, 0
                    while total - base >= capacity:
                        part = ids[4 * base : 4 * (base + capacity)]
                        out += rows_of(packer.full((key, total, base, part)))
                        base += capacity
                    if base < total:
                        rest = (key, total, base, ids[4 * base :])
                        out += rows_of(packer.add(rest, total - base))
                if out:
                    yield table(out)
        if id_type is not None:
            yield table(rows_of(packer.finish()))

    return rows.mapInArrow(released(run), schema).withColumnRenamed("id", id_column)
