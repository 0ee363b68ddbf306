"""Removal of repeated byte strings by sorting suffixes.

Each byte covered by a ``LENGTH``-byte string that also starts earlier, in a
document of smaller id or before in the same one, is removed.

Shards. Equal strings must meet in one task, and no task may hold the corpus. A
string's key is the least hash among the ``GRAM``-byte strings inside it; equal
strings have equal keys. Neighbouring strings of a text mostly share their key
and form one segment. Very common grams, found in a bounded sample, come last in
the order of hashes, so that no key collects the strings around a common line;
the choice moves strings between shards and never changes the result.

Selection. Segments travel as hashes. Those that equal an earlier one as a whole
repeat it. A key whose segments differ, or a segment that repeats itself, needs a
closer look: their bytes are fetched and sent to the shard of their key.

Large keys. The segments to look at are added up by key. Where a key has more
than ``KEY_BYTES``, each of its strings gets a name, a hash of all its bytes, and
goes to the shard of its name, where the first of one key and name stays.

Sorting. A shard's other segments are one text, and ``induced_sort`` gives the order
of its suffixes with common prefixes. Suffixes that have ``LENGTH`` bytes in common
are one string; all its occurrences but the earliest are repeats. Keys do not
share strings, so a shard, which Spark sorts by key on disk, is sorted in parts of
about ``PART_BYTES`` in memory, and no part is larger than that and one key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm import arrays
from loanloom.llm.induced_sort import DEPTH as LENGTH
from loanloom.llm.induced_sort import SuffixOrder
from loanloom.llm.scratch import Scratch

GRAM = 32
GRAMS = LENGTH - GRAM + 1  # in one string
MOST_STRINGS = 127  # in one segment
PART_BYTES = 1 << 20
#: Most bytes of one key that are sorted in one task.
KEY_BYTES = 1 << 20
#: Common grams: documents looked at, and the share of them that makes one common.
SAMPLE_DOCS = 500
COMMON_SHARE = 0.01
_TABLE = arrays.byte_table(3, fold_case=False)
_NAMES_TABLE = arrays.byte_table(13, fold_case=False)
_TOP = np.uint64(1 << 63)
_FILTER_BITS = 20
#: Ids that are null come after all others.
NO_ID = (1 << 63) - 1


class CommonGrams:
    def __init__(self, hashes: np.ndarray) -> None:
        self.hashes = np.sort(hashes)
        self._maybe = np.zeros(1 << _FILTER_BITS, bool)
        self._maybe[self._slot(self.hashes)] = True

    @staticmethod
    def _slot(hashes: np.ndarray) -> np.ndarray:
        return (hashes & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)

    def last(self, hashes: np.ndarray) -> np.ndarray:
        """The hashes, with common ones above all others."""
        hashes = hashes & ~_TOP
        if not len(self.hashes):
            return hashes
        maybe = np.flatnonzero(self._maybe[self._slot(hashes)])
        known = hashes[maybe]
        at = np.minimum(np.searchsorted(self.hashes, known), len(self.hashes) - 1)
        hashes[maybe[self.hashes[at] == known]] |= _TOP
        return hashes


def gram_hashes(ranges: arrays.PrefixHash) -> np.ndarray:
    return ranges.windows(GRAM)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    reach, out = 1, values
    while 2 * reach <= width:
        out = np.minimum(out[:-reach], out[reach:])
        reach *= 2
    return np.minimum(out[: len(values) - width + 1], out[width - reach : len(values) - reach + 1]) if width > reach else out


def segments(data: np.ndarray, offsets: np.ndarray, common: CommonGrams):
    """Row, start in the row, number of strings, key, content hash and whether
    a gram with the key's hash comes twice, for each segment of a block."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none.view(np.uint64), none.view(np.uint64), none.astype(bool)
    ranges = arrays.PrefixHash(data, _TABLE)
    grams = common.last(gram_hashes(ranges))
    key = _sliding_min(grams, GRAMS)  # of the string that starts at each byte
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = row[: len(key)] == row[LENGTH - 1 :]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | ~inside[:-1] | (row[1 : len(key)] != row[: len(key) - 1])
    at = np.arange(len(key))
    begun = np.maximum.accumulate(np.where(fresh, at, 0))
    fresh |= (at - begun) % MOST_STRINGS == 0  # long runs in equal pieces
    start = np.flatnonzero(fresh & inside)
    ends = np.flatnonzero(fresh | ~inside)
    following = np.searchsorted(ends, start, "right")
    end = np.where(following < len(ends), ends[np.minimum(following, len(ends) - 1)], len(key))
    keys = key[start]
    content = ranges.ranges(start, end + LENGTH - 1)
    # grams that are the least of some string; equal ones close to each other
    twice = np.zeros(len(start), bool)
    covered = np.concatenate([np.zeros(GRAMS - 1, np.uint64), np.where(inside, key, 0), np.zeros(GRAMS - 1, np.uint64)])
    most = ~_sliding_min(~covered, GRAMS)
    chosen = np.flatnonzero(most[: len(grams)] == grams)
    order = np.lexsort((chosen, grams[chosen]))
    place, value = chosen[order], grams[chosen][order]
    near = np.flatnonzero((value[1:] == value[:-1]) & (np.diff(place) <= GRAMS))
    if len(near):
        a, b, v = place[near], place[near + 1], value[near]
        low = np.maximum(np.minimum(a, b - GRAMS + 1), 0)
        first = np.maximum(np.searchsorted(start, low, "right") - 1, 0)
        last = np.searchsorted(start, np.maximum(a, b - GRAMS + 1), "right")
        count = np.maximum(last - first, 0)
        which = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
        twice[which[keys[which] == np.repeat(v, count)]] = True
    twice |= end - start > GRAMS
    rows = row[start]
    return rows, start - offsets[rows], end - start, keys, content, twice


# segments travel as (place, kind, key, content, doc, start, strings, twice)
_SEGMENT, _REPEAT = 0, 1
_FIELDS = "place long, kind int, key long, content long, doc long, start long, strings int, twice boolean"
_NAMES = [f.split()[0] for f in _FIELDS.split(", ")]


def _segment_rows(rows: DataFrame, shared) -> DataFrame:
    """Segments of (doc, text). Equal segments of a block are passed on once;
    the later ones are repeats, neighbours together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for first, _, data, offsets in arrays.blocks(batch.column(1)):
                row, start, strings, key, content, twice = segments(data, offsets, shared.value)
                doc = ids[first + row]
                order = np.lexsort((start, doc, content, key))
                row, start, strings, key, content, twice, doc = (
                    x[order] for x in (row, start, strings, key, content, twice, doc)
                )
                again = np.zeros(len(key), bool)
                again[1:] = (key[1:] == key[:-1]) & (content[1:] == content[:-1])
                # the same place of a row that is there twice is no repeat
                lead = np.maximum.accumulate(np.where(~again, np.arange(len(key)), 0))
                same = again & (doc == doc[lead]) & (start == start[lead])
                keep = ~again
                parts = [
                    (key[keep], _SEGMENT, key[keep], content[keep], doc[keep], start[keep], strings[keep], twice[keep])
                ]
                late = np.flatnonzero(again & ~same)
                late = late[np.lexsort((start[late], row[late]))]
                r, s, n = row[late], start[late], strings[late]
                new = np.ones(len(late), bool)
                new[1:] = (r[1:] != r[:-1]) | (s[1:] != s[:-1] + n[:-1])
                head = np.flatnonzero(new)
                total = np.add.reduceat(n, head) if len(head) else n
                zero = np.zeros(len(head), np.uint64)
                d = doc[late][head]
                parts.append((arrays.mix(d.astype(np.uint64)), _REPEAT, zero, zero, d, s[head], total, zero.astype(bool)))
                for place, kind, k, c, d, s, n, t in parts:
                    columns = [place.view(np.int64), np.full(len(d), kind, np.int32), k.view(np.int64)]
                    columns += [c.view(np.int64), d, s, n.astype(np.int32), t]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], _NAMES)

    return rows.mapInArrow(arrays.released(run), _FIELDS)


_NEEDED = "repeat boolean, key long, doc long, start long, strings int"


def _selected(dealt: DataFrame) -> DataFrame:
    """From segments sorted by (kind, key, content, doc, start): later copies
    of a segment are repeats; first copies whose key has several segments, or
    that may repeat themselves, are needed in full. Only the first copy of the last
    segment of a batch is held over to the next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, known = None, False  # the last first copy, and whether it was passed on

        def rows(repeat, key, doc, start, strings) -> pa.RecordBatch:
            columns = [np.full(len(key), repeat), key, doc, start, strings]
            return pa.RecordBatch.from_arrays(
                [pa.array(c) for c in columns], ["repeat", "key", "doc", "start", "strings"]
            )

        for batch in batches:
            x = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in _NAMES[1:]}
            done = x["kind"] == _REPEAT
            if done.any():
                yield rows(True, *(x[c][done] for c in ("key", "doc", "start", "strings")))
                x = {c: v[~done] for c, v in x.items()}
            if not len(x["key"]):
                continue
            if kept is not None:
                x = {c: np.concatenate([kept[c], v]) for c, v in x.items()}
            first = np.ones(len(x["key"]), bool)
            first[1:] = (x["key"][1:] != x["key"][:-1]) | (x["content"][1:] != x["content"][:-1])
            lead = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
            same = (x["doc"] == x["doc"][lead]) & (x["start"] == x["start"][lead])
            later = ~first & ~same
            yield rows(True, *(x[c][later] for c in ("key", "doc", "start", "strings")))
            firsts = np.flatnonzero(first)
            key, needed = x["key"][firsts], x["twice"][firsts].astype(bool)
            needed[1:] |= key[1:] == key[:-1]
            needed[:-1] |= key[1:] == key[:-1]
            new = needed.copy()
            new[0] &= not known
            at = firsts[new]
            yield rows(False, *(x[c][at] for c in ("key", "doc", "start", "strings")))
            # a segment that is alone so far may meet another of its key
            known = bool(needed[-1]) or (known and len(firsts) == 1)
            kept = {c: v[firsts[-1:]] for c, v in x.items()}

    return dealt.mapInArrow(arrays.released(run), _NEEDED)


def _contents(joined: DataFrame) -> DataFrame:
    """(key, doc, start, content) of (doc, text, wanted)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = arrays.string_buffers(batch.column(1))
            wanted = batch.column(2)
            n = np.diff(wanted.offsets.to_numpy())
            flat = wanted.flatten()
            key, start, strings = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("key", "start", "strings"))
            row = np.repeat(np.arange(batch.num_rows), n)
            begin = offsets[row] + start
            end = np.minimum(begin + strings + LENGTH - 1, offsets[row + 1])
            ids = batch.column(0).to_numpy(zero_copy_only=False)[row]
            for a in range(0, len(key), 8192):
                b = a + 8192
                content = [data[i:j].tobytes() for i, j in zip(begin[a:b].tolist(), end[a:b].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[a:b]), pa.array(ids[a:b]), pa.array(start[a:b]), pa.array(content, pa.binary())],
                    ["key", "doc", "start", "content"],
                )

    return joined.mapInArrow(arrays.released(run), "key long, doc long, start long, content binary")


_STRINGS = "place long, repeat boolean, key long, name long, doc long, start long, strings long"


def _named_strings(contents: DataFrame) -> DataFrame:
    """The strings of (key, doc, start, content), named by a hash of their bytes.
    Equal ones of a batch are passed on once; the later ones are repeats,
    neighbours together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = arrays.string_buffers(batch.column(3))
            if not len(data):
                continue
            strings = np.maximum(np.diff(offsets) - LENGTH + 1, 0)
            owner = np.repeat(np.arange(len(strings)), strings)
            within = np.arange(len(owner)) - np.repeat(np.cumsum(strings) - strings, strings)
            at = offsets[owner] + within
            name = arrays.PrefixHash(data, _NAMES_TABLE).ranges(at, at + LENGTH).view(np.int64)
            key, doc, start = (batch.column(c).to_numpy(zero_copy_only=False)[owner] for c in range(3))
            start = start + within
            order = np.lexsort((start, doc, name, key))
            key, name, doc, start = (x[order] for x in (key, name, doc, start))
            first, later = _firsts(key, name, doc, start)
            zero = np.zeros(int(first.sum()), np.int64)
            parts = [(name[first], zero, key[first], name[first], doc[first], start[first], zero + 1)]
            d, b = doc[later], start[later]
            order = np.lexsort((b, d))
            d, b = d[order], b[order]
            new = np.ones(len(d), bool)
            new[1:] = (d[1:] != d[:-1]) | (b[1:] > b[:-1] + 1)
            head, zero = np.flatnonzero(new), np.zeros(int(new.sum()), np.int64)
            total = b[np.append(head[1:], len(d)) - 1] - b[head] + 1 if len(head) else zero
            place = arrays.mix(d[head].view(np.uint64) ^ arrays.mix(b[head].astype(np.uint64))).view(np.int64)
            parts.append((place, zero + 1, zero, zero, d[head], b[head], total))
            for columns in parts:
                columns = [c if i != 1 else c.astype(bool) for i, c in enumerate(columns)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], [f.split()[0] for f in _STRINGS.split(", ")]
                )

    return contents.mapInArrow(arrays.released(run), _STRINGS)


def _firsts(key: np.ndarray, name: np.ndarray, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of sorted strings are the first of their key and name, and which
    come later; the same place of a row that is there twice is neither."""
    first = np.ones(len(key), bool)
    first[1:] = (key[1:] != key[:-1]) | (name[1:] != name[:-1])
    lead = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
    return first, ~first & ((doc != doc[lead]) | (start != start[lead]))


def _named_repeats(dealt: DataFrame) -> DataFrame:
    """(doc, start, strings) from strings sorted by (repeat, name, key, doc,
    start); one string is held over from batch to batch."""
    columns = ["key", "name", "doc", "start"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            x = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in [*columns, "strings", "repeat"]}
            done = x.pop("repeat").astype(bool)
            out = [{c: v[done] for c, v in x.items()}]
            x = {c: v[~done] for c, v in x.items()}
            if len(x["key"]):
                if kept is not None:
                    x = {c: np.concatenate([kept[c], v]) for c, v in x.items()}
                first, later = _firsts(*(x[c] for c in columns))
                out.append({c: v[later] for c, v in x.items()})
                kept = {c: v[np.flatnonzero(first)[-1:]] for c, v in x.items()}
            for part in out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[c]) for c in ("doc", "start", "strings")], ["doc", "start", "strings"]
                )

    return dealt.mapInArrow(arrays.released(run), "doc long, start long, strings long")


def repeats_in(
    doc: np.ndarray, start: np.ndarray, data: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, start, strings) of runs of strings that also start earlier, among
    the strings of some segments."""
    n = len(offsets) - 1
    length = np.diff(offsets)
    text = np.zeros(len(data) + n, np.int16)
    place = np.arange(len(data)) + np.repeat(np.arange(n), length)
    text[place] = data.astype(np.int16) + 1
    begin = offsets[:-1] + np.arange(n)
    # what a position means: its segment, and its place in the order of starts
    del place
    owner = np.repeat(np.arange(n, dtype=np.int32), length + 1)
    strings = length - LENGTH + 1
    within = (np.arange(len(text)) - begin[owner]).astype(np.int32)
    is_string = within < strings[owner]
    order = np.lexsort((start, doc))
    later = (np.diff(doc[order]) != 0) | (np.diff(start[order]) != 0)
    rank = np.empty(n, np.int64)
    rank[order] = np.concatenate([[0], np.cumsum(later)])  # a row that is there twice is one
    earlier = (rank[owner] << 20) + within
    repeated = np.zeros(len(text), bool)
    held: np.ndarray = np.zeros(0, np.int64)

    def settle(positions: np.ndarray, group: np.ndarray) -> None:
        head = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        least = np.minimum.reduceat(earlier[positions], head)
        size = np.diff(np.append(head, len(positions)))
        repeated[positions] = earlier[positions] > np.repeat(least, size)

    for positions, lcps in SuffixOrder(text).ascending():
        keep = is_string[positions]
        # strings are LENGTH long, so no other suffix lies between equal ones
        positions, lcps = positions[keep], lcps[keep]
        positions = np.concatenate([held, positions])
        equal = np.concatenate([np.ones(len(held), bool), lcps >= LENGTH])
        if not len(positions):
            continue
        equal[0] = False
        group = np.cumsum(~equal)
        last = np.searchsorted(group, group[-1])
        held = positions[last:]
        if last:
            settle(positions[:last], group[:last])
    if len(held):
        settle(held, np.zeros(len(held), np.int64))
    edge = np.diff(np.concatenate([[0], repeated.astype(np.int8), [0]]))
    low, high = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return doc[owner[low]], start[owner[low]] + within[low], high - low


def _sorted_repeats(dealt: DataFrame) -> DataFrame:
    """(doc, start, strings) from segments sorted by (key, doc, start), one part
    at a time; segments of a row that is there twice are held once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        before = None

        def found(part: pa.Table) -> pa.RecordBatch:
            part = part.combine_chunks()
            data, offsets = arrays.string_buffers(part["content"])
            result = repeats_in(part["doc"].to_numpy(), part["start"].to_numpy(), data, offsets)
            return pa.RecordBatch.from_arrays(
                [pa.array(x.astype(np.int64)) for x in result], ["doc", "start", "strings"]
            )

        for batch in batches:
            names = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in range(3)], 1)
            if not len(names):
                continue
            new = np.ones(len(names), bool)
            new[1:] = (names[1:] != names[:-1]).any(1)
            new[0] = before is None or bool((names[0] != before).any())
            before = names[-1]
            if not new.all():
                batch = batch.filter(pa.array(new))
            held.append(batch)
            size += batch.column(3).nbytes
            if size < PART_BYTES:
                continue
            table = pa.Table.from_batches(held)
            key = table["key"].to_numpy()
            cut = int(np.searchsorted(key, key[-1]))
            if cut:
                yield found(table.slice(0, cut))
                held = table.slice(cut).to_batches()
                size = sum(b.column(3).nbytes for b in held)
        if held:
            yield found(pa.Table.from_batches(held))

    return dealt.mapInArrow(arrays.released(run), "doc long, start long, strings long")


def _common_grams(rows: DataFrame, sample_docs: int) -> np.ndarray:
    """Hashes of grams in more than ``COMMON_SHARE`` of a sample of documents,
    those with the smallest hash of their id: at most one in each byte of
    1 / COMMON_SHARE texts."""
    sample = rows.select("doc").orderBy(F.xxhash64("doc"), "doc").limit(sample_docs)
    texts = rows.join(F.broadcast(sample.distinct()), "doc").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in arrays.blocks(batch.column(0)):
                grams = gram_hashes(arrays.PrefixHash(data, _TABLE)) & ~_TOP
                row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(grams)]
                once = arrays.mix(grams ^ arrays.mix(row.astype(np.uint64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams[np.unique(once, return_index=True)[1]].view(np.int64))], ["gram"]
                )

    counted = texts.mapInArrow(run, "gram long").groupBy("gram").agg(F.count("*").alias("n"))
    least = max(3.0, COMMON_SHARE * sample_docs)
    found = counted.where(F.col("n") >= least).select("gram").toArrow()["gram"].to_numpy()
    return found.view(np.uint64)


def _distinguished(
    docs: DataFrame, id_column: str, text_column: str, keep: list[str], scratch: Scratch
) -> DataFrame:
    """(doc, id, text, kept columns) where doc tells texts apart and orders them. It is the id,
    unless an id comes with different texts; then it is a number in the order of
    (id, hash of the text)."""
    rows = docs.select(
        docs[id_column].cast("long").alias("id"),
        docs[text_column].alias("text"),
        *[docs[c].alias(f"_kept{i}") for i, c in enumerate(keep)],
    )
    rows = rows.withColumns(
        {"doc": F.coalesce("id", F.lit(NO_ID)), "text": F.coalesce("text", F.lit(""))}
    )
    named = rows.select("doc", F.xxhash64("text").alias("h"))
    clash = named.groupBy("doc").agg(F.min("h").alias("low"), F.max("h").alias("high")).where("low != high")
    if clash.isEmpty():
        return rows
    order = named.distinct().orderBy("doc", "h").withColumn("place", F.monotonically_increasing_id())
    order = scratch.store(order, "order").withColumnRenamed("doc", "d")
    joined = rows.withColumn("h", F.xxhash64("text")).withColumnRenamed("doc", "d").join(order, ["d", "h"])
    return scratch.store(joined.withColumnRenamed("place", "doc").drop("d", "h"), "numbered")


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    sample_docs: int = SAMPLE_DOCS,
    keep: list[str] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, n_spans, spans (byte
    ranges, start and end in turn), kept_sha256 and kept_text, the text without
    the spans, where a character that loses some of its bytes loses all.

    A null or empty text has no bytes. Rows with the same id and text are one
    document and have the same result; rows with the same id and other texts are
    ordered by a hash of their texts. A null id comes after all others. ``keep``
    names columns of ``docs`` that are returned as they are; others are ignored,
    whatever their names.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "repeats")
    keep = [c for c in keep or [] if c not in (id_column, text_column)]
    rows = _distinguished(docs, id_column, text_column, keep, scratch)
    plain = rows.select("doc", "text")
    common = CommonGrams(_common_grams(plain, sample_docs))
    shared = spark.sparkContext.broadcast(common)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = _segment_rows(plain, shared).repartition(partitions, "place")
    dealt = dealt.sortWithinPartitions("kind", "key", "content", "doc", "start")
    selected = scratch.store(_selected(dealt), "selected")

    needed = selected.where("NOT repeat")
    sizes = needed.groupBy("key").agg(F.sum(F.col("strings") + F.lit(LENGTH - 1)).alias("bytes"))
    large = scratch.store(sizes.where(F.col("bytes") > F.lit(KEY_BYTES)).select("key"), "large")
    any_large = not large.isEmpty()
    # at most one key in each KEY_BYTES of text
    small = needed.join(F.broadcast(large), "key", "left_anti") if any_large else needed

    shards = _contents(_texts_with(plain, small)).repartition(partitions, "key")
    sorted_ = scratch.store(_sorted_repeats(shards.sortWithinPartitions("key", "doc", "start")), "sorted")

    runs = selected.where("repeat").select("doc", "start", F.col("strings").cast("long")).unionAll(sorted_)
    if any_large:
        spread = _texts_with(plain, needed.join(F.broadcast(large), "key", "left_semi"))
        strings = _named_strings(_contents(spread)).repartition(partitions, "place")
        strings = strings.sortWithinPartitions("repeat", "name", "key", "doc", "start")
        runs = runs.unionAll(scratch.store(_named_repeats(strings), "named"))
    runs = runs.groupBy("doc").agg(F.collect_list(F.struct("start", "strings")).alias("runs"))
    runs = scratch.store(runs, "runs")
    scratch.drop("selected", "large", "sorted", "named")

    return _cleaned(rows.join(runs, "doc", "left"), id_column, keep)


def _texts_with(plain: DataFrame, segments: DataFrame) -> DataFrame:
    """(doc, text, wanted): the texts that have some of the segments, with them."""
    wanted = segments.groupBy("doc").agg(F.collect_list(F.struct("key", "start", "strings")).alias("wanted"))
    return plain.join(wanted, "doc").select("doc", "text", "wanted")


def _cleaned(joined: DataFrame, id_column: str, keep: list[str]) -> DataFrame:
    kept = [f"_kept{i}" for i in range(len(keep))]
    joined = joined.select("id", *kept, "text", "runs")
    kinds = {f.name: f.dataType.simpleString() for f in joined.schema}
    out = [*[f"{c} {kinds[c]}" for c in ["id", *kept]], "n_bytes long", "n_removed long", "n_spans long"]
    out += ["spans array<long>", "kept_sha256 string", "kept_text string"]
    names = [f.split()[0] for f in out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = arrays.string_buffers(batch.column(len(kept) + 1))
            found = batch.column(len(kept) + 2)
            lists, flat = found.offsets.to_numpy(), found.values
            start = flat.field("start").to_numpy(zero_copy_only=False)
            strings = flat.field("strings").to_numpy(zero_copy_only=False)
            removed, spans, digest, texts = [], [], [], []
            for i in range(batch.num_rows):
                text = data[offsets[i] : offsets[i + 1]].tobytes()
                mine = slice(int(lists[i]), int(lists[i + 1])) if found[i].is_valid else slice(0, 0)
                ranges: list[int] = []
                if mine.stop > mine.start:
                    s = start[mine]
                    order = np.argsort(s, kind="stable")
                    s = s[order]
                    e = np.maximum.accumulate(s + strings[mine][order] + LENGTH - 1)
                    new = np.ones(len(s), bool)
                    new[1:] = s[1:] > e[:-1]
                    head = np.flatnonzero(new)
                    ranges = np.stack([s[head], e[np.append(head[1:], len(s)) - 1]], 1).ravel().tolist()
                cuts = [0, *ranges, len(text)]
                left = b"".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True))
                spans.append(ranges)
                removed.append(len(text) - len(left))
                digest.append(hashlib.sha256(left).hexdigest())
                parts = (text[a:b].decode("utf-8", "ignore") for a, b in zip(cuts[::2], cuts[1::2], strict=True))
                texts.append("".join(parts))
            columns = [
                *batch.columns[: len(kept) + 1],
                pa.array(np.diff(offsets)),
                pa.array(removed, pa.int64()),
                pa.array([len(s) // 2 for s in spans], pa.int64()),
                pa.array(spans, pa.list_(pa.int64())),
                pa.array(digest, pa.string()),
                pa.array(texts, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    cleaned = joined.mapInArrow(arrays.released(run), ", ".join(out))
    return cleaned.select(
        F.col("id").alias(id_column),
        *[F.col(f"_kept{i}").alias(c) for i, c in enumerate(keep)],
        *names[1 + len(kept) :],
    )
