"""Alignment of two tokenizers by the bytes that their tokens cover.

A text is encoded by a byte-level BPE (A, of the text with a space before it) and
by a sentencepiece model (B, which adds that space). Which bytes a token covers is a
row of a token-byte incidence matrix in CSR form. The product A . B^T, built row by
row after Gustavson, holds the bytes that an A token and a B token share: the
overlap links. Offsets where tokens of both end cut the text into groups; the
product of the two token-group matrices holds the pairs that share a group.

Running text repeats its words, and the matrices are block-diagonal: texts are cut
where both tokenizers provably cut, and each distinct block is encoded and
multiplied once per Python worker while it stays in a table of bounded size.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm import tokens
from loanloom.llm.arrays import released
from loanloom.llm.scratch import Scratch

#: Blocks kept in each of two tables of a Python worker, about 500 bytes each, and
#: the longest block that is kept.
KEPT_BLOCKS = 150_000
KEPT_CHARS = 40
#: Id pairs whose counts are broadcast; all others are joined.
TOP_PAIRS = 1 << 20
#: Distinct pairs that a task counts before it hands them on.
COUNTED_PAIRS = 1 << 19

#: Blocks end before white space, or between such a character and such a mark.
_BEFORE_MARK = re.compile("[0-9A-Za-zÀ-ÖØ-öø-ÿ]")
_MARKS = ".,;:!?&$%#*|"


@dataclass
class Csr:
    """A matrix of ones: row r has the columns indices[indptr[r]:indptr[r + 1]]."""

    indptr: np.ndarray
    indices: np.ndarray
    n_columns: int


def gustavson(left: Csr, right: Csr) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries (row, column, value) of ``left`` times ``right`` in order of row and
    column: an entry (i, k) of ``left`` adds row k of ``right`` to row i."""
    row_of = np.repeat(np.arange(len(left.indptr) - 1), np.diff(left.indptr))
    begin = right.indptr[left.indices]
    size = right.indptr[left.indices + 1] - begin
    rows = np.repeat(row_of, size)
    before = np.cumsum(size) - size
    columns = right.indices[np.arange(len(rows)) + np.repeat(begin - before, size)]
    place = rows * max(1, right.n_columns) + columns
    if len(place) and (np.diff(place) < 0).any():
        order = np.argsort(place, kind="stable")
        place, rows, columns = place[order], rows[order], columns[order]
    first = np.flatnonzero(np.diff(place, prepend=-1))
    return rows[first], columns[first], np.diff(first, append=len(place))


def _byte_of_letter() -> dict[str, int]:
    """The letters of byte-level BPE: a printable byte is its own letter, the others
    are numbered from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """Tokenizer A. Strings of special tokens inside a text are plain text."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        letters = _byte_of_letter()
        self.bytes = [b""] * (1 + max(vocabulary.values()))
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(letters[c] for c in token) if set(token) <= letters.keys() else token.encode()
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = [t.content for t in added.values()]

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of every text as it stands (the caller has added the space)."""
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class PieceModel:
    """Tokenizer B."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        plain = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                self.bytes.append(bytes([int(piece[3:-1], 16)]))
            else:
                self.bytes.append(piece.replace("▁", " ").encode())
                if not self.model.is_control(i) and not self.model.is_unknown(i):
                    plain.append(piece.replace("▁", " "))
        # BPE joins neighbours only into pieces that it knows, so it cuts between
        # two characters that stand together in no piece.
        together = {p[i : i + 2] for p in plain for i in range(len(p) - 1)}
        self._space = self.model.encode("\n")[:-1]
        self.cuts = (
            not any(b in " \t\n" and a not in " \t\n\r" for a, b in together)
            and not any(b in _MARKS and _BEFORE_MARK.match(a) for a, b in together)
            and not any("\n" in p for p in plain)
            and len(self.model.encode("\n")) == 2
        )

    def encode_after_space(self, texts: list[str]) -> list[list[int]]:
        """Ids of every text with a space added in front."""
        found = self.model.encode(texts, num_threads=1)
        return [f if t else [] for f, t in zip(found, texts, strict=True)]

    def encode_blocks(self, blocks: list[str]) -> list[list[int]]:
        """Ids of blocks as they stand inside a text. The space that a block begins
        with is the one that the model adds; other blocks follow a line feed, which
        no piece holds."""
        asked = [b[1:] if b[0] == " " else "\n" + b for b in blocks]
        found = self.model.encode(asked, num_threads=1)
        skip = len(self._space) + 1
        return [
            (f or self._space) if b[0] == " " else f[skip:]
            for b, f in zip(blocks, found, strict=True)
        ]


@dataclass(eq=False, slots=True)
class Block:
    """What one block of text adds to its document."""

    pairs: bytes  # ids of the links that end together, (a << 16 | b) as 32-bit words
    groups: str  # a1,a2|b1;a3|b2
    sizes: int  # A tokens, and B tokens from bit 40 on
    overlaps: np.ndarray | None  # (A token, B token, shared bytes)
    shared: np.ndarray | None  # (A token, B token)


_EMPTY = Block(b"", "", 0, np.empty((0, 3), np.int64), np.empty((0, 2), np.int64))


class Aligner:
    """Blocks of a Python worker; its table serves all tasks that run there."""

    def __init__(self, a_file: str, b_file: str, kept: int, with_links: bool) -> None:
        self.a, self.b = ByteLevel(a_file), PieceModel(b_file)
        if len(self.a.bytes) > 1 << 16 or len(self.b.bytes) > 1 << 16:
            raise ValueError("vocabularies of more than 65,536 tokens")
        self._a_size = np.array([len(t) for t in self.a.bytes], np.int64)
        self._b_size = np.array([len(t) for t in self.b.bytes], np.int64)
        self._a_name = [str(i) for i in range(len(self.a.bytes))]
        self._b_name = [str(i) for i in range(len(self.b.bytes))]
        self._kept, self._with_links = kept, with_links
        self._new: dict[str, Block | None] = {}
        self._old: dict[str, Block | None] = {}

    def _blocks_of(self, text: str) -> list[str] | None:
        """The blocks of a text with its space; none if its cuts are not proven."""
        if not self.b.cuts or "\r" in text or any(s in text for s in self.a.special):
            return None
        if tokens._OTHER_SPACE.search(text):
            return None
        return tokens._WITH_SPACE.findall(text)

    def _aligned(self, texts: list[str], a: list[list[int]], b: list[list[int]]) -> list[Block | None]:
        """Blocks of texts; none where the joined bytes of A or B are not the text's."""
        a_bytes, b_bytes = self.a.bytes, self.b.bytes
        fits = []
        for text, x, y in zip(texts, a, b, strict=True):
            data = text.encode()
            fits.append(
                b"".join([a_bytes[i] for i in x]) == data and b"".join([b_bytes[i] for i in y]) == data
            )
        a = [x for x, ok in zip(a, fits, strict=True) if ok]
        b = [y for y, ok in zip(b, fits, strict=True) if ok]
        good = iter(self._multiplied(a, b))
        return [next(good) if ok else None for ok in fits]

    def _multiplied(self, a: list[list[int]], b: list[list[int]]) -> list[Block]:
        """All blocks as one block-diagonal matrix."""
        if not a:
            return []
        a_of = np.cumsum([0, *map(len, a)])
        b_of = np.cumsum([0, *map(len, b)])
        a_ids = np.fromiter((i for x in a for i in x), np.int64, a_of[-1])
        b_ids = np.fromiter((i for y in b for i in y), np.int64, b_of[-1])
        a_end, b_end = np.cumsum(self._a_size[a_ids]), np.cumsum(self._b_size[b_ids])
        n_bytes = int(a_end[-1]) if len(a_end) else 0
        by_byte = Csr(np.concatenate([[0], a_end]), np.arange(n_bytes), n_bytes)
        token_of = np.repeat(np.arange(len(b_ids)), self._b_size[b_ids])
        b_turned = Csr(np.arange(n_bytes + 1), token_of, len(b_ids))
        row, column, n = gustavson(by_byte, b_turned)
        ends = a_end[row] == b_end[column]
        cuts = a_end[row[ends]]
        pairs = ((a_ids[row[ends]] << 16) | b_ids[column[ends]]).astype("<u4")
        a_group, b_group = np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end)
        # tokens before each group, and groups before each block
        a_cut = np.searchsorted(a_group, np.arange(len(cuts) + 1)).tolist()
        b_cut = np.searchsorted(b_group, np.arange(len(cuts) + 1)).tolist()
        g_of = np.searchsorted(a_cut, a_of).tolist()
        shared = None
        if self._with_links:
            in_group = Csr(np.arange(len(a_ids) + 1), a_group, len(cuts))
            held = Csr(np.array(b_cut), np.arange(len(b_ids)), len(b_ids))
            shared = np.stack(gustavson(in_group, held)[:2], axis=1)
        a_name = [self._a_name[i] for i in a_ids.tolist()]
        b_name = [self._b_name[i] for i in b_ids.tolist()]
        names = [
            ",".join(a_name[i:j]) + "|" + ",".join(b_name[k:l])
            for i, j, k, l in zip(a_cut[:-1], a_cut[1:], b_cut[:-1], b_cut[1:], strict=True)
        ]
        data = pairs.tobytes()
        out = []
        for i in range(len(a)):
            g, h = g_of[i], g_of[i + 1]
            block = Block(
                data[4 * g : 4 * h], ";".join(names[g:h]), len(a[i]) | len(b[i]) << 40, None, None
            )
            if shared is not None:
                start = np.array([a_of[i], b_of[i], 0])
                p, q = np.searchsorted(row, a_of[i : i + 2])
                block.overlaps = np.stack([row[p:q], column[p:q], n[p:q]], axis=1) - start
                p, q = np.searchsorted(shared[:, 0], a_of[i : i + 2])
                block.shared = shared[p:q] - start[:2]
            out.append(block)
        return out

    def _whole(self, texts: list[str]) -> list[Block | None]:
        spaced = [" " + t for t in texts]
        return self._aligned(spaced, self.a.encode(spaced), self.b.encode_after_space(texts))

    def align(self, texts: list[str]) -> list[list[Block] | None]:
        """The blocks of each text; none for a text without tokens."""
        cut = [self._blocks_of(" " + t) if t else [] for t in texts]
        known = self._new
        wanted = set().union(*(c for c in cut if c)).difference(known)
        if len(known) + len(wanted) > self._kept:
            # blocks that are still in use come back from the old table
            self._old, self._new = known, {}
            known = self._new
            wanted = set().union(*(c for c in cut if c))
        again = wanted.intersection(self._old)
        known.update((w, self._old[w]) for w in again)
        fresh = list(wanted.difference(again))
        if fresh:
            made = self._aligned(fresh, self.a.encode(fresh), self.b.encode_blocks(fresh))
            known.update(zip(fresh, made, strict=True))
        out: list[list[Block] | None] = []
        for text, blocks in zip(texts, cut, strict=True):
            found = None if blocks is None else [known[b] for b in blocks]
            if found is None or None in found:
                (one,) = self._whole([text])
                found = None if one is None else [one]
            out.append(found or None)
        for block in [w for w in wanted if len(w) > KEPT_CHARS]:
            del known[block]
        return out


@lru_cache(maxsize=2)
def aligner(a_file: str, b_file: str, kept: int, with_links: bool) -> Aligner:
    return Aligner(a_file, b_file, kept, with_links)


def _placed(blocks: list[Block], name: str) -> list[list[int]]:
    """Links of blocks numbered through the whole document."""
    out, a, b = [], 0, 0
    for block in blocks:
        for entry in getattr(block, name).tolist():
            out.append([entry[0] + a, entry[1] + b, *entry[2:]])
        a += block.sizes & ((1 << 40) - 1)
        b += block.sizes >> 40
    return out


_STRUCT = "struct<a: int, b: int, bytes: int>"


def align(
    docs: DataFrame,
    a_file: str,
    b_file: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_links: bool = False,
    kept: int = KEPT_BLOCKS,
) -> DataFrame:
    """One row per row of ``docs``: id, n_a, n_b, n_groups, n_links, groups_sha256
    and pairs (binary: for each A and B token that end together, A's id * 65,536 +
    B's id, as little-endian 32-bit words in order).

    ``with_links`` adds groups (text, as hashed), overlaps (array of the A token's
    and the B token's place in the document and the bytes they share) and shared
    (array of places of tokens in one group, bytes 0).

    A text that is null, empty, or whose joined token bytes of A or B differ from
    the text with its space has no tokens: zeros, an empty string, no links. A null
    id is returned as it is; repeated rows are aligned each. Other columns of
    ``docs`` are ignored, whatever their names. Nothing is shuffled.
    """
    rows = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    names = ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs"]
    schema = f"id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary"
    if with_links:
        names += ["groups", "overlaps", "shared"]
        schema += f", groups string, overlaps array<{_STRUCT}>, shared array<{_STRUCT}>"
    link = pa.list_(pa.struct([(n, pa.int32()) for n in ("a", "b", "bytes")]))

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(a_file, b_file, kept, with_links)
        for batch in batches:
            found = both.align(pc.fill_null(batch.column(1), "").to_pylist())
            blocks = [f or [] for f in found]
            sizes = [sum([x.sizes for x in f]) for f in blocks]
            pairs = [b"".join([x.pairs for x in f]) for f in blocks]
            # each offset where both end has one A token and one B token: a group a link
            n_links = pa.array([len(p) // 4 for p in pairs], pa.int64())
            groups = [";".join([x.groups for x in f]) for f in blocks]
            columns = [
                batch.column(0),
                pa.array([s & ((1 << 40) - 1) for s in sizes], pa.int64()),
                pa.array([s >> 40 for s in sizes], pa.int64()),
                n_links,
                n_links,
                pa.array([hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]),
                pa.array(pairs, pa.binary()),
            ]
            if with_links:
                fields = ("a", "b", "bytes")
                columns += [
                    pa.array(groups),
                    *(
                        pa.array(
                            [[dict(zip(fields, [*e, 0], strict=False)) for e in _placed(f, name)] for f in blocks],
                            link,
                        )
                        for name in ("overlaps", "shared")
                    ),
                ]
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_column)


def _all_pairs(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a batch, and the offsets of its rows."""
    rows = column.to_pylist()
    offsets = np.cumsum([0, *(len(r) // 4 for r in rows)])
    return np.frombuffer(b"".join(rows), "<u4"), offsets


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, n (links of that id pair in the whole corpus) and best (no pair with
    this B id has more). Tasks count before they shuffle."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(pair: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(pair.astype(np.int64)), pa.array(n)], ["pair", "n"]
            )

        pair, n = np.empty(0, np.uint32), np.empty(0, np.int64)
        for batch in batches:
            found, times = np.unique(_all_pairs(batch.column(0))[0], return_counts=True)
            pair, at = np.unique(np.concatenate([pair, found]), return_inverse=True)
            n = np.bincount(at, np.concatenate([n, times]), len(pair)).astype(np.int64)
            if len(pair) > COUNTED_PAIRS:
                yield emit(pair, n)
                pair, n = pair[:0], n[:0]
        yield emit(pair, n)

    counted = aligned.select("pairs").mapInArrow(run, "pair long, n long")
    counted = counted.groupBy("pair").agg(F.sum("n").alias("n"))
    b_id = F.col("pair").bitwiseAND(F.lit((1 << 16) - 1))
    highest = counted.groupBy(b_id.alias("b_id")).agg(F.max("n").alias("most"))
    named = counted.withColumn("b_id", b_id)
    return named.join(highest, "b_id").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _frequent(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """At most ``most`` of the most frequent pairs, by a power of two that their
    counts reach, in order of pair."""
    level = F.floor(F.log2("n")).cast("int")
    sizes = dict(counts.groupBy(level.alias("level")).count().collect())
    taken, least = 0, 64
    for k in sorted(sizes, reverse=True):
        taken += sizes[k]
        if taken > most:
            break
        least = k
    table = counts.where(level >= least).toArrow()
    pair = table["pair"].to_numpy().astype(np.uint32)
    order = np.argsort(pair)
    return pair[order], table["n"].to_numpy()[order], table["best"].to_numpy()[order]


def link_statistics(
    docs: DataFrame,
    a_file: str,
    b_file: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    top_pairs: int = TOP_PAIRS,
    kept: int = KEPT_BLOCKS,
) -> DataFrame:
    """``align`` with n_best (links whose id pair is the most frequent of their B
    id in the corpus, ties included) and count_sum (corpus counts of the id pairs,
    summed over the links) instead of pairs. Cases as in ``align``; the result does
    not depend on ``top_pairs``.

    Aligned documents are written once. Counts of at most ``top_pairs`` pairs are
    broadcast; links of all other pairs meet theirs in a join.
    """
    scratch = Scratch(docs.sparkSession, "alignment")
    kind = docs.schema[id_column].dataType.simpleString()
    aligned = align(docs, a_file, b_file, id_column, text_column, kept=kept)
    aligned = aligned.withColumnRenamed(id_column, "id").withColumn("row", F.monotonically_increasing_id())
    aligned = scratch.store(aligned, "aligned")
    counts = scratch.store(pair_counts(aligned), "counts")
    pair, n, best = _frequent(counts, top_pairs)

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        padded = np.append(pair, np.uint32(0))
        for batch in batches:
            found, offsets = _all_pairs(batch.column(0))
            at = np.searchsorted(pair, found)
            known = (at < len(pair)) & (padded[at] == found)
            at[~known] = 0
            number = np.where(known, n[at] if len(n) else 0, 0)
            good = known & (best[at] if len(best) else False)
            sums = [np.concatenate([[0], np.cumsum(v)]) for v in (good, number)]
            sums = [v[offsets[1:]] - v[offsets[:-1]] for v in sums]
            rare = np.flatnonzero(~known)
            others = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(rare, offsets).astype(np.int32)),
                pa.array(found[rare].astype(np.int64)),
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], *(pa.array(v.astype(np.int64)) for v in sums), others],
                [*batch.schema.names[1:], "n_best", "count_sum", "rare"],
            )

    told = ["row", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    schema = (
        f"row long, id {kind}, n_a long, n_b long, n_groups long, n_links long,"
        " groups_sha256 string, n_best long, count_sum long, rare array<long>"
    )
    summed = scratch.store(aligned.select("pairs", *told).mapInArrow(run, schema), "summed")
    scratch.drop("aligned")
    rare = summed.select("row", F.explode("rare").alias("pair"))
    rare = rare.groupBy("row", "pair").agg(F.count(F.lit(1)).alias("times"))
    rare = rare.join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("times") * F.col("n")).alias("more_count"),
    )
    both = summed.join(rare, "row", "left")
    return both.select(
        F.col("id").alias(id_column),
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_count", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )
