"""Language-model scores by context-tree weighting over bytes.

A text is its words in lower case, joined by one space and closed by a line
feed. The next byte is eight binary decisions, each a node of a tree over its
bits. For every context of 0 to ``DEPTH`` bytes, a node's counts of zeros and
ones give a Krichevsky-Trofimov estimate, and the estimates of all depths are
mixed with the weights of context-tree weighting: a node's share is half its own
block probability over its weighted probability. Where the longer context of a
decision was never seen, the shorter one decides alone. So every byte has a
probability, and those of all bytes in a context add up to 1.

How it runs:

- One scan counts all words and all (``DEPTH`` + 1)-byte sequences; counts of
  training texts and zeros for what only other texts have.
- The tree is split by the last byte of the context. Each part is built by
  itself, twice: first for what the root needs (255 nodes a part), then for the
  log-probability of every sequence.
- Scoring looks up the most frequent words and sequences in arrays of at most
  ``TOP_WORDS`` and ``TOP_GRAMS`` entries, which are broadcast; all others are
  joined with the full tables. The result does not depend on these two numbers.

Log-probabilities are rounded to integers of 2^-32, so that sums are exact and
do not depend on how the rows are split.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.llm import arrays
from loanloom.llm.scratch import Scratch

DEPTH = 5
TOP_WORDS = 1 << 19
TOP_GRAMS = 1 << 20
UNIT = 2.0**32
END = 10
SPACE = 32

_TABLE = arrays.byte_table(7, fold_case=True)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD, _GRAM = 0, 1


class Stream(NamedTuple):
    """The normalised bytes of a block of texts."""

    grams: np.ndarray  # the DEPTH bytes before each byte, and the byte
    offsets: np.ndarray  # of the texts among them
    words: np.ndarray  # word hashes
    word_offsets: np.ndarray


def stream(data: np.ndarray, offsets: np.ndarray) -> Stream:
    n = len(offsets) - 1
    start, end, row = arrays.words(data, offsets, arrays.PLAIN_WORD)
    hashes = arrays.PrefixHash(data, _TABLE).ranges(start, end)
    word_offsets = arrays.spans(row, n)
    # a text without words has one empty word, whose separator is its end
    empty = np.flatnonzero(np.diff(word_offsets) == 0)
    at = word_offsets[empty]
    start, end, row = np.insert(start, at, 0), np.insert(end, at, 0), np.insert(row, at, empty)
    length = end - start + 1
    out_end = np.cumsum(length)
    out_start = out_end - length
    source = np.arange(out_end[-1] if len(out_end) else 0) + np.repeat(start - out_start, length)
    text = _LOWER[data[np.minimum(source, max(len(data) - 1, 0))]] if len(data) else np.zeros(len(source), np.uint8)
    text[out_end - 1] = SPACE
    first_word = arrays.spans(row, n)
    last = first_word[1:] - 1
    text[out_end[last] - 1] = END
    text_offsets = np.concatenate([[0], out_end[last]]).astype(np.int64)
    # before a text, its context is DEPTH line feeds
    byte_row = np.repeat(np.arange(n), np.diff(text_offsets))
    place = np.arange(len(text)) + DEPTH * (byte_row + 1)
    padded = np.full(len(text) + DEPTH * n, END, np.uint8)
    padded[place] = text
    wide = padded.astype(np.uint64)
    grams = np.zeros(max(len(padded) - DEPTH, 0), np.uint64)
    for k in range(DEPTH + 1):
        grams = grams << np.uint64(8) | wide[k : len(padded) - DEPTH + k]
    return Stream(grams[place - DEPTH], text_offsets, hashes, word_offsets)


def is_held_out(id_column: Column) -> Column:
    """crc32 of the id as text, modulo 7, is 2; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def _add(held: tuple[np.ndarray, np.ndarray], keys: np.ndarray, counts: np.ndarray):
    """Sums of counts by key; keys of both sides may repeat."""
    keys, counts = np.concatenate([held[0], keys]), np.concatenate([held[1], counts])
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else []
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def _counted(keys: np.ndarray, train: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and how many are marked in ``train`` (all, if None)."""
    if train is None:
        found = np.sort(keys)
        first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])) if len(keys) else np.zeros(0, int)
        return found[first], np.diff(np.append(first, len(keys)))
    return _add((np.zeros(0, np.uint64), np.zeros(0, np.int64)), keys, train.astype(np.int64))


#: Distinct keys that a task holds before it passes them on.
HELD = 2_000_000


def _counts(rows: DataFrame) -> DataFrame:
    """(kind, key, n) partial counts of rows (id, text, held_out)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zero = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        held = [zero, zero]
        fresh: list[list] = [[], []]
        sizes = [0, 0]

        def settle(kind: int) -> None:
            if fresh[kind]:
                keys, counts = (np.concatenate(x) for x in zip(*fresh[kind], strict=True))
                held[kind] = _add(held[kind], keys, counts)
                fresh[kind], sizes[kind] = [], 0

        def passed(kind: int) -> pa.RecordBatch:
            keys, counts = held[kind]
            held[kind] = zero
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(keys), kind, np.int32)),
                    pa.array(keys.view(np.int64)),
                    pa.array(counts.astype(np.int64)),
                ],
                ["kind", "key", "n"],
            )

        for batch in batches:
            train = ~batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            for first, last, data, offsets in arrays.blocks(batch.column(1)):
                s = stream(data, offsets)
                mine = train[first:last]
                for kind, keys, at in ((_WORD, s.words, s.word_offsets), (_GRAM, s.grams, s.offsets)):
                    for chosen in (True, False):
                        own = np.repeat(mine == chosen, np.diff(at))
                        found, counts = _counted(keys[own], None)
                        fresh[kind].append((found, counts if chosen else np.zeros_like(counts)))
                        sizes[kind] += len(found)
                    if sizes[kind] > HELD:
                        settle(kind)
                        if len(held[kind][0]) > HELD:
                            yield passed(kind)
        for kind in (_WORD, _GRAM):
            settle(kind)
            yield passed(kind)

    return rows.mapInArrow(run, "kind int, key long, n long")


# the tree


def _lgamma_half(n: np.ndarray) -> np.ndarray:
    return _lgamma(n + 0.5)


def _lgamma(x: np.ndarray) -> np.ndarray:
    """log gamma of positive numbers, by Stirling's series above 16."""
    x = np.asarray(x, float)
    shift = np.zeros_like(x)
    for _ in range(16):
        small = x < 16
        if not small.any():
            break
        shift = np.where(small, shift - np.log(np.where(small, x, 1)), shift)
        x = np.where(small, x + 1, x)
    i = 1 / x
    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + i / 12 - i**3 / 360 + i**5 / 1260 + shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log block probability of a node's counts."""
    return _lgamma_half(zeros) + _lgamma_half(ones) - math.log(math.pi) - _lgamma(zeros + ones + 1)


class Root(NamedTuple):
    """The nodes of the empty context, by bit prefix (1 to 255)."""

    zeros: np.ndarray
    ones: np.ndarray
    share: np.ndarray


def make_root(zeros: np.ndarray, ones: np.ndarray, log_children: np.ndarray) -> Root:
    own = log_kt(zeros, ones)
    return Root(zeros, ones, np.exp(own - np.logaddexp(own, log_children)))


def _nodes(context: np.ndarray, byte: np.ndarray, bit: int) -> tuple[np.ndarray, np.ndarray]:
    """Node keys and the decision taken there, for one of the eight bits."""
    prefix = (1 << bit) | (byte >> (8 - bit))
    return context << 8 | prefix, (byte >> (7 - bit)) & 1


def tree_part(keys: np.ndarray, counts: np.ndarray, root: Root | None):
    """The part of the tree whose contexts end in one byte.

    ``keys`` are distinct sequences with that byte before their last. With a
    root: the log-probability of each last byte. Without: the nodes of depth 1
    as (prefix, zeros, ones, log weighted probability).
    """
    keys = keys.astype(np.int64)
    byte = keys & 255
    context = np.zeros_like(keys)  # last byte first
    for k in range(1, DEPTH + 1):
        context = context << 8 | (keys >> (8 * k)) & 255
    log_p = np.zeros(len(keys))
    top = []
    for bit in range(8):
        p = seen = None
        weighted_child = child_of = None
        for depth in range(DEPTH, 0, -1):
            node, taken = _nodes(context >> (8 * (DEPTH - depth)), byte, bit)
            names, first, at = np.unique(node, return_index=True, return_inverse=True)
            zeros = np.bincount(at, counts * (taken == 0), len(names))
            ones = np.bincount(at, counts * (taken == 1), len(names))
            own = log_kt(zeros, ones)
            if child_of is None:
                weighted = own
                share = np.ones(len(names))
            else:
                # children: the distinct nodes one byte deeper, each once
                children = np.bincount(at[child_of], weighted_child, len(names))
                weighted = np.logaddexp(own, children) - math.log(2)
                share = np.exp(own - math.log(2) - weighted)
            n = (zeros + ones)[at]
            kt = (np.where(taken == 1, ones[at], zeros[at]) + 0.5) / (n + 1)
            p = kt if p is None else np.where(seen, share[at] * kt + (1 - share[at]) * p, kt)
            seen = n > 0
            weighted_child, child_of = weighted, first
            if depth == 1 and root is None:
                top.append((names & 255, zeros, ones, weighted))
        if root is not None:
            prefix = (1 << bit) | (byte >> (8 - bit))
            zeros, ones = root.zeros[prefix], root.ones[prefix]
            kt = (np.where(taken == 1, ones, zeros) + 0.5) / (zeros + ones + 1)
            share = root.share[prefix]
            log_p += np.log(np.where(seen, share * kt + (1 - share) * p, kt))
    if root is None:
        return tuple(np.concatenate(x) for x in zip(*top, strict=True))
    return log_p


def _model(grams: DataFrame) -> DataFrame:
    """(key, value) of all sequences (key, n); value in units of 2^-32."""
    by_byte = grams.withColumn("last", F.expr("(key >> 8) & 255"))

    def roots(table: pa.Table) -> pa.Table:
        found = tree_part(table["key"].to_numpy(), table["n"].to_numpy(), None)
        return pa.table(dict(zip(["prefix", "zeros", "ones", "weighted"], found, strict=True)))

    schema = "prefix long, zeros double, ones double, weighted double"
    nodes = by_byte.groupBy("last").applyInArrow(roots, schema)
    sums = nodes.groupBy("prefix").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "weighted")])
    zeros, ones, weighted = np.zeros(256), np.zeros(256), np.zeros(256)
    for r in sums.collect():  # at most 255 rows
        zeros[r.prefix], ones[r.prefix], weighted[r.prefix] = r.zeros, r.ones, r.weighted
    root = make_root(zeros, ones, weighted)

    def values(table: pa.Table) -> pa.Table:
        log_p = tree_part(table["key"].to_numpy(), table["n"].to_numpy(), root)
        return pa.table({"key": table["key"], "value": np.rint(log_p * UNIT).astype(np.int64), "n": table["n"]})

    return by_byte.groupBy("last").applyInArrow(values, "key long, value long, n long")


# scoring


def _frequent(table: DataFrame, most: int) -> Column:
    """Marks rows (n) that are among at most ``most`` with the largest counts:
    those above the first step of n, in eighths of a power of two, that fits."""
    step = F.when(F.col("n") > 0, F.floor(F.log2(F.col("n")) * 8)).otherwise(-1).cast("int")
    held, least = 0, None
    for r in sorted(table.groupBy(step.alias("s")).count().collect(), key=lambda r: -r.s):
        held += r["count"]
        if held > most:
            break
        least = r.s
    return step >= F.lit(least) if least is not None else F.lit(False)


def _lookup(table: DataFrame, frequent: Column) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and values of the frequent rows."""
    found = table.where(frequent).select("key", "value").toArrow()
    keys, values = found["key"].to_numpy().view(np.uint64), found["value"].to_numpy()
    order = np.argsort(keys)
    return keys[order], values[order]


def _find(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The value of each key, and whether it is there."""
    if not len(table[0]):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table[0], keys), len(table[0]) - 1)
    there = table[0][at] == keys
    return np.where(there, table[1][at], 0), there


def _find_all(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``_find``, for many repeated keys: each distinct one is looked up once."""
    order = np.argsort(keys)
    ranked = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    value, there = _find(table, ranked[new])
    group = np.cumsum(new) - 1
    values, found = np.empty(len(keys), np.int64), np.empty(len(keys), bool)
    values[order], found[order] = value[group], there[group]
    return values, found


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def score(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    held_out: Column | None = None,
    top_words: int = TOP_WORDS,
    top_grams: int = TOP_GRAMS,
) -> DataFrame:
    """One row per row of ``docs``: id, held_out, n_tokens, n_known,
    train_tokens, base_score, score, n_bytes and bits_per_byte (code length).

    ``held_out`` marks rows that nothing is learnt from. Tokens are lower-case
    words and one end. base_score is the unigram baseline with one added count.
    A null or empty text is its end alone. A null id counts as empty text in the
    choice of training rows. Repeated rows are scored, and learnt from, each.
    Without training rows all estimates are those of empty counts. Other columns
    of ``docs`` are ignored, whatever their names.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "context-tree")
    rows = docs.select(
        docs[id_column].alias("id"),
        docs[text_column].alias("text"),
        (is_held_out(docs[id_column]) if held_out is None else held_out).alias("held_out"),
    )
    kind_of_id = rows.schema["id"].dataType.simpleString()
    counts = _counts(rows).groupBy("kind", "key").agg(F.sum("n").alias("n"))
    counts = scratch.store(counts, "counts")
    words = counts.where(F.col("kind") == _WORD).select(
        "key", (F.log10(F.col("n") + 1.0) * UNIT).cast("long").alias("value"), "n"
    )
    grams = counts.where(F.col("kind") == _GRAM).select("key", "n")
    total = words.agg(F.sum("n"), F.count(F.when(F.col("n") > 0, 1))).first()
    ends = rows.where(~F.col("held_out")).count()
    train_tokens = int(total[0] or 0) + ends
    types = int(total[1]) + (ends > 0)
    below = math.log10(train_tokens + types + 1)
    end_value = int(math.log10(ends + 1) * UNIT)
    model = scratch.store(_model(grams), "model")
    often_word, often_gram = _frequent(words, top_words), _frequent(model, top_grams)
    # the value of a word also tells whether it is known: 0 is log10(0 + 1)
    shared = spark.sparkContext.broadcast((_lookup(words, often_word), _lookup(model, often_gram)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_table, gram_table = shared.value
        for batch in batches:
            for first, last, data, offsets in arrays.blocks(batch.column(1)):
                s = stream(data, offsets)
                n = last - first
                word_value, word_there = _find_all(word_table, s.words)
                gram_value, gram_there = _find_all(gram_table, s.grams)
                rare = []
                for keys, there, at in (
                    (s.words, word_there, s.word_offsets),
                    (s.grams, gram_there, s.offsets),
                ):
                    missing = np.flatnonzero(~there)
                    cut = np.searchsorted(missing, at)
                    rare.append(
                        pa.ListArray.from_arrays(
                            pa.array(cut.astype(np.int32)), pa.array(keys[missing].view(np.int64))
                        )
                    )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, n),
                        batch.column(2).slice(first, n),
                        pa.array(np.diff(s.word_offsets) + 1),
                        pa.array(_sums(word_value > 0, s.word_offsets)),
                        pa.array(_sums(word_value, s.word_offsets)),
                        pa.array(_sums(gram_value, s.offsets)),
                        pa.array(np.diff(s.offsets)),
                        *rare,
                    ],
                    names,
                )

    names = ["id", "held_out", "n_tokens", "known", "words", "grams", "n_bytes", "rare_words", "rare_grams"]
    schema = f"id {kind_of_id}, held_out boolean, n_tokens long, known long, words long, grams long, n_bytes long"
    schema += ", rare_words array<long>, rare_grams array<long>"
    scored = rows.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id())
    scored = scratch.store(scored, "scored")

    def rest(column: str, table: DataFrame, often: Column, value: str) -> DataFrame:
        keys = scored.select("row", F.explode(column).alias("key"))
        keys = keys.groupBy("row", "key").agg(F.count("*").alias("times"))
        found = keys.join(table.where(~often).select("key", "value").hint("merge"), "key")
        parts = {
            "known": F.when(F.col("value") > 0, F.col("times")).otherwise(0) if value == "words" else F.lit(0),
            "words": F.col("value") * F.col("times") if value == "words" else F.lit(0),
            "grams": F.col("value") * F.col("times") if value == "grams" else F.lit(0),
        }
        return found.select("row", *[c.cast("long").alias(k) for k, c in parts.items()])

    sums = (
        scored.select("row", "known", "words", "grams")
        .unionAll(rest("rare_words", words, often_word, "words"))
        .unionAll(rest("rare_grams", model, often_gram, "grams"))
        .groupBy("row")
        .agg(*[F.sum(c).alias(c) for c in ("known", "words", "grams")])
    )
    log_p = F.col("grams") / F.lit(UNIT)
    return (
        scored.select("row", "id", "held_out", "n_tokens", "n_bytes")
        .join(sums, "row")
        .select(
            F.col("id").alias(id_column),
            "held_out",
            "n_tokens",
            (F.col("known") + F.lit(1 if ends else 0)).alias("n_known"),
            F.lit(train_tokens).cast("long").alias("train_tokens"),
            ((F.col("words") + F.lit(end_value)) / F.lit(UNIT) - F.col("n_tokens") * F.lit(below)).alias("base_score"),
            (log_p / F.lit(math.log(10))).alias("score"),
            "n_bytes",
            (-log_p / F.lit(math.log(2)) / F.col("n_bytes")).alias("bits_per_byte"),
        )
    )
