"""Toxicity scores of texts after noisy-channel deobfuscation.

Words that look disguised (digits or symbols among letters, three equal letters
in a row, single letters with spaces or marks between them) become lattices: a
character may stand for itself, for the letters it imitates, for a shorter run,
or for nothing; where single letters follow each other, a word may end after any
of them. A Viterbi search finds the cheapest path under the channel's costs and a
character 4-gram model of the whole corpus. The words found so are words of the
document like any others.

A word's evidence is the largest weight among itself and its first 4, 5 and 6
bytes: the log odds of occurring in a toxic against another document, learnt
from a bounded sample of labelled rows and kept where a likelihood-ratio test
leaves no doubt. Two sums of a document's evidence go into a logistic model
fitted on the same sample.
"""

from __future__ import annotations

import math
import os.path
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.llm import arrays
from loanloom.llm.quality import labelled_sample

#: Bound of the labelled rows of each label that the classifier is fitted on.
SAMPLE_ROWS = 20_000
#: Likelihood-ratio statistic from which a word counts as evidence.
LEAST_EVIDENCE = 20.0
#: Sum of weights around which a further word begins to add less.
EVIDENCE_SCALE = 40.0
PREFIXES = (4, 5, 6)
THRESHOLD = 0.3

#: The letters that a character imitates.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "*": "abcdefghijklmnopqrstuvwxyz",
}
#: Channel costs in nats.
COST_LETTER, COST_IMITATED, COST_ANY, COST_SKIPPED, COST_DROPPED = 0.0, 0.7, 2.0, 0.3, 4.0
COST_SHORTER, COST_LONG_RUN = 0.5, 4.0
#: Longer words are decoded each time; the others are remembered.
REMEMBERED = 60
#: Slots after which what all paths have in common is set aside.
PIECE = 32
#: Marks around a word that are no part of it.
OUTER = ".,;:?\"'()[]{}<>#%&=/\\~^`_-"

_CODES = 28  # 0 end of word, 1-26 letters, 27 any other letter
_TABLE = arrays.byte_table(8, fold_case=True)
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_CODE = np.zeros(256, np.int64)
_CODE[97:123] = _CODE[65:91] = np.arange(1, 27)
_CODE[128:] = 27
_IMITATES = np.zeros(256, bool)
_IMITATES[[ord(c) for c in LOOKS_LIKE]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_OUTER = np.zeros(256, bool)
_OUTER[[ord(c) for c in OUTER]] = True
_FINAL = _OUTER.copy()  # at the end of a word, too
_FINAL[ord("!")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# the character model


def character_counts(docs: DataFrame, text_column: str) -> np.ndarray:
    """Counts of all 4-grams of letters in words that are letters alone; at most
    28^4 of them reach the driver."""
    size = _CODES**4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for _, _, data, _ in arrays.blocks(batch.column(0)):
                # the end of a text ends no word here unless a mark follows; that is
                # one 4-gram in a text and does not matter to the model
                codes = np.concatenate([[0, 0, 0], _CODE[data], [0]])
                gram = ((codes[:-3] * _CODES + codes[1:-2]) * _CODES + codes[2:-1]) * _CODES + codes[3:]
                real = (codes[3:] > 0) | (codes[2:-1] > 0)
                total += np.bincount(gram[real], minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["gram", "n"])

    counted = docs.select(docs[text_column].alias("text")).mapInArrow(run, "gram long, n long")
    found = counted.groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, np.int64)
    out[found["gram"].to_numpy()] = found["n"].to_numpy()
    return out


def character_model(counts: np.ndarray) -> np.ndarray:
    """log P(next | three before), longer contexts backed by shorter ones."""
    c4 = counts.reshape((_CODES,) * 4).astype(float)
    # what stands before the start of a word does not matter
    start = c4.sum(0)
    p = np.full(_CODES, 1.0 / _CODES)
    for table, weight in ((c4.sum((0, 1, 2)), 5.0), (c4.sum((0, 1)), 5.0), (start, 3.0), (c4, 2.0)):
        p = (table + weight * p) / (table.sum(-1, keepdims=True) + weight)
    return np.log(p).astype(np.float32)


# the lattice


def _slots(word: str, ends: bool = False) -> list[list[tuple[str, float]]]:
    """What each run of equal characters may stand for, and at what cost. With
    ``ends`` words (a blank) may end at the marks, without any between all runs."""
    out, i = [], 0
    anywhere = ends and all(c.isalpha() or c in LOOKS_LIKE for c in word)
    while i < len(word):
        c, j = word[i], i
        while j < len(word) and word[j] == c:
            j += 1
        n = j - i
        i = j
        options: dict[str, float] = {}
        if c.isalpha():
            for copies in {1, min(2, n)}:
                options[c * copies] = COST_LETTER if copies == n else COST_SHORTER
            if n > 2:
                options[c * n] = COST_LONG_RUN
            if anywhere and n > 1:
                options[f"{c} {c}"] = COST_LETTER if n == 2 else COST_SHORTER
        elif c in LOOKS_LIKE:
            looks = LOOKS_LIKE[c]
            cost = COST_ANY if len(looks) > 3 else COST_IMITATED
            for letter in looks:
                for copies in {1, min(2, n)}:
                    options[letter * copies] = cost * copies + (COST_SHORTER if copies < n else 0.0)
            options[""] = COST_DROPPED if c.isdigit() else COST_SKIPPED * 4
        else:
            options[""] = COST_SKIPPED
            if ends:
                options[" "] = COST_SKIPPED
        if anywhere and out:
            out.append([("", 0.0), (" ", 0.0)])
        out.append(list(options.items()))
    return out


def _code(letter: str) -> int:
    if letter == " ":
        return 0
    return ord(letter) - 96 if "a" <= letter <= "z" else 27


def decode(word: str, model: np.ndarray, ends: bool = False) -> str:
    """The letters that the word most probably stands for; with ``ends`` the
    words, with blanks between them."""
    beam: dict[tuple[int, int, int], tuple[float, str]] = {(0, 0, 0): (0.0, "")}
    settled = []
    for i, options in enumerate(_slots(word, ends)):
        if i % PIECE == PIECE - 1:
            # all paths agree on what they begin with, and none changes it later
            common = os.path.commonprefix([text for _, text in beam.values()])
            settled.append(common)
            beam = {state: (cost, text[len(common) :]) for state, (cost, text) in beam.items()}
        grown: dict[tuple[int, int, int], tuple[float, str]] = {}
        for state, (cost, text) in beam.items():
            for letters, extra in options:
                total, at = cost + extra, state
                for letter in letters:
                    code = _code(letter)
                    total -= float(model[at[0], at[1], at[2], code])
                    at = (at[1], at[2], code)
                best = grown.get(at)
                found = (total, text + letters)
                if best is None or found < best:
                    grown[at] = found
        beam = grown
    ended = ((cost - float(model[s[0], s[1], s[2], 0]), text) for s, (cost, text) in beam.items())
    return "".join([*settled, min(ended)[1]])


class Restorer:
    """Decodes words; equal words are decoded once while they are remembered."""

    def __init__(self, model: np.ndarray) -> None:
        self._decode = lambda word, ends: decode(word, model, ends)
        self._remembered = lru_cache(maxsize=50_000)(self._decode)

    def __call__(self, word: str, ends: bool = False) -> str:
        word = word.lower().strip(OUTER)
        if len(word) <= 2:
            return ""
        return (self._remembered if len(word) <= REMEMBERED else self._decode)(word, ends)


def _disguised(
    data: np.ndarray, start: np.ndarray, end: np.ndarray, row: np.ndarray
) -> list[tuple[int, bytes, bool]]:
    """(row, characters, whether they may be several words) of the words that
    look disguised."""
    n = len(data)
    if not len(start):
        return []
    letter, imitates = _LETTER[data], _IMITATES[data]
    other = ~letter & ~_DIGIT[data]
    gap = other.copy()
    gap[1:] &= ~other[:-1]  # many marks in a row are one gap
    counts = [np.concatenate([[0], np.cumsum(m)]) for m in (letter, imitates, other, gap)]
    letters, marks, *_ = (c[end] - c[start] for c in counts)
    at = np.arange(n)
    last_letter = np.maximum.accumulate(np.where(letter, at, -1))[end - 1]
    # between letters
    others, gaps = (c[np.maximum(last_letter, start)] - c[start] for c in counts[2:])
    first_mark = np.minimum.accumulate(np.where(imitates, at, n)[::-1])[::-1][start]
    inside = (letters >= 2) & (marks > 0) & (first_mark < last_letter)
    after = np.minimum(last_letter + 1, n - 1)
    tail = (letters >= 2) & (last_letter + 1 < end) & (end - last_letter <= 3) & imitates[after]
    tail &= _DIGIT[data[after]] | (data[after] == ord("$")) & (end - last_letter == 2)
    low = _LOWER[data]
    triple = np.zeros(n + 1, np.int64)
    if n > 2:
        same = (low[:-2] == low[1:-1]) & (low[1:-1] == low[2:]) & letter[:-2] & (data[:-2] < 128)
        triple[3:] = np.cumsum(same)
    repeated = (end - start >= 4) & (triple[end] > triple[np.minimum(start + 2, end)])
    spelt = (letters >= 3) & (others >= 2) & (2 * others >= letters - 1) & (end - start <= 2 * letters + marks + 2)
    spelt |= (letters >= 3) & (gaps >= 2) & (2 * gaps >= letters - 1)
    chosen = (inside | tail | repeated | spelt) & (letters + marks >= 3)
    out = [
        (int(r), data[s:e].tobytes(), p)
        for s, e, r, p in zip(*(x[chosen].tolist() for x in (start, end, row, spelt)), strict=True)
    ]
    # single characters with spaces between them, and marks around them
    first = np.minimum.accumulate(np.where(_OUTER[data], n, at)[::-1])[::-1][start]
    last = np.maximum.accumulate(np.where(_FINAL[data], -1, at))[end - 1] + 1
    bare = last <= first  # of marks alone
    first, last = np.where(bare, start, first), np.where(bare, end, last)
    second = data[np.minimum(first + 1, n - 1)]
    two_bytes = (last - first == 2) & (data[first] >= 0xC3) & (data[first] < 0xE0) & (second >= 0x80) & (second < 0xC0)
    single = (last - first == 1) & (letter | imitates)[first] | two_bytes
    if single.sum() >= 4:
        joined = np.zeros(len(start) + 1, bool)
        joined[1:-1] = single[1:] & single[:-1] & (row[1:] == row[:-1])
        edge = np.diff(np.concatenate([[0], joined[1:].astype(np.int8), [0]]))
        for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
            b += 1
            if b - a >= 4:
                parts = zip(first[a:b].tolist(), last[a:b].tolist(), strict=True)
                out.append((int(row[a]), b"".join(data[s:e].tobytes() for s, e in parts), True))
    return out


# evidence


def _features(
    data: np.ndarray, start: np.ndarray, end: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each word and its prefixes, and the word they belong to."""
    hashes = arrays.PrefixHash(data, _TABLE)
    keys, owners = [hashes.ranges(start, end)], [np.arange(len(start))]
    for k in PREFIXES:
        long = np.flatnonzero(end - start > k)
        keys.append(arrays.mix(hashes.ranges(start[long], start[long] + k) + np.uint64(k)))
        owners.append(long)
    return np.concatenate(keys), np.concatenate(owners)


def _words(
    data: np.ndarray, offsets: np.ndarray, restore: Restorer
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[tuple[int, str]]]:
    """Bytes, start, end and row of all words, the restored ones at the end."""
    plain = arrays.words(data, offsets, arrays.PLAIN_WORD)
    found = []
    for r, characters, several in _disguised(data, *plain):
        words = restore(characters.decode("utf-8", "ignore"), several).split(" ")
        found += [(r, text) for text in words if len(text) > 2]
    start, end, row = arrays.words(data, offsets, _LETTER)
    if found:
        parts = [t.encode() for _, t in found]
        more_end = len(data) + np.cumsum([len(p) for p in parts])
        more_start = more_end - np.array([len(p) for p in parts])
        data = np.concatenate([data, np.frombuffer(b"".join(parts), np.uint8)])
        start, end = np.concatenate([start, more_start]), np.concatenate([end, more_end])
        row = np.concatenate([row, np.array([r for r, _ in found], np.int64)])
    return data, start, end, row, found


def _sampled_features(drawn: DataFrame, shared) -> DataFrame:
    """(key, label) once for each labelled document that has the feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(shared.value)
        for batch in batches:
            labels = batch.column(0).to_numpy(zero_copy_only=False)
            for first, _, data, offsets in arrays.blocks(batch.column(1)):
                data, start, end, row, _ = _words(data, offsets, restore)
                keys, owner = _features(data, start, end)
                row = row[owner]
                once = np.unique(np.stack([row.astype(np.uint64), keys]), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(once[1].view(np.int64)),
                        pa.array(labels[first + once[0].astype(np.int64)].astype(np.int32)),
                    ],
                    ["key", "label"],
                )

    return drawn.mapInArrow(run, "key long, label int")


def learnt_weights(features: DataFrame, n_toxic: int, n_other: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and weights of all that is evidence of toxic documents. The
    sample bounds them: a key must occur in several of its toxic documents."""
    counted = features.groupBy("key").agg(
        F.sum(F.col("label").cast("double")).alias("t"), F.sum(1.0 - F.col("label")).alias("o")
    )
    n = float(n_toxic + n_other)
    part = lambda seen, all_: F.when(seen > 0, seen * F.log(seen / all_)).otherwise(0.0)
    both = F.col("t") + F.col("o")
    g = 2 * (
        part(F.col("t"), both * (n_toxic / n))
        + part(F.col("o"), both * (n_other / n))
        + part(n_toxic - F.col("t"), (n - both) * (n_toxic / n))
        + part(n_other - F.col("o"), (n - both) * (n_other / n))
    )
    odds = F.log((F.col("t") + 0.5) / (n_toxic + 1)) - F.log((F.col("o") + 0.5) / (n_other + 1))
    kept = counted.select("key", odds.alias("weight"), g.alias("g")).where(
        (F.col("g") >= LEAST_EVIDENCE) & (F.col("weight") > 1)
    )
    found = kept.toArrow()
    keys = found["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], found["weight"].to_numpy()[order]


def _evidence(
    data: np.ndarray, offsets: np.ndarray, weights: tuple[np.ndarray, np.ndarray], restore: Restorer
) -> tuple[np.ndarray, list[tuple[int, str]]]:
    """For each text: its strongest word, the sum over its distinct words (each
    further word adds less, but always something), and that against the
    logarithm of its length."""
    n = len(offsets) - 1
    data, start, end, row, found = _words(data, offsets, restore)
    out = np.zeros((n, 3))
    if len(start) and len(weights[0]):
        keys, owner = _features(data, start, end)
        at = np.minimum(np.searchsorted(weights[0], keys), len(weights[0]) - 1)
        hit = np.flatnonzero(weights[0][at] == keys)
        if len(hit):
            best = np.zeros(len(start))
            np.maximum.at(best, owner[hit], weights[1][at[hit]])
            words = np.flatnonzero(best)
            name = keys[: len(start)][words]
            _, first = np.unique(np.stack([row[words].astype(np.uint64), name]), axis=1, return_index=True)
            words = np.sort(words[first])
            np.maximum.at(out[:, 0], row[words], best[words])
            np.add.at(out[:, 1], row[words], best[words])
    counts = np.bincount(row, minlength=n)[:n]
    out[:, 1] = EVIDENCE_SCALE * -np.expm1(-out[:, 1] / EVIDENCE_SCALE)
    out[:, 2] = out[:, 1] / (1 + np.log1p(counts))
    return out, found


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights with the intercept last, by Newton's method."""
    x = np.concatenate([x, np.ones((len(x), 1))], 1)
    w = np.zeros(x.shape[1])
    penalty = np.diag([*[ridge] * (x.shape[1] - 1), 1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + penalty, x.T @ (p - y) + penalty @ w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def is_held_out(id_column: Column) -> Column:
    """crc32 of the id as text, modulo 4, is 2; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def score(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    threshold: float = THRESHOLD,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: id, held_out, score, predicted, restored
    (the words found behind disguised ones, in order of length and place).

    Labels of held-out ids are never read. A null or empty text has no evidence
    and the score of one without any. Labels of null ids, and ids with several
    labels but the largest, are not used; without labels of both kinds every
    score is the share of toxic labels, or 0.5 without any. Repeated rows are
    scored each. Other columns of ``docs`` are ignored, whatever their names.
    """
    spark = docs.sparkSession
    context = spark.sparkContext
    rows = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    model = context.broadcast(character_model(character_counts(docs, text_column)))
    usable = labels.where(~is_held_out(labels[id_column]))
    sample = labelled_sample(usable, label_column, id_column, sample_rows).collect()
    known = spark.createDataFrame([(r.id, r.label) for r in sample], "id long, label int")
    drawn = rows.withColumn("id", F.col("id").cast("long")).join(
        F.broadcast(known), "id"  # at most 2 * sample_rows rows
    )
    drawn = drawn.select("label", "text").persist()
    sizes = {r.label: r["count"] for r in drawn.groupBy("label").count().collect()}
    n_toxic, n_other = sizes.get(1, 0), sizes.get(0, 0)
    empty = (np.zeros(0, np.uint64), np.zeros(0))
    if n_toxic and n_other:
        found = learnt_weights(_sampled_features(drawn, model), n_toxic, n_other)
    else:
        found = empty
    weights = context.broadcast(found)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(model.value)
        for batch in batches:
            for first, last, data, offsets in arrays.blocks(batch.column(1)):
                x, _ = _evidence(data, offsets, weights.value, restore)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), *[pa.array(c) for c in x.T]],
                    ["label", "x0", "x1", "x2"],
                )

    if n_toxic and n_other:
        points = drawn.mapInArrow(measured, "label int, x0 double, x1 double, x2 double").toArrow()
        x = np.stack([points[c].to_numpy() for c in ("x0", "x1", "x2")], 1)
        order = np.lexsort((*x.T, points["label"].to_numpy()))  # the same sums on every run
        fitted = fit_logistic(x[order], points["label"].to_numpy()[order].astype(float))
    else:
        share = n_toxic / (n_toxic + n_other) if sizes else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        fitted = np.array([0.0, 0.0, 0.0, math.log(share / (1 - share))])
    drawn.unpersist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(model.value)
        for batch in batches:
            for first, last, data, offsets in arrays.blocks(batch.column(1)):
                x, found = _evidence(data, offsets, weights.value, restore)
                margin = np.clip(x @ fitted[:-1] + fitted[-1], -30, 30)
                restored: list[list[str]] = [[] for _ in range(last - first)]
                for r, text in found:
                    restored[r].append(text)
                p = 1 / (1 + np.exp(-margin))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array(p),
                        pa.array((p >= threshold).astype(np.int32)),
                        pa.array(restored, pa.list_(pa.string())),
                    ],
                    ["id", "score", "predicted", "restored"],
                )

    schema = f"id {kind}, score double, predicted int, restored array<string>"
    return rows.mapInArrow(run, schema).select(
        F.col("id").alias(id_column), is_held_out(F.col("id")).alias("held_out"), "score", "predicted", "restored"
    )
