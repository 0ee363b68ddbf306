"""Document quality by a hashed n-gram log-likelihood ratio.

Two multinomials over hashed byte n-grams are counted: one from trusted target
documents, one from the whole raw corpus. A document's score is the mean over
its n-grams of log(p_target / p_raw), so its length does not matter. Ratios are
rounded to integers of 1/65536, so the score is an exact sum and every document
is judged alike however the input is split.

The raw counts cover all documents, the target all that are labelled good. The
threshold is the cut that costs least over the scores of all labelled documents,
where a good document rejected costs ``reject_cost`` bad ones kept. Scores are
counted in bins of ``BIN`` for that, so the driver gets a row per bin and label.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm import arrays

BUCKETS = 1 << 16
N = 4
#: Width of a bin of scores (1/1024 nat), in units of 1/65536.
BIN = 64
#: Labels up to this number are broadcast (16 bytes each), more are joined.
BROADCAST_LABELS = 1_000_000
REJECT_COST = 50
SMOOTHING = 0.5
UNIT = 65536
MIN_WORDS = 50
MAX_REPEAT = 50

_TABLE = arrays.byte_table(2, fold_case=False)
_CONTINUES = (np.arange(256) & 0xC0) == 0x80
_SYMBOL = ~arrays.byte_class("#*$%&|<>")
_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def gram_buckets(data: np.ndarray) -> np.ndarray:
    """The bucket of the n-gram that starts at each byte but the last three."""
    if len(data) < N:
        return np.zeros(0, np.uint16)
    b = data.astype(np.uint32)
    gram = b[: -N + 1].copy()
    for k in range(1, N):
        gram |= b[k : len(b) - N + 1 + k] << np.uint32(8 * k)
    gram *= np.uint32(2654435761)
    gram ^= gram >> np.uint32(15)
    gram *= np.uint32(0x85EBCA6B)
    return (gram >> np.uint32(16)).astype(np.uint16)


def gram_ranges(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end n-gram of each text of a block."""
    return offsets[:-1], np.maximum(offsets[1:] - N + 1, offsets[:-1])


def _per_row(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(marks) + 1, np.int64)
    np.cumsum(marks, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def base_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of ``BASE`` for each text of a block."""
    n = len(offsets) - 1
    start, end, row = arrays.words(data, offsets, arrays.PLAIN_WORD)
    in_word = arrays.PLAIN_WORD[data]
    hashes = arrays.PrefixHash(data, _TABLE)
    out = {
        "n_words": np.bincount(row, minlength=n),
        "word_chars": _per_row(in_word & ~_CONTINUES[data], offsets),
        "n_symbols": _per_row(_SYMBOL[data], offsets),
    }
    # lines: cut at \n and between texts
    breaks = np.flatnonzero(data == 10)
    line_start = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    line_end = np.sort(np.concatenate([offsets[1:], breaks]), kind="stable")
    words_before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(in_word, out=words_before[1:])
    full = words_before[line_end] > words_before[line_start]
    line_start, line_end = line_start[full], line_end[full]
    line_row = np.searchsorted(offsets, line_start, "right") - 1
    key = arrays.mix(hashes.ranges(line_start, line_end) + line_row.astype(np.uint64) * _K[0])
    first = np.unique(key, return_index=True)[1]
    out["n_dup_lines"] = np.bincount(line_row, minlength=n) - np.bincount(line_row[first], minlength=n)
    # words in 3-word windows that the text has twice or more
    covered = np.zeros(len(start), bool)
    if len(start) >= 3:
        h = hashes.ranges(start, end)
        at = np.flatnonzero(row[2:] == row[:-2])
        key = arrays.mix(h[at] * _K[0] + h[at + 1] * _K[1] + h[at + 2] * _K[2])
        key = arrays.mix(key + row[at].astype(np.uint64) * _K[0])
        order = np.argsort(key)
        key = key[order]
        same = np.zeros(len(key) + 1, bool)
        same[1:-1] = key[1:] == key[:-1]
        twice = at[order[same[1:] | same[:-1]]]
        for k in range(3):
            covered[twice + k] = True
    out["n_repeat_words"] = np.bincount(row[covered], minlength=n)
    return out


def known_labels(labels: DataFrame, label: str, id_column: str) -> DataFrame:
    """(id, label) of the rows with an id and a 0/1 label, the largest of several."""
    known = labels.select(
        labels[id_column].cast("long").alias("id"), labels[label].cast("int").alias("label")
    ).where("id IS NOT NULL AND label IN (0, 1)")
    return known.groupBy("id").agg(F.max("label").alias("label"))


def labelled_sample(labels: DataFrame, label: str, id_column: str, rows: int) -> DataFrame:
    """At most ``rows`` rows of each value of a 0/1 label: id, label. The rows
    with the smallest hash of their id, so the sample is the same every time."""
    known = known_labels(labels, label, id_column)
    parts = [
        known.where(F.col("label") == v).orderBy(F.xxhash64("id"), "id").limit(rows) for v in (0, 1)
    ]
    return parts[0].unionAll(parts[1])


def corpus_counts(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Raw and target counts of each bucket of rows (label, text); the target is
    label 1. ``BUCKETS`` rows reach the driver, however large the corpus is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            chosen = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False) == 1
            for first, last, data, offsets in arrays.blocks(batch.column(1)):
                grams = gram_buckets(data)
                low, high = gram_ranges(offsets)
                own = np.zeros(len(grams) + 1, np.int8)
                some = high > low
                np.add.at(own, low[some], 1)
                np.add.at(own, high[some], -1)
                own = np.cumsum(own[:-1], dtype=np.int8).astype(bool)
                raw += np.bincount(grams[own], minlength=BUCKETS)
                for r in np.flatnonzero(chosen[first:last] & some):
                    target += np.bincount(grams[low[r] : high[r]], minlength=BUCKETS)
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(raw[used]), pa.array(target[used])],
            ["bucket", "raw", "target"],
        )

    counted = labelled.select("label", "text").mapInArrow(
        arrays.released(run), "bucket int, raw long, target long"
    )
    found = counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for r in found.collect():
        raw[r.bucket], target[r.bucket] = r.raw, r.target
    return raw, target


def log_ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """log(p_target / p_raw) of each bucket in units of 1/65536. Without any
    target text all ratios are 0."""
    if not target.sum():
        return np.zeros(BUCKETS, np.int64)
    p = (target + SMOOTHING) / (target.sum() + SMOOTHING * BUCKETS)
    q = (raw + SMOOTHING) / (raw.sum() + SMOOTHING * BUCKETS)
    return np.rint(np.log(p / q) * UNIT).astype(np.int64)


def block_scores(data: np.ndarray, offsets: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the ratios and number of n-grams of each text."""
    sums = np.zeros(max(len(data) - N + 1, 0) + 1, np.int64)
    np.cumsum(ratios[gram_buckets(data)], out=sums[1:])
    low, high = gram_ranges(offsets)
    n = high - low
    low, high = np.minimum(low, len(sums) - 1), np.minimum(high, len(sums) - 1)
    return np.where(n > 0, sums[high] - sums[low], 0), n


def best_threshold(
    scores: np.ndarray,
    labels: np.ndarray,
    reject_cost: float = REJECT_COST,
    counts: np.ndarray | None = None,
) -> float:
    """The cut between two scores that costs least, the lowest of equals; all
    scores from it on are kept. ``counts`` says how many documents a score with
    its label stands for, 1 by default. Minus infinity without both labels."""
    if not (labels == 1).any() or not (labels == 0).any():
        return float("-inf")
    counts = np.ones(len(scores), np.int64) if counts is None else counts
    order = np.argsort(scores, kind="stable")
    s, good, bad = scores[order], (counts * (labels == 1))[order], (counts * (labels == 0))[order]
    rejected_good = np.concatenate([[0], np.cumsum(good)])
    kept_bad = bad.sum() - np.concatenate([[0], np.cumsum(bad)])
    cost = reject_cost * rejected_good + kept_bad
    cut = np.ones(len(s) + 1, bool)
    cut[1:-1] = s[1:] > s[:-1]
    at = int(np.flatnonzero(cut)[np.argmin(cost[cut])])
    if at == 0:
        return float("-inf")
    return float(s[-1] + BIN) if at == len(s) else float((s[at - 1] + s[at]) / 2)


def judge(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    reject_cost: float = REJECT_COST,
    keep: list[str] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: id, the counts of ``BASE``, score, base_failed, kept.

    A null text has no words and fails; texts shorter than an n-gram score 0. A
    null id is returned as it is; labels of ids that ``docs`` lacks are of no
    use. Without labels of both kinds the base rules alone decide. Repeated rows
    are judged each. ``keep`` names columns that are returned as they are; others
    are ignored, whatever their names.
    """
    known = known_labels(labels, label_column, id_column)
    if known.count() <= BROADCAST_LABELS:
        known = F.broadcast(known)
    texts = docs.select(docs[id_column].cast("long").alias("id"), docs[text_column].alias("text"))
    spark = docs.sparkSession
    ratios = log_ratios(*corpus_counts(texts.join(known, "id", "left")))
    shared = spark.sparkContext.broadcast(ratios)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [block_scores(d, o, shared.value) for _, _, d, o in arrays.blocks(batch.column(1))]
            if parts:
                total, n = (np.concatenate(p) for p in zip(*parts, strict=True))
                bins = np.floor(total / np.maximum(n, 1) / BIN).astype(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bins)], ["label", "bin"])

    drawn = texts.join(known, "id").select("label", "text")
    found = (
        drawn.mapInArrow(arrays.released(scored), "label int, bin long")
        .groupBy("bin", "label")
        .count()
        .collect()
    )
    threshold = best_threshold(
        np.array([(r.bin + 0.5) * BIN for r in found]),  # the middle of each bin
        np.array([r.label for r in found]),
        reject_cost,
        np.array([r["count"] for r in found], np.int64),
    )
    keep = [c for c in keep or [] if c != id_column]
    rows = docs.select(
        docs[id_column].alias("_id"),
        docs[text_column].alias("_text"),
        *[docs[c].alias(f"_kept{i}") for i, c in enumerate(keep)],
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios = shared.value
        for batch in batches:
            counts: list[dict] = []
            sums, n_grams = [], []
            for _, _, data, offsets in arrays.blocks(batch.column(1)):
                counts.append(base_counts(data, offsets))
                total, n = block_scores(data, offsets, ratios)
                sums.append(total)
                n_grams.append(n)
            if not counts:
                continue
            base = {c: np.concatenate([x[c] for x in counts]) for c in BASE}
            score = np.concatenate(sums) / np.maximum(np.concatenate(n_grams), 1)
            failed = (base["n_words"] < MIN_WORDS) | (
                100 * base["n_repeat_words"] > MAX_REPEAT * base["n_words"]
            )
            columns = [
                batch.column(0),
                *batch.columns[2:],
                *[pa.array(base[c].astype(np.int64)) for c in BASE],
                pa.array(score / UNIT),
                pa.array(failed),
                pa.array(~failed & (score >= threshold)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    fields = [f for f in rows.schema if f.name != "_text"]
    names = [f.name for f in fields] + [*BASE, "score", "base_failed", "kept"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    schema += "".join(f", {c} long" for c in BASE) + ", score double, base_failed boolean, kept boolean"
    return rows.mapInArrow(arrays.released(run), schema).select(
        F.col("_id").alias(id_column),
        *[F.col(f"_kept{i}").alias(c) for i, c in enumerate(keep)],
        *names[len(fields) :],
    )
