"""Benchmark decontamination by a generalised suffix automaton.

The automaton recognises every word sequence that occurs in a test item. Words
of a document are fed to it; the length of the longest suffix that still occurs
in some item is tracked. Where it reaches the window length, the window that
ends there occurs in an item; suffix links lead to the state that stands for
exactly that window and knows its items. Items shorter than a window are found
at the state of their whole text.

Most words need no step: pairs of neighbouring words that no item has end every
match, so only runs of known pairs, at least as long as the shortest window, are
fed to the automaton. Pairs are looked up by hash, a run's words exactly.

Items are dealt to groups of about ``MAX_WORDS`` words by a hash, in the cluster,
and written to the shared folder, a folder per group. A task reads a group's
items and builds its automaton, which goes when the task ends, so one is alive per
worker however large the benchmark is. Each further group is one more step over
the same rows, which are stored in between.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm import arrays
from loanloom.llm.keyed_ids import open_folder, qualified
from loanloom.llm.scratch import Scratch

WINDOW = 10
#: Words of items in one automaton, about 1 kB each in a worker.
MAX_WORDS = 200_000

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_TABLE = arrays.byte_table(5, fold_case=True)
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)
_BITS = 22


def item_words(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").encode().translate(_LOWER))


class SuffixAutomaton:
    """All word sequences of the items, with the items of each window."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW) -> None:
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        order = sorted(range(len(self.next)), key=self.length.__getitem__)
        self.at_window = [0] * len(self.next)
        for state in order[1:]:
            if self.length[state] >= window:
                up = self.link[state]
                self.at_window[state] = state if self.length[up] < window else self.at_window[up]
        # items of the states that stand for a window, and short items by state
        self.items: dict[int, set[str]] = {}
        own: dict[int, list[tuple[int, str]]] = {}
        for name, words in items:
            state = 0
            for word in words:
                state = self.next[state][word]
                if self.length[state] >= window and len(words) >= window:
                    self.items.setdefault(self.at_window[state], set()).add(name)
            if 0 < len(words) < window:
                while self.length[self.link[state]] >= len(words):
                    state = self.link[state]
                own.setdefault(state, []).append((len(words), name))
        self.short: dict[int, list[tuple[int, str]]] = {}
        for state in order[1:]:
            found = self.short.get(self.link[state], []) + own.get(state, [])
            if found:
                self.short[state] = found
        self.least = min([window, *(len(w) for _, w in items if w)])
        pairs = {p for _, w in items for p in zip(w, w[1:], strict=False)}
        singles = {w[0] for _, w in items if len(w) == 1}
        self.known = self._known(pairs)
        self.singles = self._singles(singles)

    def _extend(self, last: int, word: bytes) -> int:
        nxt, link, length = self.next, self.link, self.length
        if word in nxt[last]:
            target = nxt[last][word]
            if length[target] == length[last] + 1:
                return target
            return self._clone(last, word, target)
        new = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        state = last
        while state >= 0 and word not in nxt[state]:
            nxt[state][word] = new
            state = link[state]
        if state >= 0:
            target = nxt[state][word]
            if length[target] == length[state] + 1:
                link[new] = target
            else:
                link[new] = self._clone(state, word, target)
        return new

    def _clone(self, state: int, word: bytes, target: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        copy = len(nxt)
        nxt.append(dict(nxt[target]))
        length.append(length[state] + 1)
        link.append(link[target])
        link[target] = copy
        while state >= 0 and nxt[state].get(word) == target:
            nxt[state][word] = copy
            state = link[state]
        return copy

    @staticmethod
    def _hashes(words: list[bytes]) -> np.ndarray:
        data = np.frombuffer(b"".join(words), np.uint8)
        end = np.cumsum([len(w) for w in words], dtype=np.int64)
        start = end - np.array([len(w) for w in words], np.int64)
        return arrays.PrefixHash(data, _TABLE).ranges(start, end)

    def _known(self, pairs: set[tuple[bytes, bytes]]) -> np.ndarray:
        table = np.zeros(1 << _BITS, bool)
        if pairs:
            left = self._hashes([a for a, _ in pairs])
            right = self._hashes([b for _, b in pairs])
            table[pair_slots(left, right)] = True
        return table

    def _singles(self, words: set[bytes]) -> np.ndarray:
        table = np.zeros(1 << _BITS, bool)
        if words:
            table[self._hashes(sorted(words)) >> np.uint64(64 - _BITS)] = True
        return table

    def scan(self, words: list[bytes]) -> Iterator[tuple[int, int, set[str]]]:
        """(first word, end word, items) of each window that ends at a word."""
        state, matched = 0, 0
        nxt, link, length = self.next, self.link, self.length
        for i, word in enumerate(words):
            while state and word not in nxt[state]:
                state = link[state]
                matched = length[state]
            if word not in nxt[state]:
                matched = 0
                continue
            state = nxt[state][word]
            matched += 1
            if matched >= self.window:
                found = self.items.get(self.at_window[state])
                if found:
                    yield i + 1 - self.window, i + 1, found
            for n, name in self.short.get(state, ()):
                if matched >= n:
                    yield i + 1 - n, i + 1, {name}


def pair_slots(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return arrays.mix(left * _PAIR + right) >> np.uint64(64 - _BITS)


def store_items(
    items: DataFrame, scratch: Scratch, max_words: int, item_id_column: str, item_text_column: str
) -> list[str]:
    """Writes the items that have an id and words, each once, and returns a folder
    per group of about ``max_words`` words; an item lies in one group."""
    named = (
        items.select(
            items[item_id_column].cast("string").alias("item"), items[item_text_column].alias("text")
        )
        .where("item IS NOT NULL AND text IS NOT NULL")
        .distinct()
        .withColumn("words", F.regexp_count("text", F.lit(_WORD.pattern.decode())))
        .where("words > 0")
    )
    total = named.agg(F.sum("words")).first()[0]
    if not total:
        return []
    n = math.ceil(total / max_words)
    folder = qualified(items.sparkSession, scratch.path("items"))
    part = F.pmod(F.xxhash64("item", "text"), F.lit(n)).cast("int")
    dealt = named.select("item", "text", part.alias("part"))
    dealt.repartition(n, "part").write.mode("append").partitionBy("part").parquet(folder)
    return [f"{folder}/part={i}" for i in range(n)]


def group_automaton(folder: str, window: int) -> SuffixAutomaton | None:
    """The automaton of a stored group; none for a group without items."""
    files, path = open_folder(folder)
    found = files.get_file_info(arrow_fs.FileSelector(path, allow_not_found=True))
    names = sorted(f.path for f in found if f.path.endswith(".parquet"))
    rows: list[tuple[str, list[bytes]]] = []
    for name in names:
        with files.open_input_file(name) as stream:
            table = pq.read_table(stream)
        pairs = zip(table["item"].to_pylist(), table["text"].to_pylist(), strict=True)
        rows += [(item, item_words(text)) for item, text in pairs]
    return SuffixAutomaton(sorted(rows), window) if rows else None


def _mark_block(
    automaton: SuffixAutomaton, data: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, dict[int, set[str]]]:
    start, end, row = arrays.words(data, offsets, arrays.LETTER_WORD)
    hit = np.zeros(len(start), bool)
    items: dict[int, set[str]] = {}
    if len(start):
        h = arrays.PrefixHash(data, _TABLE).ranges(start, end)
        joined = np.zeros(len(start) + 1, bool)  # word i goes on from word i - 1
        joined[1:-1] = automaton.known[pair_slots(h[:-1], h[1:])] & (row[1:] == row[:-1])
        first = np.flatnonzero(~joined[:-1])
        last = np.append(first[1:], len(start))
        long = last - first >= automaton.least
        if automaton.least == 1:
            alone = automaton.singles[h >> np.uint64(64 - _BITS)]
            has = np.add.reduceat(alone, first) > 0
            long &= (last - first > 1) | has
        for a, b in zip(first[long].tolist(), last[long].tolist(), strict=True):
            words = [
                data[s:e].tobytes().translate(_LOWER)
                for s, e in zip(start[a:b].tolist(), end[a:b].tolist(), strict=True)
            ]
            for low, high, names in automaton.scan(words):
                hit[a + low : a + high] = True
                items.setdefault(int(row[a]), set()).update(names)
    return start, end, row, hit, items


def find_test_items(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
    max_words: int = MAX_WORDS,
    keep: list[str] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_hit, longest_hit (words of
    the longest run of hit words), items (sorted texts of their ids), spans
    (byte ranges of the runs, start and end in turn) and clean_text (the text
    without them).

    A null or empty text has no words and no hits; items with a null id or no
    words are ignored, repeated items count once. A null document id is returned
    as it is and repeated rows are judged each. ``keep`` names columns of
    ``docs`` that are returned as they are; others are ignored, whatever their
    names. Without items nothing is hit.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontaminate")
    groups = store_items(items, scratch, max_words, item_id_column, item_text_column)
    keep = [c for c in keep or [] if c not in (id_column, text_column)]
    rows = docs.select(
        docs[id_column].alias("_id"),
        docs[text_column].alias("_text"),
        *[docs[c].alias(f"_kept{i}") for i, c in enumerate(keep)],
        F.lit(b"").cast("binary").alias("_hits"),
        F.array().cast("array<string>").alias("_items"),
    )
    schema = rows.schema
    n_kept = len(keep)

    def stepper(folder: str):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = None
            for n, batch in enumerate(batches):
                if n == 0:
                    automaton = group_automaton(folder, window)
                if automaton is None:
                    yield batch
                    continue
                hits = batch.column(n_kept + 2).to_pylist()
                names = batch.column(n_kept + 3).to_pylist()
                for first, _, data, offsets in arrays.blocks(batch.column(1)):
                    _, _, row, hit, found = _mark_block(automaton, data, offsets)
                    at = arrays.spans(row, len(offsets) - 1)
                    for r, new in found.items():
                        mine = hit[at[r] : at[r + 1]]
                        before = hits[first + r]
                        if before:
                            old = np.unpackbits(np.frombuffer(before, np.uint8), count=len(mine))
                            mine = mine | old.astype(bool)
                        hits[first + r] = np.packbits(mine).tobytes()
                        names[first + r] = sorted(new.union(names[first + r]))
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns[: n_kept + 2],
                        pa.array(hits, pa.binary()),
                        pa.array(names, pa.list_(pa.string())),
                    ],
                    schema=batch.schema,
                )

        return arrays.released(run)

    for i, folder in enumerate(groups):
        if i:
            rows = scratch.store(rows, f"hits-{i}")
        if i > 1:
            scratch.drop(f"hits-{i - 1}")
        rows = rows.mapInArrow(stepper(folder), schema)

    out_names = ["n_words", "n_hit", "longest_hit", "items", "spans", "clean_text"]
    out_kinds = [pa.int64()] * 3 + [pa.list_(pa.string()), pa.list_(pa.int64()), pa.string()]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = batch.column(n_kept + 2).to_pylist()
            names = batch.column(n_kept + 3)
            n_words, n_hit, longest, spans, clean = [], [], [], [], []
            for first, last, data, offsets in arrays.blocks(batch.column(1)):
                start, end, row = arrays.words(data, offsets, arrays.LETTER_WORD)
                at = arrays.spans(row, last - first)
                for r in range(last - first):
                    a, b = int(at[r]), int(at[r + 1])
                    n_words.append(b - a)
                    if not hits[first + r]:
                        n_hit.append(0)
                        longest.append(0)
                        spans.append([])
                        clean.append(None)
                        continue
                    bits = np.unpackbits(np.frombuffer(hits[first + r], np.uint8), count=b - a)
                    edge = np.diff(np.concatenate(([0], bits, [0])).astype(np.int8))
                    low, high = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                    n_hit.append(int(bits.sum()))
                    longest.append(int((high - low).max()))
                    pairs = np.stack([start[a + low], end[a + high - 1]], 1) - offsets[r]
                    spans.append(pairs.ravel().tolist())
                    text = data[offsets[r] : offsets[r + 1]].tobytes()
                    cuts = [0, *spans[-1], len(text)]
                    clean.append(b"".join(text[i:j] for i, j in zip(cuts[::2], cuts[1::2], strict=True)).decode())
            whole = batch.column(1).to_pylist()
            clean = [w if c is None else c for c, w in zip(clean, whole, strict=True)]
            columns = [n_words, n_hit, longest, names, spans, clean]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *batch.columns[2 : n_kept + 2]]
                + [c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, out_kinds, strict=True)],
                ["_id", *[f"_kept{i}" for i in range(n_kept)], *out_names],
            )

    kinds = {f.name: f.dataType.simpleString() for f in schema}
    out = ", ".join(f"{n} {kinds[n]}" for n in ["_id", *[f"_kept{i}" for i in range(n_kept)]])
    out += ", n_words long, n_hit long, longest_hit long, items array<string>, spans array<long>, clean_text string"
    found = rows.mapInArrow(arrays.released(finish), out)
    return found.select(
        F.col("_id").alias(id_column),
        *[F.col(f"_kept{i}").alias(c) for i, c in enumerate(keep)],
        *out_names,
    )
