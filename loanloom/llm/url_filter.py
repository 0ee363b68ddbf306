"""URL filter: all glob rules at once by a bit-parallel wildcard automaton.

Every literal byte of every rule is one bit of a state of several 64-bit words
(multiword Shift-And). A step shifts the state by one bit, lets rules start, and
keeps the bits whose byte was read; bits before a ``*`` stay set. One pass over
the canonical URL so decides all rules; URLs of a batch advance together.

The canonical form is ``.host``, the byte FF, ``path``. FF occurs in no UTF-8
text, so a rule can tell host from path; a rule (host, path) that holds for the
host, its subdomains and all longer paths is the glob ``*.host FF path*``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.arrays import string_buffers

SPLIT = b"\xff"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Host globs that block a URL which no rule decides; all other URLs with a host
#: are allowed, and URLs without one are blocked.
BLOCKED_HOSTS = ("*adult*", "*bets*", "*casino*", "*porn*")


@dataclass(frozen=True)
class Rule:
    """A host (with its subdomains), the start of the path, and the verdict."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def glob(self) -> bytes:
        """``*`` in host or path is a wildcard, ``?`` stands for one byte."""
        return b"*." + self.host.encode() + SPLIT + self.path.encode() + b"*"


def host_glob(pattern: str) -> bytes:
    return b"." + pattern.encode() + SPLIT + b"*"


class GlobAutomaton:
    """Shift-And masks of globs."""

    def __init__(self, globs: Sequence[bytes]) -> None:
        literals = [[c for c in g if c != ord("*")] for g in globs]
        n_bits = sum(map(len, literals))
        self.n_words = max(1, -(-n_bits // 64))
        self.masks = np.zeros((256, self.n_words), np.uint64)
        first, anywhere, stay = (np.zeros(self.n_words, np.uint64) for _ in range(3))
        self._final: list[int] = []  # bit, or -1 for a glob without literals
        self._any: list[bool] = []
        bit = 0
        for glob, chars in zip(globs, literals, strict=True):
            self._any.append(not chars and b"*" in glob)
            if not chars:
                self._final.append(-1)
                continue
            word = lambda b: (b >> 6, np.uint64(1) << np.uint64(b & 63))
            w, m = word(bit)
            first[w] |= m
            if glob.startswith(b"*"):
                anywhere[w] |= m
            at = bit - 1
            for c in glob:
                if c == ord("*"):
                    if at >= bit:
                        w, m = word(at)
                        stay[w] |= m
                    continue
                at += 1
                w, m = word(at)
                if c == ord("?"):
                    self.masks[:, w] |= m
                else:
                    self.masks[c, w] |= m
            self._final.append(at)
            bit = at + 1
        self._first, self._anywhere, self._stay = first, anywhere, stay

    def match(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Texts x globs: which globs match which whole texts."""
        n = len(offsets) - 1
        lengths = np.diff(offsets)
        order = np.argsort(-lengths, kind="stable")
        start, sorted_lengths = offsets[:-1][order], lengths[order]
        state = np.zeros((n, self.n_words), np.uint64)
        one, top = np.uint64(1), np.uint64(63)
        active = n
        for t in range(int(sorted_lengths[0]) if n else 0):
            while active and sorted_lengths[active - 1] <= t:
                active -= 1
            now = state[:active]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            moved &= ~self._first
            moved |= self._first if t == 0 else self._anywhere
            moved &= self.masks[data[start[:active] + t]]
            moved |= now & self._stay
            state[:active] = moved
        out = np.zeros((n, len(self._final)), bool)
        for k, bit in enumerate(self._final):
            if bit < 0:
                out[order, k] = True if self._any[k] else sorted_lengths == 0
            else:
                out[order, k] = state[:, bit >> 6] >> np.uint64(bit & 63) & one == one
        return out


def filter_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    blocked_hosts: Sequence[str] = BLOCKED_HOSTS,
    id_column: str = "page_id",
    url_column: str = "url",
) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict.

    The longest fitting rule decides (of equally long ones the first that
    blocks, then the smaller text); without one, ``blocked_hosts`` blocks, an
    empty host is blocked, and all else is allowed. A null url or one without
    ``://`` has an empty host and path. Repeated rows are judged each; other
    columns are ignored, whatever their names.
    """
    ranked = sorted(rules, key=lambda r: (-len(r.text), r.verdict != "block", r.text))
    globs = [r.glob for r in ranked] + [host_glob(p) for p in blocked_hosts]
    automaton = GlobAutomaton(globs)
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(pages[url_column], F.lit(""))
    rows = pages.select(
        pages[id_column].alias("id"),
        F.translate(F.regexp_extract(url, parts, 1), UPPER, LOWER).alias("host"),
        F.regexp_extract(url, parts, 2).alias("path"),
    )
    kind = rows.schema["id"].dataType.simpleString()
    n_rules = len(ranked)
    texts = np.array([r.text for r in ranked] + [None], object)
    verdicts = np.array([r.verdict for r in ranked] + [None], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            host, h = string_buffers(batch.column(1))
            path, p = string_buffers(batch.column(2))
            # interleave ".", host, FF and path
            offsets = h + p + 2 * np.arange(n + 1)
            data = np.empty(offsets[-1], np.uint8)
            data[offsets[:-1]] = ord(".")
            data[offsets[:-1] + 1 + np.diff(h)] = SPLIT[0]
            for part, at, base in ((host, h, offsets[:-1] + 1), (path, p, offsets[:-1] + 2 + np.diff(h))):
                lengths = np.diff(at)
                data[np.arange(len(part)) + np.repeat(base - at[:-1], lengths)] = part
            found = automaton.match(data, offsets)
            fits = found[:, :n_rules]
            best = np.where(fits.any(1), fits.argmax(1), n_rules) if n_rules else np.zeros(n, int)
            bad = found[:, n_rules:].any(1) | (np.diff(h) == 0)
            verdict = np.where(best < n_rules, verdicts[best], np.where(bad, "block", "allow"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    batch.column(2),
                    pa.array(texts[best], pa.string()),
                    pa.array(verdict, pa.string()),
                ],
                ["id", "host", "path", "rule", "verdict"],
            )

    schema = f"id {kind}, host string, path string, rule string, verdict string"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_column)
