"""Suffix order and common prefixes of a byte text by induced sorting.

The order of the leftmost S-type suffixes (LMS) induces that of all others: a
scan of the sorted suffixes from the smallest pushes each preceding L-type
suffix to the queue of its first character, where suffixes arrive in order; a
scan from the largest does the same for S-type suffixes. A pushed suffix carries
its common prefix with the one pushed before it: one more than the least common
prefix met since. The order of the LMS suffixes comes from the same induction of
their substrings, which gives them names, and from the text of those names,
whose suffixes are ranked by doubling; as two LMS positions are at least two
characters apart, six doublings cover ``DEPTH`` characters, beyond which order
is of no interest here.

Queues and long arrays lie on disk beyond ``HELD_BYTES``; a step holds at most
``STEP`` suffixes in memory. Files have no name and vanish with the task.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

DEPTH = 100
STEP = 1 << 16
HELD_BYTES = 48 << 20
#: Characters are bytes plus one; 0 separates strings.
ALPHABET = 257


def disk_array(n: int, kind) -> np.ndarray:
    """An array, on disk if it is large."""
    size = n * np.dtype(kind).itemsize
    if size <= HELD_BYTES:
        return np.empty(n, kind)
    with tempfile.TemporaryFile() as file:
        file.truncate(size)
        return np.memmap(file, kind, "r+", shape=(n,))


class Queue:
    """First in, first out: positions with the common prefix each has with the
    one before. Counted in advance, so its place on disk is fixed."""

    def __init__(self, positions: np.ndarray, lcps: np.ndarray) -> None:
        self.positions, self.lcps = positions, lcps
        self.written = self.read = 0

    def push(self, positions: np.ndarray, lcps: np.ndarray) -> None:
        end = self.written + len(positions)
        self.positions[self.written : end] = positions
        self.lcps[self.written : end] = lcps
        self.written = end

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        end = min(self.written, self.read + STEP)
        part = np.array(self.positions[self.read : end]), np.array(self.lcps[self.read : end])
        self.read = end
        return part


class Queues:
    """One queue for each first character, side by side in two arrays."""

    def __init__(self, sizes: np.ndarray) -> None:
        n = int(sizes.sum())
        positions, lcps = disk_array(n, np.int64 if n > 1 << 31 else np.int32), disk_array(n, np.uint8)
        at = np.concatenate([[0], np.cumsum(sizes)])
        self.by_char = [Queue(positions[a:b], lcps[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]


def _range_minima(values: np.ndarray) -> list[np.ndarray]:
    """Minima of all ranges whose length is a power of two."""
    out, width = [values], 1
    while 2 * width <= len(values):
        last = out[-1]
        out.append(np.minimum(last[:-width], last[width:]))
        width *= 2
    return out


def _least(table: list[np.ndarray], first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Least value of each range, both ends included; ranges are not empty."""
    level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
    out = np.empty(len(first), np.uint8)
    for k in np.unique(level).tolist():
        at = level == k
        out[at] = np.minimum(table[k][first[at]], table[k][last[at] + 1 - (1 << k)])
    return out


class Inducer:
    """Pushes predecessors of scanned suffixes; ``wanted`` is the type to push."""

    def __init__(self, text: np.ndarray, s_type: np.ndarray, wanted: bool, sizes: np.ndarray) -> None:
        self.text, self.s_type, self.wanted = text, s_type, wanted
        self.queues = Queues(sizes)
        #: least common prefix since the last push to each queue
        self.since = np.zeros(ALPHABET, np.uint8)

    def scan(self, positions: np.ndarray, lcps: np.ndarray) -> None:
        """Scanned suffixes in order, each with the prefix that it has in common
        with the one scanned before."""
        n = len(positions)
        table = _range_minima(lcps)
        before = positions - 1
        at = np.flatnonzero(before >= 0)
        at = at[self.s_type[before[at]] == self.wanted]
        chars = self.text[before[at]]
        order = np.argsort(chars, kind="stable")
        at, chars = at[order], chars[order]
        pushed = before[at]
        first = np.ones(len(at), bool)
        first[1:] = chars[1:] != chars[:-1]
        start = np.where(first, 0, np.concatenate([[0], at[:-1] + 1])) if len(at) else at
        least = _least(table, start, at) if len(at) else np.zeros(0, np.uint8)
        least[first] = np.minimum(least[first], self.since[chars[first]])
        carried = np.minimum(least, DEPTH - 1) + np.uint8(1)
        edges = np.append(np.flatnonzero(first), len(at))
        self.since = np.minimum(self.since, lcps.min()) if n else self.since
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            c = int(chars[a])
            self.queues.by_char[c].push(pushed[a:b], carried[a:b])
            last = int(at[b - 1])
            self.since[c] = lcps[last + 1 :].min() if last + 1 < n else DEPTH


def _run_lengths(text: np.ndarray) -> np.ndarray:
    """How often each character is repeated from its position on, up to DEPTH."""
    n = len(text)
    ends = np.append(np.flatnonzero(text[1:] != text[:-1]), n - 1)
    run_of = np.repeat(ends, np.diff(np.concatenate([[-1], ends])))
    return np.minimum(run_of - np.arange(n) + 1, DEPTH).astype(np.uint8)


def s_types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next; the last is not, as what
    follows the text counts as smaller than every character."""
    n = len(text)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int32) - text[:-1].astype(np.int32))
    step[-1] = -1
    known = np.where(step != 0, np.arange(n), n)
    known = np.minimum.accumulate(known[::-1])[::-1]
    return step[known] > 0


class SuffixOrder:
    """Sorted suffixes of a text of characters 0 to 256."""

    def __init__(self, text: np.ndarray) -> None:
        self.text = text
        self.s_type = s_types(text)
        self.runs = _run_lengths(text)
        self.lms = np.flatnonzero(self.s_type[1:] & ~self.s_type[:-1]) + 1
        self._l_sizes = np.bincount(text[~self.s_type], minlength=ALPHABET)
        self._s_sizes = np.bincount(text[self.s_type], minlength=ALPHABET)

    def _boundary(self, a: int, b: int) -> int:
        """Common prefix of an L-type and an S-type suffix of one character."""
        return min(int(self.runs[a]), int(self.runs[b]))

    def _induce(self, seeds: np.ndarray, lcps: np.ndarray) -> tuple[Queues, Queues]:
        """L-type suffixes in ascending and S-type ones in descending order,
        from LMS suffixes in ascending order."""
        text = self.text
        up = Inducer(text, self.s_type, False, self._l_sizes)
        up.scan(np.array([len(text)]), np.zeros(1, np.uint8))
        at = np.searchsorted(text[seeds], np.arange(ALPHABET + 1))
        for c in range(ALPHABET):
            queue, previous = up.queues.by_char[c], None
            while queue.read < queue.written:
                new = queue.read == 0
                positions, common = queue.take()
                if new:
                    common[0] = 0
                up.scan(positions, common)
                previous = int(positions[-1])
            for a in range(at[c], at[c + 1], STEP):
                b = min(a + STEP, int(at[c + 1]))
                common = lcps[a:b].copy()
                if a == at[c]:
                    common[0] = 0 if previous is None else self._boundary(previous, int(seeds[a]))
                up.scan(seeds[a:b], common)
        down = Inducer(text, self.s_type, True, self._s_sizes)
        for c in reversed(range(ALPHABET)):
            queue, previous = down.queues.by_char[c], None
            while queue.read < queue.written:
                new = queue.read == 0
                positions, common = queue.take()
                if new:
                    common[0] = 0
                down.scan(positions, common)
                previous = int(positions[-1])
            large = up.queues.by_char[c]
            n = large.written
            for b in range(n, 0, -STEP):
                a = max(0, b - STEP)
                positions = np.array(large.positions[a:b])[::-1]
                # with the next larger one, which was scanned before
                common = np.zeros(b - a, np.uint8)
                common[1:] = large.lcps[a + 1 : b][::-1]
                if b < n:
                    common[0] = large.lcps[b]
                elif previous is not None:
                    common[0] = self._boundary(int(positions[0]), previous)
                down.scan(positions, common)
        return up.queues, down.queues

    def _sorted_lms(self) -> tuple[np.ndarray, np.ndarray]:
        """LMS suffixes in order of their first DEPTH characters at least, and
        the common prefix of each with the one before."""
        lms, text = self.lms, self.text
        if len(lms) < 2:
            return lms, np.zeros(len(lms), np.uint8)
        # order of LMS substrings, by induction from their first characters
        first = lms[np.argsort(text[lms], kind="stable")]
        _, small = self._induce(first, np.zeros(len(first), np.uint8))
        is_lms = np.zeros(len(text) + 1, bool)
        is_lms[lms] = True
        found = [np.array(q.positions[: q.written])[::-1] for q in small.by_char]
        order = np.concatenate(found)
        order = order[is_lms[order]]
        index = np.searchsorted(lms, order)
        end = np.append(lms[1:], len(text) - 1)[index] + 1
        data = _Ranges(text)
        same = (end - order)[1:] == (end - order)[:-1]
        same[same] = data.equal(order[1:][same], order[:-1][same], (end - order)[1:][same])
        name = np.empty(len(lms), np.int64)
        name[index] = np.concatenate([[0], np.cumsum(~same)])
        # the text of names: ranks of 2, 4, 8, ... names
        width = 1
        top = int(name.max())
        while 2 * width <= DEPTH + 1 and top + 1 < len(name):
            following = np.zeros(len(name), np.int64)
            following[:-width] = name[width:] + 1
            key = name * (top + 2) + following
            by_key = np.argsort(key)
            ranked = key[by_key]
            rank = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
            name[by_key] = rank
            top, width = int(rank[-1]), 2 * width
        order = lms[np.argsort(name, kind="stable")]
        lcps = np.zeros(len(order), np.uint8)
        lcps[1:] = data.common(order[:-1], order[1:])
        return order, lcps

    def ascending(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All suffixes in order of their first DEPTH characters, in parts, each
        with its common prefix (DEPTH at most) with the one before."""
        large, small = self._induce(*self._sorted_lms())
        for c in range(ALPHABET):
            l_queue, s_queue = large.by_char[c], small.by_char[c]
            n, previous = l_queue.written, None
            for a in range(0, n, STEP):
                positions, common = np.array(l_queue.positions[a : a + STEP]), np.array(l_queue.lcps[a : a + STEP])
                if a == 0:
                    common[0] = 0
                yield positions, common
                previous = int(positions[-1])
            n = s_queue.written
            for b in range(n, 0, -STEP):
                a = max(0, b - STEP)
                positions = np.array(s_queue.positions[a:b])[::-1]
                common = np.zeros(b - a, np.uint8)
                common[1:] = s_queue.lcps[a + 1 : b][::-1]
                if b < n:
                    common[0] = s_queue.lcps[b]
                elif previous is not None:
                    common[0] = self._boundary(previous, int(positions[0]))
                yield positions, common


class _Ranges:
    """Equality of ranges of a text by their hashes."""

    def __init__(self, text: np.ndarray) -> None:
        from loanloom.llm.arrays import mix, powers

        table = mix(np.arange(1, ALPHABET + 1, dtype=np.uint64) * np.uint64(11))
        up, self._down = powers(len(text) + 1)
        self._sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(table[text] * up[: len(text)], out=self._sums[1:])
        self._n = len(text)

    def equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        one = (self._sums[a + length] - self._sums[a]) * self._down[a]
        return one == (self._sums[b + length] - self._sums[b]) * self._down[b]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefix, DEPTH at most: whole, or found by bisection."""
        room = np.minimum(DEPTH, self._n - np.maximum(a, b))
        out = room.copy()
        open_ = np.flatnonzero(~self.equal(a, b, room))
        a, b = a[open_], b[open_]
        low, high = np.zeros(len(a), np.int64), room[open_] - 1
        for _ in range(DEPTH.bit_length()):
            middle = (low + high + 1) >> 1
            same = self.equal(a, b, middle)
            low, high = np.where(same, middle, low), np.maximum(np.where(same, high, middle - 1), np.where(same, middle, low))
        out[open_] = low
        return out.astype(np.uint8)
