"""Texts of an Arrow batch as NumPy arrays, for work on many texts at once.

Functions here see a block of whole texts as one byte array with offsets, so
that finding words, hashing words and comparing windows are array operations.
A block holds about ``BLOCK_BYTES`` of text; a longer text is a block of its own.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 19

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def release() -> None:
    """Hands memory back that this process does not need between tasks."""
    _powers[:] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
    _prime_powers.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def released(run: Callable) -> Callable:
    """A task function that calls ``release`` when it is done. Python workers
    are kept for later tasks, and an idle one would hold what its largest task
    has used. (Only functions are named here: what a task function names is sent
    along with it.)"""

    @wraps(run)
    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return inner


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def byte_table(seed: int, fold_case: bool) -> np.ndarray:
    """A random 64-bit number for each byte; with ``fold_case`` A-Z as a-z."""
    table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(2 * seed + 1))
    if fold_case:
        table[65:91] = table[97:123]
    return table


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, at least ``n`` of them."""
    if len(_powers[0]) < n:
        size = max(n, 2 * BLOCK_BYTES)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _powers[k] = np.multiply.accumulate(factors)
    return _powers[0], _powers[1]


#: Two primes below 2^31 and a base for each.
_PRIMES = (np.uint64(2147483647), np.uint64(2147483629))
_PRIME_BASES = (1283694701, 1771823419)
_prime_powers: list[tuple[np.ndarray, np.ndarray]] = []


def _modulo(values: np.ndarray, prime: np.uint64) -> np.ndarray:
    """The remainders, in place (a product and a quotient take less than %)."""
    quotient = values // prime
    quotient *= prime
    values -= quotient
    return values


def _power_run(base: int, prime: np.uint64, n: int) -> np.ndarray:
    run = np.ones(1, np.uint64)
    while len(run) < n:
        step = np.uint64(pow(base, len(run), int(prime)))
        run = np.concatenate([run, _modulo(run * step, prime)])
    return run


def prime_powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each prime, powers of its base and of the base's inverse."""
    if not _prime_powers or len(_prime_powers[0][0]) < n:
        size = max(n, 2 * BLOCK_BYTES)
        _prime_powers[:] = [
            (_power_run(base, prime, size), _power_run(pow(base, -1, int(prime)), prime, size))
            for base, prime in zip(_PRIME_BASES, _PRIMES, strict=True)
        ]
    return _prime_powers


class PrefixHash:
    """62-bit hashes of any ranges of a block in constant time each: polynomials
    modulo two primes. (Modulo a power of two, words such as Thue and Morse's and
    its complement collide from 1,024 letters on, whatever the base.)"""

    def __init__(self, data: np.ndarray, table: np.ndarray) -> None:
        self._parts = []
        halves = (table & np.uint64(0xFFFFFFFF), table >> np.uint64(32))
        for (up, down), half, prime in zip(prime_powers(len(data) + 1), halves, _PRIMES, strict=True):
            terms = (half % prime)[data]
            terms *= up[: len(data)]
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(_modulo(terms, prime), out=sums[1:])
            self._parts.append((sums, down, prime))

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        sizes = (end - start).astype(np.uint64)
        return self._joined([(s[end] - s[start], d[start]) for s, d, _ in self._parts], sizes)

    def windows(self, width: int) -> np.ndarray:
        """``ranges`` of ``width`` bytes from every position that has so many."""
        n = max(0, len(self._parts[0][0]) - width)
        parts = [(s[width:] - s[:n], d[:n]) for s, d, _ in self._parts] if n else []
        return self._joined(parts, np.array([width], np.uint64)) if n else np.zeros(0, np.uint64)

    def _joined(self, parts: list[tuple[np.ndarray, np.ndarray]], sizes: np.ndarray) -> np.ndarray:
        found = []
        for (h, down), (_, _, prime) in zip(parts, self._parts, strict=True):
            h = _modulo(h, prime)
            h *= down
            found.append(_modulo(h, prime))
        h = found[1] << np.uint64(31)
        h |= found[0]
        h += sizes * np.uint64(0xD6E8FEB86659FD93)
        return mix(h)


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a string or binary array; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        binary = pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)
        column = pc.fill_null(column, b"" if binary else "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if large else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def blocks(
    column: pa.Array, size: int = BLOCK_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of blocks of whole texts."""
    data, offsets = string_buffers(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def words(
    data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each maximal run of bytes marked in ``is_word``."""
    keep = is_word[data]
    before = np.empty_like(keep)
    before[1:] = keep[:-1]
    before[:1] = False
    inner = offsets[:-1][offsets[:-1] < len(data)]
    before[inner] = False
    start = np.flatnonzero(keep & ~before)
    after = np.empty_like(keep)
    after[:-1] = keep[1:]
    after[-1:] = False
    last = offsets[1:][offsets[1:] > 0] - 1
    after[last] = False
    end = np.flatnonzero(keep & ~after) + 1
    row = np.searchsorted(offsets, start, "right") - 1
    return start, end, row


def byte_class(excluded: str) -> np.ndarray:
    """Marks all bytes but those of ``excluded`` (Latin-1 codes)."""
    table = np.ones(256, bool)
    table[np.frombuffer(excluded.encode("latin-1"), np.uint8)] = False
    return table


#: Bytes of words ``[^\x20\x09-\x0D]+``.
PLAIN_WORD = byte_class(" \t\n\x0b\x0c\r")
#: Bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z became a-z.
LETTER_WORD = np.zeros(256, bool)
LETTER_WORD[48:58] = LETTER_WORD[65:91] = LETTER_WORD[97:123] = LETTER_WORD[128:] = True


def spans(row: np.ndarray, n_rows: int) -> np.ndarray:
    """Offsets by row of items whose rows are ascending."""
    return np.searchsorted(row, np.arange(n_rows + 1))
