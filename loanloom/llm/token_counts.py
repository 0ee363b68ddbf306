"""Token counts of whole texts, with huge texts encoded in overlapping pieces.

A text longer than ``piece_chars`` is cut into pieces that reach ``overlap``
characters over both ends of their range. Neighbours are spliced at a position
where both encodings start a pre-token and which lies ``MARGIN`` characters
inside the overlap. Such a position is a true boundary:

- the tokenizer's pattern matches from left to right and looks one character
  ahead, never back. The left piece starts, or was spliced, at a true boundary,
  so its matches are those of the whole text until they come near its end;
- a pattern that starts a match at the same position reads the same characters
  from there on, so the right piece goes on as the whole text does;
- a special string is shorter than ``MARGIN``, so one that lies across the
  position would be seen, and not cut, by both pieces.

Without a common position the overlap is widened; once it would reach half a
piece, the two pieces are encoded as one.
"""

from __future__ import annotations

import json
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from loanloom.llm.tokens import piece_encoder, tokenizer

PIECE_CHARS = 16_384
OVERLAP = 256
MARGIN = 32
#: Characters handed to the tokenizer at once.
GROUP_CHARS = 1 << 20


@dataclass
class _Piece:
    start: int
    end: int
    marks: list[tuple[int, int]]  # (character, tokens before it) where a pre-token starts
    n_tokens: int


def _encode(tok, text: str, ranges: list[tuple[int, int]]) -> list[_Piece]:
    found = tok.encode_batch([text[a:b] for a, b in ranges], add_special_tokens=False)
    pieces = []
    for (a, b), e in zip(ranges, found, strict=True):
        marks, before = [], -1
        for i, (word, (at, _)) in enumerate(zip(e.word_ids, e.offsets, strict=True)):
            if word != before:
                marks.append((a + at, i))
                before = word
        pieces.append(_Piece(a, b, marks, len(e)))
    return pieces


def _common(left: _Piece, right: _Piece, length: int) -> tuple[int, int] | None:
    """Tokens before the first proven common boundary, in either piece."""
    low = right.start + MARGIN
    high = left.end - MARGIN if left.end < length else left.end
    at = dict(right.marks[bisect_left(right.marks, (low, -1)) :])
    for position, tokens in left.marks[bisect_left(left.marks, (low, -1)) :]:
        if position > high:
            break
        if position in at:
            return tokens, at[position]
    return None


@lru_cache(maxsize=4)
def _is_plain_byte_level(tokenizer_file: str) -> bool:
    """Does the tokenizer split as ``PieceEncoder`` proves it for byte-level BPE:
    the usual pattern, nothing before it, texts neither cut nor padded?"""
    parts = json.loads(tokenizer(tokenizer_file).to_str())
    split = parts["pre_tokenizer"] or {}
    return (
        split.get("type") == "ByteLevel"
        and split.get("use_regex", True)
        and not split.get("add_prefix_space")
        and not any(parts[k] for k in ("normalizer", "truncation", "padding"))
    )


def count_whole(tokenizer_file: str, texts: list[str]) -> list[int]:
    """Tokens of each text; known words of a byte-level tokenizer are looked up."""
    if _is_plain_byte_level(tokenizer_file):
        return [len(ids) // 4 for ids in piece_encoder(tokenizer_file, True).encode(texts)]
    found = tokenizer(tokenizer_file).encode_batch_fast(texts, add_special_tokens=False)
    return [len(e) for e in found]


def count_long(tok, text: str, piece_chars: int = PIECE_CHARS, overlap: int = OVERLAP) -> int:
    """Tokens of one text, from its overlapping pieces."""
    n = len(text)
    cuts = list(range(0, n, piece_chars)) or [0]
    ranges = [(max(0, c - overlap), min(n, c + piece_chars + overlap)) for c in cuts]
    # a few pieces at a time: only their marks are held
    total = 0
    left: _Piece | None = None
    skipped = 0  # tokens of ``left`` that belong to what is before it
    for i in range(0, len(ranges), 8):
        for piece, cut in zip(_encode(tok, text, ranges[i : i + 8]), cuts[i : i + 8], strict=True):
            if left is None:
                left = piece
                continue
            reach, right, wide = overlap, piece, left
            spliced = _common(wide, right, n)
            while spliced is None and 2 * reach < piece_chars // 2:
                reach *= 2
                (wide,) = _encode(tok, text, [(left.start, min(n, cut + reach))])
                (right,) = _encode(tok, text, [(max(0, cut - reach), piece.end)])
                spliced = _common(wide, right, n)
            if spliced is None:
                (left,) = _encode(tok, text, [(left.start, piece.end)])
                continue
            total += spliced[0] - skipped
            left, skipped = right, spliced[1]
    return total + (left.n_tokens - skipped if left else 0)


def count_tokens(
    docs: DataFrame,
    tokenizer_file: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    piece_chars: int = PIECE_CHARS,
    overlap: int = OVERLAP,
) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes (UTF-8), n_tokens.

    Begin, end and added special tokens are left out; special strings inside a
    text are handled as the library does by default. A null text is empty and
    has no tokens; a null id is returned as it is. Repeated rows are counted
    each. Other columns of ``docs`` are ignored, whatever their names. The work
    needs no shuffle; memory is bounded by ``GROUP_CHARS``, the longest text and
    the kept pieces of a worker: with a byte-level tokenizer a word is encoded once
    while its ids are kept.
    """
    rows = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(tokenizer_file)
        for batch in batches:
            column = pc.fill_null(batch.column(1), "")
            texts = column.to_pylist()
            counts = [0] * len(texts)
            group: list[int] = []
            size = 0
            for i, text in enumerate([*texts, None]):
                if text is None or size > GROUP_CHARS:
                    for k, n in zip(group, count_whole(tokenizer_file, [texts[k] for k in group]), strict=True):
                        counts[k] = n
                    group, size = [], 0
                if text is None:
                    break
                if len(text) > piece_chars:
                    counts[i] = count_long(tok, text, piece_chars, overlap)
                else:
                    group.append(i)
                    size += len(text)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pc.binary_length(column).cast(pa.int64()),
                    pa.array(counts, pa.int64()),
                ],
                ["id", "n_bytes", "n_tokens"],
            )

    return rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long").withColumnRenamed(
        "id", id_column
    )
