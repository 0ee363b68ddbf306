"""Token ids of many texts through the ``tokenizers`` library.

Ids come from ``tokenizers`` alone. Running text repeats its words, so texts are
cut where the tokenizer provably cuts too, each distinct piece is encoded once
per Python worker while its ids stay in a table of bounded size.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Pieces kept in each of two tables of a Python worker, about 200 bytes each,
#: the longest piece that is kept, and pieces encoded in one call.
KEPT_PIECES = 1_000_000
KEPT_CHARS = 40
JOINED = 2048

_SPACE = r" \t\n\r"
_MARKS = r".,;:!?&$%#*|"
#: A letter or digit before one of the marks: both tokenizers part letters and
#: digits from other characters. (Only an apostrophe may belong to letters.)
_WORD_END = r"(?<=[0-9A-Za-zÀ-ÖØ-öø-ÿ])(?=[" + _MARKS + "])"
_LEADING = f"[^{_SPACE}{_MARKS}]++"
_PIECE = f"{_LEADING}(?![{_MARKS}])|{_LEADING}{_WORD_END}|[^{_SPACE}]+"
#: Byte-level BPE cuts before white space that follows other text, and lets one
#: space join the next word; so a piece is white space and what follows it.
_WITH_SPACE = re.compile(f"[{_SPACE}]*(?:{_PIECE})|[{_SPACE}]+\\Z")
#: Word BPE drops white space; a piece is what stands between.
_BETWEEN_SPACE = re.compile(_PIECE)
#: White space beyond the four characters above, where cuts are not proven.
_OTHER_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0 ᠎ -​    　]")
#: Marks that may compose with a letter before it is lower-cased; without them, a
#: tokenizer that lower-cases gives the same ids for A-Z and a-z.
_COMBINING = re.compile("[\u0300-\u036f]")


@lru_cache(maxsize=4)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def id_array(ids: list[int]) -> np.ndarray:
    return np.fromiter(ids, "<u4", len(ids))


def id_bytes(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return id_array(ids).tobytes()


class PieceEncoder:
    """Encodes whole texts; equal to encoding each text by itself.

    ``keeps_space`` tells a byte-level tokenizer, for which white space belongs
    to the pieces, from one that drops it. A text whose cuts are not proven
    (special strings or rare white space inside) is encoded in one call. New
    pieces are encoded together, parted by a special token, at which the library
    cuts a text before anything else.
    """

    def __init__(self, path: str, keeps_space: bool, kept_pieces: int = KEPT_PIECES) -> None:
        self.tokenizer = tokenizer(path)
        self._most = kept_pieces
        self._find = (_WITH_SPACE if keeps_space else _BETWEEN_SPACE).findall
        normalizer = self.tokenizer.normalizer
        self._lowers = (
            not keeps_space and normalizer is not None and normalizer.normalize_str("A") == "a"
        )
        added = self.tokenizer.get_added_tokens_decoder()
        self._special = [t.content for t in added.values()]
        self._keeps_space = keeps_space
        self._part_id, self._part = next(((i, t.content) for i, t in added.items()), (None, None))
        self._new: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def _whole(self, text: str) -> bool:
        if any(s in text for s in self._special):
            return True
        return self._keeps_space and _OTHER_SPACE.search(text) is not None

    def _pieces(self, text: str) -> list[str] | None:
        if self._whole(text):
            return None
        if self._lowers and not _COMBINING.search(text):
            text = text.encode().lower().decode()  # A-Z alone
        return self._find(text)

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        encode = self.tokenizer.encode_batch_fast
        if self._part is None:
            return [id_bytes(e.ids) for e in encode(pieces, add_special_tokens=False)]
        out: list[bytes] = []
        for at in range(0, len(pieces), JOINED):
            some = pieces[at : at + JOINED]
            ids = id_array(encode([self._part.join(some)], add_special_tokens=False)[0].ids)
            cuts = np.flatnonzero(ids == self._part_id)
            if len(cuts) != len(some) - 1:
                raise RuntimeError("the tokenizer does not cut at its special token")
            data = ids.tobytes()
            cuts = (4 * cuts).tolist()
            out += [data[a:b] for a, b in zip([0, *(c + 4 for c in cuts)], [*cuts, len(data)], strict=True)]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as bytes."""
        pieces = [self._pieces(t) for t in texts]
        known = self._new
        wanted = set().union(*(p for p in pieces if p is not None)).difference(known)
        if wanted:
            if len(known) + len(wanted) > self._most:
                # pieces that are still in use come back from the old table
                self._old, self._new = known, {}
                known = self._new
                wanted = set().union(*(p for p in pieces if p is not None))
            old = self._old
            again = wanted.intersection(old)
            known.update((p, old[p]) for p in again)
            fresh = list(wanted.difference(again))
            known.update(zip(fresh, self._encode_pieces(fresh), strict=True))
        get = known.__getitem__
        out = []
        for text, parts in zip(texts, pieces, strict=True):
            if parts is None:
                out.append(id_bytes(self.tokenizer.encode(text, add_special_tokens=False).ids))
            else:
                out.append(b"".join(map(get, parts)))
        for piece in [p for p in wanted if len(p) > KEPT_CHARS]:
            del known[piece]
        return out


@lru_cache(maxsize=4)
def piece_encoder(path: str, keeps_space: bool, kept_pieces: int = KEPT_PIECES) -> PieceEncoder:
    """The encoder of a Python worker; its table serves all tasks that run there."""
    return PieceEncoder(path, keeps_space, kept_pieces)
