"""Words of whole texts as arrays: one pass over the bytes of an Arrow batch, no Python loop over words.

Texts are cut into pieces of at most ``PIECE_BYTES`` (a longer text is a piece of its own), so that the
arrays stay small whatever the batch size. Words, k-grams and windows are known by 64-bit hashes; operators
that need certainty compare the words themselves where hashes agree.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)

#: Bytes of words: any but the blank and \x09-\x0D; and digits, lower-case letters and non-ASCII.
SOLID = np.ones(256, bool)
SOLID[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_powers: dict[str, np.ndarray] = {}


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        steps = np.full(max(n, PIECE_BYTES + 1), _BASE if kind == "up" else _INVERSE)
        steps[0] = 1
        have = _powers[kind] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


@dataclass
class Piece:
    """Texts ``lo`` to ``hi`` of a batch: their bytes (lower-cased if asked for) and their words.

    ``row`` (from 0 within the piece), ``start``, ``end`` (byte places in ``data``) and ``hash`` are per word;
    ``first`` is the index of each text's first word, with the number of words at its end.
    """

    lo: int
    hi: int
    data: np.ndarray
    bounds: np.ndarray
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray
    sums: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places (word indices) and hashes of all runs of ``k`` words inside one text."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        h = np.zeros(n, np.uint64)
        for j in range(k):
            h = h * _STEP + self.hash[j : j + n]
        at = np.flatnonzero(self.row[:n] == self.row[k - 1 :])
        return at, mix(h[at])

    def prefixes(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Words of more than ``size`` bytes, and the hashes of their first ``size`` bytes."""
        at = np.flatnonzero(self.end - self.start > size)
        start = self.start[at]
        h = (self.sums[start + size] - self.sums[start]) * _power("down", len(self.data) + 1)[start]
        return at, mix(h + np.uint64(size))

    def text(self, first: int, last: int) -> bytes:
        """The words ``first`` to ``last`` (exclusive) as they stand, joined by one blank."""
        blob, s, e = self.data, self.start[first:last], self.end[first:last]
        return b" ".join(blob[a:b].tobytes() for a, b in zip(s, e))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """The hashes that pieces give these words."""
    sizes = np.array([len(w) for w in words])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    return _piece(0, len(words), np.frombuffer(b"".join(words), np.uint8), bounds, SOLID, False).hash


def pieces(column: pa.Array, kind: np.ndarray = SOLID, lower: bool = False, limit: int | None = None) -> Iterator[Piece]:
    """Cut a text column into pieces of ``limit`` bytes (``PIECE_BYTES``); null is as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    _, places, blob = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + n + 1]
    whole = np.frombuffer(blob, np.uint8) if blob is not None and blob.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + (limit or PIECE_BYTES), "right")) - 1)
        yield _piece(lo, hi, whole[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], kind, lower)
        lo = hi


def _piece(lo: int, hi: int, data: np.ndarray, bounds: np.ndarray, kind: np.ndarray, lower: bool) -> Piece:
    data = LOWER[data] if lower else data
    n = len(data)
    solid = np.zeros(n + 1, bool)
    solid[:n] = kind[data]
    new_text = np.zeros(n + 1, bool)
    new_text[bounds] = True
    before = np.concatenate([[False], solid[:-1]])
    start = np.flatnonzero(solid & (~before | new_text))
    end = np.flatnonzero(before & (~solid | new_text))
    row = np.searchsorted(bounds, start, "right") - 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power("up", n), dtype=np.uint64, out=sums[1:])
    h = mix((sums[end] - sums[start]) * _power("down", n + 1)[start] + (end - start).astype(np.uint64))
    first = np.searchsorted(row, np.arange(hi - lo + 1), "left")
    return Piece(lo, hi, data, bounds, row, start, end, h, first, sums)
