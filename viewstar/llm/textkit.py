"""Vectorised word splitting and hashing of Arrow text batches (numpy, inside tasks).

Texts are handled as UTF-8 bytes.  Every byte of a non-ASCII character is
>= 0x80 and belongs to a word in both word classes below, so splitting bytes
gives the same words as splitting code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64


def _lut(separators: bytes) -> np.ndarray:
    lut = np.ones(256, dtype=bool)
    lut[list(separators)] = False
    return lut


#: ``[^\x20\x09-\x0D]+``
SPACE_WORDS = _lut(bytes([0x20, *range(0x09, 0x0E)]))
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` once A-Z is lower-cased
ALNUM_WORDS = _lut(bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
#: bytes.translate table that lower-cases A-Z only
FOLD_TABLE = _FOLD.tobytes()

_rng = np.random.default_rng(20240607)
_BYTE_CODE = _rng.integers(1, 2**63, size=256, dtype=np.uint64) * U64(2) + U64(1)
_STEP = U64(0x9E3779B97F4A7C15)
#: Bytes of text handled at once (a longer text is a slice of its own).
SLICE_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class Slice:
    """Words of a few consecutive texts: ``h`` word hashes, ``first`` the first word of each
    text (with one more entry at the end), ``data`` the folded bytes, ``start``/``end`` word bounds."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, word: np.ndarray, fold: bool = True):
        self.data = data = _FOLD[data] if fold else data
        self.offsets = offsets
        inside = word[data]
        begin, end = inside.copy(), inside.copy()
        if len(inside):
            begin[1:] &= ~inside[:-1]
            end[:-1] &= ~inside[1:]
            lo, hi = offsets[:-1], offsets[1:]
            some = hi > lo
            begin[lo[some]] = inside[lo[some]]
            end[hi[some] - 1] = inside[hi[some] - 1]
        self.start = np.flatnonzero(begin)
        self.end = np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.start, offsets)

    def hashes(self) -> np.ndarray:
        """One 64-bit hash per word (polynomial in its bytes, mixed with its length)."""
        size = self.end - self.start
        h = np.zeros(len(size), dtype=U64)
        active = np.arange(len(size))
        for k in range(int(size.max(initial=0))):
            if k:
                active = active[size[active] > k]
            if len(active) < 64 and k > 64:  # a few very long words: finish each in one go
                for i in active:
                    rest = _BYTE_CODE[self.data[self.start[i] + k:self.end[i]]]
                    powers = np.cumprod(np.full(len(rest), _STEP, dtype=U64))
                    h[i] = h[i] * powers[-1] + (rest * np.append(powers[-2::-1], U64(1))).sum(dtype=U64)
                break
            h[active] = h[active] * _STEP + _BYTE_CODE[self.data[self.start[active] + k]]
        return mix(h + size.astype(U64))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without copying; nulls are empty."""
    if pa.types.is_large_string(column.type) or pa.types.is_string(column.type):
        if column.null_count:
            column = column.fill_null("")
    else:
        column = column.cast(pa.string()).fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, off, data = column.buffers()
    if off is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(off, dtype=kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offsets


def bounds(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts together stay under ``limit`` bytes (one text at least)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def slices(column: pa.Array, word: np.ndarray) -> Iterator[tuple[int, int, Slice]]:
    """(first row, last row, words) over a batch's text column."""
    raw, offsets = text_bytes(column)
    for lo, hi in bounds(offsets):
        yield lo, hi, Slice(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], word)


def grams(h: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """Hash of every n consecutive words, by first word (length len(h) - n + 1)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=U64)
    step = U64((0xD6E8FEB86659FD93 + 2 * salt * 0x5851F42D4C957F2D) % 2**64 | 1)
    out = np.zeros(m, dtype=U64)
    for k in range(n):
        out = out * step + h[k:k + m]
    return mix(out + U64(salt))


def totals(h: np.ndarray, first: np.ndarray, salt: int = 0) -> np.ndarray:
    """Hash of each text's whole word sequence (order counts); 0 without words."""
    size = np.diff(first)
    out = np.zeros(len(size), dtype=U64)
    if len(h):
        step = U64((0xA0761D6478BD642F + 2 * salt * 0xE7037ED1A0B428DB) % 2**64 | 1)
        powers = np.cumprod(np.full(int(size.max()), step, dtype=U64))
        rank = np.arange(len(h)) - np.repeat(first[:-1], size)
        some = size > 0
        out[some] = np.add.reduceat(h * powers[rank], first[:-1][some])
        out[some] = mix(out[some] + size[some].astype(U64))
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def planes(x: np.ndarray) -> bytes:
    """uint32 values byte plane by byte plane, which the shuffle's compression shrinks."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def unplanes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()
