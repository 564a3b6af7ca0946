"""Words and 64-bit word hashes of whole Arrow text columns, in numpy.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]``.  Null texts have
no words.  Memory is a few bytes per text byte plus 24 bytes per word, and 16
bytes per byte of ``CHUNK`` for tables that every worker holds: callers pass
slices of at most ``CHUNK`` bytes (or one longer document).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 18
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_TABLE = np.random.default_rng(20260101).integers(1, 1 << 63, 256, dtype=np.uint64)
_U = np.uint64


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW = _powers(_BASE, CHUNK)
_INV = _powers(pow(_BASE, -1, 1 << 64), CHUNK)


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix finaliser)."""
    h = np.asarray(h, np.uint64) + _U((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and n + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of documents of at most ``limit`` bytes together, or one longer document."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def bounds(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (exclusive) and document of each word."""
    word = ~SPACE[data] if inside is None else inside
    first, last = word.copy(), word.copy()
    if len(data):
        first[1:] &= ~word[:-1]
        last[:-1] &= ~word[1:]
        at = offsets[:-1][offsets[:-1] < len(data)]
        first[at] = word[at]
        at = offsets[1:][offsets[1:] > 0] - 1
        last[at] = word[at]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool) -> np.ndarray:
    """One hash per word, equal for equal bytes; with ``fold`` A-Z count as a-z."""
    table = _TABLE[LOWER] if fold else _TABLE
    at_start, at_end, inverse = (np.zeros(len(start), np.uint64) for _ in range(3))
    carry, scale, unscale = _U(0), _U(1), _U(1)
    with np.errstate(over="ignore"):
        for lo in range(0, max(len(data), 1), CHUNK):
            part = data[lo : lo + CHUNK]
            sums = np.empty(len(part) + 1, np.uint64)
            sums[0] = 0
            np.cumsum(table[part] * _POW[: len(part)], out=sums[1:])
            sums = sums * scale + carry
            a, b = np.searchsorted(start, (lo, lo + CHUNK))
            at_start[a:b] = sums[start[a:b] - lo]
            inverse[a:b] = _INV[start[a:b] - lo] * unscale
            a, b = np.searchsorted(end, (lo + 1, lo + CHUNK + 1))
            at_end[a:b] = sums[end[a:b] - lo]
            carry = sums[-1]
            scale = scale * _POW[-1] * _U(_BASE)
            unscale = unscale * _INV[-1] * _INV[1]
        return mix((at_end - at_start) * inverse)


def words(column: pa.Array, fold: bool, limit: int = CHUNK) -> Iterator[tuple]:
    """(first document, last document + 1, hash and document of each word) by slices of documents.

    Documents are counted from the first of the slice.
    """
    data, offsets = buffers(column)
    for lo, hi in slices(offsets, limit):
        part = data[offsets[lo] : offsets[hi]]
        start, end, doc = bounds(part, offsets[lo : hi + 1] - offsets[lo])
        yield lo, hi, hashes(part, start, end, fold), doc


def windows(h: np.ndarray, doc: np.ndarray, width: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``width`` words and whether it lies within one document."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    out = np.zeros(n, np.uint64)
    factor = _U((0xD1342543DE82EF95 + 2 * seed * 0x2545F4914F6CDD1D) % 2**64 | 1)
    with np.errstate(over="ignore"):
        for k in range(width):
            out = out * factor + h[k : k + n]
        return mix(out, seed + 1), doc[:n] == doc[width - 1 :]
