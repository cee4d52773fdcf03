"""Vectorised scanning of UTF-8 text inside Arrow batches.

Texts of a batch are taken as one byte buffer with document offsets.  Words are
maximal runs of bytes other than space and the controls 9 to 13, so cutting at
white space never splits a word.  Hashes are polynomial in the bytes modulo
2**64 over random byte values, finished by a mixing step; one running sum gives
the hash of any slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes scanned at once; keeps the working arrays inside the cache and memory bounded.
SLICE = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _U(_BASE))
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse."""
    if len(_powers.get("up", ())) < n:
        size = max(n, SLICE + 4096)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


def running_sum(data: np.ndarray) -> np.ndarray:
    """``len(data) + 1`` prefix sums from which ``slice_hash`` reads."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTES[data] * powers(len(data))[0], out=out[1:])
    return out


def slice_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes ``starts[i]:ends[i]`` under the buffer of ``sums``."""
    down = powers(len(sums))[1]
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (``n + 1``) of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def runs(offsets: np.ndarray, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Consecutive documents ``a:b`` of at most ``limit`` bytes, or one longer document."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a buffer; words never cross documents."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~SPACE[data]
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    after[-1], after[:-1] = False, inside[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    before[inner] = False
    after[inner - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def words(
    data: np.ndarray, offsets: np.ndarray, detail: bool = False
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray | None]]:
    """Documents ``a:b`` with the hashes of their lower-cased words.

    Yields ``a, b, hashes, counts, shapes``: words of all these documents in
    order, words per document, and with ``detail`` the ``shape_class`` of each.
    A document longer than a slice is hashed piece by piece, cut at white space.
    """
    for a, b in runs(offsets):
        at = offsets[a : b + 1] - offsets[a]
        part = LOWER[data[offsets[a] : offsets[b]]]
        hashes, shapes, starts = [], [], []
        for lo, hi in _pieces(part):
            piece = part[lo:hi]
            inner = at[(at >= lo) & (at <= hi)] - lo
            s, e = word_bounds(piece, inner)
            hashes.append(slice_hash(running_sum(piece), s, e))
            starts.append(s + lo)
            if detail:
                shapes.append(shape_class(piece, s, e))
        begun = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        counts = np.diff(np.searchsorted(begun, at))
        none = np.zeros(0, np.uint64)
        yield a, b, np.concatenate(hashes or [none]), counts, (
            np.concatenate(shapes or [np.zeros(0, np.int64)]) if detail else None
        )


def _pieces(data: np.ndarray) -> Iterator[tuple[int, int]]:
    lo, n = 0, len(data)
    while n - lo > 2 * SLICE:
        gaps = np.flatnonzero(SPACE[data[lo + SLICE // 2 : lo + SLICE]])
        if len(gaps):
            hi = lo + SLICE // 2 + int(gaps[-1])
        else:  # a word longer than half a slice: the next white space, wherever it is
            rest = np.flatnonzero(SPACE[data[lo + SLICE :]])
            hi = lo + SLICE + int(rest[0]) if len(rest) else n
        yield lo, hi
        lo = hi
    if lo < n:
        yield lo, n


#: Number of spelling classes that ``shape_class`` gives.
SHAPES = 32
_LAST = np.full(256, 3, np.int64)
_LAST[97:123] = 0
_LAST[128:] = 0
_LAST[44] = 1
_LAST[46] = 2


def shape_class(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A class from a word's spelling: non-ASCII or not, its last byte, its length."""
    if not len(starts):
        return np.zeros(0, np.int64)
    wide = np.zeros(len(data) + 1, np.int64)
    np.cumsum(data > 127, out=wide[1:])
    band = np.minimum((ends - starts - 1) // 4, 3)
    return (wide[ends] > wide[starts]) * 16 + _LAST[data[ends - 1]] * 4 + band
