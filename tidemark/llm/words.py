"""Words, word hashes and shingles of whole texts, computed with numpy on the buffers of an Arrow column.

A word is a maximal run of bytes other than space and \\t..\\r, with A-Z lower-cased. Its hash is a polynomial over the
bytes modulo 2^64, finished by an avalanche step. Texts are taken in small slices, as each byte costs some forty in between.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 18
SHINGLE = 5

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche step of a 64-bit hash."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n + 1, _BASE, dtype=_U), np.full(n + 1, _BASE_INVERSE, dtype=_U)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row bounds) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def row_slices(bounds: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about `limit` bytes; a longer row is a range of its own."""
    lo, n = 0, len(bounds) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes and the length of every span."""
    n = len(raw)
    up, down = _powers(1 << max(19, int(n - 1).bit_length()))
    total = np.zeros(n + 1, dtype=_U)
    np.cumsum((raw.astype(_U) + _U(1)) * up[:n], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(_U))


def word_hashes(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, bounds of each row's words)."""
    n = len(raw)
    if n == 0:
        return np.zeros(0, dtype=_U), np.zeros(len(bounds), dtype=np.int64)
    if n > 2 * SLICE_BYTES and len(bounds) > 2:
        parts = [word_hashes(raw[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo]) for lo, hi in row_slices(bounds, SLICE_BYTES)]
        starts = np.cumsum([0, *(len(h) for h, _ in parts)])
        return np.concatenate([h for h, _ in parts]), np.concatenate([*(b[:-1] + at for (_, b), at in zip(parts, starts, strict=False)), starts[-1:]])
    inside = ~_SPACE[raw]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    full = np.flatnonzero(np.diff(bounds))
    first, last = bounds[full], bounds[full + 1] - 1
    starts[first] = inside[first]
    ends[last] = inside[last]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return span_hashes(_LOWER[raw], starts, ends), np.searchsorted(starts, bounds)


def shingles(hashes: np.ndarray, bounds: np.ndarray, width: int = SHINGLE) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its `width`-word shingles; a row of fewer words has its whole sequence as one."""
    factors = [_U(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]
    factors += [_U((0x9E3779B97F4A7C15 * (2 * k + 3)) % (1 << 64) | 1) for k in range(max(0, width - 5))]
    n = len(hashes)
    every = np.zeros(max(0, n - width + 1), dtype=_U)
    for k in range(width if len(every) else 0):
        every += hashes[k : k + len(every)] * factors[k]
    every = mix(every)
    out = []
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if hi - lo >= width:
            own = np.sort(every[lo : hi - width + 1])
            keep = np.ones(len(own), dtype=bool)
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            out.append(own[keep])
        elif hi > lo:
            short = (hashes[lo:hi] * np.array(factors[: hi - lo], dtype=_U)).sum(keepdims=True, dtype=_U)
            out.append(mix(short + _U(hi - lo)))
        else:
            out.append(np.zeros(0, dtype=_U))
    return out
