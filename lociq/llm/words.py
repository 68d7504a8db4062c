"""Vectorised cutting of Arrow text columns at ASCII white space (numpy, inside tasks).

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D. Texts are handled in slices of
a few MB; a text longer than a slice is cut where a word ends, so that memory stays bounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_N = 1 << 12
_RNG = np.random.default_rng(20240229)
_R1 = _RNG.integers(0, 1 << 63, _N, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_R2 = _RNG.integers(0, 1 << 63, _N, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (shift-multiply finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets, present) of a string column; a null is empty and not present."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    n = len(column)
    present = np.ones(n, bool) if not column.null_count else ~np.asarray(column.is_null())
    if not n:
        return np.empty(0, np.uint8), np.zeros(1, np.int64), present
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1].copy()
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    if column.null_count:
        length = np.where(present, np.diff(off), 0)
        if (np.diff(off) != length).any():  # a null with bytes below it
            return text_buffers(column.fill_null(b""))[:2] + (present,)
    return raw[off[0] : off[-1]], off - off[0], present


class Slice(NamedTuple):
    """Bytes [lo, hi) of a column; rows and bounds (relative to lo) of the texts or parts of texts in it."""

    data: np.ndarray
    lo: int
    rows: np.ndarray
    bounds: np.ndarray


def slices(data: np.ndarray, off: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    n, row = len(off) - 1, 0
    while row < n:
        end = int(np.searchsorted(off, off[row] + limit, "right")) - 1
        if end > row:
            yield Slice(data[off[row] : off[end]], int(off[row]), np.arange(row, end), off[row : end + 1] - off[row])
            row = end
            continue
        at, stop = int(off[row]), int(off[row + 1])
        while at < stop:
            cut = min(at + limit, stop)
            while cut < stop and not (_SPACE[data[cut]] and not _SPACE[data[cut - 1]]):
                ahead = data[cut : cut + 65536]
                space = _SPACE[ahead]
                before = np.concatenate(([_SPACE[data[cut - 1]]], space[:-1]))
                hit = np.flatnonzero(space & ~before)
                cut = min(stop, cut + int(hit[0])) if len(hit) else min(stop, cut + len(ahead))
            yield Slice(data[at:cut], at, np.array([row]), np.array([0, cut - at]))
            at = cut
        row += 1


def word_bounds(s: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte ranges of the slice's words; words first[i]:first[i+1] belong to rows[i]."""
    if not len(s.data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(s.bounds), np.int64)
    solid = ~_SPACE[s.data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    edge = s.bounds[:-1][np.diff(s.bounds) > 0]
    begins[edge] |= solid[edge]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:]
    last = s.bounds[1:][np.diff(s.bounds) > 0] - 1
    ends[last] |= solid[last]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, s.bounds)


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False, second: bool = False) -> tuple[np.ndarray, ...]:
    """A 64-bit multilinear hash (random odd weights, length mixed in) of each byte range; two if second."""
    lens = ends - starts
    total = int(lens.sum())
    if not total:
        zero = np.zeros(len(starts), np.uint64)
        return (zero, zero) if second else (zero,)
    heads = np.concatenate(([0], np.cumsum(lens)[:-1]))
    pos = np.arange(total) - np.repeat(heads, lens)
    b = data[np.repeat(starts, lens) + pos]
    b = (_LOWER[b] if lower else b).astype(np.uint64) + np.uint64(1)
    far = pos >> 12 if int(lens.max()) > _N else None
    out = []
    for table in (_R1, _R2) if second else (_R1,):
        w = table[pos & (_N - 1)]
        if far is not None:
            w = mix64(w + far.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        h = np.zeros(len(starts), np.uint64)
        full = lens > 0
        h[full] = np.add.reduceat(b * w, heads[full])
        out.append(mix64(h + lens.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    return tuple(out)


def distinct_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """(distinct byte strings, number of each range's string), exact: a second hash guards the first."""
    if not len(starts):
        return [], np.empty(0, np.int64)
    h1, h2 = range_hashes(data, starts, ends, second=True)
    _, first, inverse = np.unique(h1, return_index=True, return_inverse=True)
    raw = data.tobytes()
    if (h2 != h2[first][inverse]).any():
        seen: dict[bytes, int] = {}
        inverse = np.array([seen.setdefault(raw[a:z], len(seen)) for a, z in zip(starts.tolist(), ends.tolist(), strict=True)])
        return list(seen), inverse
    return [raw[a:z] for a, z in zip(starts[first].tolist(), ends[first].tolist(), strict=True)], inverse
