"""Vectorised tokenising and hashing of Arrow string batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_rng = np.random.default_rng(20240229)
#: one random odd-ish 64-bit number for each byte value; fixed by the seed
BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
GRAM = np.uint64(0xD6E8FEB86659FD93)
GRAM_INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 2**64))
BLANKS = np.zeros(256, bool)
BLANKS[[9, 10, 13, 32]] = True


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out) if n else out


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; NULL counts as empty."""
    col = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64, len(col) + 1, col.offset * 8)
    if data is None or not len(offsets) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def blank_tokens(column: pa.Array, offsets: bool = False) -> tuple[np.ndarray, ...]:
    """Tokens cut at space, tab and line break: (hash of each, row of each), in order; with ``offsets`` also the byte in its row that each begins at."""
    data, bounds = string_bytes(column)
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return (none.astype(np.uint64), none, none) if offsets else (none.astype(np.uint64), none)
    solid = ~BLANKS[data]
    fresh = np.zeros(n + 1, bool)
    fresh[bounds[:-1]] = True
    start = solid.copy()
    start[1:] &= ~solid[:-1] | fresh[1:n]
    begin = np.flatnonzero(start)
    stop = solid.copy()
    stop[:-1] &= ~solid[1:] | fresh[1:n]
    end = np.flatnonzero(stop) + 1
    with np.errstate(over="ignore"):
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE[data] * powers(BASE, n), out=total[1:])
        back = powers(INVERSE, n)
        hashes = mix((total[end] - total[begin]) * back[begin] + (end - begin).astype(np.uint64))
    rows = np.searchsorted(bounds, begin, side="right") - 1
    return (hashes, rows, begin - bounds[rows]) if offsets else (hashes, rows)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k tokens from each position, without regard to row bounds; len - k + 1 of them."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * powers(GRAM, n), out=total[1:])
        return mix((total[k:] - total[:-k]) * powers(GRAM_INVERSE, n - k + 1))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i : i + width] for each i, by doubling."""
    span = 1
    out = x
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out
