"""Vectorised words and rolling hashes over blocks of UTF-8 text.

Hashes are polynomials over 64-bit integers taken from prefix sums, so that the hash of any
run costs one subtraction, and are scrambled at the end.
"""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_tables: dict[str, np.ndarray] = {}
#: Bytes of a step, at least, whose words are hashed in blocks.
LONG = 4 << 20

#: The separators of words: space and the control characters from tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    if "up" not in _tables or len(_tables["up"]) < n:
        size = max(1 << 16, 1 << int(n - 1).bit_length())
        for name, base in (("up", BASE), ("down", INVERSE)):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            _tables[name] = np.multiply.accumulate(out)
    return _tables["up"][:n], _tables["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums of values[i] * BASE**i, from 0."""
    out = np.empty(len(values) + 1, np.uint64)
    out[0] = 0
    np.cumsum(values.astype(np.uint64) * powers(len(values))[0], out=out[1:])
    return out


def run_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the runs start:end, the same for equal runs wherever they stand."""
    down = powers(len(sums))[1]
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def all_run_hashes(sums: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size``, by where they start."""
    h = (sums[size:] - sums[:-size]) * powers(len(sums))[1][: len(sums) - size]
    return mix(h + np.uint64(size * 0xD6E8FEB86659FD93 & (1 << 64) - 1))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (in bytes) of all words, and each row's bounds among them."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    full = ~SPACE[data]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    begins = full.copy()
    begins[1:] &= ~full[:-1] | first[1:-1]
    ends = full
    ends[:-1] &= ~full[1:] | first[1:-1]
    start = np.flatnonzero(begins)
    return start, np.flatnonzero(ends) + 1, np.searchsorted(start, offsets)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the words start:end, which follow one another; a hash does not depend on where its word stands.

    More than ``LONG`` bytes, a very long text, go in blocks of words: eight bytes and more are held for each byte of a block, not of the text.
    """
    if len(data) <= LONG:
        return run_hashes(prefix(data.astype(np.uint64) + np.uint64(1)), start, end)
    out, lo = np.empty(len(start), np.uint64), 0
    while lo < len(start):
        hi = max(lo + 1, int(np.searchsorted(end, start[lo] + LONG // 4, "right")))
        base = start[lo]
        out[lo:hi] = run_hashes(prefix(data[base : end[hi - 1]].astype(np.uint64) + np.uint64(1)), start[lo:hi] - base, end[lo:hi] - base)
        lo = hi
    return out


def grams(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` within each row, and each row's bounds among them."""
    counts = np.maximum(np.diff(bounds) - size + 1, 0)
    out = np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(out[-1], dtype=np.int64) + np.repeat(bounds[:-1] - out[:-1], counts)
    return run_hashes(prefix(hashes), at, at + size), out


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each full window of ``width``, by doubling."""
    have, out = 1, values
    while have < width:
        by = min(have, width - have)
        out = np.minimum(out[:-by], out[by:]) if by else out
        have += by
    return out
