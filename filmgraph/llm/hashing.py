"""64-bit hashes of many byte ranges of a text at once.

A range's hash is the polynomial sum of (random number of the byte) * BASE^place, taken from one
running sum over the text, moved to place zero by the inverse power of its start, and mixed with its
length. Arithmetic is modulo 2^64, where an odd BASE has inverse powers.
"""

from __future__ import annotations

import numpy as np

# An odd base, its inverse modulo 2^64, and the finaliser's multipliers.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BLOCK_BYTES = 1 << 20             # longer texts are hashed in blocks cut at white space


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_LOWER = _BYTE.copy()
_LOWER[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_powers = np.ones((2, 1), dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """Powers of the base and of its inverse up to ``n``, kept for the next call."""
    global _powers
    if _powers.shape[1] <= n:
        out = np.empty((2, max(n + 1, 1 << 16)), dtype=np.uint64)
        out[:, 0] = 1
        out[0, 1:], out[1, 1:] = BASE, INVERSE
        _powers = np.multiply.accumulate(out, axis=1)
    return _powers


def hash_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                lower: bool = False) -> np.ndarray:
    """Hashes of ``data[starts[i]:ends[i]]`` (uint8); ``lower`` reads A-Z as a-z."""
    power = powers(len(data))
    run = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((_LOWER if lower else _BYTE)[data] * power[0, :len(data)], out=run[1:])
    h = (run[ends] - run[starts]) * power[1, starts]
    return mix64(h + (ends - starts).astype(np.uint64))


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the words of a text in order, A-Z read as a-z."""
    if not text:
        return np.zeros(0, dtype=np.uint64)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(space, prepend=True, append=True))
    starts, ends = edge[::2], edge[1::2]
    if len(data) <= BLOCK_BYTES or not len(starts):
        return hash_ranges(data, starts, ends, lower=True)
    out, lo = [], 0
    while lo < len(starts):           # blocks of whole words
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + BLOCK_BYTES)))
        base = starts[lo]
        out.append(hash_ranges(data[base:ends[hi - 1]], starts[lo:hi] - base, ends[lo:hi] - base,
                               lower=True))
        lo = hi
    return np.concatenate(out)
