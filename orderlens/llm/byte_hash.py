"""Vectorised hashing of byte stretches: many words of many texts in a few numpy passes.

A stretch ``b[s:e]`` has the hash ``mix(sum(T[b[j]] * B**(j - s)))`` modulo 2**64 with a fixed
random table ``T`` and an odd ``B``.  The bytes are taken in windows of ``WINDOW``: inside one the powers
run from its first byte and are taken back by the inverse power of the start, and a stretch that goes on
from the window before adds its part times a power of its own.  Tables and temporaries have the size
of a window, however long a text is.
"""

from __future__ import annotations

import numpy as np

WINDOW = 1 << 16
_BASE = 0x9E3779B97F4A7C15 | 1
_TABLE = np.random.Generator(np.random.PCG64(20240229)).integers(
    1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(base: int) -> np.ndarray:
    steps = np.full(WINDOW, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


_UP, _DOWN = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (two xor-multiply rounds)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def hash_stretches(buf: np.ndarray, starts: np.ndarray, silent: np.ndarray | None = None) -> np.ndarray:
    """Hashes of the stretches that begin at ``starts`` (ascending) and reach to the next start.
    Bytes marked in ``silent`` do not count, so trailing separators change nothing."""
    total = np.zeros(len(starts), np.uint64)
    if not len(starts):
        return total
    for lo in range(int(starts[0]), len(buf), WINDOW):
        values = _TABLE[buf[lo:lo + WINDOW]]
        if silent is not None:
            values[silent[lo:lo + WINDOW]] = 0
        values *= _UP[:len(values)]
        first, last = np.searchsorted(starts, [lo, lo + WINDOW])
        inside = starts[first:last] - lo
        head = int(inside[0]) if len(inside) else len(values)
        if first and head:                        # the stretch that began before this window
            total[first - 1:first] += values[:head].sum(dtype=np.uint64, keepdims=True) * np.uint64(
                pow(_BASE, lo - int(starts[first - 1]), 1 << 64))
        if len(inside):
            total[first:last] = np.add.reduceat(values, inside) * _DOWN[inside]
    return mix(total)
