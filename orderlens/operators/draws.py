"""Spark's random numbers, for runs that must draw what MLlib draws.

``XORShiftRandom`` is linear over bits, so numbers from any position on follow from jumps by powers of two (a table per
byte of the state): a block of rows gets its own without those before it.  ``JavaRandom`` is ``java.util.Random``.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import cache

import numpy as np

_32, _64 = (1 << 32) - 1, (1 << 64) - 1
_LOCAL_STEPS = 30                  # iterations of k-means++ over the drawn points
_DELTA, _LEAST_SHARE, _GAPS, _LEAST = 1e-4, 1e-10, 0.4, 5e-11      # of RDD.takeSample


def _signed(x: int, bits: int) -> int:
    return x - (1 << bits) if x >> (bits - 1) & 1 else x


def _murmur(data: bytes, seed: int) -> int:
    """Scala's ``MurmurHash3.bytesHash`` of whole words."""
    h = seed
    for i in range(0, len(data), 4):
        k = int.from_bytes(data[i:i + 4], "little") * 0xCC9E2D51 & _32
        k = (k << 15 | k >> 17) & _32
        h ^= k * 0x1B873593 & _32
        h = (h << 13 | h >> 19) & _32
        h = (h * 5 + 0xE6546B64) & _32
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & _32
    h = (h ^ h >> 13) * 0xC2B2AE35 & _32
    return h ^ h >> 16


def _state(seed: int) -> int:
    data = (seed & _64).to_bytes(8, "big")
    low = _murmur(data, 0x3C074A61)
    return _murmur(data, low) << 32 | low


def _next(x):
    """The state after this one, of a number or an array."""
    one = np.uint64 if isinstance(x, np.ndarray) else int
    x = x ^ (x << one(21) if one is np.uint64 else x << 21 & _64)
    x = x ^ x >> one(35)
    return x ^ (x << one(4) if one is np.uint64 else x << 4 & _64)


@cache
def _jump(power: int) -> np.ndarray:
    """``[byte, value]``: what 2 ** ``power`` steps make of each byte of a state."""
    bits = np.arange(256, dtype=np.uint64)[None, :] << (8 * np.arange(8, dtype=np.uint64))[:, None]
    return _next(bits) if not power else _jumped(power - 1, _jumped(power - 1, bits))


def _jumped(power: int, x: np.ndarray) -> np.ndarray:
    table, out = _jump(power), np.zeros_like(x)
    for byte in range(8):
        out ^= table[byte][(x >> np.uint64(8 * byte)) & np.uint64(255)]
    return out


def uniform(seed: int, first: int, n: int) -> np.ndarray:
    """``nextDouble`` of ``XORShiftRandom(seed)`` number ``first`` and the ``n - 1`` after it."""
    x = np.array([_state(seed)], np.uint64)
    skip = 2 * first + 1
    for power in range(skip.bit_length()):
        if skip >> power & 1:
            x = _jumped(power, x)
    power = 3                                         # every eighth state by jumps, those between by steps
    while len(x) << 3 < 2 * n:
        x = np.concatenate([x, _jumped(power, x)])
        power += 1
    lanes = [x]
    for _ in range(7):
        lanes.append(_next(lanes[-1]))
    x = np.stack(lanes, axis=1).ravel()
    high, low = x[:2 * n:2] & np.uint64((1 << 26) - 1), x[1:2 * n:2] & np.uint64((1 << 27) - 1)
    return ((high << np.uint64(27)) + low) * 2.0 ** -53


def seed_of(seed: int) -> int:
    """``nextInt`` of ``XORShiftRandom(seed)``."""
    return _signed(_next(_state(seed)) & _32, 32)


class JavaRandom:
    def __init__(self, seed: int):
        self.state = (seed ^ 0x5DEECE66D) & ((1 << 48) - 1)

    def bits(self, n: int) -> int:
        self.state = (self.state * 0x5DEECE66D + 0xB) & ((1 << 48) - 1)
        return _signed(self.state >> (48 - n), 32) if n == 32 else self.state >> (48 - n)

    def long(self) -> int:
        return _signed((self.bits(32) << 32) + self.bits(32) & _64, 64)

    def below(self, n: int) -> int:
        if n & (n - 1) == 0:
            return n * self.bits(31) >> 31
        while True:
            x = self.bits(31)
            if x - x % n + n - 1 < 1 << 31:
                return x % n

    def double(self) -> float:
        return ((self.bits(26) << 27) + self.bits(27)) * 2.0 ** -53


def sampled(seed: int, share: float, n: int) -> list[int]:
    """Positions that ``RDD.sample`` keeps of a partition of ``n`` rows."""
    if share >= 1:
        return list(range(n))
    if share > _GAPS:
        return np.flatnonzero(uniform(seed, 0, n) <= share).tolist()
    out, at, drawn = [], -1, 0
    while True:
        at += 1 + int(math.log(max(float(uniform(seed, drawn, 1)[0]), _LEAST)) / math.log1p(-share))
        if at >= n:
            return out
        out.append(at)
        drawn += 1


def one_of(sizes: list[int], seed: int) -> tuple[int, int]:
    """Partition and position of the row that ``takeSample(false, 1, seed)`` takes of partitions of these sizes."""
    total, rand = sum(sizes), JavaRandom(seed)
    gamma = -math.log(_DELTA) / total
    share = min(1.0, max(_LEAST_SHARE, 1 / total + gamma + math.sqrt(gamma * gamma + 2 * gamma / total)))
    found: list[tuple[int, int]] = []
    while not found:
        parts = JavaRandom(rand.bits(32))
        found = [(part, at) for part, n in enumerate(sizes) for at in sampled(parts.long(), share, n)]
    for i in range(len(found) - 1, 0, -1):
        j = rand.below(i + 1)
        found[i], found[j] = found[j], found[i]
    return found[0]


def local_centres(points: np.ndarray, weights: np.ndarray, k: int, nearest: Callable) -> np.ndarray:
    """``LocalKMeans.kMeansPlusPlus``: ``k`` centres of weighted points."""
    rand = JavaRandom(0)

    def pick(mass: np.ndarray) -> int:
        """The point where the running sum of ``mass`` reaches a random share of it."""
        sums = np.cumsum(mass)                        # one after the other, as there
        r = rand.double() * sums[-1]
        return min(int(np.searchsorted(sums, r)), len(sums) - 1) if r > 0 else 0

    centres = points[pick(weights)][None, :]
    while len(centres) < k:
        centres = np.concatenate([centres, points[pick(weights * nearest(points, centres)[1])][None, :]])
    before = np.full(len(points), -1)
    for _ in range(_LOCAL_STEPS):
        at, _ = nearest(points, centres)
        n = np.bincount(at, weights, k)
        sums = np.stack([np.bincount(at, weights * x, k) for x in points.T], axis=1)
        centres = np.array([s * (1.0 / w) if w else points[rand.below(len(points))] for s, w in zip(sums, n)])
        if (at == before).all():
            break
        before = at
    return centres
