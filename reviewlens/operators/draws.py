"""The random numbers that MLlib's forests draw, in numpy."""

from __future__ import annotations

import math
import sys

import numpy as np
from pyspark import cloudpickle

# Executors need not have this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_MASK48 = np.uint64((1 << 48) - 1)
_HASH_SEED = 0x3C074A61
# Words of the generator's state, and the places of the three it mixes in.
_WORDS, _M1, _M2, _M3 = 624, 70, 179, 449


class JavaRandom:
    """Longs of java.util.Random, many at a time."""

    def __init__(self, seed: int):
        self.state = np.uint64((seed ^ 0x5DEECE66D) & ((1 << 48) - 1))

    def longs(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The next ``n`` longs as unsigned numbers, and the state after each; moves on to the last."""
        steps, shifts = np.array([0x5DEECE66D], "uint64"), np.array([0xB], "uint64")
        while len(steps) < 2 * n:
            shifts = np.concatenate([shifts, steps * shifts[-1] + shifts])
            steps = np.concatenate([steps, steps * steps[-1]])
        states = (steps[: 2 * n] * self.state + shifts[: 2 * n]) & _MASK48
        words = (states >> np.uint64(16)).astype("uint32")
        low = words[1::2].view("int32").astype("int64").view("uint64")
        if n:
            self.state = states[-1]
        return (words[0::2].astype("uint64") << np.uint64(32)) + low, states[1::2]


def _hash(high: np.ndarray, low: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """Murmur hash of eight bytes, given as two words."""
    h = seed
    for k in (high, low):
        k = k * np.uint32(0xCC9E2D51)
        k = (k << np.uint32(15)) | (k >> np.uint32(17))
        h = h ^ (k * np.uint32(0x1B873593))
        h = (h << np.uint32(13)) | (h >> np.uint32(19))
        h = h * np.uint32(5) + np.uint32(0xE6546B64)
    h = h ^ np.uint32(8)
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return h ^ (h >> np.uint32(16))


def hashed_seeds(seeds: np.ndarray) -> np.ndarray:
    """States at which Spark's XORShiftRandom starts for these seeds (unsigned)."""
    high = (seeds >> np.uint64(32)).astype("uint32").byteswap()
    low = (seeds & np.uint64(0xFFFFFFFF)).astype("uint32").byteswap()
    first = _hash(high, low, np.full(len(seeds), _HASH_SEED, "uint32"))
    second = _hash(high, low, first)
    return (second.astype("uint64") << np.uint64(32)) | first.astype("uint64")


class XorShift:
    """Spark's XORShiftRandom, one number at a time."""

    def __init__(self, seed: int):
        self.state = int(hashed_seeds(np.array([seed & (2**64 - 1)], "uint64"))[0])

    def bits(self, n: int) -> int:
        s = self.state
        s ^= (s << 21) & 0xFFFFFFFFFFFFFFFF
        s ^= s >> 35
        s ^= (s << 4) & 0xFFFFFFFFFFFFFFFF
        self.state = s
        return s & ((1 << n) - 1)

    def double(self) -> float:
        return ((self.bits(26) << 27) + self.bits(27)) * 2.0**-53

    def integer(self) -> int:
        """A signed number of 32 bits."""
        found = self.bits(32)
        return found - (1 << 32) if found >= 1 << 31 else found


def subsets(seeds: np.ndarray, width: int, size: int) -> np.ndarray:
    """For each seed ``size`` of the numbers below ``width``, as Spark's reservoir keeps them."""
    found = np.tile(np.arange(size, dtype="int32"), (len(seeds), 1))
    s = hashed_seeds(seeds)
    t, high, spread = np.empty_like(s), np.empty_like(s), np.empty(len(s))

    def step() -> None:
        for way, by in ((np.left_shift, 21), (np.right_shift, 35), (np.left_shift, 4)):
            way(s, np.uint64(by), out=t)
            np.bitwise_xor(s, t, out=s)

    for item in range(size, width):
        step()
        np.bitwise_and(s, np.uint64((1 << 26) - 1), out=high)
        np.left_shift(high, np.uint64(27), out=high)
        step()
        np.bitwise_and(s, np.uint64((1 << 27) - 1), out=t)
        np.add(high, t, out=high)
        np.multiply(high, 2.0**-53, out=spread)
        np.multiply(spread, float(item + 1), out=spread)
        hit = np.flatnonzero(spread < size)
        found[hit, spread[hit].astype("int64")] = item
    return found


class Poissons:
    """Numbers of mean 1 as commons-math's PoissonDistribution samples them after a reseed."""

    def __init__(self, seed: int):
        words = [(seed >> 32) & 0xFFFFFFFF, seed & 0xFFFFFFFF]
        for i in range(2, _WORDS):
            last = words[i - 2]
            if last >= 1 << 31:
                last -= 1 << 32
            words.append((1812433253 * (last ^ (last >> 30)) + i) & 0xFFFFFFFF)
        self.words, self.place = words, 0
        self.found = bytearray()

    def between(self, begin: int, end: int) -> np.ndarray:
        """The numbers from place ``begin`` up to ``end``."""
        if end > len(self.found):
            self._more(end - len(self.found))
        return np.frombuffer(self.found[begin:end], "uint8")

    def _more(self, n: int) -> None:
        # Negative places count from the end, so the ring needs no modulo.
        v, i, limit, found = self.words, self.place, math.exp(-1.0), self.found
        m1, m2, m3 = _M1 - _WORDS, _M2 - _WORDS, _M3 - _WORDS
        end, product, k, high, half = len(found) + n, 1.0, 0, 0, False
        while len(found) < end:
            a, b, c = v[i], v[i + m1], v[i + m3]
            z1 = a ^ (a << 25 & 0xFFFFFFFF) ^ b ^ (b >> 27)
            z2 = (v[i + m2] >> 9) ^ c ^ (c >> 1)
            v[i] = z3 = z1 ^ z2
            # The sum of z1, z2 and z3 is 0.
            z = (v[i - 1] & 0x80000000) ^ (v[i - 2] & 0x7FFFFFFF)
            v[i - 1] = z = (z ^ (z1 << 9) ^ (z2 << 21) ^ (z3 >> 21)) & 0xFFFFFFFF
            v[i - 2] &= 0x80000000
            i = i - 1 if i else _WORDS - 1
            z ^= z << 7 & 0xE46E1700
            z ^= z << 15 & 0x9B868000
            half = not half
            if half:
                high = z >> 6
                continue
            product *= (high << 26 | z >> 6) * 2.0**-52
            if product < limit:
                found.append(k)
                product, k = 1.0, 0
            else:
                k += 1
        self.place = i


class Sampler:
    """Which rows of a partition Spark's Bernoulli sampler takes."""

    def __init__(self, seed: int, fraction: float):
        self.fraction, self.random, self.gap = fraction, XorShift(seed), None

    def _advance(self) -> None:
        u = max(self.random.double(), 5e-11)
        self.gap = int(math.log(u) / math.log1p(-self.fraction))

    def take(self) -> bool:
        if self.fraction >= 1.0:
            return True
        if self.fraction > 0.4:
            return self.random.double() <= self.fraction
        if self.gap is None:
            self._advance()
        if self.gap > 0:
            self.gap -= 1
            return False
        self._advance()
        return True
