"""Blocked Bloom filters over hashes of words, one shard for each word length.

A block is one 64-bit word, so a probe touches memory once. Filters of all lengths stand
behind one another in one array; a filter covers one slice of the vocabulary, so that its
size has a bound whatever the size of the vocabulary.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BITS_PER_KEY = 16
BITS_SET = 5
BLOCK_BITS = 64
#: Lengths from here on share one shard.
LAST_SHARD = 40
# Odd, hence with an inverse modulo 2^64.
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread polynomial hashes over all 64 bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Spelled:
    """Words laid end to end: code points, their places, and one polynomial hash a word.

    The hash of a word is the sum of its code points times BASE to the power of their
    place, so the hash of any single edit follows from it without spelling the edit out.
    """

    def __init__(self, words: list[str]):
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.owner = np.repeat(np.arange(len(words)), self.lengths)
        self.place = np.arange(len(self.codes)) - self.starts[self.owner]
        longest = int(self.lengths.max(initial=0))
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(longest, BASE, np.uint64)]))
        self.power = powers[self.place]
        # Sums wrap modulo 2^64, as they should.
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(self.codes * self.power)])
        self.hashes = self.sums[self.starts + self.lengths] - self.sums[self.starts]

    def deleted(self, at: np.ndarray) -> np.ndarray:
        """Hashes of the words without the code point at each of the places ``at``."""
        word = self.owner[at]
        start = self.starts[word]
        before = self.sums[at] - self.sums[start]
        after = self.sums[start + self.lengths[word]] - self.sums[at + 1]
        return before + after * BASE_INVERSE

    def replaced(self, at: np.ndarray, code: int) -> np.ndarray:
        """Hashes of the words with ``code`` at each of the places ``at``."""
        return self.hashes[self.owner[at]] + (np.uint64(code) - self.codes[at]) * self.power[at]


def shards(lengths: np.ndarray) -> np.ndarray:
    return np.minimum(lengths, LAST_SHARD)


@dataclass(frozen=True)
class Layout:
    """Blocks of each length's filter, for one of ``slices`` parts of the vocabulary."""

    starts: np.ndarray
    blocks: np.ndarray
    slices: int

    @classmethod
    def of(cls, words_by_shard: dict[int, int], slices: int) -> Layout:
        """``words_by_shard``: number of words of each shard, over all slices."""
        blocks = np.zeros(LAST_SHARD + 1, np.uint64)
        for shard, n in words_by_shard.items():
            blocks[shard] = n * BITS_PER_KEY // (BLOCK_BITS * slices) + 16
        return cls((np.cumsum(blocks) - blocks).astype(np.uint64), blocks, slices)

    @property
    def size(self) -> int:
        return int(self.blocks.sum())

    def places(self, hashes: np.ndarray, shard: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(slice, block, bits) of keys."""
        h = mixed(hashes)
        bits = np.zeros(len(h), np.uint64)
        for i in range(BITS_SET):
            bits |= np.uint64(1) << ((h >> np.uint64(6 * i)) & np.uint64(63))
        block = self.starts[shard] + (((h >> np.uint64(32)) * self.blocks[shard]) >> np.uint64(32))
        part = mixed(h) % np.uint64(self.slices)
        return part.astype(np.int64), block.astype(np.int64), bits


def found(layout: Layout, filter_: np.ndarray, part: int, hashes: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Which keys may be words of slice ``part``; words always are.

    A shard without words has no block; keys that fall there are no words.
    """
    there = layout.blocks[shard] > 0
    if layout.slices > 1:
        there &= mixed(mixed(hashes)) % np.uint64(layout.slices) == np.uint64(part)
    out = np.flatnonzero(there)
    _, block, bits = layout.places(hashes[out], shard[out])
    return out[filter_[block] & bits == bits]
