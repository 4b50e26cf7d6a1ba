"""Minimal perfect hashing of 128-bit digests in numpy: a rank over layered bit tables."""

from __future__ import annotations

import numpy as np

# Cells of a layer per key that is left; more cells, fewer layers.
CELLS_PER_KEY = 2


def _cell(keys: np.ndarray, layer: int, size: int) -> np.ndarray:
    """The cell of each key in a layer; both halves of the digest and the layer count."""
    salt = np.uint64((layer + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    h = (keys[:, 0] ^ salt) * np.uint64(0xBF58476D1CE4E5B9) + keys[:, 1]
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return ((h ^ (h >> np.uint64(32))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Slots 0 to n - 1 for n distinct digests, rows of two 64-bit numbers.

    A key that has a cell of its own in a layer is settled there; the others go on to the
    next layer. The slot is the number of settled cells before the key's. Digests are kept
    at their slots, so a digest that is not among the keys is found out by comparison.
    """

    def __init__(self, keys: np.ndarray):
        self.layers: list[tuple[int, np.ndarray]] = []
        left, before = keys, 0
        while len(left):
            size = CELLS_PER_KEY * len(left)
            cells = _cell(left, len(self.layers), size)
            alone = np.bincount(cells, minlength=size) == 1
            if not alone.any() and len(self.layers) > 64:
                raise ValueError("keys of a perfect hash must be distinct")
            # Slot of each settled cell, -1 elsewhere.
            slots = np.where(alone, before + np.cumsum(alone) - 1, -1)
            self.layers.append((size, slots))
            left, before = left[~alone[cells]], before + int(alone.sum())
        self.keys = np.empty_like(keys)
        self.keys[self._slots(keys)] = keys

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        for layer, (size, slots) in enumerate(self.layers):
            open_ = np.flatnonzero(out < 0)
            if not len(open_):
                break
            out[open_] = slots[_cell(keys[open_], layer, size)]
        return out

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each digest, or -1 where it is not among the keys."""
        slots = self._slots(keys)
        there = slots >= 0
        there[there] = (self.keys[slots[there]] == keys[there]).all(1)
        return np.where(there, slots, -1)
