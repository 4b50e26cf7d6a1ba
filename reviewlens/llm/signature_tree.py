"""Signature trees over shingle sets, and their dual traversal."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BITS = 2048
WORDS = BITS // 64
LEAF = 8


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """One bit per shingle, by its top bits."""
    bits = np.zeros(BITS, bool)
    bits[(shingles >> np.uint64(53)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").view(np.uint64)


class Tree:
    """Sets in a fixed order, with a node for each range of a binary division.

    A node holds the bits that any of its sets has, the smallest and largest size, and
    how many shingles of one set share bits at most.
    """

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.maps = np.array([bitmap(s) for s in sets], np.uint64).reshape(len(sets), WORDS)
        self.slack = self.sizes - np.bitwise_count(self.maps).sum(1, dtype=np.int64)
        self.nodes: dict[tuple[int, int], tuple] = {}
        if sets:
            self._build(0, len(sets))

    def _build(self, start: int, end: int) -> tuple:
        if end - start <= LEAF:
            part = slice(start, end)
            node = (
                np.bitwise_or.reduce(self.maps[part]), int(self.sizes[part].min()),
                int(self.sizes[part].max()), int(self.slack[part].max()),
            )
        else:
            middle = (start + end) // 2
            left, right = self._build(start, middle), self._build(middle, end)
            node = (
                left[0] | right[0], min(left[1], right[1]),
                max(left[2], right[2]), max(left[3], right[3]),
            )
        self.nodes[start, end] = node
        return node


def may_overlap(one: tuple, two: tuple, percent: int) -> bool:
    """Whether two nodes can hold sets whose Jaccard similarity reaches ``percent``.

    Shared shingles set shared bits, and no set has more shingles on some bits than
    their number and its slack.
    """
    bits1, low1, high1, slack1 = one
    bits2, low2, high2, slack2 = two
    if 100 * high1 < percent * low2 or 100 * high2 < percent * low1:
        return False
    most = min(int(np.bitwise_count(bits1 & bits2).sum()) + min(slack1, slack2), high1, high2)
    return (100 + percent) * most >= percent * (low1 + low2)


def linked(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    """100 * |intersection| >= percent * |union| of two sorted distinct arrays."""
    if len(one) > len(two):
        one, two = two, one
    at = np.searchsorted(two, one)
    at[at == len(two)] = 0
    shared = int((two[at] == one).sum()) if len(two) else 0
    return 100 * shared >= percent * (len(one) + len(two) - shared)


def join_trees(
    one: Tree, two: Tree | None, percent: int, labels: np.ndarray | None = None
) -> Iterator[tuple[int, int]]:
    """Pairs (i, j) that link all sets of ``one`` and ``two``, or of ``one`` alone.

    Every similar pair ends up connected: a pair of nodes is left out if its sets cannot
    reach the similarity, or if all of them are connected already. ``labels`` are those of
    the sets of both trees, equal where sets are connected before; they are updated.
    """
    self_join = two is None
    two = one if self_join else two
    shift = 0 if self_join else len(one.sets)
    if labels is None:
        labels = np.arange(shift + len(two.sets))

    def connected(a: tuple[int, int], b: tuple[int, int]) -> bool:
        first = labels[a[0]]
        return bool(
            (labels[a[0] : a[1]] == first).all()
            and (labels[shift + b[0] : shift + b[1]] == first).all()
        )

    stack = [((0, len(one.sets)), (0, len(two.sets)))] if one.sets and two.sets else []
    while stack:
        a, b = stack.pop()
        # A set is always connected with itself; a range of one has no pair inside.
        if connected(a, b) or not may_overlap(one.nodes[a], two.nodes[b], percent):
            continue
        small_a, small_b = a[1] - a[0] <= LEAF, b[1] - b[0] <= LEAF
        if small_a and small_b:
            yield from _leaf_pairs(one, two, a, b, shift, labels, percent, self_join)
            continue
        halves_a, halves_b = ([r] if s else _halves(r) for r, s in ((a, small_a), (b, small_b)))
        for x in halves_a:
            for y in halves_b:
                # Of two ranges of the same tree one order is enough.
                if not self_join or x <= y:
                    stack.append((x, y))


def _halves(r: tuple[int, int]) -> list[tuple[int, int]]:
    middle = (r[0] + r[1]) // 2
    return [(r[0], middle), (middle, r[1])]


def _leaf_pairs(one, two, a, b, shift, labels, percent, self_join):
    bits = np.bitwise_count(one.maps[a[0] : a[1], None] & two.maps[None, b[0] : b[1]]).sum(2, dtype=np.int64)
    slack = np.minimum(one.slack[a[0] : a[1], None], two.slack[None, b[0] : b[1]])
    sizes = one.sizes[a[0] : a[1], None] + two.sizes[None, b[0] : b[1]]
    for x, y in np.argwhere((100 + percent) * (bits + slack) >= percent * sizes).tolist():
        i, j = a[0] + x, b[0] + y
        if self_join and i >= j:
            continue
        if labels[i] != labels[shift + j] and linked(one.sets[i], two.sets[j], percent):
            labels[labels == labels[shift + j]] = labels[i]
            yield i, j
