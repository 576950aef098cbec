"""A packed R-tree over count vectors.

A set is a point: the numbers of its elements in ``groups`` hash groups. Two sets share at most the sum, over the groups,
of the smaller count. A node keeps the largest count of its points in each group and the range of their sizes, so the
same sum against a node bounds the overlap with every point below it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tidemark.llm.shingles import PERCENT, least_overlap

FANOUT = 16


def groups_for(largest: int) -> int:
    """Groups for sets of up to this size: enough that a group has a few elements."""
    return int(min(2048, max(32, 1 << (max(largest, 1) // 4).bit_length())))


def count_vector(elements: np.ndarray, groups: int) -> np.ndarray:
    """Counts by group, in the smallest type that holds any count of so many elements and is the same for sets of about a size."""
    return np.bincount((elements % np.uint64(groups)).astype(np.int64), minlength=groups).astype(np.uint32)


class CountTree:
    """Points by size, then in packs of ``FANOUT`` below nodes, level by level."""

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray):
        self.order = np.lexsort((vectors.argmax(axis=1), sizes))
        self.vectors, self.sizes = vectors[self.order], sizes[self.order]
        #: Per level, from the leaves: largest counts, smallest and largest size of each node.
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        tops, low, high = self.vectors, self.sizes, self.sizes
        while len(tops) > FANOUT:
            starts = np.arange(0, len(tops), FANOUT)
            tops = np.maximum.reduceat(tops, starts, axis=0)
            low, high = np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)
            self.levels.append((tops, low, high))

    def _possible(self, vector, size, tops, low, high) -> np.ndarray:
        """Which of these nodes may hold a point that links with the query."""
        fits = (low * PERCENT <= 100 * size) & (size * PERCENT <= 100 * high)
        # With the smallest partner the needed overlap is smallest; partners have at least 75 % of the size.
        partner = np.maximum(low, -(-PERCENT * size // 100))
        needed = -(-PERCENT * (partner + size) // (100 + PERCENT))
        at = np.flatnonzero(fits)
        bound = np.minimum(tops[at], vector).sum(axis=1, dtype=np.int64)
        return at[bound >= needed[at]]

    def search(self, vector: np.ndarray, size: int) -> np.ndarray:
        """Positions in the input of all points whose bound reaches the overlap that a link needs."""
        nodes = None
        for tops, low, high in reversed(self.levels):
            at = np.arange(len(tops)) if nodes is None else _children(nodes, len(tops))
            nodes = at[self._possible(vector, size, tops[at], low[at], high[at])]
            if len(nodes) == 0:
                return nodes
        at = np.arange(len(self.sizes)) if nodes is None else _children(nodes, len(self.sizes))
        found = at[self._possible(vector, size, self.vectors[at], self.sizes[at], self.sizes[at])]
        return self.order[found]


def _children(nodes: np.ndarray, below: int) -> np.ndarray:
    at = (nodes[:, None] * FANOUT + np.arange(FANOUT)).ravel()
    return at[at < below]


class Forest:
    """Union-find over the positions of a block."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.parent[a] = b
        return a != b


#: Sets that link lie in one band of sizes or in neighbouring ones, each so many times as wide as the one below; a little
#: more than a link allows, so that no rounding matters.
BAND = 1.01 * 100 / PERCENT


def banded_links(sets: list[np.ndarray], overlap, first: int, searching: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links that span the linked classes of ``sets``, of those that are ``searching`` with all.

    Every two neighbouring bands of sizes have a tree of their own, whose vectors are as long as its sets need. In each the
    sets are compared with set ``first``, or else the first of the searching ones, before all others.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    bands = np.floor(np.log(np.maximum(sizes, 1)) / np.log(BAND)).astype(np.int64)
    forest = Forest(len(sets))
    for band in np.unique(bands).tolist():
        at = np.flatnonzero((bands == band) | (bands == band + 1))
        # Searches from the upper band reach the lower one too; within itself it is searched with the next.
        queries = np.flatnonzero(searching[at])
        if len(at) < 2 or not len(queries):
            continue
        if not (bands[at] == band + 1).any() or searching.all():
            queries = queries[bands[at][queries] == band]
        yield from _spanning_links([sets[i] for i in at], sizes[at], overlap, first, forest, at, queries)


def _spanning_links(sets, sizes, overlap, first, forest, at, queries) -> Iterator[tuple[int, int]]:
    """Links among ``sets``, which are those at the positions ``at``, as positions.

    A pair already in one class is passed over, any other that the tree lets through is verified.
    """
    groups = groups_for(int(sizes.max()))
    vectors = np.stack([count_vector(s, groups) for s in sets])

    def linked(a: int, b: int) -> bool:
        return overlap(sets[a], sets[b]) >= least_overlap(int(sizes[a]), int(sizes[b]))

    tree = CountTree(vectors, sizes)
    leading = np.flatnonzero(at == first)
    order = [*leading.tolist(), *(q for q in queries.tolist() if at[q] != first)]
    for a in order:
        own = int(at[a])
        main = forest.root(own)
        for b in tree.search(vectors[a], int(sizes[a])).tolist():
            other = int(at[b])
            # A pair of two queries is met from either side.
            if other != own and forest.root(other) != main and linked(a, b):
                forest.join(own, other)
                main = forest.root(own)
                yield own, other
