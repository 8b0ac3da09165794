"""An R-tree over count vectors, for joins on the Jaccard similarity of sets.

A set's count vector holds how many of its members hash into each group. The
overlap of two sets is at most the sum over the groups of the smaller count, and
a box of vectors is bounded by its upper corner, so a search visits a node only
if the sum of minima with that corner, and the sizes below it, still allow the
asked similarity. A search also skips nodes whose members all carry the query's
own label: they need no further link.

Vectors have one group for about four members (a power of two, at least
``GROUPS``), or bounds on long sets would be loose; taken modulo a smaller power
of two, groups fold, so any two vectors compare.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

GROUPS = 64
FANOUT = 16
_CELLS = 1 << 20


def count_vector(hashes: np.ndarray) -> np.ndarray:
    """Counts of a set's 64-bit hashes by their low bits."""
    groups = GROUPS
    while groups * 4 < len(hashes):
        groups *= 2
    return np.bincount((hashes & np.uint64(groups - 1)).astype(np.int64), minlength=groups).astype(np.int32)


def folded(vector: np.ndarray, groups: int) -> np.ndarray:
    return vector.reshape(-1, groups).sum(axis=0)


def least_overlap(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """The smallest overlap with 100 * overlap >= percent * union."""
    return -(-percent * (n + m) // (100 + percent))


class CountRTree:
    """Bulk-loaded: points are ordered by size class and leading coordinates,
    and every ``FANOUT`` neighbours share a node."""

    def __init__(self, vectors: list[np.ndarray], sizes: np.ndarray, labels: np.ndarray):
        coarse = np.array([folded(v, GROUPS) for v in vectors], np.int32).reshape(-1, GROUPS)
        band = np.floor(np.log2(np.maximum(sizes, 1)) * 4)
        self.order = np.lexsort((sizes, coarse[:, 2], coarse[:, 1], coarse[:, 0], band)) if len(sizes) else np.zeros(0, np.int64)
        self.vectors = vectors
        high, low_n, high_n = coarse[self.order], sizes[self.order], sizes[self.order]
        low_l, high_l = labels[self.order], labels[self.order]
        self.levels = [(high, low_n, high_n, low_l, high_l)]
        while len(high) > FANOUT:
            at = np.arange(0, len(high), FANOUT)
            high, low_n, high_n = np.maximum.reduceat(high, at), np.minimum.reduceat(low_n, at), np.maximum.reduceat(high_n, at)
            low_l, high_l = np.minimum.reduceat(low_l, at), np.maximum.reduceat(high_l, at)
            self.levels.append((high, low_n, high_n, low_l, high_l))

    def search(self, vectors: list[np.ndarray], sizes: np.ndarray, labels: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, point) of different labels that the bound allows."""
        if not len(self.order) or not len(sizes):
            return
        coarse = np.array([folded(v, GROUPS) for v in vectors], np.int32).reshape(-1, GROUPS)
        top = len(self.levels[-1][1])
        step = max(1, _CELLS // (GROUPS * FANOUT * max(top, 1)))
        for i in range(0, len(sizes), step):
            query = np.repeat(np.arange(i, min(i + step, len(sizes))), top)
            node = np.tile(np.arange(top), min(i + step, len(sizes)) - i)
            yield from self._descend(len(self.levels) - 1, query, node, coarse, vectors, sizes, labels, percent)

    def _descend(self, level, query, node, coarse, vectors, sizes, labels, percent):
        high, low_n, high_n, low_l, high_l = self.levels[level]
        n = sizes[query]
        fits = (100 * high_n[node] >= percent * n) & (percent * low_n[node] <= 100 * n)
        fits &= (low_l[node] != high_l[node]) | (low_l[node] != labels[query])
        query, node = query[fits], node[fits]
        size = max(1, _CELLS // GROUPS)
        for a in range(0, len(query), size):
            q, k = query[a : a + size], node[a : a + size]
            bound = np.minimum(coarse[q], high[k]).sum(axis=1)
            smallest = np.maximum(low_n[k], -(-percent * sizes[q] // 100))
            good = bound >= least_overlap(sizes[q], smallest, percent)
            q, k = q[good], k[good]
            if not len(q):
                continue
            if level:
                width = len(self.levels[level - 1][1])
                child = (k[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                inside = child < width
                yield from self._descend(
                    level - 1, np.repeat(q, FANOUT)[inside], child[inside], coarse, vectors, sizes, labels, percent
                )
                continue
            point = self.order[k]
            fine = np.array([self._bound(vectors[x], self.vectors[y]) for x, y in zip(q, point)])
            good = fine >= least_overlap(sizes[q], low_n[k], percent)
            if good.any():
                yield q[good], point[good]

    @staticmethod
    def _bound(a: np.ndarray, b: np.ndarray) -> int:
        groups = min(len(a), len(b))
        return int(np.minimum(folded(a, groups), folded(b, groups)).sum())
