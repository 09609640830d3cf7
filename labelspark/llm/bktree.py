"""BK-trees over 64-bit fingerprints, many at a time, as numpy arrays.

A node's children are keyed by their Hamming distance to it, a whole number from 0 to 64, and there is at most
one child per distance; all later points at that distance go below that child. A search within radius r that is at
distance d of a node follows only the edges from d - r to d + r (triangle inequality), so no match is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Visits of (query, node) that a search may hold at a time.
VISITS = 2_000_000


class Forest:
    """One tree per group; `groups` must be in order."""

    def __init__(self, groups: np.ndarray, points: np.ndarray) -> None:
        self.points = points
        self.names, roots, self.sizes = np.unique(groups, return_index=True, return_counts=True)
        self.roots = roots
        starts = np.repeat(roots, self.sizes)
        below, parent = np.arange(len(points)), starts.astype(np.int64)
        edges, children = [], []
        below, parent = below[below != starts], parent[below != starts]
        while len(below):
            # Every point still below `parent` hangs on the edge of its distance; the first one becomes the child.
            edge = parent * 65 + np.bitwise_count(points[below] ^ points[parent])
            order = np.argsort(edge, kind="stable")
            below, edge = below[order], edge[order]
            first = np.r_[True, edge[1:] != edge[:-1]]
            edges.append(edge[first])
            children.append(below[first])
            parent = below[first][np.cumsum(first) - 1]
            below, parent = below[~first], parent[~first]
        edge = np.concatenate(edges) if edges else np.zeros(0, np.int64)
        order = np.argsort(edge)
        self.edges = edge[order]
        self.children = (np.concatenate(children) if children else np.zeros(0, np.int64))[order]

    def within(self, groups: np.ndarray, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions of (query, point) at most `radius` apart, of queries against the tree of their own group."""
        if not len(self.names):
            return
        tree = np.minimum(np.searchsorted(self.names, groups), len(self.names) - 1)
        known = np.flatnonzero(self.names[tree] == groups)
        load = np.cumsum(self.sizes[tree[known]])
        cuts = np.searchsorted(load, np.arange(VISITS, load[-1] + VISITS, VISITS)) if len(load) else []
        for part in np.split(known, cuts):
            query, node = part, self.roots[tree[part]]
            while len(query):
                apart = np.bitwise_count(queries[query] ^ self.points[node]).astype(np.int64)
                hit = apart <= radius
                if hit.any():
                    yield query[hit], node[hit]
                low = np.searchsorted(self.edges, node * 65 + np.maximum(apart - radius, 0), "left")
                high = np.searchsorted(self.edges, node * 65 + np.minimum(apart + radius, 64), "right")
                count = high - low
                query = np.repeat(query, count)
                offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                node = self.children[np.repeat(low, count) + offset]


class Labels:
    """Smallest member of the set that each of n items is in; sets are united by links."""

    def __init__(self, n: int) -> None:
        self.of = np.arange(n)

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        of = self.of
        while True:
            x, y = of[a], of[b]
            differ = x != y
            if not differ.any():
                return
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            least = np.minimum(x, y)
            np.minimum.at(of, x, least)
            np.minimum.at(of, y, least)
            while not np.array_equal(of, jumped := of[of]):
                of[:] = jumped
