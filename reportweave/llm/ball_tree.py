"""Ball tree over whole-number vectors, for exact search by inner product."""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np

LEAF_POINTS = 64
_EXACT = 2.0**53
_LIMIT = 2**63 - 1


@dataclass
class Node:
    center: np.ndarray
    radius: float
    points: np.ndarray | None = None  # rows of the tree's points, in a leaf
    children: list[Node] = field(default_factory=list)


class BallTree:
    """Distinct points of one shard, each with the smallest ids that have it.

    ``per_point`` ids are kept of a point: more can never be among that many best, since equal
    vectors score alike and ties go to smaller ids.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, per_point: int) -> None:
        if vectors.shape[1] == 0:
            vectors = np.zeros((len(vectors), 1), np.int64)
        order = np.argsort(ids, kind="stable")
        self.points, where = np.unique(vectors[order], axis=0, return_inverse=True)
        by_point = np.argsort(where.ravel(), kind="stable")
        bounds = np.searchsorted(where.ravel()[by_point], np.arange(len(self.points) + 1))
        sorted_ids = ids[order][by_point]
        self.ids = [sorted_ids[a : min(b, a + per_point)] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        self.values = self.points.astype(np.float64)
        self.largest = float(np.abs(self.values).max(initial=0.0))
        self.root = self._build(np.arange(len(self.points)))

    def _build(self, rows: np.ndarray) -> Node:
        points = self.values[rows]
        center = points.mean(axis=0)
        away = np.sqrt(((points - center) ** 2).sum(axis=1))
        node = Node(center, float(away.max(initial=0.0)))
        if len(rows) <= LEAF_POINTS:
            node.points = rows
            return node
        one = points[away.argmax()]
        two = points[((points - one) ** 2).sum(axis=1).argmax()]
        order = np.argsort(points @ (two - one), kind="stable")
        half = len(rows) // 2
        node.children = [self._build(rows[order[:half]]), self._build(rows[order[half:]])]
        return node

    def _scores(self, queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Exact inner products; whole numbers that a float may not hold go another way."""
        largest = float(np.abs(queries.astype(np.float64)).max(initial=0.0))
        if largest * self.largest * self.points.shape[1] < _EXACT:
            return (queries.astype(np.float64) @ self.values[rows].T).astype(np.int64)
        exact = queries.astype(object) @ self.points[rows].astype(object).T
        return np.clip(exact, -_LIMIT, _LIMIT).astype(np.int64)

    def search(
        self, own: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray
    ) -> list[list[tuple[int, int]]]:
        """Per query the up to ``k`` best ``(score, id)`` that reach its ``floor``.

        Nodes are visited by their upper bound, the largest over the block of queries that still
        need them; a query leaves a node when the bound is below its current kth score. Equal
        bounds are visited, as a tie may have a smaller id. The row of the query's own id takes
        no part.
        """
        if queries.shape[1] == 0:
            queries = np.zeros((len(queries), 1), np.int64)
        values = queries.astype(np.float64)
        lengths = np.sqrt((values**2).sum(axis=1))
        kth = floor.astype(np.float64)
        best: list[list[tuple[int, int]]] = [[] for _ in own]

        def bound(node: Node, rows: np.ndarray) -> np.ndarray:
            at, reach = values[rows] @ node.center, lengths[rows] * node.radius
            slack = 1e-9 * (lengths[rows] * (np.sqrt((node.center**2).sum()) + node.radius)) + 0.5
            return at + reach + slack

        everyone = np.arange(len(own))
        first = bound(self.root, everyone)
        heap = [(-float(first.max(initial=-np.inf)), 0, self.root, everyone, first)]
        count = 1
        while heap:
            _, _, node, rows, bounds = heapq.heappop(heap)
            rows = rows[bounds >= kth[rows]]
            if not len(rows):
                continue
            if node.points is None:
                for child in node.children:
                    bounds = bound(child, rows)
                    open_rows = bounds >= kth[rows]
                    if open_rows.any():
                        bounds = bounds[open_rows]
                        heapq.heappush(heap, (-float(bounds.max()), count, child, rows[open_rows], bounds))
                        count += 1
                continue
            scores = self._scores(queries[rows], node.points)
            hits = scores >= kth[rows][:, None]
            for at in np.flatnonzero(hits.any(axis=1)):
                q = rows[at]
                found = best[q]
                for p in np.flatnonzero(hits[at]):
                    score = int(scores[at, p])
                    found += [(score, int(i)) for i in self.ids[node.points[p]] if i != own[q]]
                found.sort(key=lambda pair: (-pair[0], pair[1]))
                del found[k:]
                if len(found) == k:
                    kth[q] = max(kth[q], found[-1][0])
        return best
