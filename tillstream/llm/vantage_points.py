"""A vantage-point tree over the vectors of one shard, for the largest inner products.

Vectors get one more coordinate that makes them all as long as the longest of the corpus; a query's
is zero. Its squared distance to a vector is then a constant less twice their inner product, so the
nearest vectors in this metric are those of largest inner product, and the triangle inequality holds.

A node knows, for either child, the least and the greatest distance of its vectors from the
vantage point. With the query's own distance they bound the distance to any vector of the child. A
child is left out if ``factor`` times the bound exceeds the distance of the k-th vector found: factor 1
leaves out only what cannot be among the nearest, a larger one more.
"""

from __future__ import annotations

import io

import numpy as np

LEAF = 128
_ROWS = 128
_NO_ID = np.iinfo(np.int64).max


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner product per row, summed from the first component to the last."""
    return np.cumsum(a * b, axis=1)[:, -1]


class VantageTree:
    """``nodes`` has vantage, first, last, left, right, and ``bounds`` least and greatest distances."""

    def __init__(
        self, ids: np.ndarray, vectors: np.ndarray, nodes: np.ndarray, bounds: np.ndarray, longest: float
    ) -> None:
        self.ids, self.vectors, self.nodes, self.bounds = ids, vectors, nodes, bounds
        self.longest = longest

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray, longest: float) -> VantageTree:
        """Split at the median distance from a vantage point, down to ``LEAF`` vectors."""
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        extra = np.sqrt(np.maximum(longest**2 - (vectors**2).sum(1), 0))
        full = np.hstack([vectors, extra[:, None]])
        place = np.arange(len(ids))
        nodes: list[list[int]] = []
        bounds: list[list[float]] = []
        todo = [(0, len(ids), -1, 0)]
        while todo:
            first, last, parent, side = todo.pop()
            number = len(nodes)
            if parent >= 0:
                nodes[parent][3 + side] = number
            members = place[first:last]
            # The vector furthest from the middle splits its surroundings best.
            middle = full[members].mean(0)
            vantage = members[((full[members] - middle) ** 2).sum(1).argmax()]
            nodes.append([int(vantage), first, last, -1, -1])
            bounds.append([0.0, 0.0, 0.0, 0.0])
            if last - first <= LEAF:
                continue
            distance = np.sqrt(((full[members] - full[vantage]) ** 2).sum(1))
            ranked = np.argsort(distance, kind="stable")
            place[first:last] = members[ranked]
            distance = distance[ranked]
            half = (last - first) // 2
            bounds[number] = [distance[0], distance[half - 1], distance[half], distance[-1]]
            todo += [(first, first + half, number, 0), (first + half, last, number, 1)]
        # Nodes name vectors by their place in the new order.
        where = np.argsort(place)
        table = np.array(nodes, np.int64)
        table[:, 0] = where[table[:, 0]]
        return cls(ids[place], vectors[place], table, np.array(bounds), longest)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, ids=self.ids, vectors=self.vectors, nodes=self.nodes, bounds=self.bounds,
                 longest=np.array(self.longest))
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> VantageTree:
        held = np.load(io.BytesIO(data))
        return cls(held["ids"], held["vectors"], held["nodes"], held["bounds"], float(held["longest"]))

    def search(
        self, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float = 1.0
    ) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the ``k`` nearest found per query, best first; no id where fewer."""
        if factor < 1:
            raise ValueError("factor must be at least 1")
        scores = np.full((len(queries), k), -np.inf)
        ids = np.full((len(queries), k), _NO_ID)
        lengths = (queries**2).sum(1) + self.longest**2
        slack = 1e-7 * (np.sqrt(lengths) + self.longest)

        def distance(rows: np.ndarray, product: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(lengths[rows] - 2 * product, 0))

        def look(rows: np.ndarray, first: int, last: int) -> None:
            for begin in range(0, len(rows), _ROWS):
                part = rows[begin : begin + _ROWS]
                product = queries[part] @ self.vectors[first:last].T
                # What may be better, if rounding is allowed for, is computed again in order.
                margin = 1e-12 * lengths[part, None]
                better = product >= scores[part, -1:] - margin
                better &= self.ids[None, first:last] != query_ids[part, None]
                r, c = np.nonzero(better)
                if not len(r):
                    continue
                exact = np.full(product.shape, -np.inf)
                for at in range(0, len(r), 1 << 14):
                    p, q = r[at : at + (1 << 14)], c[at : at + (1 << 14)]
                    exact[p, q] = inner(queries[part[p]], self.vectors[first + q])
                hit = better.any(1)
                chosen = part[hit]
                own = np.where(better[hit], self.ids[None, first:last], _NO_ID)
                all_scores = np.hstack([scores[chosen], exact[hit]])
                all_ids = np.hstack([ids[chosen], own])
                best = np.lexsort((all_ids, -all_scores), axis=-1)[:, :k]
                scores[chosen] = np.take_along_axis(all_scores, best, 1)
                ids[chosen] = np.take_along_axis(all_ids, best, 1)

        def visit(number: int, rows: np.ndarray) -> None:
            vantage, first, last, left, right = self.nodes[number]
            if left < 0:
                look(rows, first, last)
                return
            away = distance(rows, queries[rows] @ self.vectors[vantage])
            inside_least, inside_most, outside_least, outside_most = self.bounds[number]
            # The child that is nearer goes first, so that the other one can be left out more often.
            bound = {
                left: np.maximum(np.maximum(away - inside_most, inside_least - away), 0),
                right: np.maximum(np.maximum(away - outside_most, outside_least - away), 0),
            }
            inner_first = bound[left] <= bound[right]
            for near in (True, False):
                for child, here in ((left, inner_first == near), (right, inner_first != near)):
                    reach = distance(rows, scores[rows, -1]) + slack[rows]
                    open_rows = rows[here & (factor * bound[child] <= reach)]
                    if len(open_rows):
                        visit(child, open_rows)

        if len(self.ids) and len(queries):
            with np.errstate(invalid="ignore"):
                visit(0, np.arange(len(queries)))
        return scores, ids
