"""Exact top-k by integer inner product, with a KD-tree per shard.

A tree halves its rows at the median of the dimension in which they spread most, down to small
leaves, and keeps a tight bounding box for each node. A box bounds the inner product of a query with
everything in it: each component takes the better end of the box's side. The traversal opens the node
with the best bound first, and ends when no bound reaches the k-th score so far - which starts from
the floor that the first round of ``grid`` found in another shard.

Components become floor(1024 * x). Products are exact: in doubles while they stay below 2^52, in
Python integers beyond; a score outside the range of long is set to its nearest end before it is
ranked. For NULLs, odd vectors, repeated rows and short tables see ``grid``.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from tidings.llm.common import table
from tidings.llm.grid import grid_search

SCALE, LEAF_ROWS = 1024.0, 64
LONG = (-(2**63), 2**63 - 1)


def in_range(scores: np.ndarray) -> np.ndarray:
    """Scores as longs: doubles here are whole and small, Python integers are cut to the range."""
    return scores if scores.dtype != object else np.minimum(np.maximum(scores, LONG[0]), LONG[1])


class Tree:
    """Nodes in arrays: box (low, high), children or rows [start, end) of the reordered table."""

    def __init__(self, rows: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.order = np.arange(len(rows))
        self.low, self.high, self.children, self.spans = [], [], [], []
        self._grow(rows, 0, len(rows), leaf_rows)
        self.low, self.high = np.array(self.low), np.array(self.high)
        self.rows = rows[self.order]

    def _grow(self, rows: np.ndarray, start: int, end: int, leaf_rows: int) -> int:
        mine = rows[self.order[start:end]]
        low, high, node = mine.min(axis=0), mine.max(axis=0), len(self.low)
        self.low.append(low)
        self.high.append(high)
        self.spans.append((start, end))
        self.children.append(None)
        widest = int(np.argmax(high - low))
        if end - start > leaf_rows and high[widest] > low[widest]:
            middle = (end - start) // 2
            self.order[start:end] = self.order[start:end][np.argsort(mine[:, widest], kind="stable")]
            self.children[node] = (self._grow(rows, start, start + middle, leaf_rows), self._grow(rows, start + middle, end, leaf_rows))
        return node

    def best(self, query: np.ndarray, ids: np.ndarray, own: int, k: int, floor: int) -> list[tuple]:
        """At most k pairs (score, -id), and none below the floor; ``ids`` in the tree's order."""
        bounds = in_range(self.high @ np.maximum(query, 0) + self.low @ np.minimum(query, 0))
        heap, open_ = [], [(-bounds[0], 0)]
        while open_:
            bound, node = heapq.heappop(open_)
            least = heap[0][0] if len(heap) == k else floor
            if -bound < least:
                break
            if self.children[node]:
                for child in self.children[node]:
                    if bounds[child] >= least:
                        heapq.heappush(open_, (-bounds[child], child))
                continue
            start, end = self.spans[node]
            scores = in_range(self.rows[start:end] @ query)
            for i in np.flatnonzero(scores >= least):
                pair = (int(scores[i]), -int(ids[start + i]))
                if -pair[1] == own:
                    continue
                if len(heap) < k:
                    heapq.heappush(heap, pair)
                elif pair > heap[0]:
                    heapq.heapreplace(heap, pair)
        return heap


def to_integers(vectors: np.ndarray, exact_in_doubles: bool) -> np.ndarray:
    scaled = np.floor(vectors * SCALE)
    return scaled if exact_in_doubles else np.array([[int(x) for x in row] for row in scaled], object).reshape(scaled.shape)


def search_tile(queries, query_ids, floors, candidates, ids, k):
    largest = [float(np.abs(m).max()) * SCALE + 1 for m in (queries, candidates)]
    doubles = largest[0] * largest[1] * queries.shape[1] < 2**52
    queries, tree = to_integers(queries, doubles), Tree(to_integers(candidates, doubles))
    ids, found = ids[tree.order], ([], [], [])
    for i, query in enumerate(queries):
        for score, minus_id in tree.best(query, ids, int(query_ids[i]), k, int(floors[i])):
            found[0].append(i)
            found[1].append(-minus_id)
            found[2].append(score)
    return found


def op7_kdtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_search(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), 100, 10, search_tile, "long")
