"""Nearest neighbours by cosine: a block matrix join over int8 tiles.

Unit vectors are quantised to int8 with a scale per row; what is lost of a row is known exactly, so a
tile's int8 product gives each cosine up to a bound. A pair survives if its upper end reaches the
k-th lower end of its query (or the floor that the first round of ``grid`` found); survivors are
recomputed in double precision from the original vectors and merged by a heap per query. As bounds
hold always, nothing is missed: the search is exact.

For NULLs, zero vectors, odd components, repeated rows and short tables see ``grid``.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from tidings.llm.common import table
from tidings.llm.grid import grid_search

TILE_ROWS, LEVELS = 1024, 127
SLACK = 1e-6  # rounding of the bounds themselves


def scaled_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows times a power of two (exact; squares stay in range), and their norms."""
    _, exponent = np.frexp(np.abs(rows).max(axis=1))
    rows = np.ldexp(rows, -exponent[:, None])
    return rows, np.sqrt(np.einsum("ij,ij->i", rows, rows))


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales, and the length of what each row lost."""
    scale = np.abs(unit).max(axis=1) / LEVELS
    levels = np.rint(unit / scale[:, None]).astype(np.int8)
    lost = np.sqrt(((unit - levels * scale[:, None]) ** 2).sum(axis=1))
    return levels, scale, lost


def cosines(left: np.ndarray, left_norms: np.ndarray, right: np.ndarray, right_norms: np.ndarray) -> np.ndarray:
    """Row by row, so equal pairs of vectors have equal values."""
    return np.clip(np.einsum("ij,ij->i", left, right) / (left_norms * right_norms), -1.0, 1.0)


def search_tile(queries, query_ids, floors, candidates, ids, k):
    queries, query_norms = scaled_rows(queries)
    candidates, norms = scaled_rows(candidates)
    q8, q_scale, q_lost = quantised(queries / query_norms[:, None])
    c8, c_scale, c_lost = quantised(candidates / norms[:, None])
    # float32 holds the int8 products exactly up to about a thousand dimensions
    exact = np.float32 if LEVELS * LEVELS * q8.shape[1] < 2**24 else np.float64
    q8 = q8.astype(exact)
    heaps: list[list] = [[] for _ in query_ids]
    for start in range(0, len(ids), TILE_ROWS):
        part = slice(start, start + TILE_ROWS)
        near = (q8 @ c8[part].astype(exact).T) * (q_scale[:, None] * c_scale[part])
        error = (1 + q_lost[:, None]) * c_lost[part] + q_lost[:, None] + SLACK
        near[query_ids[:, None] == ids[part]] = -np.inf
        least = np.array([h[0][0] if len(h) == k else f for h, f in zip(heaps, floors)])
        if near.shape[1] > k:
            lower = near - error
            least = np.maximum(least, np.partition(lower, -k, axis=1)[:, -k])
        rows, columns = np.nonzero((near + error >= least[:, None]) & np.isfinite(near))
        scores = cosines(queries[rows], query_norms[rows], candidates[part][columns], norms[part][columns])
        for i, j, score in zip(rows.tolist(), columns.tolist(), scores.tolist()):
            pair = (score, -int(ids[start + j]))
            if score < floors[i]:
                continue
            if len(heaps[i]) < k:
                heapq.heappush(heaps[i], pair)
            elif pair > heaps[i][0]:
                heapq.heapreplace(heaps[i], pair)
    found = ([], [], [])
    for i, heap in enumerate(heaps):
        for score, minus_id in heap:
            found[0].append(i)
            found[1].append(-minus_id)
            found[2].append(score)
    return found


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_search(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), 50, 5, search_tile, "double", nonzero=True)
