"""Search of a query set against all vectors, in blocks: queries x candidates as a grid of tiles.

Candidates fall into shards and queries into blocks by the hash of their id, so a tile has a bounded
number of rows on both sides, whatever the table. Both sides are copied along the other's axis, which
is the cost of any exact search, and meet in a co-grouped join by tile. A first round searches one
shard per query only; the k-th score that it finds is handed to all tiles of the second round, which
then return only rows that can still be among the best.

Rows that take part: vec_id not NULL, and a vector that is not NULL or empty, with no NULL, NaN or
infinite component (and not zero, for cosines). A vector meets only vectors of its own length. Of rows
that share the id of a query, the smallest vector is the query, and none of them is a candidate for
it; other repeated rows are candidates each. Fewer than k candidates: all of them.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidings.session import cut_lineage

SHARD_ROWS, BLOCK_ROWS = 8192, 1024
Tile = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, int], tuple[list, list, list]]


def usable(vectors: DataFrame, nonzero: bool) -> DataFrame:
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = vectors.select("vec_id", "embedding").where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & ~odd)
    return kept.where(F.exists("embedding", lambda x: x != 0)) if nonzero else kept


def _matrix(table: pa.Table) -> np.ndarray:
    flat = table.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, np.float64).reshape(table.num_rows, -1)


def grid_search(vectors: DataFrame, query_modulus: int, k: int, tile: Tile, score_type: str, nonzero: bool = False,
                shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best of each query, ties to the smaller vec_id.

    ``tile(queries, query_ids, floors, candidates, candidate_ids, k)`` returns the positions of
    queries, ids and scores of what a tile contributes; nothing below a query's floor is needed.
    """
    rows = usable(vectors, nonzero)
    asked = rows.where(F.col("vec_id") % query_modulus == 0).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    shards = max(1, -(-rows.count() // shard_rows))
    blocks = max(1, -(-asked.count() // block_rows))
    kind = pa.int64() if score_type == "long" else pa.float64()

    def search(key, left: pa.Table, right: pa.Table) -> pa.Table:
        found: tuple[list, list, list] = ([], [], [])
        ids = np.zeros(0, np.int64)
        if left.num_rows and right.num_rows:
            ids = left.column("vec_id").to_numpy()
            floors = left.column("floor").to_numpy().astype(object if score_type == "long" else np.float64)
            found = tile(_matrix(left), ids, floors, _matrix(right), right.column("own_id").to_numpy(), k)
        return pa.table({
            "query_id": pa.array(ids[np.asarray(found[0], np.int64)], pa.int64()),
            "vec_id": pa.array(found[1], pa.int64()), "score": pa.array(found[2], kind)})

    keys = ["dim", "shard", "block"]
    schema = f"query_id long, vec_id long, score {score_type}"
    dim = F.size("embedding").alias("dim")
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    block = F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(blocks)).cast("int")
    candidates = rows.select(F.col("vec_id").alias("own_id"), F.col("embedding").alias("embedding"), dim, shard.alias("shard"))
    lowest = F.lit(-(2**63)) if score_type == "long" else F.lit(float("-inf"))

    # Round 1: the home shard of each query gives a floor for its k-th score.
    home = asked.select("vec_id", "embedding", dim, shard.alias("shard"), F.lit(0).alias("block"), lowest.alias("floor"))
    at_home = candidates.withColumn("block", F.lit(0))
    first = home.groupBy(*keys).cogroup(at_home.groupBy(*keys)).applyInArrow(search, schema)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    floors = cut_lineage(first.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k).select("query_id", F.col("score").alias("known")))

    # Round 2: all tiles.
    every = asked.join(floors, asked["vec_id"] == floors["query_id"], "left").select(
        F.col("vec_id").alias("vec_id"), F.col("embedding").alias("embedding"), dim, F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), block.alias("block"),
        F.coalesce("known", lowest).alias("floor"))
    copied = candidates.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = every.groupBy(*keys).cogroup(copied.groupBy(*keys)).applyInArrow(search, schema)
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
