"""Connected components of an edge table, with joins that survive hubs.

Tasks first contract the edges they hold: every node they have met points at the least one it is joined with.
While that shrinks the table, fewer tasks contract again, until one task's bounded share is left; only an edge
table that does not shrink takes the rounds of joins, which cost a dozen jobs each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm.common import tidied
from tidings.session import cut_lineage

LOCAL_EDGES = 200_000  # that a task contracts at a time


class Forest(dict):
    """Union-find over a few rows; the root is the least of them."""

    def root(self, x: int) -> int:
        while (up := self.get(x, x)) != x:
            self[x] = x = self.get(up, up)
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self[max(x, y)] = min(x, y)
        return x != y


def _contracted(edges: DataFrame, tasks: int, most: int) -> DataFrame:
    """Edges (u > v) of the same components: a star for each component of what a task holds at a time."""

    def stars(forest: Forest) -> pa.RecordBatch:
        ends = [(node, forest.root(node)) for node in list(forest)]
        pairs = np.array([e for e in ends if e[0] != e[1]], np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for batch in batches:
            if len(forest) > 2 * most:
                yield stars(forest)
                forest = Forest()
            for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
                forest.join(u, v)
        yield stars(forest)

    return cut_lineage(edges.coalesce(tasks).mapInArrow(tidied(run), "u long, v long"))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _star(edges: DataFrame, larger_only: bool) -> DataFrame:
    """One step: every node hands its smallest neighbour to its larger (or its smaller) neighbours.

    Both sides of the join are stored, so a hub with a third of all edges is a skewed partition of
    a plain join, which Spark splits; the minima combine before they are shuffled.
    """
    if larger_only:
        both = cut_lineage(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))))
    else:
        both = edges
    least = cut_lineage(both.groupBy("u").agg(F.min("v").alias("m")))
    joined = both.join(least, "u").select("u", "v", F.least("u", "m").alias("m"))
    if larger_only:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return cut_lineage(moved.where("u > v").distinct())


def components(edges: DataFrame, most: int = LOCAL_EDGES) -> DataFrame:
    """(node, label): the smallest node of its component, for every node of an edge (u, v)."""
    edges = cut_lineage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v"))
    count, shrinks = edges.count(), True
    while count > most and shrinks:
        edges = _contracted(edges, -(-count // most), most)
        before, count = count, edges.count()
        shrinks = 2 * count <= before
    if count <= most:
        edges = _contracted(edges, 1, most)
    else:
        edges = _joined(edges)
    # Each node now points at its smallest node; those point nowhere.
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def _joined(edges: DataFrame) -> DataFrame:
    """Stars of the components by rounds of joins, whatever the size of the table."""
    edges, before = cut_lineage(edges.distinct()), None
    while (now := _state(edges)) != before:
        before = now
        edges = _star(_star(edges, True), False)
    return edges
