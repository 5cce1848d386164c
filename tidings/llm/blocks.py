"""Similarity joins on sets: candidates that share keys, proof on full sets, and keys that hold several components.

Shared by the joins that show keys of documents' sets. A stored table has a row for each document (row,
hash: xxhash64 of its text, n: size of its set, f1 and f2: the set's fingerprint); ``reps`` has one row for
each different set, with a sketch. No key or family gives all its pairs: rows are paired with the first
row of a key and the row before; keys left open that share most of their rows are put together; their rows are
connected by spanning forests into blocks, whose full sets are compared in tiles of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.llm.common import tidied
from tidings.llm.components import Forest, components
from tidings.session import cut_lineage

BROADCAST_ROWS = 1_000_000  # text hashes that a broadcast may hold
SET_BATCH = 128  # rows with whole sets that a task holds at a time
TILE_ELEMENTS = 1 << 20  # elements of sets that are compared at a time
Linked = Callable[[np.ndarray, np.ndarray], bool]
Near = Callable[[np.ndarray, list[bytes]], Callable[[int, np.ndarray], np.ndarray]]  # sizes and sketches of a tile; row, later rows: which may be linked
SetOf = Callable[[str | None], np.ndarray]


@contextmanager
def small_batches(spark: SparkSession, rows: int):
    """Rows that hold whole sets go to Python a few at a time."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def first_of_sets(stored: DataFrame, classes: DataFrame) -> DataFrame:
    """The stored rows with a sketch that stand for their class (``rep``). Tasks store one row of equal
    sets each, so few rows go: they are broadcast while they are few (counted before), and joined beyond."""
    firsts = stored.where("sketch IS NOT NULL")
    others = cut_lineage(firsts.select("row").join(classes.select(F.col("rep").alias("row")), "row", "left_anti"))
    few = others.count() <= BROADCAST_ROWS
    return firsts.join(F.broadcast(others) if few else others.hint("merge"), "row", "left_anti")


# --- candidates ------------------------------------------------------------------------------

def neighbours(shown: DataFrame, folder: str) -> DataFrame:
    """Of rows (key, row), store (key, first, before, row) for the rows of each key after its first in a task.

    Rows are range-partitioned by key and row, so a frequent key fills several tasks.

    A task's first and last key may go on in other tasks: their first rows are told as well (first = row).
    """

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "first", "before", "row"]
        alone = lambda key, row: pa.RecordBatch.from_arrays([pa.array([int(x)], pa.int64()) for x in (key, row, row, row)], names=names)
        opened = now = first = last = None  # the task's first key; the running key, its first row, the row before
        for batch in batches:
            key, row = batch.column("key").to_numpy(), batch.column("row").to_numpy()
            if not len(key):
                continue
            if now is None:
                opened, now, first, last = key[0], key[0], row[0], row[0]
                yield alone(now, first)
                key, row = key[1:], row[1:]
                if not len(key):
                    continue
            starts = np.r_[key[0] != now, key[1:] != key[:-1]]
            firsts, befores = np.r_[first, row[starts]][np.cumsum(starts)], np.r_[last, row[:-1]]
            yield pa.RecordBatch.from_arrays([pa.array(x[~starts]) for x in (key, firsts, befores, row)], names=names)
            now, first, last = key[-1], firsts[-1], row[-1]
        if now != opened:
            yield alone(now, first)

    tasks = int(shown.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = shown.repartitionByRange(tasks, "key", "row").sortWithinPartitions("key", "row")
    laid.mapInArrow(tidied(pair), "key long, first long, before long, row long").write.option("compression", "zstd").parquet(folder)
    return shown.sparkSession.read.parquet(folder)


def spanning(near: DataFrame) -> DataFrame:
    """(key, first, least): the first rows of a key that fills several tasks, and the least of them."""
    firsts = near.where("first = row").select("key", "first")
    least = firsts.groupBy("key").agg(F.min("first").alias("least"), F.count(F.lit(1)).alias("tasks"))
    return firsts.join(least.where("tasks > 1"), "key").select("key", "first", "least")


def leader_pairs(near: DataFrame) -> DataFrame:
    one = near.select(F.col("first").alias("a"), F.col("row").alias("b"))
    two = near.where("before <> first").select(F.col("before").alias("a"), F.col("row").alias("b"))
    three = spanning(near).select(F.col("least").alias("a"), F.col("first").alias("b"))
    return one.unionByName(two).unionByName(three).where("a < b").distinct()


# --- proof -----------------------------------------------------------------------------------

def full_sets(rows: DataFrame, stored: DataFrame, texts: DataFrame, set_of: Callable[[], SetOf], name_of: Callable) -> DataFrame:
    """(row, elements) of the rows: their sets, made again from the texts.

    Only the texts of these rows leave the scan: their hashes are broadcast while they are few
    (counted before), and meet the texts in a shuffled join beyond. A set is known by its size and
    fingerprint, so of many copies of a text each task sends one and one is kept.
    """
    wanted = cut_lineage(stored.join(rows, "row", "left_semi").select("row", "hash", "n", "f1", "f2"))
    hashes = wanted.select("hash").distinct()
    few = wanted.count() <= BROADCAST_ROWS
    texts = texts.join(F.broadcast(hashes) if few else hashes.hint("merge"), "hash", "left_semi")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_set, seen = set_of(), set()
        for batch in batches:  # a few texts
            new, sets = [], []
            for value in batch.column("text"):
                found = make_set(value.as_py())
                name = (len(found), *name_of(found))
                if name not in seen:
                    seen.add(name)
                    new.append(name)
                    sets.append(found.tobytes())
            columns = [pa.array([name[k] for name in new], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sets, pa.binary())], names=["n", "f1", "f2", "elements"])

    sets = texts.select("text").mapInArrow(tidied(make), "n long, f1 long, f2 long, elements binary")
    sets = sets.groupBy("n", "f1", "f2").agg(F.first("elements").alias("elements"))
    return wanted.select("row", "n", "f1", "f2").join(sets, ["n", "f1", "f2"]).select("row", "elements")


def confirmed(pairs: DataFrame, sets_of: Callable[[DataFrame], DataFrame], linked: Linked) -> DataFrame:
    """The linked ones among the pairs (a, b) of rows, by their full sets."""
    spark = pairs.sparkSession
    rows = pairs.select(F.col("a").alias("row")).unionByName(pairs.select(F.col("b").alias("row"))).distinct()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [
                linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64))
                for x, y in zip(batch.column("a_set"), batch.column("b_set"))]
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    with small_batches(spark, SET_BATCH):
        sets = cut_lineage(sets_of(rows))
        side = lambda p: sets.select(F.col("row").alias(p), F.col("elements").alias(f"{p}_set"))
        joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "a_set", "b_set")
        return cut_lineage(joined.mapInArrow(tidied(compare), "a long, b long"))


# --- keys that hold several components -------------------------------------------------------

def _tiled(members: DataFrame, group: str, tiles: DataFrame) -> DataFrame:
    """Rows of groups split into tiles: a row goes to every pair (i, j) of tiles that its own, ``mine``, is in."""
    mine = F.pmod(F.xxhash64("row", group), F.col("tiles")).cast("int").alias("mine")
    spread = cut_lineage(members.join(tiles, group).select(group, "row", "tiles", mine))
    spread = spread.select(group, "row", "mine", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("with"))
    return spread.select(group, F.least("mine", "with").alias("i"), F.greatest("mine", "with").alias("j"), "mine", "row")


def _by_tile(batches: Iterator[pa.RecordBatch], group: str, columns: list[str]) -> Iterator[tuple[bool, list[tuple]]]:
    """Of rows sorted by tile pair: whether it is a pair of two tiles, and the rows of it."""
    now, held = None, []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in (group, "i", "j", *columns))):
            if row[:3] != now:
                if held:
                    yield now[1] != now[2], held
                now, held = row[:3], []
            held.append(row[3:])
    if held:
        yield now[1] != now[2], held


def _pairs_within(mine, label, two: bool, may_link: Callable[[int, np.ndarray], np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """For each row of a tile pair the later rows of other components that it may be linked with."""
    for x in range(len(label) - 1):
        others = np.arange(x + 1, len(label))
        others = others[label[others] != label[x]]
        if two:
            others = others[mine[others] != mine[x]]
        if len(others):
            others = others[may_link(x, others)]
            if len(others):
                yield x, others


def _pair_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([min(p) for p in pairs], pa.int64()), pa.array([max(p) for p in pairs], pa.int64())], names=["a", "b"])


def _laid(rows: DataFrame, group: str) -> DataFrame:
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, group, "i", "j").sortWithinPartitions(group, "i", "j")


def _gathered(members: DataFrame, sizes: DataFrame, tile_rows: int) -> tuple[DataFrame, DataFrame]:
    """Members (key, row) and tiles (key, tiles) with the keys that share rows put together, where that moves no
    more rows and compares no more pairs.

    Each of many near copies shows dozens of keys, and each key holds other copies: compared key by key, a row
    moves for each of them and a pair meets in each. Put together, a row moves once for a tile of the block.
    ``sizes`` has (key, g, s3): a key's rows and the least of them.
    """
    tiles = lambda g: F.ceil(F.col(g) / tile_rows)
    members = cut_lineage(members.join(sizes.select("key", F.col("s3").alias("hub")), "key"))
    named = cut_lineage(components(members.where("row <> hub").select(F.col("hub").alias("u"), F.col("row").alias("v"))))
    apart = sizes.join(named.withColumnRenamed("node", "s3"), "s3").groupBy("label").agg(
        F.sum(F.col("g") * tiles("g")).alias("moved"), F.sum(F.col("g").cast("double") * F.col("g")).alias("pairs"))
    together = named.groupBy("label").agg(F.count(F.lit(1)).alias("rows")).join(apart, "label")
    cheaper = (F.col("rows") * tiles("rows") <= F.col("moved")) & (F.col("rows").cast("double") * F.col("rows") <= F.col("pairs"))
    chosen = cut_lineage(together.where(cheaper).select("label", F.xxhash64(F.lit("block"), "label").alias("block"), tiles("rows").cast("int").alias("tiles")))
    alone = cut_lineage(sizes.join(named.join(chosen, "label", "left_anti").withColumnRenamed("node", "s3"), "s3", "left_semi").select("key", tiles("g").cast("int").alias("tiles")))
    gathered = named.join(chosen, "label").select(F.col("block").alias("key"), F.col("node").alias("row"))
    kept = members.select("key", "row").join(alone, "key", "left_semi")
    return gathered.unionByName(kept), chosen.select(F.col("block").alias("key"), "tiles").unionByName(alone)


def forests(near: DataFrame, reps: DataFrame, tested: DataFrame, labels: DataFrame, may: Near, tile_rows: int) -> DataFrame:
    """Edges (a, b) that connect all pairs of a key that may be linked and are in different components."""
    label = lambda p: F.coalesce(F.col(f"{p}_label"), F.col(p))
    named = lambda p: labels.select(F.col("node").alias(p), F.col("label").alias(f"{p}_label"))
    apart = tested.join(named("a"), "a", "left").join(named("b"), "b", "left").where(label("a") != label("b")).select("a", "b")
    # A key is open if its first row and another row, or the first rows of its tasks, are apart.
    crossing = spanning(near).select("key", F.col("least").alias("a"), F.col("first").alias("b")).where("a < b")
    starred = near.where("first < row").select("key", F.col("first").alias("a"), F.col("row").alias("b")).unionByName(crossing)
    keys = cut_lineage(starred.join(apart, ["a", "b"], "left_semi").select("key").distinct())
    members = near.select("key", "row").unionByName(near.select("key", F.col("first").alias("row"))).join(keys, "key", "left_semi").distinct()
    members = cut_lineage(members)
    # Keys with the same rows connect the same pairs: one of them is enough. Two rows are settled by their one pair.
    mark = F.xxhash64("row")
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("g"), F.bit_xor(mark).alias("s1"), F.bit_xor(F.xxhash64(mark)).alias("s2"), F.min("row").alias("s3"))
    sizes = cut_lineage(sizes.where("g > 2").groupBy("g", "s1", "s2", "s3").agg(F.min("key").alias("key")))
    members, tiles = _gathered(members, sizes, tile_rows)
    info = reps.join(labels, reps["row"] == labels["node"], "left").select("row", "n", F.coalesce("label", "row").alias("label"), "sketch")
    columns = ["mine", "row", "n", "label", "sketch"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set[tuple[int, int]] = set()  # edges that this task has told last
        for two, held in _by_tile(batches, "key", columns):
            mine, row, n, label = (np.array([m[k] for m in held], np.int64) for k in range(4))
            if len(np.unique(label)) < 2:
                continue
            forest, edges = Forest(), []
            for x, others in _pairs_within(mine, label, two, may(n, [m[4] for m in held])):
                edges += [(int(row[x]), y) for y in row[others].tolist() if forest.join(int(row[x]), y)]
            new = [e for e in edges if e not in told]
            told = told | set(new) if len(told) < 100_000 else set(new)
            if new:
                yield _pair_batch(new)

    laid = _laid(_tiled(members, "key", tiles).join(info, "row").select("key", "i", "j", *columns), "key")
    return laid.mapInArrow(run, "a long, b long").distinct()


def block_links(
    edges: DataFrame, reps: DataFrame, labels: DataFrame, sets_of: Callable[[DataFrame], DataFrame], may: Near, linked: Linked, tile_rows: int
) -> DataFrame:
    """Links (a, b) that join the components of the blocks that the edges connect: whole sets, compared tile by tile."""
    spark = edges.sparkSession
    blocks = cut_lineage(components(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))).select(F.col("node").alias("row"), F.col("label").alias("block")))
    sized = reps.select("row", "n").join(blocks, "row")
    count = F.greatest(F.ceil(F.count(F.lit(1)) / tile_rows), F.ceil(F.sum("n") / TILE_ELEMENTS)).cast("int")
    tiles = cut_lineage(sized.groupBy("block").agg(count.alias("tiles")))
    columns = ["mine", "row", "n", "label", "sketch", "elements"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for two, held in _by_tile(batches, "block", columns):
            mine, row, n, label = (np.array([m[k] for m in held], np.int64) for k in range(4))
            sets = [np.frombuffer(m[5], np.uint64) for m in held]
            forest, links = Forest(), []
            for x, others in _pairs_within(mine, label, two, may(n, [m[4] for m in held])):
                for y in others.tolist():
                    one, other = int(label[x]), int(label[y])
                    if forest.root(one) != forest.root(other) and linked(sets[x], sets[y]):
                        forest.join(one, other)
                        links.append((int(row[x]), int(row[y])))
            if links:
                yield _pair_batch(links)

    with small_batches(spark, SET_BATCH):
        info = reps.join(labels, reps["row"] == labels["node"], "left").select("row", "n", F.coalesce("label", "row").alias("label"), "sketch")
        sets = sets_of(blocks.select("row"))
        whole = cut_lineage(info.join(blocks.select("row"), "row", "left_semi").join(sets, "row"))
        laid = _laid(_tiled(blocks, "block", tiles).join(whole, "row").select("block", "i", "j", *columns), "block")
        return cut_lineage(laid.mapInArrow(run, "a long, b long"))


def joined_labels(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (node, label) after more links (a, b): only the components that these connect are joined."""
    named = lambda p, name: labels.select(F.col("node").alias(p), F.col("label").alias(name))
    ends = links.join(named("a", "u"), "a", "left").join(named("b", "v"), "b", "left").select(F.coalesce("u", "a").alias("u"), F.coalesce("v", "b").alias("v"))
    joined = cut_lineage(components(ends).withColumnRenamed("label", "top"))
    kept = labels.join(joined.select(F.col("node").alias("label"), "top"), "label", "left").select("node", F.coalesce("top", "label").alias("label"))
    single = joined.join(labels.select("node"), "node", "left_anti").select("node", F.col("top").alias("label"))
    return cut_lineage(kept.unionByName(single))


def all_labels(
    near: DataFrame, reps: DataFrame, tested: DataFrame, linked_pairs: DataFrame, sets_of: Callable[[DataFrame], DataFrame], may: Near, linked: Linked, tile_rows: int
) -> DataFrame:
    """(node, label) of the rows that are linked with others: the links found among the tested pairs, and all others."""
    labels = cut_lineage(components(linked_pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))))
    edges = cut_lineage(forests(near, reps, tested, labels, may, tile_rows))
    if edges.isEmpty():
        return labels
    return joined_labels(labels, block_links(edges, reps, labels, sets_of, may, linked, tile_rows))
