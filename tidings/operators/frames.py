"""Cluster searches of many timeframes at once: the timeframe is part of the key of every fit.

A fit is known by (timeframe, sample, K). Its centres live in a table, a row for each timeframe and
sample; the points of a timeframe are laid out once, in parts of bounded size. One pass serves all
timeframes: parts meet their centres in a co-grouped join that moves only the centres, reference
samples are made again where their centres are, and the partial sums of both combine by (timeframe,
sample). Rows whose fits have all stopped leave the next pass, and timeframes with a chosen K leave the
next block, so a pass costs what still moves. A timeframe whose points fill one part at most takes no passes:
its fits, and those of each of its samples, begin and end in the task that holds the points. Nothing of a timeframe's size, and no list of
timeframes, reaches the driver.

Fits, starts, samples and the choice of K are those of ``gap.search`` on each timeframe by itself.

Defined cases: rows with a NULL timeframe form one more timeframe; a timeframe with fewer distinct
points than ``k_max`` is searched up to their number; one without a chosen K has no centres and no digest;
an empty table gives empty results.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from tidings.functions.vectors import max_vectors, min_vectors, sum_vectors
from tidings.operators import gap
from tidings.operators.kmeans import _nearest, _points, add_sums
from tidings.operators.noise import box_points
from tidings.session import bounded_batches, local_table
from tidings.session import cut_lineage as checkpointed

KEY = "timeframe"
PART_BYTES = 8 << 20  # of points in a part, and of sample points made at a time
STATE = f"{KEY} string, ref_id int, n bigint, low array<double>, high array<double>, last int, centres array<double>, running array<boolean>"
SUMS = f"{KEY} string, ref_id int, sums array<double>"


class FrameSearch(NamedTuple):
    """Gap table (timeframe, k, ...), chosen K (timeframe, k) and centres (timeframe, centres: one array of k vectors)."""

    table: DataFrame
    chosen: DataFrame
    centres: DataFrame


class Layout(NamedTuple):
    """Points by (timeframe, part), cached; the parts (_key, _part); a row for each timeframe; vector length."""

    points: DataFrame
    parts: DataFrame
    frames: DataFrame
    dims: int
    id_cols: tuple[str, ...]
    part_rows: int  # points of a part; a timeframe of more has several


def cut_lineage(df: DataFrame) -> DataFrame:
    """Stored rows under columns of their own, so that they can meet the frames that they came from in a join."""
    return checkpointed(df).toDF(*df.columns)


# --- layout ----------------------------------------------------------------------------------

def first_distinct(points: DataFrame, k: int, seed: int, id_cols: Sequence[str]) -> DataFrame:
    """(timeframe, starts): up to ``k`` distinct points of each timeframe, in the order of a seeded hash of the ids.

    A few times ``k`` rows usually hold ``k`` distinct points; where copies crowd them out, all copies are folded.
    """
    place = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in id_cols]))
    placed = points.select(KEY, "features", place.alias("place"))
    wanted = 4 * k
    few = placed.withColumn("_at", F.row_number().over(Window.partitionBy(KEY).orderBy("place"))).where(F.col("_at") <= wanted)

    def folded(rows: DataFrame) -> DataFrame:
        once = rows.groupBy(KEY, "features").agg(F.min("place").alias("place"))
        once = once.withColumn("_at", F.row_number().over(Window.partitionBy(KEY).orderBy("place"))).where(F.col("_at") <= k)
        listed = F.transform(F.sort_array(F.collect_list(F.struct("_at", "features"))), lambda s: s["features"])
        return once.groupBy(KEY).agg(listed.alias("starts"))

    few = cut_lineage(few.drop("_at"))
    found = cut_lineage(folded(few))
    full = few.groupBy(KEY).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") == wanted)
    crowded = found.join(full, found[KEY].eqNullSafe(full[KEY]), "left_semi").where(F.size("starts") < k).select(F.col(KEY).alias("_crowded"))
    if crowded.isEmpty():
        return found
    on = F.col(KEY).eqNullSafe(F.col("_crowded"))
    return found.join(crowded, on, "left_anti").unionByName(folded(placed.join(crowded, on, "left_semi")))


def lay_out(vectors: DataFrame, id_cols: Sequence[str], k_max: int, seed: int, part_bytes: int = PART_BYTES) -> Layout:
    """Cache the points by (timeframe, part) and describe every timeframe."""
    # A NULL key joins nothing: it becomes a label of its own, which is taken off again at the end.
    points = vectors.select(_shown(F.col(KEY)).alias(KEY), *id_cols, F.col("features").cast("array<double>").alias("features"))
    first = points.select(F.size("features").alias("dims")).first()
    dims = first.dims if first else 0
    column = F.col("features")
    boxes = points.groupBy(KEY).agg(F.count(F.lit(1)).alias("n"), min_vectors(column).alias("low"), max_vectors(column).alias("high"))
    starts = first_distinct(points, k_max, seed, id_cols)
    frames = cut_lineage(boxes.join(starts, KEY).select(
        KEY, "n", "low", "high", F.flatten("starts").alias("starts"), F.size("starts").alias("limit")))
    rows = max(1, part_bytes // (8 * max(1, dims)))
    many = frames.where(F.col("n") > rows).select(KEY, F.ceil(F.col("n") / rows).cast("int").alias("parts"))
    part = F.coalesce(F.pmod(F.xxhash64(*id_cols), F.col("parts")), F.lit(0)).cast("int")
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = points.join(many, KEY, "left").withColumn("part", part).drop("parts")
    laid = laid.repartition(tasks, KEY, "part").sortWithinPartitions(KEY, "part").persist(StorageLevel.MEMORY_AND_DISK)
    parts = cut_lineage(laid.select(F.col(KEY).alias("_key"), F.col("part").alias("_part")).distinct())
    return Layout(laid, parts, frames, dims, tuple(id_cols), rows)


_MISSING = "\0"  # stands for a NULL timeframe; "\1" escapes labels that begin with either


def _shown(key):
    text = key.cast("string")
    return F.when(text.isNull(), F.lit(_MISSING)).when(text.rlike("^[\\x00\\x01]"), F.concat(F.lit("\1"), text)).otherwise(text)


def _taken_off(key):
    return F.when(key != _MISSING, F.when(key.startswith("\1"), F.substr(key, F.lit(2))).otherwise(key))


# --- fits ------------------------------------------------------------------------------------

def _slots(first: int, last: int) -> np.ndarray:
    """The K of every slot of the fits ``first`` to ``last``."""
    ks = np.arange(first, last + 1)
    return np.repeat(ks, ks)


def _sums(points: np.ndarray, centres: np.ndarray, first: int, last: int, final: bool) -> np.ndarray:
    """Counts, costs (of the final centres) and totals of all slots, end to end."""
    counts, costs, totals = np.zeros(len(centres)), np.zeros(len(centres)), np.zeros_like(centres)
    add_sums(points, centres, range(first, last + 1), counts, None if final else totals, costs if final else None)
    return np.concatenate([counts, costs, totals.ravel()])


def _list(column: pa.Array, i: int) -> np.ndarray:
    return column[i].values.to_numpy(zero_copy_only=False)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays) if arrays else np.zeros(0)))


def _start(frames: DataFrame, first: int, block: int, n_refs: int, seed: int, dims: int) -> DataFrame:
    """The first centres of a block's fits: a row for each timeframe and sample."""
    names = T.StructType.fromDDL(STATE).names

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                n, limit = batch.column("n")[i].as_py(), batch.column("limit")[i].as_py()
                low, high = _list(batch.column("low"), i), _list(batch.column("high"), i)
                starts = _list(batch.column("starts"), i).reshape(-1, dims)
                last = min(first + block - 1, limit)
                of_slot = np.concatenate([np.arange(k) for k in range(first, last + 1)])
                centres = [starts[of_slot].ravel()]
                centres += [box_points(ref * n + of_slot, low, high, seed).ravel() for ref in range(n_refs)]
                rows = n_refs + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(batch.column(KEY)[i], rows), pa.array(range(rows), pa.int32()), pa.repeat(pa.scalar(n, pa.int64()), rows),
                     _lists([low] * rows), _lists([high] * rows), pa.repeat(pa.scalar(last, pa.int32()), rows), _lists(centres),
                     pa.array([[True] * (last - first + 1)] * rows, pa.list_(pa.bool_()))], names=names)

    return frames.where(F.col("limit") >= first).select(KEY, "n", "low", "high", "starts", "limit").mapInArrow(begin, STATE)


def _pass(layout: Layout, state: DataFrame, first: int, seed: int, final: bool = False) -> DataFrame:
    """(timeframe, ref_id, sums) of the rows of ``state``: one pass over their points and samples."""
    dims = layout.dims
    names = T.StructType.fromDDL(SUMS).names
    data = state.where("ref_id = 0").select(KEY, "last", "centres")
    # A timeframe's centres go to each of its parts; points meet them as they lie, by timeframe and part.
    parts = layout.parts.join(data.withColumnRenamed(KEY, "_key"), "_key").select("_key", "_part", "last", "centres")
    moving = _parts_of(layout, data).select(KEY, "part", "features")

    def on_data(points: pa.Table, centres: pa.Table) -> pa.Table:
        if not centres.num_rows or not points.num_rows:
            return pa.Table.from_pydict({n: [] for n in names}, schema=_arrow(SUMS))
        flat = _points(points.column("features").combine_chunks())
        last = centres.column("last")[0].as_py()
        found = _sums(flat, np.asarray(centres.column("centres")[0].values).reshape(-1, dims), first, last, final)
        return pa.Table.from_arrays([pa.array([points.column(KEY)[0].as_py()]), pa.array([0], pa.int32()), _lists([found])], names=names)

    rows = max(1, PART_BYTES // (8 * max(1, dims)))

    def on_noise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for i in range(batch.num_rows):
                ref, n, piece = (batch.column(c)[i].as_py() for c in ("ref_id", "n", "piece"))
                mine = (ref - 1) * n + np.arange(piece * rows, min(n, (piece + 1) * rows))
                points = box_points(mine, _list(batch.column("low"), i), _list(batch.column("high"), i), seed)
                found.append(_sums(points, _list(batch.column("centres"), i).reshape(-1, dims), first, batch.column("last")[i].as_py(), final))
            yield pa.RecordBatch.from_arrays([batch.column(KEY), batch.column("ref_id"), _lists(found)], names=names)

    pieces = F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / rows).cast("int") - 1)).alias("piece")
    noise = state.where("ref_id > 0").select(KEY, "ref_id", "n", "low", "high", "last", "centres", pieces)
    both = moving.groupBy(KEY, "part").cogroup(parts.groupBy("_key", "_part")).applyInArrow(on_data, SUMS)
    both = both.unionByName(noise.mapInArrow(on_noise, SUMS))
    return both.groupBy(KEY, "ref_id").agg(sum_vectors(F.col("sums")).alias("sums"))


def _parts_of(layout: Layout, frames: DataFrame) -> DataFrame:
    """The points of some timeframes. The join has both keys of the layout, so the cached points do not move for it."""
    parts = layout.parts.join(frames.select(F.col(KEY).alias("_key")), "_key", "left_semi")
    return layout.points.join(parts, (F.col(KEY) == F.col("_key")) & (F.col("part") == F.col("_part")), "left_semi")


def _arrow(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T.StructType.fromDDL(ddl))


def _moved(state: DataFrame, sums: DataFrame, first: int, dims: int, tolerance: float) -> DataFrame:
    """The state after a step; centres of stopped fits, and those without points, stay."""
    names = T.StructType.fromDDL(STATE).names

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            centres, running = [], []
            for i in range(batch.num_rows):
                ks = _slots(first, batch.column("last")[i].as_py())
                fit = ks - first
                old, found = _list(batch.column("centres"), i).reshape(-1, dims), _list(batch.column("sums"), i)
                counts, totals = found[:len(ks)], found[2 * len(ks):].reshape(-1, dims)
                runs = np.array(batch.column("running")[i].as_py())
                moves = runs[fit] & (counts > 0)
                new = np.where(moves[:, None], totals / np.maximum(counts, 1)[:, None], old)
                far = np.linalg.norm(new - old, axis=1) > tolerance
                centres.append(new.ravel())
                running.append((runs & (np.bincount(fit, weights=far, minlength=len(runs)) > 0)).tolist())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names[:-2]), _lists(centres), pa.array(running, pa.list_(pa.bool_()))], names=names)

    return state.join(sums, [KEY, "ref_id"]).select(*names, "sums").mapInArrow(step, STATE)


def _fitted(points: np.ndarray, starts: np.ndarray, first: int, last: int, max_iter: int, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """Centres, end to end, and dispersions of a block's fits whose points are all here: the steps of ``_moved``, then the costs.

    The fits go in step, so that one product meets the centres of all; one whose centres stay is left out of the next step.
    """
    ks = range(first, last + 1)
    centres, running = {k: starts[:k] for k in ks}, list(ks)
    for _ in range(max_iter):
        old = np.concatenate([centres[k] for k in running])
        counts, totals = np.zeros(len(old)), np.zeros(old.shape)
        add_sums(points, old, running, counts, totals)
        new = np.where(counts[:, None] > 0, totals / np.maximum(counts, 1)[:, None], old)
        far = np.linalg.norm(new - old, axis=1) > tolerance
        ends = np.cumsum(running)
        centres |= dict(zip(running, np.split(new, ends[:-1])))
        running = [k for k, moved in zip(running, np.split(far, ends[:-1])) if moved.any()]
        if not running:
            break
    every = np.concatenate([centres[k] for k in ks])
    counts, costs = np.zeros(len(every)), np.zeros(len(every))
    add_sums(points, every, ks, counts, costs=costs)
    return every, np.array([np.cumsum(w)[-1] for w in np.split(costs, np.cumsum(ks)[:-1])])


def _fit_small(layout: Layout, frames: DataFrame, first: int, block: int, n_refs: int, seed: int, max_iter: int, tolerance: float) -> tuple[DataFrame, DataFrame]:
    """``fit_block`` for timeframes of one part: a task fits their points, or one of their samples, from start to end."""
    dims, top = layout.dims, first + block - 1
    parts = layout.parts.join(frames.select(F.col(KEY).alias("_key"), "limit", "starts"), "_key").select("_key", "_part", "limit", "starts")
    fits = f"{KEY} string, first int, last int, centres array<double>, costs array<double>"
    costs = f"{KEY} string, ref_id int, costs array<double>"
    fits_arrow, costs_arrow = _arrow(fits), _arrow(costs)

    def on_data(points: pa.Table, begun: pa.Table) -> pa.Table:
        if not begun.num_rows or not points.num_rows:
            return fits_arrow.empty_table()
        flat = _points(points.column("features").combine_chunks())
        last = min(top, begun.column("limit")[0].as_py())
        starts = np.asarray(begun.column("starts")[0].values).reshape(-1, dims)
        centres, found = _fitted(flat, starts, first, last, max_iter, tolerance)
        key = pa.array([points.column(KEY)[0].as_py()], pa.string())
        ends = [pa.array([x], pa.int32()) for x in (first, last)]
        return pa.Table.from_arrays(
            [key, *ends, _lists([centres.ravel()]), _lists([found])], schema=fits_arrow)

    def on_noise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for i in range(batch.num_rows):
                ref, n, limit = (batch.column(c)[i].as_py() for c in ("ref_id", "n", "limit"))
                points = box_points((ref - 1) * n + np.arange(n), _list(batch.column("low"), i), _list(batch.column("high"), i), seed)
                found.append(_fitted(points, points, first, min(top, limit), max_iter, tolerance)[1])
            yield pa.RecordBatch.from_arrays([batch.column(KEY), batch.column("ref_id"), _lists(found)], schema=costs_arrow)

    points = _parts_of(layout, frames).select(KEY, "part", "features")
    data = cut_lineage(points.groupBy(KEY, "part").cogroup(parts.groupBy("_key", "_part")).applyInArrow(on_data, fits))
    tasks = int(frames.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    every = data.select(KEY, F.lit(0).alias("ref_id"), "costs")
    if n_refs:
        drawn = frames.select(KEY, "n", "limit", "low", "high", F.explode(F.sequence(F.lit(1), F.lit(n_refs))).alias("ref_id"))
        every = every.unionByName(drawn.repartition(tasks, KEY, "ref_id").mapInArrow(on_noise, costs))
    dispersions = every.select(KEY, F.posexplode("costs").alias("at", "w"), "ref_id").select(KEY, (F.col("at") + first).alias("k"), "ref_id", "w")
    return data.drop("costs"), cut_lineage(dispersions)


def fit_block(
    layout: Layout, frames: DataFrame, first: int, block: int, n_refs: int, seed: int, max_iter: int = 10, tolerance: float = 1e-4
) -> tuple[DataFrame, DataFrame]:
    """Fit K = ``first`` to ``first + block - 1`` on every timeframe of ``frames`` and its samples.

    Returns (timeframe, first, last, centres) of the data and (timeframe, k, ref_id, w).
    """
    found = []
    for frames_of, fit in ((frames.where(F.col("n") <= layout.part_rows), _fit_small), (frames.where(F.col("n") > layout.part_rows), _fit_in_step)):
        if not frames_of.isEmpty():
            found.append(fit(layout, frames_of, first, block, n_refs, seed, max_iter, tolerance))
    return tuple(reduce(DataFrame.unionByName, tables) for tables in zip(*found))


def _fit_in_step(layout: Layout, frames: DataFrame, first: int, block: int, n_refs: int, seed: int, max_iter: int, tolerance: float) -> tuple[DataFrame, DataFrame]:
    """``fit_block`` for timeframes of several parts: pass by pass, all fits in step."""
    spark, dims = frames.sparkSession, layout.dims
    slots = len(_slots(first, first + block - 1))
    with bounded_batches(spark, 8 * (2 * slots * (dims + 1) + 2 * dims)):
        state = cut_lineage(_start(frames, first, block, n_refs, seed, dims))
        finished = []
        for _ in range(max_iter):
            moved = cut_lineage(_moved(state, _pass(layout, state, first, seed), first, dims, tolerance))
            runs = F.exists("running", lambda x: x)
            finished.append(moved.where(~runs))
            state = moved.where(runs)
            if state.isEmpty():
                break
        final = reduce(DataFrame.unionByName, finished, state)
        sums = cut_lineage(_pass(layout, final, first, seed, final=True))
    # Costs follow the counts; those of one K follow each other.
    with_last = sums.join(final.select(KEY, "ref_id", "last"), [KEY, "ref_id"])
    all_slots = lambda last: (last * (last + 1) - F.lit(first * (first - 1))) / 2
    ks = with_last.select(KEY, "ref_id", "sums", all_slots(F.col("last")).cast("int").alias("slots"), F.explode(F.sequence(F.lit(first), F.col("last"))).alias("k"))
    before = ((F.col("k") * (F.col("k") - 1) - first * (first - 1)) / 2).cast("int")
    costs = F.slice("sums", F.col("slots") + before + 1, F.col("k"))
    dispersions = ks.select(KEY, "k", "ref_id", F.aggregate(costs, F.lit(0.0), lambda a, x: a + x).alias("w"))
    centres = final.where("ref_id = 0").select(KEY, F.lit(first).alias("first"), "last", "centres")
    return centres, cut_lineage(dispersions)


# --- search and digests ----------------------------------------------------------------------

def search(
    layout: Layout, n_refs: int = 50, k_max: int = 30, seed: int = 0, max_iter: int = 10, block: int = 4, rule: str = "first_drop"
) -> FrameSearch:
    """``gap.search`` for every timeframe of the layout, in as many passes as the longest of them takes."""
    spark, dims = layout.frames.sparkSession, layout.dims
    open_frames, chosen, centres, tables = layout.frames, [], [], []
    dispersions = local_table(spark, [], f"{KEY} string, k int, ref_id int, w double")
    empty = f"{KEY} string, k int"
    for first in range(1, k_max + 1, block):
        live = open_frames.where(F.col("limit") >= first)
        if live.isEmpty():
            break
        found, costs = fit_block(layout, live, first, min(block, k_max - first + 1), n_refs, seed, max_iter)
        dispersions = dispersions.join(open_frames, KEY, "left_semi").unionByName(costs)
        gaps = gap.gap_statistics(dispersions, [KEY])
        stops = cut_lineage(gap.choose_k(gaps, rule, [KEY]).select(KEY, "k"))
        chosen.append(stops)
        centres.append(found)
        kept = F.col("k") <= F.col("_top") + (0 if rule == "first_drop" else 1)
        tables.append(cut_lineage(gaps.join(stops.select(KEY, F.col("k").alias("_top")), KEY).where(kept).drop("_top")))
        open_frames = open_frames.join(stops, KEY, "left_anti")
        dispersions = cut_lineage(dispersions.join(stops, KEY, "left_anti"))
    union = lambda frames, schema: reduce(DataFrame.unionByName, frames) if frames else local_table(spark, [], schema)
    table = union([*tables, gap.gap_statistics(dispersions, [KEY])], "")
    best = union(chosen, empty)
    every = union(centres, f"{KEY} string, first int, last int, centres array<double>")
    picked = every.join(best, KEY).where("k BETWEEN first AND last")
    before = ((F.col("k") * (F.col("k") - 1) - F.col("first") * (F.col("first") - 1)) / 2 * dims).cast("int")
    picked = picked.select(KEY, F.slice("centres", before + 1, F.col("k") * dims).alias("centres"))
    return FrameSearch(table, best, cut_lineage(picked))


def assign(layout: Layout, centres: DataFrame) -> DataFrame:
    """(timeframe, ids, cluster, d2): nearest centre of the point's timeframe; timeframes without centres have no rows."""
    dims, ids = layout.dims, list(layout.id_cols)
    points = _parts_of(layout, centres)
    parts = layout.parts.join(centres.withColumnRenamed(KEY, "_key"), "_key").select("_key", "_part", "centres")
    schema = T.StructType([*points.select(KEY, *ids).schema, T.StructField("cluster", T.IntegerType()), T.StructField("d2", T.DoubleType())])
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return arrow.empty_table()
        flat = _points(left.column("features").combine_chunks())
        found = np.asarray(right.column("centres")[0].values).reshape(-1, dims)
        cluster = _nearest(flat, found)
        gaps = flat - found[cluster]
        named = left.select([KEY, *ids])
        named = named.append_column("cluster", pa.array(cluster.astype(np.int32))).append_column("d2", pa.array(np.einsum("ij,ij->i", gaps, gaps)))
        return named.cast(arrow)

    return points.groupBy(KEY, "part").cogroup(parts.groupBy("_key", "_part")).applyInArrow(nearest, schema)


def nearest_points(assigned: DataFrame, n: int, id_cols: Sequence[str]) -> DataFrame:
    """Of each timeframe's largest cluster (the lower number on ties) the ``n`` points nearest its centre."""
    sizes = assigned.groupBy(KEY, "cluster").agg(F.count(F.lit(1)).alias("n"))
    top = sizes.groupBy(KEY).agg(F.max_by("cluster", F.struct("n", -F.col("cluster"))).alias("cluster"))
    members = assigned.join(top, [KEY, "cluster"], "left_semi")
    place = F.row_number().over(Window.partitionBy(KEY).orderBy("d2", *id_cols))
    return members.withColumn("_at", place).where(F.col("_at") <= n).drop("_at")


def digests(
    vectors: DataFrame, id_cols: Sequence[str], n_refs: int = 50, k_max: int = 30, num_take: int = 10, seed: int = 0, max_iter: int = 10,
    block: int = 4, rule: str = "first_drop", distinct_sentences: bool = False,
) -> DataFrame:
    """``(timeframe, vector, sentences)`` of every timeframe of ``(timeframe, ids, sentence, features)``.

    A timeframe without a chosen K has no row. ``distinct_sentences`` keeps one of each sentence of a timeframe.
    """
    points = vectors
    if distinct_sentences:
        smallest = F.min_by(F.struct(*id_cols, "features"), F.struct(*id_cols)).alias("_kept")
        points = points.groupBy(KEY, "sentence").agg(smallest).select(KEY, "_kept.*", "sentence")
    points = cut_lineage(points.select(KEY, *id_cols, "sentence", "features"))
    layout = lay_out(points, id_cols, k_max, seed)
    try:
        found = search(layout, n_refs, k_max, seed, max_iter, block, rule)
        near = cut_lineage(nearest_points(assign(layout, found.centres), num_take, id_cols))
    finally:
        layout.points.unpersist()
    # At most num_take rows a timeframe meet their vectors and sentences again.
    wanted = near.withColumn(KEY, _taken_off(F.col(KEY)))
    left, right = points.alias("p"), wanted.alias("w")
    on = reduce(lambda a, b: a & b, [F.col(f"p.{c}").eqNullSafe(F.col(f"w.{c}")) for c in (KEY, *id_cols)])
    rows = left.join(right, on).select(*[F.col(f"p.{c}").alias(c) for c in (KEY, *id_cols, "sentence", "features")], F.col("w.d2").alias("d2"))
    ordered = F.sort_array(F.collect_list(F.struct("d2", *id_cols, "sentence")))
    return rows.groupBy(KEY).agg(sum_vectors(F.col("features")).alias("vector"), ordered.getField("sentence").alias("sentences"))
