"""Mixing sources to target weights, in DataFrame operations only.

1. Each source's words are laid out in one line, document after document, and cut into blocks of
   ``block_tokens`` words (the last may be shorter).
2. Targets: the sources share ``total_share`` of all words by weight; a source stops at ``most`` times
   its own words, and what is over is shared again.
3. The mix is a row of slots, one block each, in output shards of ``shard_slots`` slots. Each shard
   draws multinomial source counts with the targets as weights. Slots drawn beyond a source's quota
   are dealt to the sources that are short of theirs, so the whole mix meets the targets to a block.
4. A source's slots are numbered through all shards; slot j takes the block perm(j mod N), a
   pseudorandom permutation of the source's N blocks for each round through them.
5. Slots meet the blocks of the documents by (source, block).

Nothing is drawn from a state: all choices are hashes of positions, so reruns and retried tasks agree.
The table of sources (one row per source) is brought to the driver; it is the mix's configuration.

Defined cases: a NULL or blank text has size 0 and takes 0; a NULL source is a source of its own, last
in order; repeated rows are documents of their own (rows with equal doc_id, source and size stand next
to each other in either order); an empty table or one without words gives an empty mix.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidings.llm.common import WORD_PATTERN, running_sum, table
from tidings.session import cut_lineage, local_table

WEIGHTS = (3.0, 1.0, 2.0)
BLOCK_TOKENS = 64
SHARD_SLOTS = 1 << 16
TOTAL_SHARE, MOST = 1.5, 2.0
ROUNDS = 4  # of the permutation's network
RANGE_ROWS = 50_000  # of a source that are added up together
WALKS = 64  # at most; a step leaves the range with a chance below 1/2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def fill_targets(sizes: Sequence[int], weights: Sequence[float], total: float, most: float = MOST) -> list[float]:
    """Shares of ``total`` by weight; none above ``most`` times its size, the excess shared anew."""
    targets, open_ = [0.0] * len(sizes), list(range(len(sizes)))
    left = min(total, most * sum(sizes))
    while open_:
        weight = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / weight > most * sizes[i]]
        if not full:
            for i in open_:
                targets[i] = left * weights[i] / weight
            break
        for i in full:
            targets[i] = most * sizes[i]
        left -= sum(targets[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return targets


def alias_table(shares: Sequence[float]) -> tuple[list[float], list[int]]:
    """Cell i holds source i up to ``cut`` and source ``other`` beyond: one look-up per draw."""
    n, total = len(shares), sum(shares)
    scaled = [s * n / total for s in shares]
    cut, other = [1.0] * n, list(range(n))
    small, large = [i for i in range(n) if scaled[i] < 1], [i for i in range(n) if scaled[i] >= 1]
    while small and large:
        a, b = small.pop(), large[-1]
        cut[a], other[a] = scaled[a], b
        scaled[b] -= 1 - scaled[a]
        if scaled[b] < 1:
            small.append(large.pop())
    return cut, other


def plan_sources(per_source: DataFrame, weights: Sequence[float], block_tokens: int, total_share: float, most: float) -> list[tuple]:
    """(source, rank, words, rows, blocks, quota in blocks, target) of each source, in code-point order, NULL last."""
    rows = per_source.collect()
    ordered = sorted((r for r in rows if r["source"] is not None), key=lambda r: r["source"].encode()) + [r for r in rows if r["source"] is None]
    sizes = [r["words"] for r in ordered]
    targets = fill_targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], total_share * sum(sizes), most)
    out = []
    for rank, (row, target) in enumerate(zip(ordered, targets)):
        blocks = -(-row["words"] // block_tokens)
        # by the mean block, as the last block is shorter
        quota = min(math.floor(target * blocks / row["words"] + 0.5), math.floor(most * blocks)) if blocks else 0
        out.append((row["source"], rank, row["words"], row["n"], blocks, quota, target))
    return out


def permuted(index: Column, count: Column, key: Column) -> Column:
    """A pseudorandom permutation of 0..count-1, one for each ``key``.

    A balanced network permutes the square of side ceil(sqrt(count)); a value that falls outside the
    range walks on until it is inside, which keeps it a permutation.
    """
    side = F.ceil(F.sqrt(count.cast("double"))).cast("long")

    def network(x: Column) -> Column:
        left, right = F.floor(x / side).cast("long"), x % side
        for k in range(ROUNDS):
            left, right = right, F.pmod(left + F.pmod(F.xxhash64(key, F.lit(k), right), side), side)
        return left * side + right

    # transform over one element binds the value to a name, so that it is evaluated once
    first = F.transform(F.array(index), network)[0]
    return F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), first, lambda x, _: F.when(x < count, x).otherwise(F.transform(F.array(x), network)[0]))


def draw_counts(spark: SparkSession, slots: int, quotas: Sequence[int], seed: int, shard_slots: int) -> DataFrame:
    """Multinomial counts: (shard, rank, n), one row per output shard and source drawn in it."""
    cut, other = alias_table(quotas)
    uniform = F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.lit(1 << 52)) / float(1 << 52) * len(quotas)
    cells, others = F.array(*map(F.lit, cut)), F.array(*map(F.lit, other))
    drawn = (
        spark.range(slots)
        .select(F.floor(F.col("id") / shard_slots).alias("shard"), uniform.alias("u"))
        .select("shard", F.floor("u").cast("int").alias("cell"), (F.col("u") - F.floor("u")).alias("part"))
        .select("shard", F.when(F.col("part") < F.get(cells, F.col("cell")), F.col("cell")).otherwise(F.get(others, F.col("cell"))).alias("rank"))
    )
    return drawn.groupBy("shard", "rank").agg(F.count(F.lit(1)).alias("n"))


def numbered_slots(counts: DataFrame, sources: DataFrame) -> DataFrame:
    """Slots (shard, rank, ordinal): each source has exactly its quota of ordinals, from 0.

    Draws beyond the quota (only the last shards have any) are dealt one by one to the sources that
    drew too few: unit k of the surplus takes unit k of the shortage.
    """
    earlier = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("start", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(sources.select("rank", "quota"), "rank")
    kept_n = F.greatest(F.lit(0), F.least(F.col("n"), F.col("quota") - F.col("start")))
    placed = placed.withColumn("kept", kept_n)
    tasks = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few rows, but each becomes many
    kept = placed.where("kept > 0").repartition(tasks, "shard", "rank").select("shard", "rank", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("kept") - 1)).alias("ordinal"))
    by_shard = Window.orderBy("shard", "rank").rowsBetween(Window.unboundedPreceding, -1)
    surplus = placed.where("n > kept").withColumn("over", F.col("n") - F.col("kept")).withColumn("first", F.coalesce(F.sum("over").over(by_shard), F.lit(0)))
    surplus = surplus.select("shard", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("over") - 1)).alias("unit"))
    drawn = counts.groupBy("rank").agg(F.sum("n").alias("drawn"))
    short = sources.join(drawn, "rank", "left").withColumn("drawn", F.coalesce("drawn", F.lit(0))).where("quota > drawn")
    by_rank = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    short = short.withColumn("first", F.coalesce(F.sum(F.col("quota") - F.col("drawn")).over(by_rank), F.lit(0)))
    short = short.select("rank", F.explode(F.sequence(F.col("drawn"), F.col("quota") - 1)).alias("ordinal"), "first", "drawn")
    short = short.select("rank", "ordinal", (F.col("first") + F.col("ordinal") - F.col("drawn")).alias("unit"))
    return kept.unionByName(surplus.join(short, "unit").select("shard", "rank", "ordinal"))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, block_tokens: int = BLOCK_TOKENS, total_share: float = TOTAL_SHARE,
        most: float = MOST, seed: int = 0, shard_slots: int = SHARD_SLOTS) -> tuple[DataFrame, DataFrame]:
    """The slots (shard, rank, ordinal, block) and the documents (doc_id, size, source_size, target, rank, first word).

    The text is read for its size only; sizes, not texts, are shuffled.
    """
    spark = docs.sparkSession
    sized = cut_lineage(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    plan = plan_sources(sized.groupBy("source").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")), weights, block_tokens, total_share, most)
    sources = local_table(spark, plan, "source string, rank int, words long, n long, blocks long, quota long, target double")
    laid = running_sum(sized, ["source"], ["doc_id", "size"], F.col("size"), "first", sum(p[3] for p in plan))
    laid = laid.alias("d").join(sources.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))).select(
        "doc_id", "size", F.col("words").alias("source_size"), "target", "rank", "first")
    quotas = [p[5] for p in plan]
    if not sum(quotas):
        return local_table(spark, [], "shard long, rank int, ordinal long, block long"), laid
    slots = numbered_slots(draw_counts(spark, sum(quotas), quotas, seed, shard_slots), sources).join(sources.select("rank", "blocks"), "rank")
    round_ = F.floor(F.col("ordinal") / F.col("blocks"))
    block = permuted(F.col("ordinal") % F.col("blocks"), F.col("blocks"), F.xxhash64(F.lit(seed), F.col("rank"), round_))
    return slots.select("shard", "rank", "ordinal", block.alias("block")), laid


def taken_words(slots: DataFrame, laid: DataFrame, block_tokens: int = BLOCK_TOKENS, more: Sequence[str] = ()) -> DataFrame:
    """Join slots and documents by block; the words of each document that the mix takes, repeats counted. ``more`` names further columns of ``laid``."""
    uses = slots.groupBy("rank", "block").agg(F.count(F.lit(1)).alias("uses"))
    last = F.col("first") + F.col("size")
    parts = laid.where("size > 0").select(
        "doc_id", "size", "source_size", "target", "rank", "first",
        F.explode(F.sequence(F.floor(F.col("first") / block_tokens), F.floor((last - 1) / block_tokens))).alias("block"))
    begin, end = F.col("block") * block_tokens, (F.col("block") + 1) * block_tokens
    overlap = F.least(last, end) - F.greatest(F.col("first"), begin)
    names = ["doc_id", "size", "source_size", "target"]
    found = parts.join(uses, ["rank", "block"]).groupBy(*names, "rank", "first").agg(F.sum(overlap * F.col("uses")).alias("taken"))
    whole = laid.select(*names, "rank", "first", F.lit(0).cast("long").alias("taken")).unionByName(found.select(*names, "rank", "first", "taken"))
    # Rows without words may agree in all keys; they must stay as many as they are.
    zero = laid.where("size = 0").select(*names, *more, F.lit(0).cast("long").alias("taken"))
    summed = whole.where("size > 0").groupBy("rank", "first", *names).agg(F.sum("taken").cast("long").alias("taken"))
    return summed.select(*names, *more, "taken").unionByName(zero)


def whole_times(ratios: DataFrame) -> DataFrame:
    """Add ``times``: whole numbers that follow the ratios (doc_id, size, rank, ratio) of each source.

    The ratios of a source are added up in the order of sizes, and a document occurs as often as the sum
    passes a whole number in it. So every run of documents has as many as its ratios say, but for one, and as
    sizes are in order the words of a source miss what is taken by no more than a document. A
    source of any size is added up in ranges of a bounded number of rows, one number a range.
    """
    unit = 1 << 20  # sums of whole units are the same in any order
    rows = ratios.withColumn("_bucket", F.floor(F.log2("size") * 8).cast("int")).withColumn("_units", F.round(F.col("ratio") * unit).cast("long"))
    ranges = rows.groupBy("rank", "_bucket").agg(F.ceil(F.count(F.lit(1)) / RANGE_ROWS).cast("long").alias("_ranges"))
    rows = cut_lineage(rows.join(ranges, ["rank", "_bucket"]).withColumn("_range", F.pmod(F.xxhash64("doc_id", "size"), F.col("_ranges"))))
    totals = rows.groupBy("rank", "_bucket", "_range").agg(F.sum("_units").alias("_total"))
    before = Window.partitionBy("rank").orderBy("_bucket", "_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("rank", "_bucket", "_range", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("rank", "_bucket", "_range").orderBy("size", F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumn("_inside", F.sum("_units").over(inside)).join(starts, ["rank", "_bucket", "_range"])
    end = F.col("_start") + F.col("_inside") + unit // 2
    times = F.floor(end / unit) - F.floor((end - F.col("_units")) / unit)
    return summed.select(*ratios.columns, times.cast("int").alias("times"))


def apply_mix(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The documents as often as the mix takes them (0 to 2 times), all columns kept.

    Of each source as many words stay as are taken of it, to a document. Rows that agree in doc_id and
    size share what is taken of them evenly, and stand by the chance of a hash; a text without words does not occur.
    """
    slots, laid = mix(docs, seed=seed)
    taken = taken_words(slots, laid, more=["rank"]).where("size > 0")
    by_key = cut_lineage(taken.groupBy("doc_id", "size").agg(
        (F.sum("taken") / F.sum("size")).alias("ratio"), F.min("rank").alias("rank"), F.count(F.lit(1)).alias("rows")))
    single = whole_times(by_key.where("rows = 1").drop("rows")).where("times > 0").select("doc_id", "size", "times", F.lit(0.0).alias("chance"))
    shared = by_key.where("rows > 1").select("doc_id", "size", F.floor("ratio").cast("int").alias("times"), (F.col("ratio") - F.floor("ratio")).alias("chance"))
    by_key = cut_lineage(single.unionByName(shared))
    keyed = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"), word_count(F.col("text")).alias("words"))
    joined = keyed.join(by_key, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("words") == F.col("size")))
    drawn = F.pmod(F.xxhash64(F.lit(seed), "id", "words", "hash"), F.lit(1 << 30)) / float(1 << 30)
    times = F.col("times") + F.when(drawn < F.col("chance"), 1).otherwise(0)
    return joined.where(times > 0).select("doc", F.explode(F.array_repeat(F.lit(0), times.cast("int")))).select("doc.*")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    slots, laid = mix(table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return taken_words(slots, laid)
