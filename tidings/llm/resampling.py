"""Importance resampling of documents towards a target text, ranked by regular sampling.

Runs of words fall into hash buckets. A bucket's gain is the scaled logarithm of how much likelier it
is in the target than in the documents; a document's weight is the sum of its gains, looked up in one
array. A Gumbel number from a hash of the document is added, so that the highest scores are a draw
without replacement in proportion to the weights.

The ranks are exact, by parallel sorting with regular samples:

1. Scored documents are sorted inside each task and stored: sorted runs.
2. Every run gives the keys at regular distances. The driver sorts them (at most ``SAMPLES`` and one a
   run) and takes regular splitters.
3. Rows are counted between splitters; the prefix sums of the counts are the ranks at which segments
   begin. Only segments that begin within the draw are exchanged.
4. Each exchanged segment is merged by a local sort and numbered from its start.

A row number ends the key, so equal rows, however many, are shared out among segments.

Defined cases: a NULL text or one without words has no features, weight 0 and a score; a NULL doc_id
counts as the empty text in the hash and comes last among ties; each row of a repeated doc_id is a
document; texts are read whole; an empty document table gives no rows, an empty target leaves t = T = 0.
Other columns of the tables never meet the operator's names.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.llm.common import table
from tidings.session import cut_lineage, drop_scratch, scratch_path

BUCKETS, RUNS, SEED, PERCENT, LEAST_WORDS = 10_000, 1, 2024, 10, 20
SAMPLES = 100_000  # regular samples that reach the driver, beside one a run
SEGMENT_ROWS, MAX_SEGMENTS = 500_000, 4096
CACHE_FEATURES = 300_000
SLICE = 256  # texts that a task holds as Python objects at a time

#: Bytes of words stay (A-Z lower-cased), all others become spaces.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
KEYS = ["last", "none", "id", "n_features", "weight", "row"]


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(WORD_BYTES).split()


def features_of(words: list[bytes], runs: int) -> list[bytes]:
    """All runs of 1 to ``runs`` words, joined by one space."""
    found = list(words)
    for width in range(2, runs + 1):
        found += [b" ".join(words[i:i + width]) for i in range(len(words) - width + 1)]
    return found


class Buckets(dict):
    """Buckets of features, remembered up to a bound."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= CACHE_FEATURES:
            self.clear()
        found = self[feature] = zlib.crc32(feature) % self.buckets
        return found


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            yield part, part.column("text").cast(pa.binary()).to_pylist()


def bucket_counts(texts: DataFrame, buckets: int, runs: int) -> np.ndarray:
    """How many features of all texts fall into each bucket; each task sends one row a bucket at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, total = Buckets(buckets), np.zeros(buckets, np.int64)
        for _, found in _texts(batches):
            counts = Counter()
            for text in found:
                counts.update(features_of(words_of(text), runs))
            at = np.fromiter(map(place.__getitem__, counts), np.int64, len(counts))
            np.add.at(total, at, np.fromiter(counts.values(), np.int64, len(counts)))
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(total[full])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for row in texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of every bucket from the counts in the documents and in the target."""
    buckets, all_source, all_target = len(source), float(source.sum()), float(target.sum())
    ratio = (target + 1.0) * (all_source + buckets) / ((source + 1.0) * (all_target + buckets))
    return np.array([math.floor(1000 * math.log(x)) for x in ratio.tolist()], np.int64)


def scored(docs: DataFrame, gain: np.ndarray, runs: int = RUNS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, n_words, weight, score) of every document."""
    spark, source = docs.sparkSession, docs.select("doc_id", "text")
    shared = spark.sparkContext.broadcast(gain)
    schema = source.select("doc_id").schema.add("n_features", "long").add("n_words", "long").add("weight", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        place = Buckets(len(gain))
        for part, found in _texts(batches):
            n_features, n_words, weight = [], [], []
            for text in found:
                words = words_of(text)
                features = features_of(words, runs)
                n_words.append(len(words))
                n_features.append(len(features))
                weight.append(int(gain[np.fromiter(map(place.__getitem__, features), np.int64, len(features))].sum()))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n_features, n_words, weight))], names=schema.names)

    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return source.mapInArrow(run, schema).withColumn("score", F.col("weight") + noise)


# --- exact ranks -----------------------------------------------------------------------------

def _columns(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in KEYS]


def _order(columns: list[np.ndarray]) -> np.ndarray:
    return np.lexsort(columns[::-1])


def regular_samples(runs: DataFrame, gap: int) -> np.ndarray:
    """The keys at regular distances in each sorted run, sorted (one column a key part)."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            first = (gap // 2 - seen) % gap
            yield batch.take(pa.array(np.arange(first, batch.num_rows, gap), pa.int64()))
            seen += batch.num_rows

    found = runs.select(*KEYS).mapInArrow(pick, ", ".join(f"{c} long" for c in KEYS)).toArrow()
    columns = [np.asarray(found.column(c).to_numpy(), np.int64) for c in KEYS]
    order = _order(columns)
    return np.stack([c[order] for c in columns], axis=1) if len(order) else np.zeros((0, len(KEYS)), np.int64)


def with_segment(runs: DataFrame, splitters: np.ndarray) -> DataFrame:
    """Add the number of splitters that are at or before a row's key."""
    shared = runs.sparkSession.sparkContext.broadcast(splitters)
    schema = T.StructType([*runs.schema, T.StructField("segment", T.IntegerType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = shared.value
        for batch in batches:
            order = _order([np.concatenate([cuts[:, k], c]) for k, c in enumerate(_columns(batch))])
            is_row = order >= len(cuts)
            before = np.empty(batch.num_rows, np.int32)
            before[order[is_row] - len(cuts)] = np.cumsum(~is_row)[is_row]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before)], names=[*batch.schema.names, "segment"])

    return runs.mapInArrow(place, schema)


def top_ranks(runs: DataFrame, draws: int, rows: int, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Add ``rank`` to the rows of sorted runs: 1 to ``draws`` in the order of the keys, NULL for the rest."""
    segments = min(MAX_SEGMENTS, -(-rows // segment_rows))
    samples = regular_samples(runs, max(1, -(-rows // SAMPLES)))
    at = [len(samples) * k // segments for k in range(1, segments)]
    placed = with_segment(runs, samples[at] if len(samples) else samples)
    counts = dict(placed.groupBy("segment").count().collect())  # a row a segment
    starts = np.cumsum([0, *(counts.get(s, 0) for s in range(segments))]).tolist()
    inside = sum(start < draws for start in starts[:-1])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, done = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if segment is None:  # a task holds one segment
                segment = batch.column("segment")[0].as_py()
            ranks = np.arange(batch.num_rows) + starts[segment] + done + 1
            done += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(ranks, pa.int64(), mask=ranks > draws)], names=[*batch.schema.names, "rank"])

    schema = T.StructType([*placed.schema, T.StructField("rank", T.LongType())])
    drawn = placed.where(F.col("segment") < inside).repartitionById(max(1, inside), "segment").sortWithinPartitions(*KEYS)
    rest = placed.where(F.col("segment") >= inside).withColumn("rank", F.lit(None).cast("long"))
    return drawn.mapInArrow(number, schema).unionByName(rest).drop("segment")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS,
    runs: int = RUNS, seed: int = SEED, segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank): rank numbers the drawn documents, from 1."""
    spark = docs.sparkSession
    gain = gains(bucket_counts(docs, buckets, runs), bucket_counts(target, buckets, runs))
    folder = scratch_path(spark, "runs")
    keyed = scored(docs, gain, runs, seed).select(
        "*", (-F.col("score")).alias("last"), F.col("doc_id").isNull().cast("long").alias("none"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), (F.col("n_words") >= least_words).alias("fit"))
    keyed.sortWithinPartitions(*KEYS[:-1]).withColumn("row", F.monotonically_increasing_id()).write.parquet(folder)
    stored = spark.read.parquet(folder)
    fit = stored.where("fit")
    rows = fit.count()
    out = stored.where("NOT fit").withColumn("rank", F.lit(None).cast("long"))
    if rows:
        out = out.unionByName(top_ranks(fit, percent * rows // 100, rows, segment_rows))
    out = cut_lineage(out.select("doc_id", "n_features", "weight", "score", "rank"))
    drop_scratch(spark, folder)
    return out


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "text"))
