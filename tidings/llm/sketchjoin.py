"""Similarity join of documents on word shingles, with parity sketches.

A document's set holds its distinct shingles of five words. Two sets of sizes a and b with a Jaccard
similarity of 0.8 or more differ in at most (a + b) / 9 elements. A parity sketch XORs one bit for each
element, so the Hamming distance of two sketches never exceeds that number.

1. Sets fall into bands by size (powers of two). The sketch of a band is cut into parts; the bits of a
   part depend on the elements in it only, and two linked sets differ in at most d parts. So among the
   first parts of which d + 1 are not empty in one of them, a non-empty part is equal (pigeonhole). The
   sketch is wide (2^32 bits a part) and kept as a fingerprint of each part; a set near the top of its
   band also shows its parts in the next band, whose sets it may be linked with. A set with too few
   non-empty parts shows its elements instead: two such sets that are linked share one.
2. Sets that show an equal part are candidates. The rows of the parts are range-partitioned, so a frequent
   part fills several tasks; each set is paired with the first of its part in the task and with the one
   before it. No part emits all its pairs.
3. Candidates pass if the Hamming distance of their narrow sketches is within the bound, and are
   verified on the whole sets, made again from the texts.
4. Linked sets form components. Where a part holds sets of different components after that, its sets
   are compared sketch by sketch, in tiles of bounded size, which tell spanning forests only; the blocks that
   these connect are compared on whole sets. After it, every pair that shares a part is either
   connected or refuted, so no link is lost.

Within a task only the first of equal sets shows its parts; equal sets are one class everywhere.

Defined cases: a NULL text, or one without words, has an empty set and is linked with nothing; fewer
than five words make one shingle of the whole sequence; each row of a repeated doc_id is a document,
its component_id the smallest id of its component (NULL if all are NULL); texts of any length are taken
whole. Sets are compared by 64-bit hashes of their shingles.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.llm import blocks
from tidings.llm.common import table, tidied
from tidings.session import cut_lineage, drop_scratch, scratch_path

SHINGLE = 5
CACHE_WORDS = 200_000
TILE_ROWS = 1024  # rows of a part that are compared at a time
# Odd constants of the 64-bit mixing function.
MIX_A, MIX_B, GOLDEN = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        found = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        self[word] = found
        return found


def shingle_set(text: str | None, hashes: WordHashes) -> np.ndarray:
    """The sorted distinct shingle hashes of a text. Only A-Z are lower-cased; words end at ASCII white space."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(SHINGLE, len(words))
    rolled = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        rolled = mix(rolled * GOLDEN + w[k:len(words) - width + 1 + k])
    return np.unique(rolled)


def band_of(size: int) -> int:
    return size.bit_length() - 1


def parts_of(band: int) -> int:
    """As few parts as leave nearly every set of the band enough that are not empty: more elements a part."""
    widest = 2 * ((2 << band) - 1) // 9
    return widest + 1 + math.ceil(0.05 * widest + 0.6 * math.sqrt(widest))


def shown_bands(size: int) -> list[tuple[int, int]]:
    """(band, most differing parts) in which a set of this size must show itself."""
    band, largest = band_of(size), size * 5 // 4
    top = (2 << band) - 1
    bands = [(band, (size + min(largest, top)) // 9)]
    return bands + [(band + 1, (size + largest) // 9)] if largest > top else bands


def part_keys(found: np.ndarray) -> np.ndarray:
    """The keys of the parts that a set shows (sorted hashes in, 64-bit keys out)."""
    keys, mixed, lonely = [], mix(found ^ GOLDEN), False
    for band, differing in shown_bands(len(found)):
        parts = ((found >> np.uint64(32)) * np.uint64(parts_of(band))) >> np.uint64(32)
        starts = np.flatnonzero(np.r_[True, parts[1:] != parts[:-1]])
        lonely = lonely or len(starts) <= differing
        values = np.bitwise_xor.reduceat(mixed, starts)[:differing + 1]
        place = parts[starts][:differing + 1] + np.uint64((band + 1) << 40)
        keys.append(mix(values ^ mix(place * GOLDEN)))
    if lonely:
        keys.append(mix(mixed + GOLDEN))
    return np.concatenate(keys)


def narrow_sketch(found: np.ndarray) -> bytes:
    """The parity sketch: bit (hash mod width), XORed over the set; two to four bits an element."""
    width = max(64, 4 << band_of(len(found)))
    odd = np.bincount((found & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(sketch: np.ndarray, size: int) -> np.ndarray:
    """A sketch of half the width is the XOR of its halves."""
    while sketch.shape[-1] > size:
        half = sketch.shape[-1] // 2
        sketch = sketch[..., :half] ^ sketch[..., half:]
    return sketch


def may_link(n_a, n_b, distance):
    return (9 * distance <= n_a + n_b) & (5 * np.minimum(n_a, n_b) >= 4 * np.maximum(n_a, n_b))


def are_linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= 80 * (len(a) + len(b) - both) and both > 0


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def fingerprint(found: np.ndarray) -> tuple[int, int]:
    if not len(found):
        return 0, 0
    mixed = mix(found + GOLDEN)
    return int(_signed(np.bitwise_xor.reduce(mixed, keepdims=True))[0]), int(_signed(np.add.reduce(mix(mixed ^ MIX_A), keepdims=True))[0])


# --- step 1: sets, parts, sketches -----------------------------------------------------------

def sketch_documents(docs: DataFrame, folder: str) -> DataFrame:
    """Store (row, doc_id, n, f1, f2, keys, sketch); keys and sketch only for the first of equal sets in a task."""
    source = docs.select("doc_id", "text_hash", "text")
    schema = source.select("doc_id", "text_hash").schema.add("n", "long").add("f1", "long").add("f2", "long").add("keys", T.ArrayType(T.LongType())).add("sketch", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), set()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                n, prints, lengths, keys, sketches = [], [], [], [], []
                for value in part.column("text"):
                    found = shingle_set(value.as_py(), hashes)
                    label = fingerprint(found)
                    n.append(len(found))
                    prints.append(label)
                    if not len(found) or (len(found), *label) in seen:
                        lengths.append(None)
                        sketches.append(None)
                        continue
                    seen.add((len(found), *label))
                    keys.append(_signed(part_keys(found)))
                    lengths.append(len(keys[-1]))
                    sketches.append(narrow_sketch(found))
                offsets = np.cumsum([0, *[x or 0 for x in lengths]]).astype(np.int32)
                absent = pa.array([x is None for x in lengths] + [False])
                lists = pa.ListArray.from_arrays(
                    pa.array([None if a else int(o) for a, o in zip(absent.to_pylist(), offsets)], pa.int32()),
                    pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_hash"), pa.array(n, pa.int64()), pa.array([p[0] for p in prints], pa.int64()),
                     pa.array([p[1] for p in prints], pa.int64()), lists, pa.array(sketches, pa.binary())], names=schema.names)

    source.mapInArrow(tidied(run), schema).withColumn("row", F.monotonically_increasing_id()).write.parquet(folder)
    return docs.sparkSession.read.parquet(folder)


# --- steps 2 and 3: candidates and their proof -----------------------------------------------

def passing(pairs: DataFrame, stored: DataFrame) -> DataFrame:
    """Pairs (a, b) within the bound by size and sketch."""
    side = lambda p, *names: stored.select(F.col("row").alias(p), *[F.col(c).alias(f"{p}_{c}") for c in names])
    sized = pairs.join(side("a", "n"), "a").join(side("b", "n"), "b")
    close = cut_lineage(sized.where(F.least("a_n", "b_n") * 5 >= F.greatest("a_n", "b_n") * 4))  # before sketches move
    close = close.join(side("a", "sketch"), "a").join(side("b", "sketch"), "b")
    close = close.select("a", "b", "a_n", "b_n", "a_sketch", "b_sketch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a_n, b_n = (batch.column(c).to_numpy() for c in ("a_n", "b_n"))
            distance = np.zeros(batch.num_rows, np.int64)
            for i, (x, y) in enumerate(zip(batch.column("a_sketch"), batch.column("b_sketch"))):
                p, q = np.frombuffer(x.as_buffer(), np.uint8), np.frombuffer(y.as_buffer(), np.uint8)
                width = min(len(p), len(q))
                distance[i] = np.bitwise_count(folded(p, width) ^ folded(q, width)).sum()
            kept = pa.array(may_link(a_n, b_n, distance))
            yield batch.select(["a", "b"]).filter(kept)

    return close.mapInArrow(tidied(run), "a long, b long")


# --- step 4: parts that hold several components ----------------------------------------------

def near_in_tile(n: np.ndarray, sketches: list[bytes]):
    """The test of a tile: sizes and sketches allow a link."""
    narrow = min(map(len, sketches))
    flat = np.stack([folded(np.frombuffer(s, np.uint8), narrow) for s in sketches])

    def test(x: int, others: np.ndarray) -> np.ndarray:
        distance = np.bitwise_count(flat[others] ^ flat[x]).sum(axis=1, dtype=np.int64)
        return may_link(n[others], n[x], distance)

    return test


# --- the whole -------------------------------------------------------------------------------

def similar_documents(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text_hash, n_shingles, component_id, keeper): keeper marks one row of each component.

    ``text_hash`` is ``xxhash64("text")``: with doc_id it names the text of a row, here and for callers.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    folders = [scratch_path(spark, name) for name in ("sketches", "classes", "parts")]
    stored = sketch_documents(docs, folders[0])
    # One class for each set; its first row stands for it. Empty sets are classes of their own.
    sets = ["n", "f1", "f2"]
    classes = cut_lineage(stored.where("n > 0").groupBy(*sets).agg(F.min("row").alias("rep"), F.min("doc_id").alias("least"), F.min_by("row", "doc_id").alias("least_row")))
    firsts = blocks.first_of_sets(stored, classes)
    firsts.select("row", "n", "sketch").write.parquet(folders[1])
    reps = spark.read.parquet(folders[1])
    near = blocks.neighbours(firsts.select(F.explode("keys").alias("key"), "row"), folders[2])
    tested = cut_lineage(blocks.leader_pairs(near))
    known = stored.withColumnRenamed("text_hash", "hash")
    texts = docs.select("text", F.col("text_hash").alias("hash"))
    sets_of = lambda rows: blocks.full_sets(rows, known, texts, lambda: partial(shingle_set, hashes=WordHashes()), fingerprint)
    linked = blocks.confirmed(cut_lineage(passing(tested, reps)), sets_of, are_linked)
    labels = blocks.all_labels(near, reps, tested, linked, sets_of, near_in_tile, are_linked, TILE_ROWS)

    classes = classes.join(labels, classes["rep"] == labels["node"], "left").withColumn("label", F.coalesce("label", "rep"))
    classes = cut_lineage(classes.select(*sets, "label", "least", F.coalesce("least_row", "rep").alias("first_row")))
    # Rows of equal least ids: the smallest row keeps.
    groups = cut_lineage(classes.groupBy("label").agg(F.min(F.struct(F.col("least").isNull().alias("none"), F.col("least"), F.col("first_row"))).alias("best")))
    named = cut_lineage(classes.join(groups, "label").select(*sets, F.col("best.least").alias("component_id"), F.col("best.first_row").alias("keeper_row")))
    rows = stored.where("n > 0").select("row", "doc_id", "text_hash", *sets).join(named, sets)
    full = rows.select("row", "doc_id", "text_hash", F.col("n").alias("n_shingles"), "component_id", (F.col("row") == F.col("keeper_row")).alias("keeper"))
    empty = stored.where("n = 0").select("row", "doc_id", "text_hash", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(True).alias("keeper"))
    out = cut_lineage(full.unionByName(empty))
    for folder in folders:
        drop_scratch(spark, folder)
    return out


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one row of each component, the one with its smallest doc_id; all columns kept.

    Only the rows that go, and those whose doc_id and text occur more than once, are looked up; a row
    travels as one struct, so no column name can clash with those used here.
    """
    keyed = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))
    found = similar_documents(docs)
    marks = found.where("n_shingles > 0").groupBy("doc_id", "text_hash").agg(F.max("keeper").alias("stays"), F.count(F.lit(1)).alias("rows"))
    marks = cut_lineage(marks.where(~F.col("stays") | (F.col("rows") > 1)))
    joined = keyed.join(marks, F.col("id").eqNullSafe(F.col("doc_id")) & F.col("hash").eqNullSafe(F.col("text_hash")), "left")
    whole = joined.where(F.col("stays").isNull()).select("doc.*")
    again = joined.where(F.col("stays") & (F.col("rows") > 1)).dropDuplicates(["id", "hash"]).select("doc.*")
    return whole.unionByName(again)


def op9_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", "n_shingles", "component_id")
