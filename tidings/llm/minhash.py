"""Near duplicates by MinHash signatures and a multi-index Hamming join.

Every document is the set of its word shingles. Its signature holds ``SLOTS`` minimum hashes of ``BITS``
bits; two sets of Jaccard similarity s differ in each slot with a probability of at most 1 - s. So two
linked sets differ in more than ``most_errors(slots)`` of the slots with a probability below ``MISS``.

1. The first ``INDEX_SLOTS`` slots are cut into chunks, so many that two signatures within the distance
   have a chunk with at most ``CHUNK_ERRORS`` differing slots (pigeonhole). Those errors are enumerated:
   a chunk shows one key for each way of leaving so many slots out. Every pair within the distance
   shares a key.
2. Keys are range-partitioned together with the rows that show them, so the rows of a frequent key fill
   several tasks. Each row is paired with the first row of its key in the task and with the row before
   it; the first rows of a key's tasks are paired with each other's least. No key gives all its pairs.
3. Pairs pass if their sizes allow it and their whole signatures are within the distance; they are
   confirmed on the full sets, made again from the texts. Linked sets form components.
4. Where a key still holds rows of different components, its rows are compared signature by signature
   in tiles of bounded size. A tile tells no pairs, only a spanning forest of those within the distance. The
   forests connect rows into blocks that hold every such pair; a block's full sets are sent once and
   compared in tiles, and a tile tells only the links that join components.

Equal sets are one class with one signature.

Defined cases: a NULL text, or one without words, has an empty set, is linked with nothing and kept; with
fewer words than a shingle the whole sequence is one; each row of a repeated doc_id is a document, its
component_id the smallest id of its component (NULL if all are NULL, and kept); texts of any length are
taken whole; an empty table gives no rows. Sets are compared by 64-bit hashes of their shingles.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.llm import blocks
from tidings.llm.common import table, tidied
from tidings.llm.sketchjoin import GOLDEN, WordHashes, fingerprint, mix, shingle_set
from tidings.session import cut_lineage, drop_scratch, scratch_path

SIMILARITY = 85  # per cent
SLOTS, INDEX_SLOTS, BITS, CHUNK_ERRORS, MISS = 256, 128, 16, 1, 1e-7
TILE_ROWS = 1024  # that are compared at a time
SEEDS = mix(np.arange(1, SLOTS + 1, dtype=np.uint64) * GOLDEN)[:, None]
FACTORS = (mix(np.arange(SLOTS + 1, 2 * SLOTS + 1, dtype=np.uint64) * GOLDEN) | np.uint64(1))[:, None]


def most_errors(slots: int, similarity: int = SIMILARITY, miss: float = MISS) -> int:
    """The least distance that linked signatures exceed with a probability of at most ``miss``."""
    differ, above, at = 1 - similarity / 100, 1.0, -1
    while above > miss:
        at += 1
        above -= math.comb(slots, at) * differ**at * (1 - differ) ** (slots - at)
    return at


def signature(found: np.ndarray) -> np.ndarray:
    """The low bits of the minimum hashes of a set (not empty), hashed a bounded number of elements at a time."""
    least = np.full(SLOTS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(found), 512):
        least = np.minimum(least, ((found[start:start + 512] ^ SEEDS) * FACTORS).min(axis=1))
    return (mix(least) & np.uint64((1 << BITS) - 1)).astype(np.uint16)


def chunk_keys(signatures: np.ndarray, distance: int, errors: int = CHUNK_ERRORS) -> np.ndarray:
    """Keys of every signature (a row each): one for each chunk and each choice of ``errors`` slots left out."""
    slots = signatures.shape[1]
    chunks = np.array_split(np.arange(slots), distance // (errors + 1) + 1)
    parts = mix(signatures.astype(np.uint64) + (np.arange(1, slots + 1, dtype=np.uint64) << np.uint64(32)))
    keys = []
    for chunk in chunks:
        whole = parts[:, chunk].sum(axis=1, dtype=np.uint64)
        for left_out in itertools.combinations(chunk.tolist(), min(errors, len(chunk))):
            keys.append(whole - parts[:, list(left_out)].sum(axis=1, dtype=np.uint64))
    return mix(np.stack(keys, axis=1) + np.arange(1, len(keys) + 1, dtype=np.uint64) * GOLDEN)


def are_linked(a: np.ndarray, b: np.ndarray, similarity: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= similarity * (len(a) + len(b) - both) and both > 0


# --- signatures and classes ------------------------------------------------------------------

def sign_documents(docs: DataFrame, folder: str) -> DataFrame:
    """Store (row, doc_id, hash, n, f1, f2, sketch); the signature only for the first of equal sets in a task."""
    source = docs.select("doc_id", F.xxhash64("text").alias("hash"), "text")
    schema = source.select("doc_id", "hash").schema.add("n", "long").add("f1", "long").add("f2", "long").add("sketch", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), set()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                names, signatures = [], []
                for value in part.column("text"):
                    found = shingle_set(value.as_py(), hashes)
                    names.append((len(found), *fingerprint(found)))
                    new = len(found) and names[-1] not in seen
                    seen.add(names[-1])
                    signatures.append(signature(found).tobytes() if new else None)
                columns = [pa.array(x, pa.int64()) for x in zip(*names)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("hash"), *columns, pa.array(signatures, pa.binary())], names=schema.names)

    source.mapInArrow(tidied(run), schema).withColumn("row", F.monotonically_increasing_id()).write.parquet(folder)
    return docs.sparkSession.read.parquet(folder)


# --- candidates ------------------------------------------------------------------------------

def shown_keys(reps: DataFrame, distance: int) -> DataFrame:
    """(key, row): the keys of every signature."""

    def show(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                flat = np.frombuffer(b"".join(part.column("sketch").to_pylist()), np.uint16).reshape(part.num_rows, SLOTS)
                keys = chunk_keys(flat[:, :INDEX_SLOTS], distance)
                rows = np.repeat(part.column("row").to_numpy(), keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(rows)], names=["key", "row"])

    return reps.select("row", "sketch").mapInArrow(show, "key long, row long")


def sizes_fit(n, m, similarity: int):
    return F.least(n, m) * 100 >= F.greatest(n, m) * similarity


def passing(pairs: DataFrame, reps: DataFrame, distance: int, similarity: int) -> DataFrame:
    """Pairs (a, b) whose sizes and whole signatures allow a link."""
    side = lambda p, *names: reps.select(F.col("row").alias(p), *[F.col(c).alias(f"{p}_{c}") for c in names])
    sized = pairs.join(side("a", "n"), "a").join(side("b", "n"), "b")
    close = cut_lineage(sized.where(sizes_fit(F.col("a_n"), F.col("b_n"), similarity)).select("a", "b"))
    close = close.join(side("a", "sketch"), "a").join(side("b", "sketch"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, SLOTS) for c in ("a_sketch", "b_sketch"))
            near = (a != b).sum(axis=1) <= distance
            yield batch.select(["a", "b"]).filter(pa.array(near))

    return close.select("a", "b", "a_sketch", "b_sketch").mapInArrow(run, "a long, b long")


def may_link(distance: int, similarity: int) -> blocks.Near:
    """The test of a tile: sizes and signatures allow a link."""

    def tile(n: np.ndarray, sketches: list[bytes]):
        flat = np.frombuffer(b"".join(sketches), np.uint16).reshape(len(n), SLOTS)

        def test(x: int, others: np.ndarray) -> np.ndarray:
            fits = np.minimum(n[others], n[x]) * 100 >= np.maximum(n[others], n[x]) * similarity
            fits[fits] = (flat[others[fits]] != flat[x]).sum(axis=1) <= distance
            return fits

        return test

    return tile


# --- the whole -------------------------------------------------------------------------------

def near_duplicates(docs: DataFrame, similarity: int = SIMILARITY, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    whole, index = most_errors(SLOTS, similarity), most_errors(INDEX_SLOTS, similarity)
    folders = [scratch_path(spark, name) for name in ("signatures", "classes", "neighbours")]
    stored = sign_documents(docs, folders[0])
    sets = ["n", "f1", "f2"]
    classes = cut_lineage(stored.where("n > 0").groupBy(*sets).agg(F.min("row").alias("rep"), F.min("doc_id").alias("least")))
    blocks.first_of_sets(stored, classes).select("row", "n", "sketch").write.parquet(folders[1])
    reps = spark.read.parquet(folders[1])
    near = blocks.neighbours(shown_keys(reps, index), folders[2])
    tested = cut_lineage(blocks.leader_pairs(near))
    texts = docs.select("text", F.xxhash64("text").alias("hash"))
    sets_of = lambda rows: blocks.full_sets(rows, stored, texts, lambda: partial(shingle_set, hashes=WordHashes()), fingerprint)
    linked = lambda a, b: are_linked(a, b, similarity)
    found = blocks.confirmed(cut_lineage(passing(tested, reps, whole, similarity)), sets_of, linked)
    labels = blocks.all_labels(near, reps, tested, found, sets_of, may_link(whole, similarity), linked, tile_rows)
    # Classes to components, components to rows.
    named = cut_lineage(classes.join(labels, classes["rep"] == labels["node"], "left").select(*sets, "least", F.coalesce("label", "rep").alias("label")))
    least = cut_lineage(named.groupBy("label").agg(F.min("least").alias("component_id")))
    named = cut_lineage(named.join(least, "label").select(*sets, "component_id"))
    full = stored.where("n > 0").select("doc_id", *sets).join(named, sets).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    empty = stored.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    out = cut_lineage(full.unionByName(empty).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))
    for folder in folders:
        drop_scratch(spark, folder)
    return out


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
