"""Packing token sequences into windows by non-negative least squares.

Every document is tokenised once. Whole windows are cut off its front; what is left (less than a
window) counts in a histogram of lengths. Combinations of at most three lengths that fill a window
exactly are enumerated, their repeat counts are solved against the histogram by non-negative least
squares, rounded, and never use more pieces than there are. The residual pieces go greedily, longest
first, one after the other into further windows, cut where a window ends; the last window's rest is
cut to powers of two, which need no padding.

Which window a piece goes to depends on its length and its number among the pieces of that length
only, so the plan (bounded by the window, not by the corpus) is made on the driver and applied by a
join. Tokens are stored once in the shared folder as two-byte ids and moved once, to meet their places.

Defined cases: a NULL or empty text is the single end id; each row of a repeated document is packed
by itself; texts of any length are cut into as many windows as they need; an empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import sys
import types
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.llm.common import running_sum, table, tidied
from tidings.session import bounded_batches, local_table, scratch_path

WINDOW, END_ID = 4096, 2
TOKENIZER = "word_bpe_49k.json"
CACHE_UNITS = 600_000  # what a worker remembers
TEXT_BYTES, BATCH_BYTES = 4 << 10, 4 << 20  # of a usual text, and of the texts that go to a worker at a time
MAX_TRIPLES = 30_000  # combinations of three; those of the most frequent lengths come first


# --- tokens ----------------------------------------------------------------------------------

class Tokens:
    """Ids of texts, unit by unit.

    The tokenizer lower-cases, drops white space and splits a text into units (contractions, runs of
    letters, single digits, runs of other signs), which it encodes one by one. Texts of plain Latin
    characters are split here, so that each distinct unit is encoded once; other words, and those that
    may hold a special token, go through the whole tokenizer. What is known is kept in the worker
    process, which Spark uses for many tasks.
    """

    PLAIN = re.compile("[\t-\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]*")
    UNITS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u017f]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u017f\t-\r ]+")
    WORDS = re.compile("[^\t-\r ]+")
    ODD = "\0"  # begins the key of a word that is not plain; no plain text holds it

    def __init__(self, path: str):
        kept = sys.modules.setdefault("_tidings_tokens", types.ModuleType("_tidings_tokens")).__dict__
        if path not in kept:
            kept[path] = (*self._load(path), {})
        self.whole, self.unit, self.known = kept[path]
        self.end = np.array([END_ID], "<u2").tobytes()

    @staticmethod
    def _load(path: str) -> tuple:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            content = file.read()
        whole = Tokenizer.from_str(content)
        if whole.get_vocab_size() > 1 << 16:
            raise ValueError("two bytes do not hold this vocabulary")
        parts = json.loads(content)
        parts |= {"normalizer": None, "pre_tokenizer": parts["pre_tokenizer"]["pretokenizers"][-1], "added_tokens": []}
        return whole, Tokenizer.from_str(json.dumps(parts))

    def _is_plain(self, text: str) -> bool:
        return bool(self.PLAIN.fullmatch(text)) and "<|" not in text

    def _units(self, text: str) -> list[str]:
        if self._is_plain(text):
            return self.UNITS.findall(text.lower())
        found: list[str] = []
        for word in self.WORDS.findall(text):
            found += self.UNITS.findall(word.lower()) if self._is_plain(word) else [self.ODD + word]
        return found

    def _learn(self, new: list[str]) -> None:
        odd = [u for u in new if u.startswith(self.ODD)]
        for word, found in zip(odd, self.whole.encode_batch_fast([w[1:] for w in odd], add_special_tokens=False)):
            self.known[word] = np.array(found.ids, "<u2").tobytes()
        plain = [u for u in new if not u.startswith(self.ODD)] if odd else new
        for start in range(0, len(plain), 20_000):
            part = plain[start:start + 20_000]
            found = self.unit.encode(part, is_pretokenized=True, add_special_tokens=False)
            ids, owners = np.array(found.ids, "<u2").tobytes(), np.array(found.word_ids)
            edges = (2 * np.searchsorted(owners, np.arange(len(part) + 1))).tolist()
            self.known.update((u, ids[low:high]) for u, low, high in zip(part, edges, edges[1:]))

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids and the end id, two bytes each."""
        split = [self._units(text) for text in texts]
        every: set[str] = set()
        every.update(*split)
        new = list(every.difference(self.known))
        if len(self.known) + len(new) > CACHE_UNITS:
            self.known.clear()
            new = list(every)
        self._learn(new)
        get = self.known.__getitem__
        return [b"".join(map(get, units)) + self.end for units in split]


def tokenise(docs: DataFrame, path: str, folder: str) -> DataFrame:
    """Store (row, doc_id, n, ids) once; ``row`` numbers the rows of this stored table."""
    source = docs.select("doc_id", "text")
    schema = source.select("doc_id").schema.add("n", "long").add("ids", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = tokens.encode([t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(i) // 2 for i in ids], pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "n", "ids"])

    # Batches of about BATCH_BYTES: a worker holds one with its ids beside what it remembers.
    with bounded_batches(docs.sparkSession, TEXT_BYTES, BATCH_BYTES):
        source.mapInArrow(tidied(run), schema).withColumn("row", F.monotonically_increasing_id()).write.parquet(folder)
    return docs.sparkSession.read.parquet(folder)


# --- the plan --------------------------------------------------------------------------------

def combinations(lengths: Mapping[int, int], window: int, most_triples: int = MAX_TRIPLES) -> np.ndarray:
    """Rows of three lengths (0: none) that fill the window: all pairs that occur, then triples."""
    have = np.zeros(window + 1, bool)
    have[list(lengths)] = True
    have[0] = False
    a = np.arange(1, window // 2 + 1)
    pairs = a[have[a] & have[window - a]]
    rows = [np.stack([window - pairs, pairs, np.zeros_like(pairs)], axis=1)]
    frequent = np.array(sorted(lengths, key=lambda n: (-lengths[n], n)), int)
    side = min(len(frequent), int((2 * most_triples) ** 0.5) * 2)
    x, y = np.meshgrid(frequent[:side], frequent[:side], indexing="ij")
    x, y = x.ravel(), y.ravel()
    z = window - x - y
    good = (x >= y) & (z >= 1) & (z <= y)
    good[good] = have[z[good]]
    triples = np.stack([x[good], y[good], z[good]], axis=1)
    weight = np.array([lengths[n] for n in range(window + 1)] if not isinstance(lengths, dict) else [lengths.get(n, 0) for n in range(window + 1)])
    order = np.lexsort((triples[:, 2], triples[:, 1], triples[:, 0], -weight[triples].min(axis=1))) if len(triples) else np.zeros(0, int)
    return np.concatenate([*rows, triples[order[:most_triples]]]).astype(int)


def solve_repeats(combos: np.ndarray, histogram: np.ndarray, steps: int = 400) -> np.ndarray:
    """x >= 0 that makes the pieces used close to the histogram (accelerated projected gradient).

    The matrix has at most three entries in a column, so products are gathers and scatters.
    """
    size = len(histogram)
    used = lambda x: sum(np.bincount(combos[:, k], x, size) for k in range(3)) * (np.arange(size) > 0)
    goal = histogram.astype(float) * (np.arange(size) > 0)
    # The largest eigenvalue of A'A is at most the largest column sum of |A| times the largest row sum.
    bound = 3.0 * max(1.0, used(np.ones(len(combos))).max())
    x = np.zeros(len(combos))
    y, t = x.copy(), 1.0
    for _ in range(steps):
        rest = goal - used(y)
        rest[0] = 0
        new = np.maximum(0.0, y + rest[combos].sum(axis=1) / bound)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, x, t = new + (t - 1) / t_new * (new - x), new, t_new
    return x


def make_plan(lengths: Mapping[int, int], window: int = WINDOW) -> tuple[list[tuple], list[tuple], list[int]]:
    """Places for the pieces shorter than a window.

    Returns allotments (length, first piece, pieces, first sequence, offset): pieces first,
    first + 1, ... go to sequences first sequence, + 1, ... at the offset; residuals (length, pieces
    placed before, start of the first one left in the stream of residuals); and the sizes of the
    sequences that the end of that stream is cut to.
    """
    histogram = np.zeros(window + 1, np.int64)
    for n, count in lengths.items():
        histogram[n] = count
    left, used, allotments, sequence = histogram.copy(), np.zeros(window + 1, np.int64), [], 0
    combos = combinations(dict(lengths), window)
    if len(combos):
        repeats = solve_repeats(combos, histogram)
        for k in np.argsort(-repeats, kind="stable"):
            parts = [int(n) for n in combos[k] if n]
            need = {n: parts.count(n) for n in parts}
            times = min(int(np.rint(repeats[k])), *(int(left[n]) // m for n, m in need.items()))
            if times <= 0:
                continue
            offset = 0
            for n in parts:
                allotments.append((n, int(used[n]), times, sequence, offset))
                used[n] += times
                left[n] -= times
                offset += n
            sequence += times
    residuals, at = [], 0
    for n in range(window - 1, 0, -1):
        if left[n]:
            residuals.append((n, int(used[n]), at))
            at += n * int(left[n])
    tail, sizes = at % window, []
    while tail:
        sizes.append(1 << (tail.bit_length() - 1))
        tail -= sizes[-1]
    return allotments, residuals, sizes


# --- pieces ----------------------------------------------------------------------------------

def place_pieces(stored: DataFrame, window: int = WINDOW) -> DataFrame:
    """(row, cuts): for each stored document its pieces (start, length, sequence_id, offset).

    The sequences of the plan come first, then the residual stream, then the whole windows.
    """
    spark = stored.sparkSession
    sizes = stored.select("row", "n", (F.col("n") % window).alias("rest"), F.floor(F.col("n") / window).alias("whole"))
    counted = sizes.groupBy("rest").agg(F.count(F.lit(1)).alias("c"), F.sum("whole").alias("w")).collect()  # at most `window` rows
    lengths = {r["rest"]: r["c"] for r in counted if r["rest"]}
    rows, whole_all = sum(r["c"] for r in counted), sum(r["w"] for r in counted)
    allotments, residuals, tail = make_plan(lengths, window)
    planned = max((s + t for _, _, t, s, _ in allotments), default=0)
    stream = max((at + n * (lengths[n] - first) for n, first, at in residuals), default=0)
    full = stream // window
    after = planned + full + len(tail)
    numbered = running_sum(sizes, ["rest"], ["row"], F.lit(1).cast("long"), "k", rows)
    by_length: dict[int, list] = {}
    for n, first, times, sequence, offset in allotments:
        by_length.setdefault(n, []).append((first, times, sequence, offset))
    residual_of = {n: (first, at) for n, first, at in residuals}
    plan = [(n, sorted(by_length.get(n, [])), *residual_of.get(n, (lengths[n], 0))) for n in sorted(lengths)]
    schema = "rest long, places array<struct<first:long,times:long,sequence:long,offset:long>>, kept long, at long"
    places = _plan_table(spark, plan, schema)
    joined = numbered.join(places, "rest", "left")

    # Whole windows get consecutive sequences of their own.
    joined = running_sum(joined, [], ["row"], F.col("whole"), "whole_before", rows) if whole_all else joined.withColumn("whole_before", F.lit(0).cast("long"))
    piece = lambda start, length, sequence, offset: F.struct(
        start.cast("long").alias("start"), length.cast("long").alias("length"), sequence.cast("long").alias("sequence_id"), offset.cast("long").alias("offset"))
    wholes = F.when(F.col("whole") > 0, F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("whole") - 1),
        lambda i: piece(i * window, F.lit(window), F.lit(after) + F.col("whole_before") + i, F.lit(0))))
    start = F.col("whole") * window
    allotted = F.get(F.filter("places", lambda p: (F.col("k") >= p["first"]) & (F.col("k") < p["first"] + p["times"])), F.lit(0))
    by_plan = F.array(piece(start, F.col("rest"), allotted["sequence"] + F.col("k") - allotted["first"], allotted["offset"]))
    # A residual piece covers [low, high) of the stream; it is cut at the ends of sequences.
    low = F.col("at") + (F.col("k") - F.col("kept")) * F.col("rest")
    high = low + F.col("rest")
    edges, bounds = [full * window], []
    for size in tail:
        edges.append(edges[-1] + size)
    whole_cells = F.when(low < full * window, F.sequence(F.floor(low / window), F.least(F.floor((high - 1) / window), F.lit(full - 1))))
    in_full = F.transform(F.coalesce(whole_cells, F.array().cast("array<bigint>")), lambda c: piece(
        start + F.greatest(low, c * window) - low, F.least(high, (c + 1) * window) - F.greatest(low, c * window),
        F.lit(planned) + c, F.greatest(low, c * window) - c * window))
    for j, size in enumerate(tail):
        bounds.append(F.when((low < edges[j + 1]) & (high > edges[j]), piece(
            start + F.greatest(low, F.lit(edges[j])) - low, F.least(high, F.lit(edges[j + 1])) - F.greatest(low, F.lit(edges[j])),
            F.lit(planned + full + j), F.greatest(low, F.lit(edges[j])) - edges[j])))
    in_tail = F.filter(F.array(*bounds), lambda p: p.isNotNull()) if bounds else F.array().cast(_PIECES)
    residual = F.concat(in_full, in_tail)
    rest = F.when(F.col("rest") == 0, F.array().cast(_PIECES)).when(F.col("k") < F.col("kept"), by_plan).otherwise(residual)
    return joined.select("row", F.concat(F.coalesce(wholes, F.array().cast(_PIECES)), rest).alias("cuts"))


_PIECES = "array<struct<start:bigint,length:bigint,sequence_id:bigint,offset:bigint>>"


def _plan_table(spark: SparkSession, plan: list[tuple], schema: str) -> DataFrame:
    named = [(n, [dict(zip(("first", "times", "sequence", "offset"), p)) for p in places], kept, at) for n, places, kept, at in plan]
    return local_table(spark, named, schema)


def cut_pieces(stored: DataFrame, placed: DataFrame) -> DataFrame:
    """Join the ids with their places and check-sum each piece."""
    joined = stored.join(placed.hint("shuffle_hash"), "row").select("doc_id", "n", "ids", "cuts")
    schema = stored.select("doc_id").schema
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    for name in names:
        schema = schema.add(name, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            owners = []
            for i in range(batch.num_rows):
                ids = np.frombuffer(batch.column("ids")[i].as_buffer(), "<u2").astype("<u4")
                n = len(ids)
                for cut in batch.column("cuts")[i].as_py():
                    start, length = cut["start"], cut["length"]
                    owners.append(i)
                    rows.append((start, length, zlib.crc32(ids[start:start + length].tobytes()), n, cut["sequence_id"], cut["offset"]))
            columns = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(owners, pa.int64())), *[pa.array(c, pa.int64()) for c in columns]], names=["doc_id", *names])

    return joined.mapInArrow(tidied(run), schema)


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    stored = tokenise(docs, tokenizer_path, scratch_path(docs.sparkSession, "tokens"))
    return cut_pieces(stored, place_pieces(stored, window))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents", "doc_id", "text"), default_tokenizer())
