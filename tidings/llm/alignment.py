"""Alignment of two tokenizers over whole texts, by pointer jumping.

Tokenizer A is a byte-level BPE and encodes a space and the text; B is a piece model, which adds that
space itself. Tokens of A and B are linked where their byte ranges overlap; the components of the links
are groups, cut at the bytes where tokens of both end.

Every token points to the token of the other tokenizer that overlaps it and reaches farthest to the
right; where tokens of both end at a byte, the one of B points to the one of A and that to itself.
Doubling the successors of all tokens at once (``to = to[to]``) leads each token to the last token of its
group, which labels it.

Both tokenizers cut a text before a space that follows other than white space, so a text is split there,
and each distinct chunk is encoded and aligned once, all chunks of a batch together; a task remembers
a bounded number of them. (If a piece of B could span such a place, texts would stay whole.)

1. Tasks count their chunks; the links of a chunk count as often as it occurs. Spark adds the pairs up.
2. The pairs seen most, at most ``BROADCAST_PAIRS``, go to all tasks, which add up counts and best
   pairs of their texts. Texts that hold other pairs list them; those are joined with their counts.

Defined cases: texts that are NULL, empty, or not given back by both tokenizers byte by byte (such as
those with U+2581) have no tokens, zeros and empty groups, and their links count nowhere; each row of
a repeated doc_id is a document; texts of any length are aligned whole; ties of the highest count are
all best; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.llm.common import table, tidied
from tidings.session import cut_lineage, drop_scratch, scratch_path

BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"
BROADCAST_PAIRS = 1_000_000  # of 17 bytes
CACHE_CHUNKS, CACHE_CHARS = 300_000, 6_000_000
JOINED, SHORT = 2000, 100  # chunks that are encoded as one text, and their characters
# Fixed value: how the byte-level BPE cuts a text before it merges.
PRETOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PENDING_LINKS = 4_000_000  # that a task counts at a time
SLICE = 128  # texts that a task holds as Python objects at a time
NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "n_rare"]


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable Latin-1 as itself, others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers, with the bytes of every token."""

    def __init__(self, byte_path: str, piece_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(byte_path), sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.a.encode_special_tokens = True
        letters = byte_letters()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(map(letters.get, token)) if all(c in letters for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.quick = self._quick(byte_path, letters)
        self.sizes = tuple(np.array([len(x) for x in y], np.int64) for y in (self.a_bytes, self.b_bytes))
        self.separate = not any(re.search("[^▁]▁", p) for p in pieces)
        self.width = len(pieces)

    def _quick(self, byte_path: str, letters: dict[str, int]):
        """The same byte-level BPE by ranks, which short words take a fraction of the time in; None for another kind of file."""
        import tiktoken

        with open(byte_path, encoding="utf-8") as file:
            parts = json.load(file)
        merges = [m if isinstance(m, list) else m.split(" ") for m in parts["model"]["merges"]]
        before, vocab = parts["pre_tokenizer"] or {}, parts["model"]["vocab"]
        plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and not parts["normalizer"]
        if not plain or any(vocab.get(a + b) != 256 + i for i, (a, b) in enumerate(merges)):
            return None
        ranks = {bytes(map(letters.__getitem__, t)): i for t, i in vocab.items() if i < 256 + len(merges) and all(c in letters for c in t)}
        return tiktoken.Encoding("a", pat_str=PRETOKENS, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(self, chunks: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and B for chunks without their leading space, each by itself."""
        a = [e.ids for e in self.a.encode_batch_fast([" " + c for c in chunks], add_special_tokens=False)]
        return a, self.b.encode(chunks, num_threads=1)

    def encode_joined(self, chunks: list[str]) -> tuple[tuple[np.ndarray, np.ndarray], ...] | None:
        """For A and B the ids of all chunks and their number in each, from one text; None if it is not given back chunk by chunk."""
        text = " ".join(chunks)
        raw = (" " + text).encode("utf-8", "replace")
        bounds = np.cumsum([len(c.encode("utf-8", "replace")) + 1 for c in chunks])
        out = []
        for ids, spelled, sizes in (
            (self.quick(" " + text) if self.quick else self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, self.a_bytes, self.sizes[0]),
            (self.b.encode(text), self.b_bytes, self.sizes[1]),
        ):
            if b"".join(map(spelled.__getitem__, ids)) != raw:
                return None
            found = np.array(ids, np.int64)
            ends = np.cumsum(sizes[found])
            last = np.searchsorted(ends, bounds)
            if not np.array_equal(ends[last], bounds):
                return None
            out.append((found, np.diff(last + 1, prepend=0)))
        return tuple(out)


IRREGULAR, CUTS = re.compile(r"\s | \Z"), re.compile(r"(?<=\S) (?=.)", re.DOTALL)


def split_chunks(text: str, separate: bool = True) -> list[str]:
    """The chunks of a space and the text, each without its leading space."""
    if not separate:
        return [text]
    if not IRREGULAR.search(" " + text):
        return text.split(" ")
    first, *rest = CUTS.split(" " + text)
    return [first[1:], *rest]


# --- alignment of token ends -----------------------------------------------------------------

def terminals(a_end: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """For all tokens (those of A first) the token of A that ends their group; ends are sorted, the last ones equal."""
    n = len(a_end)
    over_a = np.searchsorted(b_end, a_end)  # the token of B that holds the last byte of a token of A
    over_b = np.searchsorted(a_end, b_end)
    to = np.concatenate([np.where(b_end[over_a] > a_end, n + over_a, np.arange(n)), over_b])
    while True:
        jumped = to[to]
        if np.array_equal(jumped, to):
            return to
        to = jumped


def links(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping tokens, as indexes of A and of B."""
    low = np.searchsorted(b_end, np.r_[0, a_end[:-1]], side="right")
    many = np.searchsorted(b_end, a_end) - low + 1
    one = np.repeat(np.arange(len(a_end)), many)
    return one, np.arange(len(one)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)


class Aligned:
    """What is known of chunks: numbers, groups in decimal, and the codes of their links."""

    def __init__(self, tokenizers: Tokenizers, counts: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None, groups: bool = True):
        self.tokenizers, self.counts, self.groups = tokenizers, counts, groups
        self.names = [[b"%d" % i for i in range(len(x))] for x in (tokenizers.a_bytes, tokenizers.b_bytes)]
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.numbers = np.zeros((1024, len(NUMBERS)), np.int64)  # n_a = 0: not given back
        self.texts: list[bytes] = []
        self.rare: dict[int, np.ndarray] = {}  # codes of links that the counts do not hold
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []  # without counts: places of chunks, and the codes of their links
        self.chars = 0

    def is_full(self) -> bool:
        return len(self.known) > CACHE_CHUNKS or self.chars > CACHE_CHARS

    def learn(self, lists: list[list[str]]) -> None:
        every: set[str] = set()
        every.update(*lists)
        new = list(every.difference(self.known))
        if not new:
            return
        base = len(self.known)
        self.known.update(zip(new, range(base, base + len(new))))
        self.chars += sum(map(len, new))
        while len(self.numbers) < base + len(new):
            self.numbers = np.concatenate([self.numbers, np.zeros_like(self.numbers)])
        self.texts += [b""] * len(new)
        # Long chunks, those that end with white space, and those that may not be given back are encoded by themselves.
        joined = self.tokenizers.separate
        plain = [k for k, c in enumerate(new) if joined and 0 < len(c) <= SHORT and "\u2581" not in c and not c[-1].isspace()]
        odd = sorted(set(range(len(new))).difference(plain))
        for low in range(0, len(plain), JOINED):
            mine = plain[low:low + JOINED]
            found = self.tokenizers.encode_joined([new[k] for k in mine])
            if found is None:
                odd += mine
            else:
                (a, n_a), (b, n_b) = found
                self._align(np.array(mine) + base, a, b, n_a, n_b)
        if odd:
            self._learn_each(base, odd, [new[k] for k in odd])

    def _learn_each(self, base: int, places: list[int], chunks: list[str]) -> None:
        a_ids, b_ids = self.tokenizers.encode(chunks)
        a_of, b_of = self.tokenizers.a_bytes.__getitem__, self.tokenizers.b_bytes.__getitem__
        given = [
            k for k, (c, a, b) in enumerate(zip(chunks, a_ids, b_ids))
            if b"".join(map(a_of, a)) == (text := b" " + c.encode("utf-8", "replace")) and b"".join(map(b_of, b)) == text]
        if given:
            flat = [np.fromiter(itertools.chain.from_iterable(ids[k] for k in given), np.int64) for ids in (a_ids, b_ids)]
            self._align(np.array([places[k] for k in given]) + base, *flat, *(np.array([len(ids[k]) for k in given]) for ids in (a_ids, b_ids)))

    def _align(self, place: np.ndarray, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> None:
        a_end, b_end = (np.cumsum(size[ids]) for size, ids in zip(self.tokenizers.sizes, (a, b)))
        to = terminals(a_end, b_end)
        one, two = links(a_end, b_end)
        a_owner = np.repeat(np.arange(len(place)), n_a)
        n_links = np.bincount(a_owner[one], minlength=len(place))
        n_groups = np.bincount(a_owner[to[:len(a)] == np.arange(len(a))], minlength=len(place))
        codes = a[one] * self.tokenizers.width + b[two]
        self.numbers[place, :4] = np.stack([n_a, n_b, n_groups, n_links], axis=1)
        if self.counts is None:
            self.parts.append((place, codes))
        else:
            known, n, best = self.counts
            at = np.minimum(np.searchsorted(known, codes), max(0, len(known) - 1))
            hit = known[at] == codes if len(known) else np.zeros(len(codes), bool)
            starts = np.cumsum(n_links) - n_links
            values = (best[at] & hit, n[at] * hit, ~hit) if len(known) else (hit, hit, ~hit)
            self.numbers[place, 4:] = np.stack([np.add.reduceat(v.astype(np.int64), starts) for v in values], axis=1)
            for k in np.flatnonzero(self.numbers[place, 6]).tolist():
                mine = slice(starts[k], starts[k] + n_links[k])
                self.rare[int(place[k])] = codes[mine][~hit[mine]]
        if self.groups:
            self._write(place, a, b, n_a + n_b, to)

    def _write(self, place: np.ndarray, a: np.ndarray, b: np.ndarray, sizes: np.ndarray, to: np.ndarray) -> None:
        """Groups in order, the ids of A before those of B."""
        side = np.repeat([0, 1], [len(a), len(b)])
        order = np.argsort(to * 2 + side, kind="stable")
        label, side, ids = to[order], side[order], np.concatenate([a, b])[order]
        after = np.where(label[1:] != label[:-1], 2, np.where(side[1:] != side[:-1], 1, 0))
        marks, names = (b",", b"|", b";", b""), self.names
        ends = np.cumsum(sizes)
        after = np.r_[after, 3]
        after[ends - 1] = 3
        parts = [names[s][i] + marks[m] for s, i, m in zip(side.tolist(), ids.tolist(), after.tolist())]
        for k, low, high in zip(place.tolist(), (ends - sizes).tolist(), ends.tolist()):
            self.texts[k] = b"".join(parts[low:high])

    def places(self, chunks: list[str]) -> np.ndarray:
        return np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks))


def _slices(batches: Iterator[pa.RecordBatch], separate: bool) -> Iterator[tuple[pa.RecordBatch, list[list[str]]]]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            yield part, [split_chunks(t, separate) if t else [] for t in part.column("text").to_pylist()]


# --- the jobs --------------------------------------------------------------------------------

def pair_counts(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """(code, n): how many links of all texts hold each pair of ids; code is the id of A times the size of B plus the id of B."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = Tokenizers(byte_path, piece_path)
        aligned = Aligned(tokenizers, groups=False)
        times = np.zeros(0, np.int64)

        def told() -> Iterator[pa.RecordBatch]:
            """The links of the chunks so far, as often as the chunks occur."""
            held, links_held = [], 0
            for last, (place, codes) in enumerate(aligned.parts, 1):
                used = times[place] if len(times) else np.zeros(len(place), np.int64)
                weights = np.repeat(used, aligned.numbers[place, 3])
                held.append((codes[weights > 0], weights[weights > 0]))
                links_held += len(codes)
                if links_held > PENDING_LINKS or last == len(aligned.parts):
                    flat, inverse = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
                    n = np.zeros(len(flat), np.int64)
                    np.add.at(n, inverse, np.concatenate([h[1] for h in held]))
                    yield pa.RecordBatch.from_arrays([pa.array(flat), pa.array(n)], names=["code", "n"])
                    held, links_held = [], 0

        for _, lists in _slices(batches, tokenizers.separate):
            if aligned.is_full():
                yield from told()
                aligned.clear()
                times = np.zeros(0, np.int64)
            aligned.learn(lists)
            found = [p for p in map(aligned.places, lists) if len(p) and aligned.numbers[p, 0].all()]
            if found:
                now = np.bincount(np.concatenate(found), minlength=len(aligned.known))
                now[:len(times)] += times
                times = now
        yield from told()

    return docs.select("text").mapInArrow(tidied(run), "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def with_best(counts: DataFrame, width: int) -> DataFrame:
    """Add whether a pair's count is the highest of its id of B; there are at most ``width`` such ids."""
    keyed = counts.withColumn("b", F.col("code") % width)
    highest = keyed.groupBy("b").agg(F.max("n").alias("most"))
    return keyed.join(F.broadcast(highest), "b").select("code", "n", (F.col("n") == F.col("most")).alias("best"))


def frequent(counts: DataFrame, most: int) -> int:
    """The least count, at the edge of a step of about a tenth, from which on there are at most ``most`` pairs."""
    step = F.floor(F.log2("n") * 8)
    steps = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("pairs"), F.min("n").alias("least")).orderBy(F.desc("step")).collect()
    least, pairs = (1 << 62), 0
    for row in steps:  # at most 8 steps for each power of two
        pairs += row["pairs"]
        if pairs > most:
            break
        least = row["least"]
    return least


def align(docs: DataFrame, byte_path: str, piece_path: str, digest: bool = False, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups): groups as ``a1,a2|b1;a3|b2,b3``.

    ``digest`` gives ``groups_sha256`` in place of the groups.
    """
    spark, source = docs.sparkSession, docs.select("doc_id", "text")
    width = _piece_count(piece_path)
    counts = cut_lineage(with_best(cut_lineage(pair_counts(source, byte_path, piece_path)), width))
    least = frequent(counts, broadcast_pairs)
    often = counts.where(F.col("n") >= least).toArrow().sort_by("code")
    shared = spark.sparkContext.broadcast(tuple(often.column(c).to_numpy() for c in ("code", "n", "best")))
    schema = source.select("doc_id").schema
    for name in NUMBERS[:-1]:
        schema = schema.add(name, "long")
    schema = schema.add("rare", T.ArrayType(T.LongType())).add("groups", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = Tokenizers(byte_path, piece_path)
        aligned = Aligned(tokenizers, shared.value)
        for part, lists in _slices(batches, tokenizers.separate):
            if aligned.is_full():
                aligned.clear()
            aligned.learn(lists)
            numbers = np.zeros((len(lists), len(NUMBERS)), np.int64)
            groups, rare = [b""] * len(lists), [[]] * len(lists)
            for i, chunks in enumerate(lists):
                places = aligned.places(chunks)
                if not len(places) or not (found := aligned.numbers[places])[:, 0].all():
                    continue
                numbers[i] = found.sum(axis=0)
                groups[i] = b";".join(map(aligned.texts.__getitem__, places.tolist()))
                if numbers[i, 6]:
                    rare[i] = np.concatenate([aligned.rare[k] for k in places[found[:, 6] > 0].tolist()]).tolist()
            columns = [pa.array(np.ascontiguousarray(numbers[:, k])) for k in range(6)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *columns, pa.array(rare, pa.list_(pa.int64())), pa.array(groups, pa.binary()).cast(pa.string())], names=schema.names)

    out = source.mapInArrow(tidied(run), schema)
    if digest:
        out = out.withColumn("groups_sha256", F.when(F.col("n_a") == 0, "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))).drop("groups")
    rest = counts.where(F.col("n") < least)
    return out.drop("rare") if rest.isEmpty() else _with_rare(out, rest)


def _with_rare(out: DataFrame, rest: DataFrame) -> DataFrame:
    """Add counts and best pairs of the links that were not broadcast."""
    spark = out.sparkSession
    folder = scratch_path(spark, "aligned")
    out.withColumn("row", F.monotonically_increasing_id()).write.parquet(folder)
    stored = spark.read.parquet(folder)
    each = stored.where(F.size("rare") > 0).select("row", F.explode("rare").alias("code")).groupBy("row", "code").agg(F.count(F.lit(1)).alias("times"))
    more = each.join(rest, "code").groupBy("row").agg(
        F.sum(F.col("times") * F.col("n")).alias("more_sum"), F.sum(F.col("times") * F.col("best").cast("long")).alias("more_best"))
    joined = stored.join(more, "row", "left").withColumns({
        "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0))})
    result = cut_lineage(joined.select([c for c in out.columns if c != "rare"]))
    drop_scratch(spark, folder)
    return result


def _piece_count(path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path).vocab_size()


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents", "doc_id", "text"), *default_paths(), digest=True)
