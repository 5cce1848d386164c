"""The registered queries: each reads the given tables and returns one DataFrame.

Lists leave as text or as one row per element, so results compare value by value.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.functions import text, timeframe, unicode, vectors
from tidings.operators import boundaries, embed, fetch, frames, gap, kmeans, noise, partition, report, summary, wordpiece
from tidings.operators.domains import suffix_rules, with_registered_domain
from tidings.plans.crawl import crawl
from tidings.plans.digest import run_digest
from tidings.session import cut_lineage, drop_scratch, local_table, scratch_path, spread
from tidings.sources import sinks, vocabulary
from tidings.sources.captures import once, read_captures
from tidings.sources.seeds import as_seeds
from tidings.streaming import closing, digests, timeframes

FULL_DIMS, FULL_K, FULL_REFS, FULL_BLOCK = 768, 30, 50, 4
STREAM_DIMS = 64
FIRST_CAPTURE = 1704067200
DIMS = 8  # of the queries with SQL
SEED = 0
K_MAX = 3
N_REFS = 3
NUM_TAKE = 10
MAX_LEN = 64
PAIR_LEN = 48
COMMON_WORD = 5
PERIOD_MINUTES = 15
PERIOD = "360 minutes"
DIGEST_LABEL = "01-01-24_00-30-00_GMT+0300"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))


def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("features"), "label"
    )


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(once(read_captures(spark, f"{sf_dir}/pages.parquet").select("url", "html")))


def _all_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_seeds(_pages(spark, sf_dir).select("url"))


def _elements(df: DataFrame, keys: list[str], column: str, digits: int) -> DataFrame:
    """One row per vector element, rounded."""
    rows = df.select(*keys, F.posexplode(column).alias("dim", "value"))
    return rows.withColumn("value", F.round("value", digits))


# --- crawl -----------------------------------------------------------------------------------

def seed_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_seeds(spark, sf_dir)


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = fetch.page_content(_all_seeds(spark, sf_dir), _pages(spark, sf_dir))
    return fetch.usable_content(content).select("url", "text")


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetch.page_links(fetch.captured(_all_seeds(spark, sf_dir), _pages(spark, sf_dir)))


def next_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    seeds = _all_seeds(spark, sf_dir)
    links = fetch.page_links(fetch.captured(seeds, _pages(spark, sf_dir)))
    return fetch.next_frontier(links, seeds, suffix_rules(spark))


def _crawl2(spark: SparkSession, sf_dir: str):
    return crawl(_all_seeds(spark, sf_dir), _pages(spark, sf_dir), suffix_rules(spark), depth=2)


def fetch_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    statuses = fetch.fetch_status(_crawl2(spark, sf_dir).frontier, _pages(spark, sf_dir))
    return fetch.status_counts(statuses, "depth")


def crawl_depth2(spark: SparkSession, sf_dir: str) -> DataFrame:
    crawled = _crawl2(spark, sf_dir)
    missing = fetch.failed(crawled.frontier, _pages(spark, sf_dir))
    columns = ["depth", "url", "seed_url", "status", "text"]
    found = crawled.content.withColumn("status", F.lit("ok")).select(*columns)
    lost = missing.withColumn("status", F.lit("failed")).withColumn("text", F.lit(None).cast("string"))
    return found.unionByName(lost.select(*columns))


def crawl_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    crawled = _crawl2(spark, sf_dir)
    pages = _pages(spark, sf_dir)
    links = fetch.page_links(fetch.captured(crawled.frontier.select("url", "seed_url"), pages))
    statuses = fetch.fetch_status(crawled.frontier, pages)
    words = text.words_by_space(F.col("text"))
    vocab = _documents(spark, sf_dir).select(F.explode(words).alias("token")).distinct()
    out = report.crawl_report(links, statuses, crawled.content, vocab)
    return out.select(
        "seed_url", "links", F.round("failed_pct", 6).alias("failed_pct"),
        F.round("unknown_pct", 6).alias("unknown_pct"),
    )


def registered_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    urls = _pages(spark, sf_dir).select("url")
    return with_registered_domain(urls, suffix_rules(spark)).select("url", "domain", "suffix")


# --- text ------------------------------------------------------------------------------------

def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", text.clean(F.col("text")).alias("cleaned"))


def _word_lists(words: Column) -> list[Column]:
    return [F.size(words).cast("bigint").alias("n_words"), F.array_join(words, "|").alias("words")]


def words_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = _documents(spark, sf_dir).select("doc_id", text.words_by_space(F.col("text")).alias("w"))
    return lists.select("doc_id", *_word_lists(F.col("w")))


def words_ws(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = _documents(spark, sf_dir).select("doc_id", text.words_by_whitespace(F.col("text")).alias("w"))
    return lists.select("doc_id", *_word_lists(F.col("w")))


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed.page_sentences(_documents(spark, sf_dir), ["doc_id"])


def learned_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences by boundaries that all documents teach."""
    docs = _documents(spark, sf_dir)
    return boundaries.sentences(docs, boundaries.learn(docs), ["doc_id"])


def word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = _documents(spark, sf_dir).select(text.words_by_space(F.col("text")).alias("words"))
    return report.word_counts(words)


def _document_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = text.words_by_space(F.col("text"))
    return _documents(spark, sf_dir).select("doc_id", F.posexplode(words).alias("at", "token"))


def vocab_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the corpus as a vocabulary line, repeats and all."""
    lines = _document_words(spark, sf_dir).select(F.struct("doc_id", "at").alias("line"), "token")
    return vocabulary.number_tokens(lines, "collide").select("token", "id")


def vocab_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = _document_words(spark, sf_dir).select("token").distinct()
    lines = tokens.select(F.col("token").alias("line"), "token")
    return vocabulary.number_tokens(lines).select("token", "id")


def pretokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = unicode.pretokens(F.col("text"))
    lists = _documents(spark, sf_dir).select("doc_id", words.alias("w"))
    return lists.select("doc_id", F.size("w").cast("bigint").alias("n_words"), F.array_join("w", " ").alias("words"))


def _corpus_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A word-piece vocabulary from the documents: special tokens, then the words met at least
    ``COMMON_WORD`` times, each as a whole word and as a continuation."""
    raws = _documents(spark, sf_dir).select(F.explode(unicode.raw_words(F.col("text"))).alias("raw"))
    counts = raws.groupBy("raw").agg(F.count(F.lit(1)).alias("n"))
    words = counts.select(unicode.normal_word(F.col("raw")).alias("word"), "n").filter(F.col("word") != "")
    common = words.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= COMMON_WORD)
    forms = F.explode(
        F.array(
            F.struct(F.lit(1).alias("kind"), F.col("word").alias("token")),
            F.struct(F.lit(2).alias("kind"), F.concat(F.lit(wordpiece.CONTINUATION), "word").alias("token")),
        )
    )
    special = ["[PAD]", wordpiece.UNK, wordpiece.CLS, wordpiece.SEP]
    first = local_table(spark, [(0, str(i), t) for i, t in enumerate(special)], "kind int, place string, token string")
    rest = common.select(forms.alias("form")).select("form.kind", F.col("form.token").alias("place"), "form.token")
    lines = first.unionByName(rest).select(F.struct("kind", "place").alias("line"), "token")
    return vocabulary.number_tokens(lines)


def _encoded_columns(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(
        *keys,
        F.array_join("tokens", " ").alias("tokens"),
        F.array_join(F.col("token_ids").cast("array<string>"), " ", "null").alias("token_ids"),
        F.array_join(F.col("segments").cast("array<string>"), " ").alias("segments"),
    )


def wordpiece_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = wordpiece.prepare(_corpus_vocabulary(spark, sf_dir))
    encoded = wordpiece.encode(_documents(spark, sf_dir), vocab, ["doc_id"])
    return _encoded_columns(encoded, ["doc_id"]).select("doc_id", "tokens", "token_ids")


def encode_padded(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = wordpiece.prepare(_corpus_vocabulary(spark, sf_dir))
    encoded = wordpiece.encode(_documents(spark, sf_dir), vocab, ["doc_id"], max_len=MAX_LEN)
    return _encoded_columns(encoded, ["doc_id"])


def _encoded_pairs(spark: SparkSession, sf_dir: str, numbered: DataFrame) -> DataFrame:
    pairs = _documents(spark, sf_dir).withColumn("about", F.concat_ws(" ", "lang", "source"))
    return wordpiece.encode(
        pairs, wordpiece.prepare(numbered), ["doc_id"], second="about", max_len=PAIR_LEN
    )


def encode_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _encoded_pairs(spark, sf_dir, _corpus_vocabulary(spark, sf_dir))
    return _encoded_columns(pairs, ["doc_id"])


def decode_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = _corpus_vocabulary(spark, sf_dir)
    decoded = wordpiece.decode(_encoded_pairs(spark, sf_dir, numbered), numbered, ["doc_id"])
    return decoded.select(
        "doc_id", F.array_join("first", " ").alias("first_tokens"), F.array_join("second", " ").alias("second_tokens")
    )


def token_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = wordpiece.prepare(_corpus_vocabulary(spark, sf_dir))
    spans = wordpiece.token_spans(_documents(spark, sf_dir), vocab, ["doc_id"])
    return spans.select("doc_id", "token", F.col("start").alias("start_pos"), F.col("end").alias("end_pos"))


# --- vectors and clusters --------------------------------------------------------------------

def sentence_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = embed.page_sentences(_documents(spark, sf_dir), ["doc_id"])
    found = embed.hashed_sentence_vectors(rows, DIMS, ["doc_id", "pos"])
    return _elements(found, ["doc_id", "pos"], "features", 6)


def bounding_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    column = F.col("features")
    box = _embeddings(spark, sf_dir).agg(
        vectors.min_vectors(column).alias("low"), vectors.max_vectors(column).alias("high")
    )
    rows = box.select(F.posexplode(F.arrays_zip("low", "high")).alias("dim", "edge"))
    return rows.select("dim", F.round("edge.low", 6).alias("low"), F.round("edge.high", 6).alias("high"))


def _label_centres(points: DataFrame) -> np.ndarray:
    """Mean vector of each label: a few fixed centres that need no fit."""
    sums = points.groupBy("label").agg(
        vectors.sum_vectors(F.col("features")).alias("total"), F.count(F.lit(1)).alias("n")
    )
    return np.asarray([np.divide(r.total, r.n) for r in sums.orderBy("label").collect()])


def _label_assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = _embeddings(spark, sf_dir)
    return kmeans.assign(points, _label_centres(points))


def assign_fixed_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned = _label_assigned(spark, sf_dir)
    return assigned.select("vec_id", "cluster", F.round("d2", 6).alias("d2"))


def dispersion_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = kmeans.dispersion(_label_assigned(spark, sf_dir))
    return out.select("cluster", "n", F.round("w", 6).alias("w"))


def largest_cluster_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned = _label_assigned(spark, sf_dir)
    rows = summary.nearest_points(assigned, summary.largest_cluster(assigned), NUM_TAKE, ["vec_id"])
    return rows.select("vec_id", "cluster", F.round("d2", 6).alias("d2"))


def digest_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned = _label_assigned(spark, sf_dir)
    rows = summary.nearest_points(assigned, summary.largest_cluster(assigned), NUM_TAKE, ["vec_id"])
    return _elements(summary.digest_vector(rows), [], "vector", 6)


def null_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = kmeans.bounding_box(_embeddings(spark, sf_dir))
    samples = noise.null_samples(spark, box.n, box.low, box.high, N_REFS, SEED)
    return _elements(samples, ["ref_id", "id"], "features", 9)


def kmeans_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = _embeddings(spark, sf_dir)
    starts = kmeans.first_distinct(points, K_MAX, SEED, ["vec_id"])
    fit = kmeans.fit_block(points, [K_MAX], starts, kmeans.bounding_box(points), seed=SEED)
    rows = [(c, float(n), centre.tolist()) for c, (n, centre) in enumerate(zip(fit.sizes, fit.data_centres(K_MAX)))]
    centres = local_table(spark, rows, "cluster int, n double, centre array<double>")
    return _elements(centres, ["cluster", "n"], "centre", 6)


def _search(spark: SparkSession, sf_dir: str) -> gap.GapSearch:
    points = _embeddings(spark, sf_dir)
    return gap.search(points, ["vec_id"], N_REFS, K_MAX, SEED, block=K_MAX)


def gap_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["gap_value", "sk", "gap_star", "sk_star"]
    return _search(spark, sf_dir).table.select("k", *[F.round(c, 6).alias(c) for c in columns])


def choose_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gap.choose_k(_search(spark, sf_dir).table).select("k")


def digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job: pages to text, sentences, vectors, chosen clusters and the digest."""
    pages = _pages(spark, sf_dir)
    content = fetch.usable_content(fetch.page_content(_all_seeds(spark, sf_dir), pages))
    rows = embed.page_sentences(content)
    points = embed.hashed_sentence_vectors(rows, DIMS, ["url", "pos"])
    message = run_digest(
        points, DIGEST_LABEL, ["url", "pos"], n_refs=FULL_REFS, k_max=FULL_K, seed=SEED, num_take=NUM_TAKE, block=FULL_BLOCK
    )
    return message.select(
        "timeframe", F.posexplode("vector").alias("dim", "value"), F.array_join("sentences", "\n").alias("sentences")
    ).withColumn("value", F.round("value", 6))


# --- at the size of a cluster run: the library's own defaults --------------------------------

def gap_table_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """50 reference samples, K to 30 in blocks of 4."""
    columns = ["gap_value", "sk", "gap_star", "sk_star"]
    found = gap.search(_embeddings(spark, sf_dir), ["vec_id"], seed=SEED)
    return found.table.select("k", F.lit(found.k).cast("int").alias("chosen"), *[F.round(c, 6).alias(c) for c in columns])


def digest_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job with 768 dimensions, 50 reference samples and K to 30."""
    content = fetch.usable_content(fetch.page_content(_all_seeds(spark, sf_dir), _pages(spark, sf_dir)))
    points = embed.hashed_sentence_vectors(embed.page_sentences(content), FULL_DIMS, ["url", "pos"])
    message = run_digest(points, DIGEST_LABEL, ["url", "pos"], seed=SEED, num_take=NUM_TAKE)
    return message.select("timeframe", F.posexplode("vector").alias("dim", "value"), F.array_join("sentences", "\n").alias("sentences"))


def frame_searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every label's points as one timeframe, searched together: the chosen K, NULL where no K is found."""
    points = _embeddings(spark, sf_dir).withColumn(frames.KEY, F.concat(F.lit("label-"), F.col("label").cast("string")))
    layout = frames.lay_out(points, ["vec_id"], FULL_K, SEED)
    try:
        found = frames.search(layout, k_max=FULL_K, seed=SEED)
        tried = found.table.groupBy(frames.KEY).agg(F.count(F.lit(1)).alias("tried"))
        out = layout.frames.select(frames.KEY, "n").join(tried, frames.KEY).join(found.chosen, frames.KEY, "left")
        return cut_lineage(out.select(frames.KEY, "n", "tried", "k"))
    finally:
        layout.points.unpersist()


def capture_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as a stream of captures, one each ten minutes: timeframes close by event time, with their digests."""
    schema = table(spark, sf_dir, "pages").schema
    arrivals = spark.readStream.schema(schema).parquet(f"{sf_dir}/page[s].parquet")
    arrivals = arrivals.select("url", "html", F.timestamp_seconds(F.lit(FIRST_CAPTURE) + F.col("page_id") * 600).alias("fetched_at"))
    base, state = scratch_path(spark, "captures"), scratch_path(spark, "state")
    closing.run_both(arrivals, "fetched_at", base, digests.parsed_captures, digests.closing_outputs(dims=STREAM_DIMS, num_take=NUM_TAKE), state, PERIOD)
    closed = sinks.read_published(spark, base, "closings").select("timeframe", "closing", "n")
    found = sinks.read_published(spark, base, "digest").select("timeframe", F.array_join("sentences", "\n").alias("sentences"), F.size("vector").alias("dims"))
    pages = sinks.read_published(spark, base, "words").groupBy("timeframe").agg(F.count(F.lit(1)).alias("pages"))
    out = cut_lineage(closed.join(pages, "timeframe", "left").join(found, "timeframe", "left"))
    drop_scratch(spark, base)
    drop_scratch(spark, state)
    return out


# --- timeframes, sinks, streams --------------------------------------------------------------

def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def timeframe_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select("event_id", timeframe.next_slot(F.col("ts")).alias("timeframe_end"))


def timeframe_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    ends = timeframe_end(spark, sf_dir)
    return ends.select("event_id", timeframe.label(F.col("timeframe_end")).alias("label"))


def run_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event starts a run that lasts ``value`` minutes: when is the next run due?"""
    runs = _events(spark, sf_dir).select(
        "event_id",
        timeframe.next_slot(F.col("ts")).alias("started"),
        "value",
    )
    finished = F.col("started") + F.make_dt_interval(mins=F.floor("value").cast("int"))
    runs = runs.select("event_id", "started", finished.alias("finished"))
    following = timeframe.next_run(F.col("started"), F.col("finished"), PERIOD_MINUTES)
    moscow = timeframe.in_zone(following.cast("timestamp"), "Europe/Moscow").cast("timestamp_ntz")
    return runs.select("event_id", following.alias("next_run"), moscow.alias("next_run_moscow"))


def _event_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One digest-like row per timeframe of the label centres, for the outbox."""
    points = _embeddings(spark, sf_dir)
    per_label = points.groupBy("label").agg(vectors.sum_vectors(F.col("features")).alias("vector"))
    return per_label.select(F.concat(F.lit("frame-"), F.col("label").cast("string")).alias("timeframe"), "vector")


def outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = sinks.outbox(_event_vectors(spark, sf_dir))
    body = F.from_json("value", "time string, vector array<double>")
    parsed = messages.select("key", body.alias("body")).select("key", "body.time", "body.vector")
    return _elements(parsed, ["key", "time"], "vector", 6)


def save_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the three text tables of all pages under one timeframe, then read them back."""
    pages = _pages(spark, sf_dir)
    content = fetch.usable_content(fetch.page_content(_all_seeds(spark, sf_dir), pages))
    named = content.select("url", "text", F.lit(DIGEST_LABEL).alias("timeframe"))
    numbered = _corpus_vocabulary(spark, sf_dir)
    keys = ["url", "timeframe"]
    cleaned = named.select(*keys, text.clean(F.col("text")).alias("text"))
    base = scratch_path(spark, "tables")
    sinks.save_tables(
        {
            "token_ids": wordpiece.encode(cleaned, wordpiece.prepare(numbered), keys).select(
                *keys, F.col("token_ids").alias("items")
            ),
            "words": named.select(*keys, text.words_by_space(F.col("text")).alias("items")),
            "sentences": named.select(*keys, text.sentences(F.col("text")).alias("items")),
        },
        base,
    )
    listed = [
        sinks.read_table(spark, base, name).select(
            "timeframe", F.lit(name).alias("table_name"), "url", F.array_join("items", "|").alias("items")
        )
        for name in sinks.TABLES
    ]
    out = cut_lineage(listed[0].unionByName(listed[1]).unionByName(listed[2]))
    drop_scratch(spark, base)
    return out


def stream_timeframes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream of arrivals: every touched timeframe is recomputed from what landed."""
    schema = _events(spark, sf_dir).schema
    # A file stream wants a folder or a pattern; this pattern also takes a table in one file.
    arrivals = spark.readStream.schema(schema).parquet(f"{sf_dir}/event[s].parquet")
    base = scratch_path(spark, "stream")

    def summarise(landed: DataFrame) -> DataFrame:
        return landed.groupBy("timeframe").agg(
            F.count(F.lit(1)).alias("n"),
            F.countDistinct("user_id").alias("users"),
            F.sum("value").alias("total"),
        )

    timeframes.run_available(arrivals, "ts", base, {"summary": summarise}, PERIOD)
    out = cut_lineage(
        sinks.read_table(spark, base, "summary").select("timeframe", "n", "users", F.round("total", 4).alias("total"))
    )
    drop_scratch(spark, base)
    return out


class _AnchorHandler:
    """Counts anchors per page with compiled state that lives as long as its partition."""

    def __enter__(self):
        import re

        self.anchor = re.compile(r"<a\s")
        return self

    def rows(self, row):
        found = len(self.anchor.findall(row["html"]))
        return [{"url": row["url"], "anchors": found}] if found else None

    def __exit__(self, *error):
        self.anchor = None


def partition_handler(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = T.StructType([T.StructField("url", T.StringType()), T.StructField("anchors", T.LongType())])
    return partition.map_rows(_pages(spark, sf_dir).select("url", "html"), _AnchorHandler, schema)


@cache
def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    queries = [
        seed_frontier, page_text, page_links, next_frontier, fetch_status, crawl_depth2,
        crawl_report, registered_domain, clean_text, words_space, words_ws, sentences,
        word_counts, vocab_build, vocab_unique, pretokens, wordpiece_ids, encode_padded,
        encode_pair, decode_tokens, token_spans, sentence_vectors, bounding_box,
        assign_fixed_centres, dispersion_fixed, largest_cluster_topn, digest_vector, null_samples,
        kmeans_fit, gap_table, choose_k, digest, timeframe_end, timeframe_label, run_schedule,
        outbox, save_tables, stream_timeframes, partition_handler, gap_table_full, digest_full,
        frame_searches, capture_stream, learned_sentences,
    ]
    return {query.__name__: query for query in queries}
