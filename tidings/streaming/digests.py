"""What a stream of captures keeps per timeframe: the text tables and the digest."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.functions import html, text
from tidings.operators import embed, fetch, frames, wordpiece
from tidings.plans.digest import DIGEST_SCHEMA, run_digest
from tidings.session import cut_lineage, local_table
from tidings.sources import sinks
from tidings.streaming.closing import Outputs
from tidings.streaming.timeframes import Recompute

DigestOf = Callable[[DataFrame, str], DataFrame]


def landed_content(landed: DataFrame) -> DataFrame:
    """``(timeframe, url, text)`` of usable pages; a page captured twice counts once per text."""
    shown = landed.select("timeframe", "url", html.visible_text(F.col("html")).alias("text"))
    return fetch.usable_content(shown).distinct()


def digests_per_timeframe(landed: DataFrame, digest_of: DigestOf) -> DataFrame:
    """Digest of each timeframe in ``landed``: one search per timeframe, a few per batch.

    A timeframe without a digest gets a row with NULL fields, so that it replaces a digest that an
    earlier batch may have written; ``read_digests`` leaves such rows out.
    """
    spark = landed.sparkSession
    labels = [r.timeframe for r in landed.select("timeframe").distinct().orderBy("timeframe").collect()]
    every = local_table(spark, [(label,) for label in labels], "timeframe string")
    if not labels:
        return every.join(local_table(spark, [], DIGEST_SCHEMA), "timeframe", "left")
    found = [
        digest_of(landed.filter(F.col("timeframe") == label).drop("timeframe"), label) for label in labels
    ]
    return every.join(reduce(DataFrame.unionByName, found), "timeframe", "left")


def parsed_captures(rows: DataFrame) -> DataFrame:
    """``(timeframe, url, version, text)`` of usable pages: what ``closing.land`` keeps of captures."""
    shown = rows.select("timeframe", "url", html.visible_text(F.col("html")).alias("text"))
    return fetch.usable_content(shown).withColumn("version", F.xxhash64("text"))


def closing_outputs(dims: int = 768, vocab: wordpiece.Vocabulary | None = None, **search: Any) -> Outputs:
    """Outputs for ``closing.close`` over parsed captures: words, sentences, token ids (with a vocabulary),
    digests and their messages, for all closing timeframes at once. ``search`` goes to ``frames.digests``.

    A page captured twice in a timeframe counts once per text. A timeframe without a digest has no row.
    """
    keys = ["timeframe", "url"]

    def outputs(landed: DataFrame) -> dict[str, DataFrame]:
        content = cut_lineage(landed.select(*keys, "version", "text").dropDuplicates([*keys, "version"]))
        rows = embed.page_sentences(content, [*keys, "version"])
        points = embed.hashed_sentence_vectors(rows, dims, [*keys, "version", "pos"])
        digest = cut_lineage(frames.digests(points, ["url", "version", "pos"], **search))
        tables = {
            "words": content.select(*keys, text.words_by_space(F.col("text")).alias("items")),
            "sentences": content.select(*keys, text.sentences(F.col("text")).alias("items")),
            "digest": digest,
            "outbox": sinks.outbox(digest).withColumn("timeframe", F.col("key")),
        }
        if vocab is not None:
            cleaned = content.select(*keys, "version", text.clean(F.col("text")).alias("text"))
            encoded = wordpiece.encode(cleaned, vocab, [*keys, "version"])
            tables["token_ids"] = encoded.select(*keys, F.col("token_ids").alias("items"))
        return tables

    return outputs


def read_digests(spark: SparkSession, base_path: str) -> DataFrame:
    return sinks.read_table(spark, base_path, "digest").filter(F.col("vector").isNotNull())


def capture_outputs(
    dims: int = 64, vocab: wordpiece.Vocabulary | None = None, **search: Any
) -> dict[str, Recompute]:
    """Functions for ``stream_writer`` over arrivals with ``url`` and ``html``.

    They give words, sentences, token ids (with a vocabulary) and the digest; ``search`` goes to
    ``run_digest``.
    """
    keys = ["timeframe", "url"]

    def words(landed: DataFrame) -> DataFrame:
        return landed_content(landed).select(*keys, text.words_by_space(F.col("text")).alias("items"))

    def sentences(landed: DataFrame) -> DataFrame:
        return landed_content(landed).select(*keys, text.sentences(F.col("text")).alias("items"))

    def token_ids(landed: DataFrame) -> DataFrame:
        # The hash tells two versions of one page apart.
        cleaned = landed_content(landed).select(
            *keys, F.xxhash64("text").alias("version"), text.clean(F.col("text")).alias("text")
        )
        encoded = wordpiece.encode(cleaned, vocab, [*keys, "version"])
        return encoded.select(*keys, F.col("token_ids").alias("items"))

    def digest(landed: DataFrame) -> DataFrame:
        def of_one(part: DataFrame, label: str) -> DataFrame:
            content = landed_content(part.withColumn("timeframe", F.lit(label)))
            content = content.select("url", F.xxhash64("text").alias("version"), "text")
            rows = embed.page_sentences(content, ["url", "version"])
            ids = ["url", "version", "pos"]
            return run_digest(embed.hashed_sentence_vectors(rows, dims, ids), label, ids, **search)

        return digests_per_timeframe(landed, of_one)

    outputs = {"words": words, "sentences": sentences, "digest": digest}
    return outputs | ({"token_ids": token_ids} if vocab is not None else {})
