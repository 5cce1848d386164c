"""Word counts and the quality report of a crawl."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.functions import text
from tidings.operators.joins import lookup_join


def word_counts(words: DataFrame, words_col: str = "words") -> DataFrame:
    """``(word, n)`` over all word lists."""
    return words.select(F.explode(words_col).alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")
    )


def crawl_report(
    links: DataFrame, statuses: DataFrame, content: DataFrame, vocab: DataFrame
) -> DataFrame:
    """Per seed: links found, percent of pages that failed, percent of words not in ``vocab``.

    Words are counted per seed before they meet the vocabulary, so a word that fills the pages is
    one row per seed in the join.
    """
    link_counts = links.groupBy("seed_url").agg(F.count(F.lit(1)).alias("links"))
    failures = statuses.groupBy("seed_url").agg(
        (100 * F.avg((F.col("status") == "failed").cast("int"))).alias("failed_pct")
    )
    words = content.select("seed_url", F.explode(text.words_by_space(F.col("text"))).alias("token"))
    counted = words.groupBy("seed_url", "token").agg(F.count(F.lit(1)).alias("n"))
    known = vocab.select("token").distinct().withColumn("known", F.lit(True))
    checked = lookup_join(counted, known, "token")
    missing = checked.groupBy("seed_url").agg(
        (100 * F.sum(F.when(F.col("known").isNull(), F.col("n")).otherwise(0)) / F.sum("n")).alias("unknown_pct")
    )
    return (
        failures.join(link_counts, "seed_url", "left")
        .join(missing, "seed_url", "left")
        .select("seed_url", F.coalesce("links", F.lit(0)).alias("links"), "failed_pct", "unknown_pct")
    )
