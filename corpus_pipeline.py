"""From raw documents to packed token windows: five stages, each written and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidings.llm import langid, mixing, packing, secrets, sketchjoin
from tidings.session import drop_scratch, scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or that fit no learned language, go."""
    return langid.keep_identified(docs, langid.fit(docs.select("doc_id", "text", "lang")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents stays."""
    return sketchjoin.one_of_each(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts."""
    return secrets.redact(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents occur as often as the mix of sources takes them."""
    return mixing.apply_mix(docs)


def packing_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents become pieces of token sequences."""
    return packing.pack(docs, packing.default_tokenizer())


STAGES: list[tuple[str, Stage]] = [
    ("language ID", language_id),
    ("near duplicates", near_duplicates),
    ("secret scans", secret_scans),
    ("mixing", mixing_sources),
    ("packing", packing_windows),
]

ORACLE_SQL = None  # SQL has no recurrent network and no tokenizer; tests compare with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES:
        folder = scratch_path(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
        if before:
            drop_scratch(spark, before)
        before = folder
    return docs
