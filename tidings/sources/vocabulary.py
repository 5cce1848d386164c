"""Vocabulary: numbered tokens from a file or from a table of lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.functions.text import WHITESPACE_CHARS
from tidings.operators.numbering import running_count
from tidings.session import cut_lineage


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(line, token)`` of a text file: line numbers from 0, tokens stripped."""
    lines = spark.read.text(path).select(
        F.btrim("value", F.lit(WHITESPACE_CHARS)).alias("token"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_read"),
    )
    numbered = running_count(lines, ["_file", "_block", "_read"], name="line")
    return numbered.select("line", "token")


def number_tokens(lines: DataFrame, duplicates: str = "reject") -> DataFrame:
    """``(token, id, line)`` for ``(line, token)``; ``line`` is the token's first line.

    ``reject``: tokens must be unique and are numbered in line order. ``collide``: a repeated
    token takes the number of different tokens read so far, which the next new token then takes
    too; so an id is the number of tokens first seen before the token's last line.
    """
    if duplicates not in ("reject", "collide"):
        raise ValueError("duplicates must be 'reject' or 'collide'")
    # Stored once: the checks and the numbering below read it several times.
    seen = cut_lineage(
        lines.groupBy("token").agg(
            F.min("line").alias("line"), F.max("line").alias("_last"), F.count(F.lit(1)).alias("_times")
        )
    )
    if duplicates == "reject":
        repeated = seen.filter("_times > 1").select("token").limit(5).collect()
        if repeated:
            raise ValueError(f"repeated vocabulary tokens: {[row.token for row in repeated]}")
        return running_count(seen.select("token", "line"), ["line"], name="id").select(
            "token", "id", "line"
        )
    # Both ends of each token on one axis: a last line counts the first lines before it.
    ends = F.explode(
        F.array(
            F.struct(F.col("line").alias("at"), F.lit(True).alias("first")),
            F.struct(F.col("_last").alias("at"), F.lit(False).alias("first")),
        )
    )
    axis = seen.select("token", "line", ends.alias("end")).select("token", "line", "end.at", "end.first")
    counted = running_count(axis, ["at", "first"], F.col("first"), name="id")
    return counted.filter(~F.col("first")).select("token", "id", "line")


def read_vocabulary(spark: SparkSession, path: str, duplicates: str = "reject") -> DataFrame:
    """``(token, id, line)`` of a vocabulary file."""
    return number_tokens(read_lines(spark, path), duplicates)
