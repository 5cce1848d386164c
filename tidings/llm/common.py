"""Helpers shared by the operators of this package."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a table; other columns never meet the operators' own names."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def tidied(function: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function of batches that gives memory back after each batch that it tells, and at its end.

    Spark reuses worker processes, and both Arrow's pool and the C library keep what was freed.
    """

    def run(batches: Iterator) -> Iterator:
        import ctypes

        def give_back() -> None:
            pa.default_memory_pool().release_unused()
            if hasattr(ctypes.CDLL(None), "malloc_trim"):
                ctypes.CDLL(None).malloc_trim(0)

        def watched() -> Iterator:
            for batch in batches:
                yield batch
                del batch
                give_back()

        try:
            yield from function(watched())
        finally:
            give_back()

    return run


def remainder(column: Column, modulus: int) -> Column:
    """crc32 of the value as text, modulo ``modulus`` (NULL counts as the empty text)."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def running_sum(
    df: DataFrame, groups: Sequence[str], order: Sequence[str], amount: Column, name: str, rows: int
) -> DataFrame:
    """Add the sum of ``amount`` over the earlier rows of each group, in the order of a hash.

    A group may hold most rows, so it is never put into one task: rows fall by the hash of
    ``order`` into about sqrt(rows) ranges; each range of a group adds up by itself, and only
    one number per group and range is added up across ranges. Rows that agree in ``order``
    follow each other in an arbitrary order, so they should agree in all that matters.
    """
    ranges = max(16, math.isqrt(max(rows, 1)))
    hashed = df.withColumn("_range", F.pmod(F.xxhash64(*order), F.lit(ranges))).withColumn("_amount", amount)
    by = [F.col(g) for g in groups]
    before = Window.unboundedPreceding, -1
    totals = hashed.groupBy(*by, "_range").agg(F.sum("_amount").alias("_total"))
    starts = totals.select(
        *by, F.col("_range"),
        F.coalesce(F.sum("_total").over(Window.partitionBy(*by).orderBy("_range").rowsBetween(*before)), F.lit(0)).alias("_start"),
    )
    inside = Window.partitionBy(*by, "_range").orderBy(*order).rowsBetween(*before)
    summed = hashed.withColumn("_inside", F.coalesce(F.sum("_amount").over(inside), F.lit(0)))
    left, right = summed.alias("l"), starts.alias("r")
    on = [F.col(f"l.{g}").eqNullSafe(F.col(f"r.{g}")) for g in [*groups, "_range"]]
    condition = on[0]
    for part in on[1:]:
        condition = condition & part
    return left.join(right, condition).select(
        *[F.col(f"l.{c}") for c in df.columns], (F.col("l._inside") + F.col("r._start")).alias(name)
    )
