"""Numbering rows in a total order without putting all rows into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidings.session import cut_lineage

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def running_count(
    df: DataFrame, order: Sequence[str], flag: Column | None = None, name: str = "position"
) -> DataFrame:
    """Add the number of earlier rows (those with ``flag``, if given) in the given order.

    ``order`` must be a total order. Rows are range-partitioned and stored, so that both steps
    see the same ranges; then each range counts by itself and only one number per range is
    added up.
    """
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    row = F.monotonically_increasing_id()
    counted = F.lit(1) if flag is None else F.when(flag, 1).otherwise(0)
    stored = cut_lineage(
        ordered.select(
            *df.columns,
            F.shiftright(row, _ROW_BITS).alias("_range"),
            row.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_row"),
            counted.cast("bigint").alias("_counted"),
        )
    )
    earlier_ranges = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        stored.groupBy("_range").agg(F.sum("_counted").alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(earlier_ranges), F.lit(0)).alias("_start"))
    )
    if flag is None:
        inside = stored.withColumn("_inside", F.col("_row"))
    else:
        # One window group per range: an even share of the rows by construction.
        earlier_rows = (
            Window.partitionBy("_range").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
        )
        inside = stored.withColumn(
            "_inside", F.coalesce(F.sum("_counted").over(earlier_rows), F.lit(0))
        )
    # ``starts`` has one row per range, that is spark.sql.shuffle.partitions rows at most.
    return inside.join(F.broadcast(starts), "_range").select(
        *df.columns, (F.col("_start") + F.col("_inside")).alias(name)
    )
