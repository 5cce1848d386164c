"""Periodic runs as a stream: captures land, and each touched timeframe is computed anew."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidings.functions import timeframe
from tidings.session import scratch_path
from tidings.sources import sinks

Recompute = Callable[[DataFrame], DataFrame]


def with_timeframe(rows: DataFrame, ts_col: str, period: str | None = None, keep_end: str | None = None) -> DataFrame:
    """Add the label of the timeframe that a row's time falls into, and its end as ``keep_end``.

    The default period is the half-hour slot; any other window length works the same way.
    """
    end = timeframe.next_slot(F.col(ts_col)) if period is None else F.window(ts_col, period)["end"]
    name = keep_end or "_end"
    labelled = rows.withColumn(name, end).withColumn("timeframe", timeframe.label(F.col(name)))
    return labelled if keep_end else labelled.drop(name)


def stream_writer(
    arrivals: DataFrame,
    ts_col: str,
    base_path: str,
    recompute: dict[str, Recompute],
    period: str | None = None,
) -> DataStreamWriter:
    """A writer that keeps one result per timeframe up to date below ``base_path``.

    A batch first lands below ``landed/``, under its timeframe and batch number, so a batch that
    runs again replaces itself. Then every timeframe it touched is computed from all that landed
    for it, and its partition of each result table is replaced: late rows change a timeframe, and
    a repeated batch changes nothing. Each function maps landed rows to rows with ``timeframe``.
    Rows without a time belong to no timeframe; they are kept below ``undated/``, by batch.
    """
    landed_path = f"{base_path.rstrip('/')}/landed"
    undated_path = f"{base_path.rstrip('/')}/undated"

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        numbered = batch.withColumn("batch_id", F.lit(batch_id))
        undated = numbered.filter(F.col(ts_col).isNull())
        (
            undated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id").parquet(undated_path)
        )
        landing = with_timeframe(numbered.filter(F.col(ts_col).isNotNull()), ts_col, period)
        (
            # One task per timeframe, more only where it is large: few files in each folder.
            landing.hint("rebalance", "timeframe").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("timeframe", "batch_id").parquet(landed_path)
        )
        landed = spark.read.schema(landing.schema).parquet(landed_path)
        # Partition columns only: the labels come from the folder names of this batch.
        touched = landed.filter(F.col("batch_id") == batch_id).select("timeframe").distinct()
        again = landed.join(F.broadcast(touched), "timeframe", "left_semi").drop("batch_id")
        for name, function in recompute.items():
            sinks.write_timeframe(function(again), f"{base_path.rstrip('/')}/{name}")

    return arrivals.writeStream.foreachBatch(process)


def run_available(
    arrivals: DataFrame,
    ts_col: str,
    base_path: str,
    recompute: dict[str, Recompute],
    period: str | None = None,
    checkpoint: str | None = None,
) -> None:
    """Process everything that has arrived and stop."""
    spark = arrivals.sparkSession
    location = checkpoint or scratch_path(spark, "stream-state")
    writer = stream_writer(arrivals, ts_col, base_path, recompute, period)
    query = writer.option("checkpointLocation", location).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    finally:
        query.stop()
