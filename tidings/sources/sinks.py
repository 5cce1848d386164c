"""Where a timeframe's results go: three text tables and an outbox of messages."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.session import adaptive

TABLES = ("token_ids", "words", "sentences")


def write_timeframe(df: DataFrame, path: str) -> None:
    """Write the ``timeframe`` partitions that ``df`` holds and leave all others alone.

    Writing a timeframe again replaces it, so a repeated run leaves one copy.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("timeframe").parquet(path)
    )


def save_tables(tables: dict[str, DataFrame], base_path: str) -> None:
    """Write each named table below ``base_path``, partitioned by timeframe."""
    for name, df in tables.items():
        write_timeframe(df, f"{base_path.rstrip('/')}/{name}")


def read_table(spark, base_path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base_path.rstrip('/')}/{name}")


# --- outputs that appear together ------------------------------------------------------------

def _hadoop(spark: SparkSession, path: str) -> tuple:
    """A path and its file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def _commit_path(base_path: str, number: int) -> str:
    return f"{base_path.rstrip('/')}/commits/{number:012d}"


def is_committed(spark: SparkSession, base_path: str, number: int) -> bool:
    path, files = _hadoop(spark, _commit_path(base_path, number))
    return files.exists(path)


def publish(tables: dict[str, DataFrame], base_path: str, number: int) -> bool:
    """Write tables with ``timeframe`` so that readers see all of them, or none.

    ``number`` orders the publications. Every attempt writes under a version of its own; the commit, a
    file that names the version, is moved into place last, and a move onto a commit that is there fails.
    So a repeated number changes nothing. ``closings`` among the tables names the timeframes that it replaces.
    """
    spark = next(iter(tables.values())).sparkSession
    base, version = base_path.rstrip("/"), f"{number:012d}-{uuid.uuid4().hex[:8]}"
    if is_committed(spark, base, number):
        return False
    with adaptive(spark):
        for name, df in tables.items():
            # A timeframe's rows come together, unless they are many: else every task writes a file for every timeframe.
            placed = df.hint("rebalance", "timeframe").withColumn("version", F.lit(version))
            placed.write.mode("append").partitionBy("version", "timeframe").parquet(f"{base}/{name}")
    target, files = _hadoop(spark, _commit_path(base, number))
    tried, _ = _hadoop(spark, f"{base}/attempts/{version}")
    files.mkdirs(target.getParent())
    out = files.create(tried, True)
    out.write(bytearray(version.encode()))
    out.close()
    return bool(files.rename(tried, target))


def _committed(spark: SparkSession, base_path: str) -> DataFrame:
    return spark.read.text(f"{base_path.rstrip('/')}/commits").select(F.col("value").alias("version"))


def read_published(spark: SparkSession, base_path: str, name: str, latest: bool = True) -> DataFrame:
    """A published table: of each timeframe the rows of its last committed version, or of all committed ones.

    Folders of other versions and timeframes are pruned from the scan by the joined versions.
    """
    base, committed = base_path.rstrip("/"), _committed(spark, base_path)
    table = spark.read.parquet(f"{base}/{name}")
    if not latest:
        return table.join(F.broadcast(committed), "version", "left_semi")
    closed = spark.read.parquet(f"{base}/closings").select("timeframe", "version").join(F.broadcast(committed), "version", "left_semi")
    current = closed.groupBy("timeframe").agg(F.max("version").alias("version"))
    return table.join(current, ["version", "timeframe"], "left_semi").drop("version")


def outbox(digests: DataFrame) -> DataFrame:
    """``(key, value)`` messages, value ``{"time", "vector"}`` as JSON: the shape that Spark's
    message sinks take."""
    body = F.struct(F.col("timeframe").alias("time"), "vector")
    return digests.select(F.col("timeframe").alias("key"), F.to_json(body).alias("value"))
