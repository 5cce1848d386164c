"""Session helpers: one place for the settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def build_session(master: str | None = None, app_name: str = "tidings", **conf: str) -> SparkSession:
    """A session with adaptive execution and a fixed UTC clock; ``conf`` wins over the defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Only a local session without that setting gets a temporary folder: on a cluster a
    machine-local path would be lost with the machine, so a missing setting is an error there.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if configured:
        if current is None:
            context.setCheckpointDir(configured)
        return configured
    if current is not None:
        return current
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidings-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder; later plans start from the written blocks."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def bounded_batches(spark: SparkSession, row_bytes: int, total: int = 32 << 20) -> Iterator[None]:
    """Plans made inside send large rows to Python in batches of about ``total`` bytes."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(max(1, min(int(before) if int(before) > 0 else 10_000, total // max(1, row_bytes)))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries made inside delete their shuffle files as soon as they have run.

    Else the files stay until the driver happens to collect its garbage; a loop of passes piles them up.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """Queries made and run inside are planned adaptively.

    The batches of a stateful stream are not, and Spark drops the hint to rebalance rows there.
    """
    name = "spark.sql.adaptive.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on a table with fewer splits than cores; larger tables stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def local_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A few driver-side rows as a local relation, whose exact size the planner knows."""
    struct = StructType.fromDDL(schema)
    named = [dict(zip(struct.names, row)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(named, schema=to_arrow_schema(struct)), schema=struct)
