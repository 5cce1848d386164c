"""Published tables have few files."""

import glob

from tidings.sources import sinks


def test_a_timeframe_is_not_written_by_every_task(spark, tmp_path):
    base = str(tmp_path / "out")
    rows = [(f"frame-{i % 5}" if i % 6 else None, i) for i in range(60)]
    df = spark.createDataFrame(rows, "timeframe string, x int").repartition(8)
    closings = df.groupBy("timeframe").count()
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # as in the batches of a stateful stream
    try:
        assert sinks.publish({"words": df, "closings": closings}, base, 0)
        assert spark.conf.get("spark.sql.adaptive.enabled") == "false"
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    files = glob.glob(f"{base}/words/*/*/*.parquet")
    assert len({f.rsplit("/", 1)[0] for f in files}) == 6 and len(files) == 6
    got = sinks.read_published(spark, base, "words", latest=False).select("timeframe", "x").collect()
    assert sorted(map(str, got)) == sorted(f"Row(timeframe={t!r}, x={x})" for t, x in rows)
