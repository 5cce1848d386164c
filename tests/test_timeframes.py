import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.functions import timeframe
from tidings.operators import partition, wordpiece
from tidings.plans.digest import run_digest
from tidings.session import scratch_path
from tidings.sources import sinks, vocabulary
from tidings.streaming import digests, timeframes

CLOCK = {
    "2024-03-05 10:00:00": "2024-03-05 10:30:00",
    "2024-03-05 10:29:59": "2024-03-05 10:30:00",
    "2024-03-05 10:30:00": "2024-03-05 11:00:00",
    "2024-03-05 23:45:00": "2024-03-06 00:00:00",
}


def clock(spark):
    return spark.createDataFrame([(t,) for t in CLOCK], "t string").withColumn("ts", F.to_timestamp_ntz("t"))


def test_next_slot_and_label(spark):
    rows = clock(spark).select(
        "t", timeframe.next_slot(F.col("ts")).alias("end"), timeframe.ceil_slot(F.col("ts")).alias("ceil")
    )
    rows = rows.select("t", "end", "ceil", timeframe.label(F.col("end")).alias("label")).collect()
    assert {r.t: str(r.end) for r in rows} == CLOCK and all(r.end == r.ceil for r in rows)
    assert {r.label for r in rows if r.t.endswith("23:45:00")} == {"06-03-24_00-00-00_GMT+0300"}


def test_next_run(spark):
    df = spark.createDataFrame(
        [("2024-03-05 10:30:00", "2024-03-05 10:40:00"), ("2024-03-05 10:30:00", "2024-03-05 10:45:00"), ("2024-03-05 10:30:00", "2024-03-05 10:46:00")],
        "p string, n string",
    ).select(F.to_timestamp_ntz("p").alias("p"), F.to_timestamp_ntz("n").alias("n"))
    out = [str(r[0])[11:] for r in df.select(timeframe.next_run(F.col("p"), F.col("n"), 15)).collect()]
    assert out == ["10:45:00", "10:45:00", "11:00:00"]
    local = df.select(timeframe.in_zone(F.col("p").cast("timestamp"), "Europe/Moscow").cast("string").alias("m")).first()
    assert local.m == "2024-03-05 13:30:00"


def test_outbox_message(spark):
    digests = spark.createDataFrame([("t1", [0.5, -1.25], ["a"])], "timeframe string, vector array<double>, sentences array<string>")
    row = sinks.outbox(digests).first()
    assert row.key == "t1" and json.loads(row.value) == {"time": "t1", "vector": [0.5, -1.25]}


def test_saving_a_timeframe_again_replaces_it(spark, tmp_path):
    base = str(tmp_path / "tables")
    first = spark.createDataFrame([("u", ["a"], "t1"), ("v", ["b"], "t2")], "url string, items array<string>, timeframe string")
    sinks.save_tables({"words": first, "sentences": first}, base)
    sinks.save_tables({"words": first.filter("timeframe = 't2'").withColumn("url", F.lit("w"))}, base)
    rows = sinks.read_table(spark, base, "words").collect()
    assert sorted((r.timeframe, r.url) for r in rows) == [("t1", "u"), ("t2", "w")]
    assert sinks.read_table(spark, base, "sentences").count() == 2


EVENTS = [(i, dt.datetime(2024, 1, 1, 0, 0) + dt.timedelta(minutes=13 * i), float(i % 5)) for i in range(60)]
EVENT_SCHEMA = "id bigint, ts timestamp_ntz, value double"


def per_frame(landed):
    return landed.groupBy("timeframe").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def arrivals(spark, folder):
    return spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def test_stream_equals_batch_with_late_and_repeated_input(spark, tmp_path):
    folder, base = str(tmp_path / "in"), str(tmp_path / "out")
    state = str(tmp_path / "state")
    df = spark.createDataFrame(EVENTS, EVENT_SCHEMA)
    # The second file brings rows for timeframes that the first one already computed.
    df.filter("id % 3 < 2").coalesce(1).write.mode("append").parquet(folder)
    timeframes.run_available(arrivals(spark, folder), "ts", base, {"summary": per_frame}, checkpoint=state)
    df.filter("id % 3 = 2").coalesce(1).write.mode("append").parquet(folder)
    timeframes.run_available(arrivals(spark, folder), "ts", base, {"summary": per_frame}, checkpoint=state)
    timeframes.run_available(arrivals(spark, folder), "ts", base, {"summary": per_frame}, checkpoint=state)
    streamed = sinks.read_table(spark, base, "summary").select("timeframe", "n", "total")
    batch = per_frame(timeframes.with_timeframe(df, "ts")).select("timeframe", "n", "total")
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))
    # From scratch over the same results: batches land again under their numbers.
    timeframes.run_available(arrivals(spark, folder), "ts", base, {"summary": per_frame}, checkpoint=str(tmp_path / "state2"))
    again = sinks.read_table(spark, base, "summary").select("timeframe", "n", "total")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, batch.collect()))


def test_digest_per_timeframe(spark):
    rows = [(i, f"s{i}", [float(i % 2) * 9 + i / 100, 1.0], f"t{i // 20}") for i in range(40)]
    landed = spark.createDataFrame(rows, "id bigint, sentence string, features array<double>, timeframe string")
    out = digests.digests_per_timeframe(
        landed, lambda part, label: run_digest(part, label, ["id"], n_refs=3, k_max=4, num_take=3)
    ).collect()
    assert {r.timeframe for r in out} == {"t0", "t1"}
    out = [r for r in out if r.vector is not None]
    assert out
    for r in out:
        assert len(r.sentences) == 3 and {int(s[1:]) // 20 for s in r.sentences} == {int(r.timeframe[1:])}


class Repeat:
    """Emits each word as often as its number says; counts how often it was opened."""

    def __enter__(self):
        self.opened = 0
        return self

    def rows(self, row):
        self.opened += 1
        return [{"word": row["word"], "nth": i, "seen": self.opened} for i in range(row["n"])] or None

    def __exit__(self, *error):
        del self.opened


def test_partition_handler(spark):
    df = spark.createDataFrame([("a", 2), ("b", 0), ("c", 1)], "word string, n int").coalesce(1)
    schema = T.StructType.fromDDL("word string, nth int, seen int")
    rows = partition.map_rows(df, Repeat, schema).collect()
    assert sorted(map(tuple, rows)) == [("a", 0, 1), ("a", 1, 1), ("c", 0, 3)]


def test_scratch_lies_in_the_shared_folder(spark):
    from tidings.session import shared_dir

    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one != two and one.startswith(shared_dir(spark).rstrip("/"))
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or shared_dir(spark) == configured


@pytest.mark.parametrize("parts", [1, 5])
def test_counts_are_sums_over_halves(spark, parts):
    df = timeframes.with_timeframe(spark.createDataFrame(EVENTS, EVENT_SCHEMA).repartition(parts), "ts", "60 minutes")
    whole = {r.timeframe: r.n for r in per_frame(df).collect()}
    halves = per_frame(df.filter("id < 30")).unionByName(per_frame(df.filter("id >= 30")))
    summed = {r.timeframe: r.n for r in halves.groupBy("timeframe").agg(F.sum("n").alias("n")).collect()}
    assert whole == summed


def test_capture_stream_equals_one_batch(spark, tmp_path):
    pages = [
        (f"http://a.test/{i}", f"<p>Red fox number {'abc'[i % 3]} runs. Blue whale sings {i}! Old tree {'xy'[i % 2]} stands.</p>",
         dt.datetime(2024, 1, 1, 0, 5 + 30 * (i % 2)))
        for i in range(12)
    ]
    schema = "url string, html string, fetched_at timestamp_ntz"
    df = spark.createDataFrame(pages, schema)
    outputs = digests.capture_outputs(dims=4, n_refs=3, k_max=4, num_take=3)
    runs = []
    for name, splits in (("split", ["url < 'http://a.test/3'", "url >= 'http://a.test/3'"]), ("whole", ["true"])):
        folder, base = str(tmp_path / f"in-{name}"), str(tmp_path / name)
        for part in splits:
            df.filter(part).coalesce(1).write.mode("append").parquet(folder)
        arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
        timeframes.run_available(arriving, "fetched_at", base, outputs, checkpoint=str(tmp_path / f"state-{name}"))
        tables = [
            sorted((r.timeframe, r.url, tuple(r["items"])) for r in sinks.read_table(spark, base, t).collect())
            for t in ("words", "sentences")
        ]
        found = [(r.timeframe, tuple(r.sentences), [round(x, 9) for x in r.vector]) for r in digests.read_digests(spark, base).collect()]
        runs.append((tables, sorted(found)))
    assert runs[0] == runs[1]
    assert len(runs[0][0][0]) == 12 and {t for t, _, _ in runs[0][0][0]} == {
        "01-01-24_00-30-00_GMT+0300", "01-01-24_01-00-00_GMT+0300"
    }


def test_rows_without_a_time_are_kept_apart(spark, tmp_path):
    schema = "id int, ts timestamp"
    spark.createDataFrame([(1, None), (2, None)], schema).unionByName(spark.sql("SELECT 3 AS id, timestamp'2024-01-01 10:05:00' AS ts")).write.parquet(str(tmp_path / "in"))
    counted = {"n": lambda landed: landed.groupBy("timeframe").agg(F.count(F.lit(1)).alias("n"))}
    arrivals = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    timeframes.run_available(arrivals, "ts", str(tmp_path / "out"), counted, "360 minutes", str(tmp_path / "state"))
    assert [r.n for r in spark.read.parquet(str(tmp_path / "out" / "n")).collect()] == [1]
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out" / "undated")).collect()) == [1, 2]


def test_a_batch_without_rows_ends_well(spark, tmp_path):
    schema = "url string, html string, fetched_at timestamp"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "in"))
    arrivals = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    outputs = digests.capture_outputs(dims=4, n_refs=2, k_max=2)
    timeframes.run_available(arrivals, "fetched_at", str(tmp_path / "out"), outputs, None, str(tmp_path / "state"))


def test_capture_stream_with_token_ids(spark, tmp_path):
    tokens = ["[PAD]", "[UNK]", "[CLS]", "[SEP]", "one", "two", "."]
    vocab = wordpiece.prepare(vocabulary.number_tokens(spark.createDataFrame(list(enumerate(tokens)), "line bigint, token string")))
    pages = spark.sql("SELECT 'http://a.test/' AS url, '<p>One two.</p>' AS html, timestamp'2024-01-01 10:05:00' AS fetched_at")
    pages.write.parquet(str(tmp_path / "in"))
    arrivals = spark.readStream.schema(pages.schema).parquet(str(tmp_path / "in"))
    outputs = digests.capture_outputs(dims=4, vocab=vocab, n_refs=2, k_max=2)
    timeframes.run_available(arrivals, "fetched_at", str(tmp_path / "out"), outputs, None, str(tmp_path / "state"))
    assert [r["items"] for r in sinks.read_table(spark, str(tmp_path / "out"), "token_ids").collect()] == [[2, 4, 5, 6, 3]]
    assert digests.read_digests(spark, str(tmp_path / "out")).count() == 0  # one sentence: no K is found
