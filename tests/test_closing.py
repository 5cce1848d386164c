import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidings.operators import frames
from tidings.sources import sinks
from tidings.streaming import closing, digests

SCHEMA = "url string, html string, fetched_at timestamp"
START = dt.datetime(2024, 1, 1)


def page(i, minutes, text=None):
    words = text or f"Red fox number {'abc'[i % 3]} runs. Blue whale sings {i}! Old tree {'xy'[i % 2]} stands."
    return f"http://a.test/{i}", f"<p>{words}</p>", START + dt.timedelta(minutes=minutes)


class Job:
    """A folder of arrivals, and the two streams over it."""

    def __init__(self, spark, folder, lateness="1 day"):
        self.spark, self.folder, self.lateness, self.parsed = spark, folder, lateness, []
        self.base = f"{folder}/out"

    def arrive(self, rows):
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.folder}/in")

    def run(self, outputs=None):
        arrivals = self.spark.readStream.schema(SCHEMA).parquet(f"{self.folder}/in")
        outputs = outputs or digests.closing_outputs(dims=4, n_refs=3, k_max=4, num_take=3)
        closing.run_both(arrivals, "fetched_at", self.base, self.parse, outputs, f"{self.folder}/state", "30 minutes", self.lateness)

    def parse(self, rows):
        self.parsed.append(rows.count())
        return digests.parsed_captures(rows)

    def closings(self, latest=False):
        rows = sinks.read_published(self.spark, self.base, "closings", latest).collect()
        return sorted((r.timeframe[9:14], r.closing, r.n) for r in rows)


@pytest.fixture
def job(spark, tmp_path):
    return Job(spark, str(tmp_path))


def words_only(landed):
    return {"words": landed.select("timeframe", "url", F.split("text", " ").alias("items"))}


def test_closes_once_and_reopens_for_late_captures(job):
    job.arrive([page(i, 5 * i) for i in range(13)])  # 00:00 to 01:00
    job.run(words_only)
    assert job.closings() == [("00-30", 1, 6), ("01-00", 1, 6)]  # the third has not ended
    job.run(words_only)  # nothing new: nothing closes again
    assert job.closings() == [("00-30", 1, 6), ("01-00", 1, 6)]
    job.arrive([page(50, 10), page(51, 95)])  # one late capture, one that ends the third
    job.run(words_only)
    assert job.closings() == [("00-30", 1, 6), ("00-30", 2, 7), ("01-00", 1, 6), ("01-30", 1, 1)]
    assert job.closings(latest=True) == [("00-30", 2, 7), ("01-00", 1, 6), ("01-30", 1, 1)]
    words = sinks.read_published(job.spark, job.base, "words")
    assert words.groupBy("timeframe").count().count() == 3 and words.count() == 14
    assert sum(job.parsed) == 15  # each capture is parsed once, though two timeframes were computed twice


def test_captures_without_time_and_too_late(job):
    job.lateness = "1 hour"
    job.arrive([page(1, 0), page(2, 20), page(3, 300), ("http://a.test/none", "<p>x</p>", None)])
    job.run(words_only)
    assert job.closings() == [("00-30", 1, 2)]
    assert job.spark.read.parquet(f"{job.base}/undated").count() == 1
    job.arrive([page(4, 10)])  # beyond the lateness: lands, but reopens nothing
    job.run(words_only)
    assert job.closings() == [("00-30", 1, 2)]
    assert closing.landed_of(job.spark, job.base, job.spark.createDataFrame([("01-01-24_00-30-00_GMT+0300",)], "timeframe string")).count() == 3


def test_digests_equal_a_search_over_the_same_captures(job):
    job.arrive([page(i, 2 * i) for i in range(40)])
    job.run()
    found = {r.timeframe: (list(r.sentences), [round(x, 9) for x in r.vector]) for r in sinks.read_published(job.spark, job.base, "digest").collect()}
    landed = job.spark.read.parquet(f"{job.base}/landed").where("timeframe < '01-01-24_01-30'")
    want = digests.closing_outputs(dims=4, n_refs=3, k_max=4, num_take=3)(landed)["digest"].collect()
    assert found == {r.timeframe: (list(r.sentences), [round(x, 9) for x in r.vector]) for r in want} and found
    messages = sinks.read_published(job.spark, job.base, "outbox", latest=False)
    assert messages.count() == len(found) == messages.select("key").distinct().count()


def test_failure_between_two_tables_leaves_the_old_version(spark, tmp_path):
    base = str(tmp_path)
    frame = lambda label: spark.createDataFrame([(label, 1)], "timeframe string, closing int")
    table = lambda label, text: spark.createDataFrame([(label, text)], "timeframe string, items string")
    assert sinks.publish({"words": table("t", "old"), "sentences": table("t", "old."), "closings": frame("t")}, base, 0)

    def broken(value):
        raise ValueError(value)

    bad = table("t", "new.").select("timeframe", F.udf(broken)("items").alias("items"))
    with pytest.raises(Exception):
        sinks.publish({"words": table("t", "new"), "sentences": bad, "closings": frame("t")}, base, 1)
    read = lambda name, **k: sorted((r.timeframe, r["items"]) for r in sinks.read_published(spark, base, name, **k).collect())
    assert read("words") == [("t", "old")] and read("sentences") == [("t", "old.")]
    assert not sinks.is_committed(spark, base, 1)
    # The batch runs again, and once more after its commit.
    tables = {"words": table("t", "new").unionByName(table("u", "u")), "sentences": table("t", "new."), "closings": frame("t").unionByName(frame("u"))}
    assert sinks.publish(tables, base, 1) and not sinks.publish(tables, base, 1)
    assert read("words") == [("t", "new"), ("u", "u")] and read("sentences") == [("t", "new.")]
    assert read("words", latest=False) == [("t", "new"), ("t", "old"), ("u", "u")]


def test_a_restart_between_landing_and_closing(job, monkeypatch):
    job.arrive([page(i, 5 * i) for i in range(13)])
    with monkeypatch.context() as broken:
        broken.setattr(closing, "close", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            job.run(words_only)
    assert not sinks.is_committed(job.spark, job.base, 0)
    job.run(words_only)
    assert job.closings() == [("00-30", 1, 6), ("01-00", 1, 6)] and sum(job.parsed) == 13


def test_key_of_frames_is_the_label_column():
    assert frames.KEY == "timeframe"
