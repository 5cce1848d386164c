import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.data import odd_documents, odd_rows, written
from tidings.llm import resampling


def brute(docs, target, percent=10, least=20, buckets=10_000, runs=1):
    """docs: (doc_id, text); the contract row by row."""
    def features(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        return words, [" ".join(words[i:i + w]) for w in range(1, runs + 1) for i in range(len(words) - w + 1)]

    place = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(map(place, features(text)[1]))
    for text in target:
        t.update(map(place, features(text)[1]))
    big_s, big_t = sum(s.values()), sum(t.values())
    rows = []
    for doc_id, text in docs:
        words, found = features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in map(place, found))
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    fit = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for k, row in enumerate(fit[:percent * len(fit) // 100]):
        row[4] = k + 1
    return [tuple(r[:5]) for r in rows]


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("runs, segment_rows", [(1, 500_000), (1, 7), (3, 5)])
def test_odd_rows_against_brute_force(spark, runs, segment_rows):
    docs = odd_documents(spark)
    target = ["the river WATER letter", None, "", "für schön été " * 4]
    frame = spark.createDataFrame([(i, x, 1) for i, x in enumerate(target)], "item_id long, text string, row long")
    got = resampling.resample(docs, frame, percent=50, runs=runs, segment_rows=segment_rows)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert ordered(got.collect()) == ordered(brute([(r[0], r[1]) for r in odd_rows()], target, 50, runs=runs))


def test_equal_rows_are_shared_out_and_ranked_without_gaps(spark):
    text = " ".join(f"w{i}" for i in range(25))
    docs = spark.createDataFrame([(None, text)] * 300 + [(i, text + f" x{i}") for i in range(100)], "doc_id long, text string").repartition(5)
    got = resampling.resample(docs, spark.createDataFrame([("w1 w2",)], "text string"), percent=100, segment_rows=20).collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 401))
    best = sorted(got, key=lambda r: r["rank"])
    assert [r["score"] for r in best] == sorted((r["score"] for r in got), reverse=True)


def test_regular_splitters_cut_even_segments(spark):
    rows = spark.range(20_000).selectExpr(
        "id % 97 AS last", "0L AS none", "id % 7 AS id", "0L AS n_features", "0L AS weight", "id AS row").repartition(6).sortWithinPartitions("last", "none", "id", "n_features", "weight", "row")
    samples = resampling.regular_samples(rows, 25)
    placed = resampling.with_segment(rows, samples[[len(samples) * k // 10 for k in range(1, 10)]])
    sizes = [r["count"] for r in placed.groupBy("segment").count().collect()]
    assert len(sizes) == 10 and max(sizes) < 2_300 and min(sizes) > 1_700


def test_empty_tables(spark, tmp_path):
    docs, target = odd_documents(spark, []), spark.createDataFrame([], "text string")
    assert resampling.resample(docs, target).collect() == []
    few = odd_documents(spark, odd_rows()[:30])
    got = resampling.resample(few, target)
    assert ordered(got.collect()) == ordered(brute([(r[0], r[1]) for r in odd_rows()[:30]], []))
    folder = written(few, tmp_path)
    written(spark.createDataFrame([(1, "the water", 2)], "item_id long, text string, score long"), tmp_path, "benchmark")
    got = resampling.op11_resampling(spark, folder)
    assert ordered(got.collect()) == ordered(brute([(r[0], r[1]) for r in odd_rows()[:30]], ["the water"]))


def test_words_keep_digits_and_letters_beyond_ascii():
    assert resampling.words_of("Été-1 A_b\x7fÖ'Ö".encode()) == ["Été".encode(), b"1", b"a", b"b", "Ö".encode(), "Ö".encode()]
    assert resampling.words_of(None) == []
    assert resampling.gains(np.array([1, 0]), np.array([0, 3])).tolist() == [math.floor(1000 * math.log(1 * 3 / (2 * 5))), math.floor(1000 * math.log(4 * 3 / (1 * 5)))]
