import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.data import odd_documents, odd_rows, prose, written
from tidings.llm import blocks, sketchjoin
from tidings.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def classes_of(sets):
    """Component of each row, by all pairs."""
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(sets))]


def expected(rows):
    sets = [shingles(t) for _, t, _, _ in rows]
    groups = classes_of(sets)
    least = {}
    for (d, *_), g in zip(rows, groups):
        if d is not None:
            least[g] = min(d, least.get(g, d))
    return Counter((d, len(s), least.get(g)) for (d, *_), s, g in zip(rows, sets, groups))


def near_copies(seed, families=12):
    """Families of texts that share more or less of each other, around the threshold, and passages that many share."""
    rng, rows, passage = random.Random(seed), [], prose("en", 40, "passage").split()
    for f in range(families):
        base = prose("en", rng.choice([3, 6, 9, 14, 30, 60, 130, 260]), f"{seed}-{f}").split()
        for _ in range(rng.randrange(1, 9)):
            words = list(base)
            for _ in range(rng.randrange(0, 2 + len(words) // 14)):
                words[rng.randrange(len(words))] = f"w{rng.randrange(1000)}"
            if rng.random() < 0.2:
                words = words + [f"w{rng.randrange(1000)}"] * rng.randrange(len(words) // 3 + 1)
            if rng.random() < 0.3:
                words = words + passage
            rows.append((" ".join(words)))
    rng.shuffle(rows)
    return [(i, t, "en", "s") for i, t in enumerate(rows)]


def result(spark, rows):
    found = sketchjoin.similar_documents(odd_documents(spark, rows))
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect())


@pytest.mark.parametrize("seed", range(4))
def test_near_copies_against_all_pairs(spark, seed):
    rows = near_copies(seed, 25)
    assert result(spark, rows) == expected(rows)


def test_small_tiles_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(sketchjoin, "TILE_ROWS", 3)
    rows = near_copies(11, 25)
    assert result(spark, rows) == expected(rows)


def test_odd_documents(spark, tmp_path):
    found = sketchjoin.op9_similarity(spark, written(odd_documents(spark), tmp_path)).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == expected(odd_rows())
    assert sketchjoin.op9_similarity(spark, written(odd_documents(spark).limit(0), tmp_path)).collect() == []


@pytest.mark.parametrize("shared", [7, None])
@pytest.mark.parametrize("first", [True, False])
def test_id_shared_with_an_unrelated_text(spark, shared, first):
    """The text of a near copy is its own, whichever text of its id the scan meets first."""
    text = prose("en", 80, "near").split()
    near = " ".join(text[:-1] + ["changed"])
    held = [(shared, " ".join(text), "en", "s"), (shared, prose("de", 80, "far"), "de", "s")]
    rows = (held if first else held[::-1]) + [(9, near, "en", "s")]
    docs = odd_documents(spark, rows).coalesce(1).sortWithinPartitions("lang", ascending=not first)
    found = sketchjoin.similar_documents(docs).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == expected(rows)


def test_many_rows_without_id(spark):
    """Near copies and exact copies without id, among unrelated texts without id."""
    rows = [(None, *row[1:]) for row in near_copies(5, 25)] + [(None, prose("fr", 50, k), "fr", "s") for k in range(150)]
    rows += rows[:5] * 20 + [(k, *rows[k][1:]) for k in range(0, 100, 9)]
    assert result(spark, rows) == expected(rows)


def test_linked_sets_show_an_equal_key():
    """The pigeonhole holds for pairs at the threshold, for sets of all sizes."""
    rng = np.random.default_rng(0)
    for _ in range(1500):
        size = int(rng.choice([1, 2, 3, 4, 5, 7, 8, 9, 12, 15, 16, 17, 31, 33, 64, 100, 127, 130, 255, 260, 700]))
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64) * np.uint64(2))
        cut = int(rng.integers(0, len(a) // 5 + 1))
        extra = int(rng.integers(0, len(a) // 4 + 1))
        b = np.unique(np.concatenate([a[rng.permutation(len(a))[cut:]], rng.integers(0, 2**63, extra).astype(np.uint64)]))
        if len(b) and sketchjoin.are_linked(a, b):
            assert set(sketchjoin.part_keys(a)) & set(sketchjoin.part_keys(b)), (len(a), len(b))


def test_sketch_distance_is_a_lower_bound():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = np.unique(rng.integers(0, 2**63, rng.integers(1, 300)).astype(np.uint64))
        b = np.unique(np.concatenate([a[:rng.integers(0, len(a) + 1)], rng.integers(0, 2**63, rng.integers(1, 300)).astype(np.uint64)]))
        p, q = (np.frombuffer(sketchjoin.narrow_sketch(x), np.uint8) for x in (a, b))
        width = min(len(p), len(q))
        distance = int(np.bitwise_count(sketchjoin.folded(p, width) ^ sketchjoin.folded(q, width)).sum())
        assert distance <= len(np.setxor1d(a, b))


def test_one_of_each_keeps_columns_and_rows(spark):
    rows = odd_rows()
    docs = odd_documents(spark)
    out = sketchjoin.one_of_each(docs)
    assert out.columns == docs.columns
    groups = classes_of([shingles(t) for _, t, _, _ in rows])
    members = {}
    for (d, t, *_), g in zip(rows, groups):
        members.setdefault(g, []).append((d, t))
    wanted = Counter(min(m, key=lambda r: (r[0] is None, r[0] or 0)) for m in members.values())
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == wanted


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 60)], None])
def test_components(spark, edges):
    rng = random.Random(4)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] if edges is None else edges
    found = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    parent = {n: n for e in edges for n in e}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for u, v in edges:
        parent[max(find(u), find(v))] = min(find(u), find(v))
    assert found == {n: find(n) for u, v in edges if u != v for n in (u, v)}


def test_components_larger_than_a_task_s_share(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(300)] + [(1000 + rng.randrange(400), 1000 + rng.randrange(400)) for _ in range(300)] + [(5000, 5000 + i) for i in range(1, 90)]
    rng.shuffle(edges)
    table = spark.createDataFrame(edges, "u long, v long").repartition(7)
    whole = Counter(map(tuple, components(table).collect()))
    assert whole == Counter(map(tuple, components(table, most=50).collect())) and whole[300, 0] == whole[5089, 5000] == 1


def test_components_of_few_edges_take_few_jobs(spark):
    table = spark.createDataFrame([(i, i + 1) for i in range(2000)], "u long, v long").repartition(5)
    spark.sparkContext.setJobGroup("components", "jobs of one call")
    try:
        found = components(table).where("label = 0").count()
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("components"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found == 2001 and 0 < jobs < 15


def test_keys_that_share_rows_are_put_together(spark):
    rng = random.Random(6)
    shared = {k: rng.sample(range(40), 25) for k in range(60)}  # near copies: many keys, other rows in each
    chain = {100 + k: list(range(1000 + 9 * k, 1010 + 9 * k)) for k in range(30)}  # neighbours share one row
    members = spark.createDataFrame([(k, r) for k, rows in (shared | chain).items() for r in rows], "key long, row long")
    sizes = spark.createDataFrame([(k, len(rows), min(rows)) for k, rows in (shared | chain).items()], "key long, g long, s3 long")
    rows, tiles = blocks._gathered(members, sizes, 20)
    held = {}
    for r in rows.collect():
        held.setdefault(r["key"], set()).add(r["row"])
    assert rows.count() == 40 + 300 and {k: set(v) for k, v in chain.items()}.items() <= held.items()
    assert set(range(40)) in held.values() and {r["key"]: r["tiles"] for r in tiles.collect()} == {k: -(-len(v) // 20) for k, v in held.items()}
