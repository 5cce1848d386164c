import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.data import odd_documents, odd_rows, prose, written
from tests.llm.test_sketchjoin import near_copies, shingles
from tidings.llm import minhash
from tidings.llm.sketchjoin import WordHashes, shingle_set


def expected(rows, similarity=85):
    """Every pair of rows compared."""
    sets = [shingles(t) for _, t, _, _ in rows]
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= similarity * (len(sets[i]) + len(sets[j]) - both):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for k, (d, *_) in enumerate(rows):
        if d is not None:
            least[find(k)] = min(d, least.get(find(k), d))
    out = Counter()
    for k, (d, *_) in enumerate(rows):
        top = least.get(find(k))
        out[d, len(sets[k]), top if sets[k] else d, d == (top if sets[k] else d)] += 1
    return out


def result(spark, rows, **options):
    found = minhash.near_duplicates(odd_documents(spark, rows), **options)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return Counter(map(tuple, found.collect()))


@pytest.mark.parametrize("seed, options", [(0, {}), (1, {"tile_rows": 3}), (2, {"similarity": 70})])
def test_near_copies_against_all_pairs(spark, seed, options):
    rows = near_copies(seed, 40)
    assert result(spark, rows, **options) == expected(rows, options.get("similarity", 85))


def test_odd_documents(spark, tmp_path):
    found = minhash.op13_minhash(spark, written(odd_documents(spark), tmp_path)).collect()
    assert Counter(map(tuple, found)) == expected(odd_rows())
    assert minhash.op13_minhash(spark, written(odd_documents(spark).limit(0), tmp_path)).collect() == []


def family(seed, count, changed):
    """Texts that each differ from a common base in some words of their own, at even distances."""
    rng, base, rows = random.Random(seed), prose("en", 200, seed).split(), []
    for k in range(count):
        words = list(base)
        for at in rng.sample(range(20), changed):
            words[10 * at] = f"f{seed}x{k}y{at}"
        rows.append(" ".join(words))
    return rows


def test_families_below_and_above_the_bound_in_one_key(spark):
    """Many sets share keys without a link, others are linked only through members that are not first of their key."""
    texts = family(1, 60, 4) + family(2, 60, 2) + family(3, 30, 1)
    random.Random(0).shuffle(texts)
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)] + [(500 + i, texts[0], "en", "s") for i in range(40)]
    assert result(spark, rows, tile_rows=25) == expected(rows)


def test_frequent_key_fills_several_tasks(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        rows = [(i, t, "en", "s") for i, t in enumerate(family(4, 150, 1) + family(5, 20, 3))]
        assert result(spark, rows) == expected(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_signatures_within_the_distance_share_a_key():
    rng = np.random.default_rng(0)
    for errors in (0, 1, 2):
        slots, distance = 24, 7
        for _ in range(300):
            a = rng.integers(0, 1 << 16, slots).astype(np.uint16)
            b = a.copy()
            b[rng.permutation(slots)[:rng.integers(0, distance + 1)]] += 1
            keys = minhash.chunk_keys(np.stack([a, b]), distance, errors)
            assert (keys[0] == keys[1]).any()


def test_distances_of_linked_sets_stay_within_the_bound():
    rng = np.random.default_rng(1)
    bound = minhash.most_errors(minhash.SLOTS)
    assert minhash.most_errors(64, 85, 1e-7) > 64 * 0.15 and minhash.most_errors(64, 100) == 0
    distances = []
    for _ in range(200):
        common = rng.integers(0, 2**63, 850).astype(np.uint64)
        a, b = (np.unique(np.r_[common, rng.integers(0, 2**63, 75).astype(np.uint64)]) for _ in range(2))
        distances.append((minhash.signature(a) != minhash.signature(b)).sum())
    assert max(distances) <= bound and abs(np.mean(distances) - 0.15 * minhash.SLOTS) < 2


def test_long_text_is_taken_whole():
    text = prose("en", 60_000, 3) + " " + " ".join(f"z{i}" for i in range(300_000))
    found = shingle_set(text, WordHashes())
    assert len(found) > 300_000
    assert len(minhash.signature(found)) == minhash.SLOTS
