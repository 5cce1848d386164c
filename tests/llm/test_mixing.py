import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.data import odd_documents, odd_rows, written
from tidings.llm import mixing


def brute_targets(sizes, weights, total, most):
    """Pour in small steps: every open source gets its share until it is full."""
    targets, left = [0.0] * len(sizes), total
    for _ in range(10_000):
        open_ = [i for i in range(len(sizes)) if targets[i] < most * sizes[i] - 1e-12]
        if not open_ or left < 1e-12:
            break
        weight = sum(weights[i] for i in open_)
        step = min([left, *[(most * sizes[i] - targets[i]) * weight / weights[i] for i in open_]])
        for i in open_:
            targets[i] += step * weights[i] / weight
        left -= step
    return targets


@pytest.mark.parametrize("sizes", [[100, 100, 100], [5, 1000, 3, 70], [0, 10], [0], [7], [1, 1, 1, 1000000, 2]])
def test_targets(sizes):
    weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    found = mixing.fill_targets(sizes, weights, 1.5 * sum(sizes))
    assert found == pytest.approx(brute_targets(sizes, weights, 1.5 * sum(sizes), 2.0))


def test_alias_table_has_the_shares():
    shares = [5, 0, 1, 14]
    cut, other = mixing.alias_table(shares)
    mass = defaultdict(float)
    for i in range(4):
        mass[i] += cut[i] / 4
        mass[other[i]] += (1 - cut[i]) / 4
    assert [mass[i] * 20 for i in range(4)] == pytest.approx(shares)


@pytest.mark.parametrize("count", [1, 2, 3, 7, 64, 1000])
def test_permutation(spark, count):
    df = spark.range(count).select(mixing.permuted(F.col("id"), F.lit(count).cast("long"), F.lit(5)).alias("p"))
    found = [r["p"] for r in df.collect()]
    assert sorted(found) == list(range(count)) and (count < 64 or found != sorted(found))


def test_mix_of_odd_documents(spark, tmp_path):
    found = mixing.op3_mixing(spark, written(odd_documents(spark), tmp_path)).collect()
    rows = odd_rows()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r["doc_id"], r["size"]) for r in found) == Counter((d, size(t)) for d, t, _, _ in rows)
    per_source = Counter()
    for _, t, _, s in rows:
        per_source[s] += size(t)
    sources = sorted([s for s in per_source if s is not None], key=lambda s: s.encode()) + [None]
    targets = brute_targets([per_source[s] for s in sources], [(3, 1, 2)[i % 3] for i in range(len(sources))], 1.5 * sum(per_source.values()), 2.0)
    wanted = {per_source[s]: t for s, t in zip(sources, targets)}
    taken = Counter()
    for r in found:
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert r["target"] == pytest.approx(wanted[r["source_size"]])
        taken[r["source_size"]] += r["taken"]
    for n, target in wanted.items():
        assert abs(taken[n] - target) <= mixing.BLOCK_TOKENS
    again = mixing.op3_mixing(spark, str(tmp_path)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, found))


def test_shards_draw_multinomial_counts(spark):
    quotas = [600, 0, 3000, 400]
    counts = mixing.draw_counts(spark, 4000, quotas, 1, 500).collect()
    assert sum(r["n"] for r in counts) == 4000 and {r["rank"] for r in counts} == {0, 2, 3}
    per_shard = [r["n"] for r in counts if r["rank"] == 0]
    assert len(per_shard) == 8 and len(set(per_shard)) > 2 and all(35 < n < 120 for n in per_shard)


def test_every_source_gets_its_quota(spark):
    quotas = [600, 1, 3000, 400]
    sources = spark.createDataFrame([(i, q) for i, q in enumerate(quotas)], "rank int, quota long")
    slots = mixing.numbered_slots(mixing.draw_counts(spark, 4001, quotas, 1, 500), sources).collect()
    by_rank = defaultdict(list)
    for r in slots:
        by_rank[r["rank"]].append(r["ordinal"])
    assert {k: sorted(v) for k, v in by_rank.items()} == {i: list(range(q)) for i, q in enumerate(quotas)}
    assert Counter(r["shard"] for r in slots) == {**{k: 500 for k in range(8)}, 8: 1}


def test_no_words_and_no_rows(spark, tmp_path):
    rows = [(1, None, None, None), (2, "  ", None, "a"), (2, "  ", None, "a")]
    found = mixing.op3_mixing(spark, written(odd_documents(spark, rows), tmp_path)).collect()
    assert sorted((r["doc_id"], r["size"], r["taken"], r["target"]) for r in found) == [(1, 0, 0, 0.0), (2, 0, 0, 0.0), (2, 0, 0, 0.0)]
    assert mixing.op3_mixing(spark, written(odd_documents(spark, rows).limit(0), tmp_path)).collect() == []


def test_applied_mix_keeps_columns(spark):
    docs = odd_documents(spark)
    out = mixing.apply_mix(docs)
    assert out.columns == docs.columns
    texts = {(d, t) for d, t, _, _ in odd_rows()}
    counts = Counter((r["doc_id"], r["text"]) for r in out.collect())
    assert set(counts) <= texts and all(c <= 2 for k, c in counts.items() if k[0] not in (10,))


@pytest.mark.parametrize("range_rows", [50_000, 7])
def test_applied_mix_meets_every_source_to_one_document(spark, monkeypatch, range_rows):
    """Also a source whose words lie in a few long texts, and one with a third of all rows of equal size."""
    monkeypatch.setattr(mixing, "RANGE_ROWS", range_rows)
    rng = random.Random(3)
    rows = [(i, "w " * rng.randrange(1, 90), "en", f"s{i % 5}") for i in range(400)]
    rows += [(1000 + i, "w " * n, "en", "long") for i, n in enumerate([4000, 2500, 1300, 700, 64])]
    rows += [(2000 + i, "w " * 40, "en", "even") for i in range(200)] + [(3000 + i, "w " * 30, "en", None) for i in range(20)]
    docs = odd_documents(spark, rows)
    slots, laid = mixing.mix(docs)
    source = {d: s for d, _, _, s in rows}
    size = {d: len(t.split()) for d, t, _, _ in rows}
    taken, kept = Counter(), Counter()
    for r in mixing.taken_words(slots, laid).collect():
        taken[source[r["doc_id"]]] += r["taken"]
    for r in mixing.apply_mix(docs).collect():
        kept[r["source"]] += size[r["doc_id"]]
    for name in set(source.values()):
        largest = max(n for d, n in size.items() if source[d] == name)
        slack = 1 if range_rows > 400 else 2
        assert abs(kept[name] - taken[name]) <= slack * largest, (name, kept[name], taken[name], largest)
