import random

import numpy as np
import pytest

from tests.llm.data import written
from tidings.llm import kdtree, nearest
from tidings.llm.grid import grid_search

SCHEMA = "vec_id long, embedding array<float>, label int, floor double, dim int, shard int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 0.5, 3, 4) for i, v in rows], SCHEMA).repartition(3)


def some_rows(n=400, dims=5, seed=0):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in rng.normal(size=dims).round(2).astype(np.float32)]) for i in range(n)]


def takes_part(v, nonzero):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and (not nonzero or any(v))


def brute(rows, modulus, k, cosine):
    rows = [(i, v) for i, v in rows if i is not None and takes_part(v, cosine)]
    out = []
    for q in sorted({i for i, _ in rows if i % modulus == 0}):
        mine = min(v for i, v in rows if i == q)
        scored = []
        for i, v in rows:
            if i == q or len(v) != len(mine):
                continue
            if cosine:
                a, b = np.array(mine, float), np.array(v, float)
                score = float(a @ b / np.sqrt(a @ a) / np.sqrt(b @ b))
            else:
                whole = lambda vec: [int(np.floor(1024.0 * x)) for x in vec]
                score = min(max(sum(x * y for x, y in zip(whole(mine), whole(v))), -2**63), 2**63 - 1)
            scored.append((-round(score, 12), i, score))
        out += [(q, rank + 1, i, score) for rank, (_, i, score) in enumerate(sorted(scored)[:k])]
    return out


ODD = [(None, [1.0] * 5), (1000, None), (1001, []), (1002, [1.0, None, 0.0, 0.0, 0.0]), (1003, [float("nan")] * 5), (1004, [float("inf")] * 5),
       (1005, [0.0] * 5), (1006, [1.0, 2.0]), (1050, [2.0, 1.0]), (7, [0.5] * 5), (7, [0.5] * 5), (8, [0.5] * 5), (50, [0.25] * 5), (50, [-0.25] * 5)]


def compare(found, expected):
    found = sorted(map(tuple, found), key=lambda r: r[:2])
    assert [r[:3] for r in found] == [r[:3] for r in expected]
    assert [r[3] for r in found] == pytest.approx([r[3] for r in expected], rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("rows", [some_rows(), some_rows() + ODD, some_rows(4), [(0, [1.0, 2.0])], [(i, [1.0, 1.0]) for i in range(300)]], ids=["plain", "odd", "few", "one", "same"])
@pytest.mark.parametrize("sizes", [(8192, 1024), (37, 2)])
def test_against_all_pairs(spark, rows, sizes):
    settings = dict(shard_rows=sizes[0], block_rows=sizes[1])
    found = grid_search(frame(spark, rows), 50, 10, kdtree.search_tile, "long", **settings).collect()
    compare(found, brute(rows, 50, 10, False))
    found = grid_search(frame(spark, rows), 25, 5, nearest.search_tile, "double", nonzero=True, **settings).collect()
    compare(found, brute(rows, 25, 5, True))


def test_large_numbers(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([1e38, -3e37, 1e-30, 5e20, 2.0]) for _ in range(4)]) for i in range(60)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    compare(grid_search(frame(spark, rows), 20, 10, kdtree.search_tile, "long").collect(), brute(rows, 20, 10, False))
    found = grid_search(frame(spark, rows), 20, 5, nearest.search_tile, "double", nonzero=True).collect()
    assert [r[3] for r in sorted(map(tuple, found))] == pytest.approx([r[3] for r in brute(rows, 20, 5, True)], rel=1e-9)


def test_tree_bounds_hold():
    rng = np.random.default_rng(2)
    rows = np.floor(rng.normal(size=(500, 6)) * 50)
    tree = kdtree.Tree(rows, 16)
    for node, (start, end) in enumerate(tree.spans):
        inside = tree.rows[start:end]
        assert (inside.min(axis=0) == tree.low[node]).all() and (inside.max(axis=0) == tree.high[node]).all()
    leaves = [s for s, c in zip(tree.spans, tree.children) if c is None]
    assert sorted(leaves)[0][0] == 0 and all(e - s <= 16 for s, e in leaves) and sum(e - s for s, e in leaves) == 500


def test_int8_bounds_hold():
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=(50, 16)), rng.normal(size=(80, 16)) * rng.choice([1e-3, 1, 1e3], (80, 1))
    ua, ub = (m / np.linalg.norm(m, axis=1)[:, None] for m in (a, b))
    (qa, sa, la), (qb, sb, lb) = nearest.quantised(ua), nearest.quantised(ub)
    near = (qa.astype(float) @ qb.astype(float).T) * sa[:, None] * sb
    assert (np.abs(near - ua @ ub.T) <= (1 + la[:, None]) * lb + la[:, None] + nearest.SLACK).all()


def test_queries_read_their_table(spark, tmp_path):
    rows = some_rows(250)
    folder = written(frame(spark, rows), tmp_path, "embeddings")
    compare(kdtree.op7_kdtree(spark, folder).collect(), brute(rows, 100, 10, False))
    compare(nearest.op10_nearest(spark, folder).collect(), brute(rows, 50, 5, True))
    folder = written(frame(spark, rows).limit(0), tmp_path, "embeddings")
    assert kdtree.op7_kdtree(spark, folder).collect() == [] and nearest.op10_nearest(spark, folder).collect() == []
