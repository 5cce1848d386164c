import numpy as np
import pytest
from pyspark.sql import functions as F

from tidings.operators import frames, gap
from tidings.plans.digest import run_digest

SCHEMA = "timeframe string, id bigint, sentence string, features array<double>"


def blobs(label, seed, sizes, dims=3):
    rng = np.random.default_rng(seed)
    centres = rng.uniform(-9, 9, (len(sizes), dims))
    points = np.concatenate([rng.normal(c, 0.2, (n, dims)) for c, n in zip(centres, sizes)])
    return [(label, i, f"{label}-s{i}", [float(x) for x in p]) for i, p in enumerate(points)]


def several():
    rows = blobs("t1", 1, [30, 50, 20]) + blobs("t2", 2, [40, 10]) + blobs("t3", 3, [12] * 5) + blobs("flat", 4, [25], 3)
    rows += [("one", 0, "only", [1.0, 2.0, 3.0])] + [("same", i, f"c{i}", [4.0, 4.0, 4.0]) for i in range(9)]
    # Copies crowd out the distinct points.
    rows += [("copies", i, f"x{i}", [float(i % 50 == 0) * i, 1.0, 0.0]) for i in range(300)]
    return rows


def rounded(rows):
    return sorted((r.timeframe, [round(x, 9) for x in r.vector], list(r.sentences)) for r in rows)


@pytest.mark.parametrize("part_bytes, block, rule", [(8 << 20, 3, "first_drop"), (400, 2, "tibshirani")])
def test_equal_to_single_searches(spark, monkeypatch, part_bytes, block, rule):
    monkeypatch.setattr(frames, "PART_BYTES", part_bytes)
    rows = several()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    layout = frames.lay_out(df, ["id"], 6, 2, part_bytes)
    try:
        found = frames.search(layout, n_refs=4, k_max=6, seed=2, block=block, rule=rule)
        tables, centres = found.table.collect(), {r.timeframe: r.centres for r in found.centres.collect()}
    finally:
        layout.points.unpersist()
    for label in {r[0] for r in rows}:
        one = gap.search(df.where(F.col("timeframe") == label), ["id"], n_refs=4, k_max=6, seed=2, block=block, rule=rule)
        assert (one.centres is None) == (label not in centres)
        if one.centres is not None:
            assert np.allclose(np.reshape(centres[label], (-1, 3)), one.centres)
        want = {r.k: [r.gap_value, r.sk, r.gap_star, r.sk_star] for r in one.table.collect()}
        got = {r.k: [r.gap_value, r.sk, r.gap_star, r.sk_star] for r in tables if r.timeframe == label}
        assert set(got) == set(want)
        for k in want:
            assert np.allclose(got[k], want[k], equal_nan=True)


def test_digests_of_many_timeframes(spark):
    rows = several()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = rounded(frames.digests(df, ["id"], n_refs=3, k_max=5, num_take=4).collect())
    single = []
    for label in sorted({r[0] for r in rows}):
        part = df.where(F.col("timeframe") == label).drop("timeframe")
        single += run_digest(part, label, ["id"], n_refs=3, k_max=5, num_take=4).collect()
    assert found == rounded(single) and len(found) >= 3
    empty = spark.createDataFrame([], SCHEMA)
    assert frames.digests(empty, ["id"], n_refs=2, k_max=3).collect() == []


def test_many_timeframes_take_as_many_passes_as_one(spark, monkeypatch):
    passes, plain = [], frames._pass
    monkeypatch.setattr(frames, "_pass", lambda *a: passes.append(1) or plain(*a))
    counts = []
    for labels in (1, 60):
        df = spark.createDataFrame([r for k in range(labels) for r in blobs(f"t{k}", 7, [10, 14])], SCHEMA)
        out = frames.digests(df, ["id"], n_refs=2, k_max=3, num_take=2).collect()
        counts.append(len(passes))
        assert len(out) in (0, labels)
        passes.clear()
    assert counts[0] == counts[1]


def test_a_timeframe_without_label_is_one_more(spark):
    rows = [(None, *r[1:]) for r in blobs("x", 5, [20, 30])] + blobs("\1odd", 6, [20, 30])
    out = frames.digests(spark.createDataFrame(rows, SCHEMA), ["id"], n_refs=3, k_max=4, num_take=3).collect()
    assert {r.timeframe for r in out} <= {None, "\1odd"} and out
    for r in out:
        assert len(r.sentences) == 3


def test_points_do_not_move_in_a_pass(spark):
    layout = frames.lay_out(spark.createDataFrame(several(), SCHEMA), ["id"], 4, 0)
    try:
        state = frames._start(layout.frames, 1, 2, 1, 0, layout.dims)
        plan = frames._pass(layout, state, 1, 0)._jdf.queryExecution().executedPlan().toString()
        left = plan[plan.index("FlatMapCoGroupsInArrow"):plan.index("InMemoryTableScan")]
        assert "Exchange" not in left, plan
    finally:
        layout.points.unpersist()


def test_small_timeframes_take_no_passes(spark, monkeypatch):
    """Timeframes of one part are fitted where they lie, beside one of several parts; results are those of passes."""
    rows = [r for k in range(5) for r in blobs(f"t{k}", k, [10, 14])] + blobs("big", 9, [40, 30, 30])
    df, passes, plain = spark.createDataFrame(rows, SCHEMA), [], frames._pass
    monkeypatch.setattr(frames, "_pass", lambda layout, state, *a: passes.append({r.timeframe for r in state.collect()}) or plain(layout, state, *a))
    got = {}
    for part_bytes in (24 * 50, 24 * 5):  # 50 points a part: only the last has more; then 5
        passes.clear()
        monkeypatch.setattr(frames, "PART_BYTES", part_bytes)
        layout = frames.lay_out(df, ["id"], 4, 3, part_bytes)
        try:
            centres, costs = frames.fit_block(layout, layout.frames, 1, 3, 2, 3, max_iter=3)
            got[part_bytes] = sorted((r.timeframe, r.k, r.ref_id, round(r.w, 9)) for r in costs.collect()), sorted((r.timeframe, np.round(r.centres, 9).tolist()) for r in centres.collect())
            assert set().union(*passes) == ({"big"} if part_bytes > 200 else {r[0] for r in rows})
        finally:
            layout.points.unpersist()
    assert got[24 * 50] == got[24 * 5] and len(got[24 * 50][0]) == 6 * 3 * 3
