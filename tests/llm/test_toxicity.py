import random
import zlib

import numpy as np
import pytest

from tests.llm.data import odd_documents, odd_rows, prose, written
from tidings.llm import toxicity as tox


def sample(n, seed):
    rng, out = random.Random(seed), []
    for k in range(n):
        text, bad = prose(rng.choice(["en", "de"]), 40, f"{seed}{k}"), k % 2
        words = text.split()
        for _ in range(3 * bad):
            words.insert(rng.randrange(len(words)), rng.choice(["idiot", "blorfa", "worthless"]))
        out.append((" ".join(words), bad))
    return out


def test_held_out_accuracy_and_scores():
    model = tox.train(sample(400, 1), odds=5.0)
    assert "blorfa" in model.lexicon.learned
    test = sample(200, 2)
    scores = model.score([tox.features(t, model.lexicon) for t, _ in test])
    assert ((scores >= 0.7) == np.array([y == 1 for _, y in test])).mean() > 0.95
    assert scores.min() >= 0 and scores.max() <= 1
    assert 0 <= model.score([tox.features("", model.lexicon)])[0] < 0.7


PHRASES = ["You are a worthless idiot", "Shut up, you fool", "you stupid loser", "What a pathetic moron you are", "Y0u are an id1ot", "idiooot scum trash"]


@pytest.fixture(scope="module")
def model():
    return tox.train(sample(600, 7), odds=3.0)


@pytest.mark.parametrize("length", [0, 1000, 3000, 10_000])
def test_one_phrase_in_a_clean_text_of_any_length(model, length):
    """Also insults and disguises that no training row holds."""
    body = prose("en", 2 + length // 4, f"host{length}")[:length].split(" ")
    at = len(body) // 2
    scores = model.score([tox.features(" ".join(body[:at] + [p] + body[at:]), model.lexicon) for p in PHRASES])
    assert (scores >= 0.7).all(), dict(zip(PHRASES, scores.round(2)))
    assert model.score([tox.features(" ".join(body), model.lexicon)])[0] < 0.7


def test_long_clean_texts_stay_clean(model):
    texts = [prose(lang, n, f"long{n}") for lang in ("en", "de", "fr") for n in (5, 500, 9000)] + ["", "1234 !!! ???"]
    assert (model.score([tox.features(t, model.lexicon) for t in texts]) < 0.7).all()


def test_learned_words_must_be_confirmed():
    rows = [("plorf the water", 1), ("the water house", 0)] * 20
    chance = [("zzyzx the", 1)] * 3 + rows
    assert tox.learn_words(rows) and set(tox.learn_words(rows)) == {"plorf"}
    assert "zzyzx" not in tox.learn_words(chance)


def brute_isotonic(margins, y, w):
    """The isotonic fit by the max-min formula."""
    order = np.argsort(margins, kind="stable")
    m, y, w = margins[order], y[order], w[order]
    values = np.unique(m)
    low = [np.searchsorted(m, v, "left") for v in values]
    high = [np.searchsorted(m, v, "right") for v in values]
    mean = lambda i, j: (y[low[i]:high[j]] * w[low[i]:high[j]]).sum() / w[low[i]:high[j]].sum()
    n = len(values)
    return values, np.array([max(min(mean(i, j) for j in range(k, n)) for i in range(k + 1)) for k in range(n)])


def test_isotonic_matches_the_formula():
    rng = np.random.default_rng(3)
    margins, y, w = rng.integers(0, 12, 60).astype(float), rng.integers(0, 2, 60).astype(float), rng.integers(1, 4, 60).astype(float)
    values, expected = brute_isotonic(margins, y, w)
    knots = tox.isotonic(margins, y, w)
    assert np.interp(values, *knots) == pytest.approx(expected)


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((800, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(float)
    trees = tox.grow_trees(x, y)
    assert ((trees.margin(x) > 0) == (y == 1)).mean() > 0.97


def test_features_read_whole_texts_and_disguises():
    lexicon = tox.Lexicon({})
    name = dict(zip(tox.FEATURES, tox.features("x " * 50_000 + "you id1ot and you IDIOT!!", lexicon)))
    assert name["insults"] > 0 and name["disguised"] > 0 and name["nearest_you"] == 1 and name["exclaims"] > 0
    assert len(tox.features("", lexicon)) == len(tox.FEATURES)


@pytest.mark.parametrize("labels", ["both", "none", "odd"])
def test_odd_documents(spark, tmp_path, labels):
    rows = odd_rows()
    folder = written(odd_documents(spark), tmp_path)
    marks = {"both": [(d, d % 2) for d, _, _, _ in rows if d is not None], "none": [], "odd": [(None, 1), (100, None), (101, 7), (102, 1), (102, 0)]}[labels]
    spark.createDataFrame([(d, 1, t, 0.5) for d, t in marks], "doc_id long, quality int, toxic int, place double").write.parquet(f"{folder}/labels.parquet")
    found = tox.op4_toxicity(spark, folder).collect()
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r[0]) for r in rows)
    for r in found:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        assert r["held_out"] == (zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 3 == 1)
    if labels == "none":
        assert {r["score"] for r in found} == {0.0}


def test_empty_table(spark, tmp_path):
    folder = written(odd_documents(spark).limit(0), tmp_path)
    spark.createDataFrame([(1, 1)], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert tox.op4_toxicity(spark, folder).collect() == []


def inflected(n, seed):
    """Texts hold two new words, toxic ones of one stem with changing endings; all hold a word of the fixed list that tells nothing."""
    rng, letters = random.Random(seed), "abcdefghijklmnoprstuvz"
    ending = lambda: "".join(rng.choice(letters) for _ in range(4))
    out = []
    for k in range(n):
        words = prose(rng.choice(["fr", "de"]), 40, f"i{seed}{k}").split() + ["vile"]
        stem = lambda: "vraxu" if k % 2 else rng.choice(letters) + ending()
        out.append((" ".join([stem() + ending(), *words, stem() + ending()]), k % 2))
    return out


def test_stems_with_new_endings_rank_toxic_texts_first():
    model = tox.train(inflected(200, 1), odds=3.0)
    test = inflected(100, 2)
    scores = model.score([tox.features(t, model.lexicon) for t, _ in test])
    bad = np.array([y == 1 for _, y in test])
    assert scores[bad].min() > scores[~bad].max() and ((scores >= 0.7) == bad).all()
    assert "vile" not in model.lexicon.insults


def test_fragments_need_both_halves_and_many_texts():
    found = tox.learn_fragments(inflected(200, 3))
    assert any(f in " vraxu" for f in found) and not any(f in "the water house" for f in found)
    rows = [("the water house", 0), ("the house", 1)] * 30
    assert tox.learn_fragments([("vraxuabc the", 1)] * 9 + rows) == {} and tox.learn_fragments(rows + rows[:1]) == {}
