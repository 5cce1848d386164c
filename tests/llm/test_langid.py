import zlib

import duckdb
import numpy as np
import pytest

from tests.llm.data import odd_documents, odd_rows, prose, written
from tidings.llm import langid


def test_gradient_matches_differences():
    rng = np.random.default_rng(1)
    w = {k: v.astype(np.float64) for k, v in langid.new_weights(4, 3, 3, seed=2).items()}
    w["bytes"] = w["bytes"] / 8
    ids, labels = rng.integers(97, 101, (5, 6)), np.array([0, 1, 2, 1, 0])

    def loss(weights):
        p = langid.position_probabilities(weights, ids)
        return -np.log(p[:, np.arange(5), labels]).mean()

    _, g = langid.gradients(w, ids, labels)
    for name in w:
        flat = np.argsort(-np.abs(g[name]).ravel())[:4]
        for place in flat:
            at = np.unravel_index(place, w[name].shape)
            moved = {k: v.copy() for k, v in w.items()}
            moved[name][at] += 1e-4
            up = loss(moved)
            moved[name][at] -= 2e-4
            assert abs((up - loss(moved)) / 2e-4 - g[name][at]) < 2e-3 * max(1.0, abs(g[name][at])), name


@pytest.fixture(scope="module")
def model():
    return langid.train([(lang, prose(lang, 80, k)) for lang in ("en", "de", "fr") for k in range(20)], steps=300)


def test_held_out_accuracy(model):
    scorer = langid.Scorer(model)
    texts = [(lang, prose(lang, 30, 1000 + k)) for lang in ("en", "de", "fr") for k in range(40)]
    found = scorer.score([t for _, t in texts])
    assert np.mean([f[0] == lang for f, (lang, _) in zip(found, texts)]) > 0.97
    assert all(0 <= f[1] <= 1 for f in found)


def test_word_sums_are_the_whole_text(model):
    """Sums of remembered words equal one pass over all windows, long words included."""
    text = prose("de", 50, 3) + " " + "ü" * 200 + " " + "a" * 47 + " b"
    scorer = langid.Scorer(model)
    scorer.score([prose("de", 50, 4)])
    lang, score = scorer.score([text])[0]
    windows = [w for word in text.encode().split() for w in langid.cut_windows(word)]
    total = np.zeros(3)
    letters = 0
    for window in windows:
        ids = np.frombuffer(window, np.uint8)
        keep = langid.LETTER_BYTE[ids]
        total += langid.position_probabilities(model.weights, ids[None])[keep, 0].sum(axis=0)
        letters += keep.sum()
    assert model.languages[int(total.argmax())] == lang and abs(total.max() / letters - score) < 1e-6


def test_small_cache_changes_nothing(model, monkeypatch):
    texts = [prose("fr", 40, k) for k in range(10)]
    whole = langid.Scorer(model).score(texts)
    monkeypatch.setattr(langid, "CACHE_WORDS", 3)
    single = langid.Scorer(model)
    assert [single.score([t])[0][0] for t in texts] == [w[0] for w in whole]


def test_odd_documents(spark, tmp_path):
    found = langid.op2_language_id(spark, written(odd_documents(spark), tmp_path)).collect()
    rows = odd_rows()
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r[0]) for r in rows)
    by_id = {r["doc_id"]: r for r in found}
    for doc_id in (5, 6, 7, 8):
        assert (by_id[doc_id]["lang_pred"], by_id[doc_id]["score"]) == ("und", 0.0)
    assert by_id[13]["lang_pred"] in ("en", "de", "fr")
    for r in found:
        assert r["held_out"] == (zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 4 == 2)
    kept = langid.keep_identified(odd_documents(spark), None)
    assert kept.columns == odd_documents(spark).columns and kept.count() == 0


def test_nothing_to_learn(spark, tmp_path):
    rows = [(1, "some text", None, "s"), (2, None, "en", "s")]
    found = langid.op2_language_id(spark, written(odd_documents(spark, rows), tmp_path)).collect()
    assert {r["lang_pred"] for r in found} == {"und"}
    assert langid.op2_language_id(spark, written(odd_documents(spark, rows).limit(0), tmp_path)).collect() == []


def test_accuracy_on_the_given_table(spark):
    found = {r["doc_id"]: r for r in langid.op2_language_id(spark, "/root/testdata/sf0.001").collect()}
    truth = duckdb.sql("select doc_id, lang from '/root/testdata/sf0.001/documents.parquet' where lang is not null and text is not null").fetchall()
    held = [(found[d]["lang_pred"], lang) for d, lang in truth if found[d]["held_out"]]
    assert np.mean([a == b for a, b in held]) > 0.9
