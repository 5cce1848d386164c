from collections import Counter

import pytest

import __spark_entry__ as entry
from tests.llm.data import odd_documents, odd_rows, prose, written
from tests.llm.test_packing import check_pieces, ids_of
from tests.llm.test_secrets import base_spans
from tests.llm.test_sketchjoin import classes_of, shingles
from tidings.llm import langid, mixing, packing
from tidings.llm.queries import registered

tokenizers = pytest.importorskip("tokenizers")
pipeline = pytest.importorskip("corpus_pipeline", reason="the pipeline is not there")


def stage_rows(spark, docs, folder, tmp_path):
    """The result of each stage, each written and read again."""
    out = []
    for name, stage in pipeline.STAGES:
        path = str(tmp_path / f"stage{len(out)}")
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_stages_against_brute_force(spark, tmp_path):
    secret = "token = 'abcdefgh1234' and more"
    rows = odd_rows() + [(300 + k, f"{prose('en', 30, k)} {secret} {prose('en', 20, k + 50)}", "en", "s1") for k in range(5)]
    docs = odd_documents(spark, rows)
    folder = written(docs, tmp_path)
    one, two, three, four, five = stage_rows(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder, tmp_path)
    for stage in (one, two, three, four):
        assert stage.columns == docs.columns
    texts = lambda df: Counter((r["doc_id"], r["text"]) for r in df.collect())

    given, kept = Counter((d, t) for d, t, _, _ in rows), texts(one)
    assert kept <= given
    assert not any(t is None or not langid.has_letter(t) for _, t in kept)
    for d, t, lang, _ in rows:  # plain documents of a learned language stay
        if lang in langid_words() and t and len(t.split()) >= 20:
            assert (d, t) in kept

    pairs = sorted(kept.elements(), key=str)
    members = {}
    for pair, g in zip(pairs, classes_of([shingles(t) for _, t in pairs])):
        members.setdefault(g, []).append(pair)
    assert texts(two) == Counter(min(m, key=lambda r: (r[0] is None, r[0] or 0)) for m in members.values())

    redacted = texts(three)
    assert Counter(d for d, _ in redacted.elements()) == Counter(d for d, _ in texts(two).elements())
    assert not any(base_spans(t) for _, t in redacted)
    assert {t for _, t in redacted} >= {t for _, t in texts(two) if not base_spans(t)}
    assert all(r["n_chars"] == len(r["text"]) for r in three.collect())

    mixed = texts(four)
    assert set(mixed) <= set(redacted) and all(n <= 2 * redacted[k] for k, n in mixed.items())
    slots, laid = mixing.mix(three)
    total = sum(r["taken"] for r in mixing.taken_words(slots, laid).collect())
    assert abs(sum(n * len(t.split()) for (_, t), n in mixed.items()) - total) < 0.35 * total

    whole = tokenizers.Tokenizer.from_file(packing.default_tokenizer())
    documents = {}
    for d, t in mixed.elements():
        documents.setdefault(d, []).append(ids_of(whole, t))
    assert check_pieces(five.collect(), documents) == 0


def langid_words():
    return ("en", "de", "fr")


def test_run_equals_its_stages(spark, tmp_path):
    folder = written(odd_documents(spark), tmp_path)
    last = stage_rows(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder, tmp_path)[-1]
    pieces = lambda df: Counter((r["doc_id"], r["doc_tokens"]) for r in df.collect())
    assert pieces(pipeline.run(spark, folder)) == pieces(last)


def test_empty_documents(spark, tmp_path):
    folder = written(odd_documents(spark).limit(0), tmp_path)
    assert pipeline.run(spark, folder).collect() == []
    folder = written(odd_documents(spark, [(1, None, None, None), (2, "  ", None, "a")]), tmp_path)
    assert pipeline.run(spark, folder).collect() == []


def test_registered_names():
    found = entry.queries()
    assert set(registered()) <= set(found) and found["pipeline"] is pipeline.run
    assert sorted(int(n[2:].split("_")[0]) for n in registered()) == list(range(1, 14))
    assert [n for n, _ in pipeline.STAGES] and len(pipeline.STAGES) == 5
