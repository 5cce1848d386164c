import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.data import odd_documents, odd_rows, prose, written
from tidings.llm import packing

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def whole():
    return tokenizers.Tokenizer.from_file(packing.default_tokenizer())


def ids_of(whole, text):
    return whole.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]


def test_tokens_equal_the_whole_tokenizer(whole):
    tokens, rng = packing.Tokens(packing.default_tokenizer()), random.Random(1)
    alphabet = "aBcÉßöÿĀİſŉª²½ǅΣςد中あ́  \x1c\x85\x00 \n\t'sltre!?.,09٣𝟘😀ﬁŸẞ_-"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(15))) + rng.choice(["", "<|endoftext|>", " it's we'll"]) for _ in range(4000)]
    texts += [prose("fr", 50, 1), "", "x" * 5000, "é" * 3000 + "中" * 3000]
    for text, found in zip(texts, tokens.encode(texts)):
        assert np.frombuffer(found, "<u2").tolist() == ids_of(whole, text), text


def test_small_cache_changes_nothing(monkeypatch):
    texts = [prose("de", 30, k) for k in range(12)]
    expected = packing.Tokens(packing.default_tokenizer()).encode(texts)
    monkeypatch.setattr(packing, "CACHE_UNITS", 3)
    tokens = packing.Tokens(packing.default_tokenizer())
    assert [tokens.encode([t])[0] for t in texts] == expected


def check_pieces(found, documents, window=packing.WINDOW):
    """Whole documents in pieces; gapless sequences; padding only where a sequence is no power of two."""
    by_doc = defaultdict(list)
    for r in found:
        by_doc[r["doc_id"]].append(r)
    for doc_id, options in documents.items():
        rows = sorted(by_doc[doc_id], key=lambda r: (r["start"], r["ids_crc32"]))
        wanted = Counter()
        for ids in options:
            wanted[len(ids)] += len(ids)
        got = Counter()
        for r in rows:
            got[r["doc_tokens"]] += r["length"]
            sums = {zlib.crc32(np.array(ids[r["start"]:r["start"] + r["length"]], "<u4").tobytes()) for ids in options if len(ids) == r["doc_tokens"]}
            assert r["ids_crc32"] in sums and r["length"] > 0
        assert got == wanted
        if len(options) == 1:
            at = 0
            for r in rows:
                assert r["start"] == at
                at += r["length"]
    sequences = defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    assert sorted(sequences) == list(range(len(sequences)))
    return padding


def test_odd_documents(spark, tmp_path, whole):
    found = packing.op8_packing(spark, written(odd_documents(spark), tmp_path)).collect()
    documents = defaultdict(list)
    for d, t, _, _ in odd_rows():
        documents[d].append(ids_of(whole, t))
    assert {r["doc_id"] for r in found} == set(documents)
    assert check_pieces(found, documents) == 0
    assert packing.op8_packing(spark, written(odd_documents(spark).limit(0), tmp_path)).collect() == []


@pytest.mark.parametrize("window", [16, 64])
def test_small_windows(spark, tmp_path, whole, window):
    rng = random.Random(window)
    rows = [(i, prose("en", rng.randrange(0, 70), i), None, None) for i in range(300)]
    found = packing.pack(odd_documents(spark, rows), packing.default_tokenizer(), window).collect()
    assert check_pieces(found, {d: [ids_of(whole, t)] for d, t, _, _ in rows}, window) == 0


def test_plan_never_uses_a_piece_twice():
    rng = random.Random(3)
    for _ in range(20):
        window = rng.choice([8, 32, 100])
        lengths = {n: rng.randrange(1, 200) for n in rng.sample(range(1, window), rng.randrange(1, window - 1))}
        allotments, residuals, tail = packing.make_plan(lengths, window)
        used, fill = Counter(), defaultdict(list)
        for n, first, times, sequence, offset in allotments:
            assert first == used[n]  # pieces are used in order, each once
            used[n] += times
            for k in range(times):
                fill[sequence + k].append((offset, n))
        assert all(used[n] <= lengths[n] for n in used)
        for parts in fill.values():
            assert sum(n for _, n in parts) == window and sorted(parts)[0][0] == 0
        at = 0
        for n, first, start in residuals:
            assert (first, start) == (used[n], at)
            at += n * (lengths[n] - first)
        assert sum(tail) == at % window and all(s & (s - 1) == 0 for s in tail) and tail == sorted(tail, reverse=True)
        assert sum(n * c for n, c in lengths.items()) == window * len(fill) + at


def test_solution_is_least_squares():
    """The gradient is zero where x is positive, and points outwards where it is zero."""
    histogram = np.array([0, 40, 10, 30, 5, 20, 0, 8])
    combos = packing.combinations({n: int(c) for n, c in enumerate(histogram) if c}, 8)
    x = packing.solve_repeats(combos, histogram, steps=20_000)
    matrix = np.zeros((8, len(combos)))
    for k, parts in enumerate(combos):
        for n in parts:
            matrix[n, k] += n > 0
    slope = matrix.T @ (matrix @ x - histogram)
    assert (slope > -1e-3).all() and (np.abs(slope[x > 1e-6]) < 1e-3).all() and (matrix[0] == 0).all()
    assert all(sum(parts) == 8 for parts in combos) and len({tuple(sorted(p)) for p in combos}) == len(combos)


def test_workers_get_texts_in_small_batches(spark, monkeypatch, tmp_path):
    def strict(function):
        def checked(batches):
            for batch in batches:
                if batch.num_rows > 1024:
                    raise ValueError("a batch of too many texts")
                yield batch

        return lambda batches: function(checked(batches))

    monkeypatch.setattr(packing, "tidied", strict)
    docs = spark.range(3000).selectExpr("id AS doc_id", "'a few words' AS text").coalesce(1)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert packing.tokenise(docs, packing.default_tokenizer(), str(tmp_path / "tokens")).count() == 3000
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
