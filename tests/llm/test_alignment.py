import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.data import odd_documents, odd_rows, prose, written
from tidings.llm import alignment

PATHS = alignment.default_paths()


def whole_texts(texts):
    """Per text (a ids, b ids, groups, links) from whole encodings, token by token; None without tokens."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a.encode_special_tokens = True
    letters = alignment.byte_letters()
    out = []
    for text in texts:
        if not text:
            out.append(None)
            continue
        one = a.encode(" " + text, add_special_tokens=False)
        two = b.encode(text)
        sizes_a = [bytes(letters[c] for c in t) for t in one.tokens]
        sizes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in two for p in [b.id_to_piece(i)]]
        if not b"".join(sizes_a) == b"".join(sizes_b) == (" " + text).encode():
            out.append(None)
            continue
        spans = []
        for ids, parts in ((one.ids, sizes_a), (two, sizes_b)):
            at, found = 0, []
            for i, part in zip(ids, parts):
                found.append((i, at, at + len(part)))
                at += len(part)
            spans.append(found)
        cuts = sorted({x[2] for x in spans[0]} & {x[2] for x in spans[1]})
        groups, start = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, s, e in side if start <= s and e <= cut) for side in spans))
            start = cut
        links = [(i, j) for i, s, e in spans[0] for j, p, q in spans[1] if s < q and p < e]
        out.append((one.ids, two, groups, links))
    return out


def expected(rows):
    """rows: (doc_id, text)"""
    found = whole_texts([t for _, t in rows])
    counts = Counter(link for f in found if f for link in f[3])
    highest = defaultdict(int)
    for (_, j), n in counts.items():
        highest[j] = max(highest[j], n)
    out = []
    for (d, _), f in zip(rows, found):
        if f is None:
            out.append((d, 0, 0, 0, 0, 0, 0, ""))
        else:
            best = sum(counts[x] == highest[x[1]] for x in f[3])
            out.append((d, len(f[0]), len(f[1]), len(f[2]), len(f[3]), best, sum(counts[x] for x in f[3]), ";".join(f[2])))
    return out


TRICKY = [
    "a  b", " lead", "trail ", "  ", " ", "\n", "a \n b", "a\n b", "a\n  b", "\t\tx  \n\n y", "don't  we'll go", "<|endoftext|> x <s> </s>", "▁", "x▁ y",
    "\x00 null", "\x1c y\x1c  z", "ﬁ Ⅳ é", "中文 文本。 ok", "🎉🎉 🎊", "1234567 89", "x" * 3000, "a　b  c", "\r\n \r\n", "﻿bom", "ab" * 400 + " " + "é" * 500,
]


def documents():
    rows = [(d, t) for d, t, *_ in odd_rows()]
    return rows + [(1000 + i, t) for i, t in enumerate(TRICKY)]


@pytest.mark.parametrize("pairs", [alignment.BROADCAST_PAIRS, 300, 0])
def test_against_whole_texts(spark, pairs):
    rows = documents()
    docs = odd_documents(spark, [(d, t, "en", "s") for d, t in rows])
    got = alignment.align(docs, *PATHS, broadcast_pairs=pairs)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected(rows), key=repr)


def test_query_digests_groups_and_takes_empty_tables(spark, tmp_path):
    rows = documents()
    folder = written(odd_documents(spark, [(d, t, "en", "s") for d, t in rows]), tmp_path)
    got = sorted(map(tuple, alignment.op12_alignment(spark, folder).collect()), key=repr)
    want = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[1] else "") for r in expected(rows)]
    assert got == sorted(want, key=repr)
    assert alignment.align(odd_documents(spark, []), *PATHS).collect() == []


def test_chunks_and_small_caches_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(alignment, "CACHE_CHUNKS", 20)
    monkeypatch.setattr(alignment, "PENDING_LINKS", 30)
    monkeypatch.setattr(alignment, "SLICE", 3)
    rows = documents()
    got = alignment.align(odd_documents(spark, [(d, t, "en", "s") for d, t in rows]).coalesce(1), *PATHS)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected(rows), key=repr)


def test_random_white_space_splits_like_whole_texts():
    rng = random.Random(5)
    tokenizers = alignment.Tokenizers(*PATHS)
    assert tokenizers.separate
    for _ in range(3000):
        text = "".join(rng.choice([" ", " ", "\n", "\t", " ", "\x1c", "　", "a", "be", "'s", ".", "1", "é", "'", "word"]) for _ in range(rng.randrange(1, 14)))
        a, b = tokenizers.encode(alignment.split_chunks(text))
        whole_a, whole_b = tokenizers.encode([text])
        assert sum(a, []) == whole_a[0] and sum(b, []) == whole_b[0], repr(text)


def test_pointers_lead_to_the_end_of_the_group():
    rng = np.random.default_rng(0)
    for _ in range(300):
        size = int(rng.integers(2, 60))
        a, b = (np.unique(np.r_[rng.integers(1, size, rng.integers(0, size)), size]) for _ in range(2))
        cuts = np.intersect1d(a, b)
        to = alignment.terminals(a, b)
        ends = np.concatenate([a, b])
        assert (ends[to] == cuts[np.searchsorted(cuts, ends)]).all() and (to < len(a)).all()
        one, two = alignment.links(a, b)
        starts_a, starts_b = np.r_[0, a[:-1]], np.r_[0, b[:-1]]
        want = [(i, j) for i in range(len(a)) for j in range(len(b)) if starts_a[i] < b[j] and starts_b[j] < a[i]]
        assert list(zip(one.tolist(), two.tolist())) == want


def test_long_word_is_taken_whole(spark):
    text = prose("en", 20, 1) + " " + "abc" * 100_000
    got = alignment.align(odd_documents(spark, [(1, text, "en", "s")]), *PATHS, digest=True).first()
    assert got["n_links"] >= got["n_a"] > 30_000 and len(got["groups_sha256"]) == 64
