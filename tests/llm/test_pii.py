import hashlib
import itertools
import math
import random
import re

import pytest

from tests.llm.data import odd_documents, odd_rows, prose, written
from tidings.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    valid = lambda s: sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(s))) % 10 == 0
    found = [(0, *m.span()) for m in EMAIL.finditer(text)]
    found += [(1, *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [(2, *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m[0])) <= 19 and valid(digits(m[0]))]
    return found + [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]


def test_rules_on_random_texts():
    rng = random.Random(4)
    parts = ["a", "b.c", "@", ".", "-", "_", " ", "+", "1", "23", "456", "4111111111111111", "255", "256", "(", ")", "é", "🎉", "\n", "x@y.z"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        assert pii.rule_spans(text) == brute(text), text


def test_rules_are_linear():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 100_000, "a@" * 100_000, "+1" + " " * 200_000):
        pii.rule_spans(text)


def all_paths(n, segments):
    """Every segmentation of n atoms: chosen segments that do not overlap."""
    for size in range(n + 1):
        for chosen in itertools.combinations(range(len(segments)), size):
            spans = sorted((segments[k][0], segments[k][1]) for k in chosen)
            if all(a[1] <= b[0] for a, b in zip(spans, spans[1:])):
                yield chosen


def test_field_against_all_segmentations():
    rng = random.Random(1)
    for _ in range(30):
        n = rng.randrange(2, 6)
        segments = [(i, j, k, [f"{i},{j},{k}"]) for i in range(n) for j in range(i + 1, n + 1) for k in range(2) if rng.random() < 0.4][:9]
        weights = {f[0]: rng.uniform(-2, 2) for *_, f in segments} | {"touch": rng.uniform(-1, 1)}

        def score(chosen):
            spans = sorted((segments[k][0], segments[k][1]) for k in chosen)
            touching = sum(a[1] == b[0] for a, b in zip(spans, spans[1:]))
            return sum(weights[segments[k][3][0]] for k in chosen) + weights["touch"] * touching

        paths = list(all_paths(n, segments))
        total = sum(math.exp(score(p)) for p in paths)
        found, log_total = pii.marginals(weights, n, segments)
        assert log_total == pytest.approx(math.log(total))
        for k in range(len(segments)):
            assert found[k] == pytest.approx(sum(math.exp(score(p)) for p in paths if k in p) / total)
        best = pii.best_path(weights, n, segments)
        assert score(best) == pytest.approx(max(map(score, paths))) and tuple(sorted(best)) in {tuple(sorted(p)) for p in paths}


@pytest.fixture(scope="module")
def weights():
    rng = random.Random(9)
    texts = []
    for k in range(150):
        number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
        entity = rng.choice([f"j{k}@mail.example.com", f"+1 ({number(3)}) {number(3)}-{number(4)}", f"10.{rng.randrange(255)}.3.{rng.randrange(255)}", number(16), number(7)])
        texts.append(f"{prose('en', 6, k)} {entity} {prose('en', 5, k + 1)}")
    return pii.train(texts)


def test_field_adds_what_rules_miss(weights):
    text = "write to joe(at)mail.example.com or call (234) 555-6789 now"
    base, added = pii.all_spans(text, weights)
    assert base == [] and [(pii.KINDS[k], text[s:e]) for k, s, e in added] == [("email", "joe(at)mail.example.com"), ("phone", "(234) 555-6789")]
    text = "call +1 (826) 555-4081 190.137.2.77 now"  # the rule's phone runs on into the address
    base, added = pii.all_spans(text, weights)
    assert [(pii.KINDS[k], text[s:e]) for k, s, e in base + added] == [("ip", "190.137.2.77"), ("phone", "+1 (826) 555-4081")]


def test_field_leaves_clean_text_alone(weights):
    for text in (prose("en", 300, 77), "in 2024 and 1999, 12 of 345", "", "version 1.2.3", "at 10:30"):
        assert pii.all_spans(text, weights) == ([], [])


def test_odd_documents(spark, tmp_path):
    found = pii.op6_pii(spark, written(odd_documents(spark), tmp_path)).collect()
    wanted = []
    for d, t, _, _ in odd_rows():
        spans = brute(t or "")
        line = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in spans)
        wanted.append((d, *[sum(s[0] == k for s in spans) for k in range(4)], hashlib.sha256(line.encode()).hexdigest()))
    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"]
    assert sorted(str(tuple(r[c] for c in names)) for r in found) == sorted(map(str, wanted))
    assert pii.op6_pii(spark, written(odd_documents(spark).limit(0), tmp_path)).collect() == []
