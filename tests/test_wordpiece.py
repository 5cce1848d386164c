import random
import time
import unicodedata

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tidings.functions import unicode
from tidings.operators import joins, piecetable, piecetrie, wordpiece
from tidings.operators.numbering import running_count
from tidings.sources import vocabulary

TOKENS = [
    "[PAD]", "[UNK]", "[CLS]", "[SEP]", "all", "rights", "re", "##ser", "##ved", ".", "#", "hash", "tag", "吃",
    "了", "?", "un", "##aff", "##able", "x", "##x", "при", "##вет", "е",
]
# Texts whose spans are known.
TEXTS = [
    "Привет, ёлка Й  мир!", "한국어 각", "éà ≠ x\x00y \x0bz q", "嘛呢，吃了吗？", "All rights reserved.",
    "  吃了吗？    ", "#hash tag ##", "áb İI", "", " \n ", "কো ক়", "＄$+", "unaffable unx xx", "a b c d\te\rf",
    "́ ́x", "‘q’ «w»­r",
]


def category(c):
    return unicodedata.category(c)


# The pieces of each word of each text, written by hand.
PIECES = [
    [["при", "##вет"], [","], ["е", "##л", "##к", "##а"], ["и"], ["м", "##и", "##р"], ["!"]],
    [["\u1112", "##\u1161", "##\u11ab", "##\u1100", "##\u116e", "##\u11a8", "##\u110b", "##\u1165"], ["\u1100", "##\u1161", "##\u11a8"]],
    [["e", "##a"], ["="], ["x", "##y"], ["z"], ["q"]],
    [["嘛"], ["呢"], ["，"], ["吃"], ["了"], ["吗"], ["？"]],
    [["all"], ["rights"], ["re", "##ser", "##ved"], ["."]],
    [["吃"], ["了"], ["吗"], ["？"]],
    [["#"], ["hash"], ["tag"], ["#"], ["#"]],
    [["a", "##b"], ["i", "##i"]],
    [],
    [],
    [["\u0995", "##\u09c7", "##\u09be"], ["\u0995"]],
    [["＄"], ["$"], ["+"]],
    [["un", "##aff", "##able"], ["un", "##x"], ["x", "##x"]],
    [["a"], ["b"], ["c"], ["d"], ["e"], ["f"]],
    [["x"]],
    [["‘"], ["q"], ["’"], ["«"], ["w"], ["»"], ["r"]],
]
WORDS = [["".join(p.removeprefix("##") if i else p for i, p in enumerate(word)) for word in text] for text in PIECES]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string").repartition(3)


@pytest.fixture(scope="module")
def numbered(spark):
    return vocabulary.number_tokens(spark.createDataFrame(list(enumerate(TOKENS)), "line bigint, token string"))


@pytest.fixture(scope="module")
def vocab(numbered):
    return wordpiece.prepare(numbered)


def test_pretokens_and_raw_words(texts):
    rows = texts.select(
        "id", unicode.pretokens(F.col("text")).alias("words"),
        F.transform(unicode.raw_words(F.col("text")), lambda w: unicode.normal_word(w)).alias("raw"),
    ).orderBy("id").collect()
    assert [r.words for r in rows] == WORDS
    assert [[w for w in r.raw if w] for r in rows] == WORDS


def test_normalise_every_decomposable_character(spark):
    chars = [chr(c) for c in range(0x80, 0x30000) if not 0xD800 <= c <= 0xDFFF and unicodedata.decomposition(chr(c))]
    chars += ["가", "각", "힣", "뷁"]
    df = spark.createDataFrame([(c,) for c in chars], "c string")
    rows = df.select("c", unicode.strip_marks(F.col("c")).alias("out")).collect()
    plain = {c: "".join(x for x in unicodedata.normalize("NFD", c) if category(x) != "Mn") for c in chars}
    assert [r.c for r in rows if r.out != plain[r.c]] == []


@pytest.fixture(params=["shipped", "joined"])
def way(request, monkeypatch):
    """Both ways to a vocabulary: in the tasks, or in a join."""
    if request.param == "joined":
        monkeypatch.setattr(wordpiece, "SHIPPED_TOKENS", -1)


def test_pieces_match_greedy_walk(texts, vocab, way):
    ids = {t: i for i, t in enumerate(TOKENS)}
    rows = {r.id: r for r in wordpiece.encode(texts, vocab, ["id"]).collect()}
    assert len(rows) == len(TEXTS)
    for i in range(len(TEXTS)):
        tokens = ["[CLS]"] + [p for word in PIECES[i] for p in word] + ["[SEP]"]
        assert rows[i].tokens == tokens
        assert rows[i].token_ids == [ids.get(x, 1) for x in tokens]
        assert rows[i].segments == [0] * len(tokens)


def greedy(word, ids, unknown):
    """The longest token at each step, every length tried."""
    out, start = [], 0
    while start < len(word):
        mark = "##" if start else ""
        size = next((n for n in range(len(word) - start, 0, -1) if mark + word[start:start + n] in ids), None)
        out.append((mark + word[start:start + (size or 1)], ids[mark + word[start:start + size]] if size else unknown, start, size or 1))
        start += size or 1
    return out


def test_trie_equals_trying_every_length():
    rng = random.Random(0)
    for _ in range(1500):
        letters = "ab#c"[:rng.randrange(1, 5)]
        tokens = {rng.choice(["", "##"]) + "".join(rng.choice(letters) for _ in range(rng.randrange(1, 6))) for _ in range(rng.randrange(12))}
        ids = {t: i + 5 for i, t in enumerate(sorted(tokens))}
        walker = piecetrie.Walker(piecetrie.build(list(ids), list(ids.values()), "##"), "##", 1)
        for _ in range(5):
            word = "".join(rng.choice("ab#cd") for _ in range(rng.randrange(15)))
            assert walker.pieces(word) == greedy(word, ids, 1), (tokens, word)


def test_a_megabyte_word_is_read_once():
    ids = {"a": 1, "##a": 2, "##" + "a" * 200 + "b": 3}
    walker = piecetrie.Walker(piecetrie.build(list(ids), list(ids.values()), "##"), "##", 0)
    started = time.perf_counter()
    assert len(walker.pieces("a" * 1_000_000)) == 1_000_000
    assert time.perf_counter() - started < 10


def test_truncation_in_closed_form(spark):
    cases = [(a, b) for a in range(14) for b in range(14)]
    df = spark.createDataFrame(cases, "a int, b int")
    for max_len in (3, 4, 7, 10, 13):
        first, second = wordpiece.kept_lengths(F.col("a"), F.col("b"), max_len)
        for row in df.select("a", "b", first.alias("x"), second.alias("y")).collect():
            x, y = row.a, row.b
            while x + y > max_len - 3:
                x, y = (x - 1, y) if x > y else (x, y - 1)
            assert (row.x, row.y) == (x, y), (row, max_len)


def test_encode_truncates_and_pads(texts, vocab, way):
    rows = {r.id: r for r in wordpiece.encode(texts, vocab, ["id"], max_len=6).collect()}
    assert rows[4].tokens == ["[CLS]", "all", "rights", "re", "##ser", "[SEP]"]
    assert rows[8].token_ids == [2, 3, 0, 0, 0, 0] and rows[8].segments == [0] * 6
    pair = texts.withColumn("other", F.lit("x tag"))
    rows = {r.id: r for r in wordpiece.encode(pair, vocab, ["id"], second="other", max_len=8).collect()}
    assert rows[4].tokens == ["[CLS]", "all", "rights", "re", "[SEP]", "x", "tag", "[SEP]"]
    assert rows[4].segments == [0, 0, 0, 0, 0, 1, 1, 1]
    assert rows[8].token_ids == [2, 3, 19, 12, 3, 0, 0, 0]
    with pytest.raises(ValueError):
        wordpiece.encode(texts, vocab, ["id"], max_len=1)


def test_decode_inverts_encode(texts, vocab, numbered):
    pair = texts.withColumn("other", F.lit("unx tag"))
    decoded = wordpiece.decode(wordpiece.encode(pair, vocab, ["id"], second="other", max_len=40), numbered, ["id"])
    rows = {r.id: r for r in decoded.collect()}
    assert rows[12].first == ["un", "##aff", "##able", "un", "##x", "x", "##x"]
    assert all(r.second == ["un", "##x", "tag"] for r in rows.values())
    single = wordpiece.decode(wordpiece.encode(texts, vocab, ["id"]), numbered, ["id"])
    assert all(r.second is None for r in single.collect())


def test_spans_of_known_texts(texts, vocab, way):
    rows = wordpiece.token_spans(texts, vocab, ["id"]).orderBy("id", "at", "part").collect()
    spans = {}
    for r in rows:
        spans.setdefault(r.id, []).append((r.start, r.end))
    assert spans[4] == [(0, 3), (4, 10), (11, 13), (13, 16), (16, 19), (19, 20)]
    assert spans[3] == [(i, i + 1) for i in range(7)]
    assert spans[5] == [(2, 3), (3, 4), (4, 5), (5, 6)]
    assert spans[1][:3] == [(0, 1)] * 3  # the letters of one syllable share its place
    for r in rows:
        piece = r.token.removeprefix("##") if len(r.token) > 2 else r.token
        found = unicodedata.normalize("NFD", TEXTS[r.id][r.start : r.end]).lower()
        assert set(piece) <= set(found)


def test_both_ways_agree(spark, vocab, monkeypatch):
    rows = [(i, " ".join(TEXTS[j] for j in range(i % 5, len(TEXTS))), f"x tag {i}") for i in range(8)] + [(8, None, "a"), (9, "y" * 300, None)]
    df = spark.createDataFrame(rows, "id int, text string, other string").repartition(3)

    def found():
        pairs = [wordpiece.encode(df, vocab, ["id"], second="other", max_len=n).collect() for n in (None, 5, 24)]
        return [sorted(map(str, p)) for p in pairs] + [sorted(map(str, wordpiece.token_spans(df, vocab, ["id"]).collect()))]

    shipped = found()
    monkeypatch.setattr(wordpiece, "SHIPPED_TOKENS", -1)
    assert found() == shipped


def test_rows_without_decoding_stay(spark, numbered):
    encoded = spark.createDataFrame([(1, [2, 4, 3]), (2, [2, 4]), (3, [2, 999, 3]), (4, []), (5, None)], "id int, token_ids array<bigint>")
    rows = {r.id: (r.first, r.second) for r in wordpiece.decode(encoded, numbered, ["id"]).collect()}
    assert rows == {1: (["all"], None), 2: (None, None), 3: (None, None), 4: (None, None), 5: (None, None)}


def test_duplicate_tokens(spark):
    lines = spark.createDataFrame(list(enumerate(["a", "b", "a", "c"])), "line bigint, token string")
    ids = {r.token: r.id for r in vocabulary.number_tokens(lines, "collide").collect()}
    assert ids == {"a": 2, "b": 1, "c": 2}
    with pytest.raises(ValueError, match="a"):
        vocabulary.number_tokens(lines)
    with pytest.raises(ValueError):
        vocabulary.number_tokens(lines, "keep")


def test_last_token_of_a_shared_id_decodes(spark):
    lines = spark.createDataFrame(list(enumerate(["[PAD]", "b", "[SEP]", "b", "c"])), "line bigint, token string")
    vocab = vocabulary.number_tokens(lines, "collide")  # b=3, c=3
    encoded = spark.createDataFrame([(1, [9, 3, 2]), (2, [3, 3, 2])], "id int, token_ids array<bigint>")
    rows = wordpiece.decode(encoded, vocab, ["id"]).collect()
    assert sorted((r.id, r.first) for r in rows) == [(1, None), (2, ["c"])]


def test_vocabulary_file(spark, tmp_path):
    path = tmp_path / "vocab.txt"
    path.write_text("a\nb \n\n c\n", encoding="utf8")
    rows = vocabulary.read_vocabulary(spark, str(path)).orderBy("id").collect()
    assert [(r.token, r.id) for r in rows] == [("a", 0), ("b", 1), ("", 2), ("c", 3)]


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_running_count_in_any_layout(spark, parts):
    rows = [(i * 7 % 101, i % 3 == 0) for i in range(101)]
    df = spark.createDataFrame(rows, "key int, flag boolean").repartition(parts)
    plain = {r.key: r.position for r in running_count(df, ["key"]).collect()}
    assert plain == {k: k for k in range(101)}
    flagged = {r.key: r.position for r in running_count(df, ["key"], F.col("flag")).collect()}
    marks = {k: f for k, f in rows}
    assert flagged == {k: sum(marks[j] for j in range(k)) for k in range(101)}


def test_lookup_join_paths_agree_on_a_hot_key(spark):
    facts = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i % 7}") for i in range(300)], "id int, key string")
    table = spark.createDataFrame([("hot", 1), ("k0", 2), ("k3", 3)], "key string, value int")
    small = joins.lookup_join(facts, table, "key")
    salted = joins.lookup_join(facts, table, "key", broadcast_bytes=0, salts=4)
    assert sorted(map(str, small.collect())) == sorted(map(str, salted.collect()))
    inner = joins.lookup_join(facts, table, "key", "inner", broadcast_bytes=0, salts=4)
    assert inner.count() == small.filter("value is not null").count()
    with pytest.raises(ValueError):
        joins.lookup_join(facts, table, "key", "full")


def test_table_equals_trying_every_length():
    rng = random.Random(1)
    for _ in range(500):
        letters = "aé#了"[:rng.randrange(1, 5)]
        tokens = {rng.choice(["", "##"]) + "".join(rng.choice(letters) for _ in range(rng.randrange(1, 6))) for _ in range(rng.randrange(12))}
        ids = {t: i + 5 for i, t in enumerate(sorted(tokens))}
        speller = piecetable.Speller(piecetable.build(pa.array(list(ids), pa.string()), list(ids.values()), "##"), "##", 1)
        words = ["".join(rng.choice("aé#了d") for _ in range(rng.randrange(15))) for _ in range(5)]
        assert speller.pieces_of(words) == [greedy(word, ids, 1) for word in words], (tokens, words)


def test_trie_and_table_agree_in_spark(spark, vocab, monkeypatch):
    rows = [(i, " ".join(TEXTS[i:]) or None, f"x tag {i}") for i in range(len(TEXTS) + 1)] + [(99, None, None), (100, "", "y" * 300)]
    df = spark.createDataFrame(rows, "id int, text string, other string").repartition(3)

    def found():
        pairs = [wordpiece.encode(df, vocab, ["id"], second="other", max_len=n).collect() for n in (None, 9)]
        return [sorted(map(str, p)) for p in pairs] + [sorted(map(str, wordpiece.token_spans(df, vocab, ["id"]).collect()))]

    trie = found()
    monkeypatch.setattr(wordpiece, "TRIE_TOKENS", -1)
    assert found() == trie


def test_texts_meet_no_join_with_a_vocabulary_of_millions(texts, vocab, numbered):
    many = vocab._replace(size=4_000_000)
    encoded = wordpiece.encode(texts, many, ["id"])
    assert "Join" not in plan_of(encoded) and "Exchange hashpartitioning" not in plan_of(encoded)
    assert "Join" not in plan_of(wordpiece.token_spans(texts, many, ["id"]))
    # Only whole lists move, and neither ids nor tokens by themselves.
    assert "Join" not in plan_of(wordpiece.decode(encoded, numbered, ["id"]))


def test_decode_ways_agree(spark, numbered, monkeypatch):
    lists = [(1, [2, 4, 3, 9, 3, 0, 0]), (1, [2, 5, 3]), (None, [2, 4, 3]), (2, [2, None, 3]), (3, [2, 999, 3]), (4, []), (5, None), (6, [2, 3]), (7, [4, 5])]
    encoded = spark.createDataFrame(lists, "id int, token_ids array<bigint>")
    shipped = sorted(map(str, wordpiece.decode(encoded, numbered, ["id"]).collect()))
    monkeypatch.setattr(wordpiece, "SHIPPED_TOKENS", -1)
    assert sorted(map(str, wordpiece.decode(encoded, numbered, ["id"]).collect())) == shipped


def test_head_of_a_text_gives_its_first_words(spark):
    ends = ["", ".", "Σ.α b", "é" * 300, "x\x00y" * 90, " " * 400 + "z", "wort " * 200]
    rows = [(f"{head}{end}",) for head in ("", "ΟΔΟΣ.α ", "a b c ", "한국어, ab " * 20, "a" * 1000 + " b") for end in ends]
    words = unicode.pretokens(F.col("text"))
    df = spark.createDataFrame(rows, "text string")
    for most in (1, 3, 7):
        found = df.select(wordpiece._head_words(F.col("text"), False, most).alias("head"), F.slice(words, 1, most).alias("whole")).collect()
        assert [r.head for r in found] == [r.whole for r in found]
