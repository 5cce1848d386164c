"""Sentence boundaries learned from the corpus, without labels.

A full stop ends a sentence unless the word before it is an abbreviation, an initial or a number and
nothing behind it looks like a beginning. Which words are abbreviations, which pairs of words hang
together across a full stop, and which words begin sentences is decided by log-likelihood ratios of
counts over all texts (Kiss and Strunk, 2006). Two grouped passes count, Spark decides by expressions on
the counts, and a small model goes to the tasks.

1. Every word as it is written gives its type (lower case, no full stop at its end). Per type: with and without
   a full stop, and in which cases it stands at and away from beginnings. A type that is nearly always
   followed by a full stop, short, or with full stops inside is an abbreviation.
2. Pairs across a full stop are counted with that knowledge: words that are frequent behind sure ends begin
   sentences; pairs that occur together more often than by chance are held together.

Defined cases: a NULL text, or one that cleaning leaves empty, has no sentences; ``!`` and ``?`` always end
one; a corpus without full stops teaches nothing, and then every full stop ends a sentence; each row
of a repeated id is a text; texts of any length are read whole; an empty table teaches nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.functions import text
from tidings.session import cut_lineage

# The thresholds of the published method.
ABBREVIATION, COLLOCATION, STARTER = 0.3, 7.88, 30.0
SURE = 0.99  # how likely a full stop follows an abbreviation
MOST_ROWS = 500_000  # of each list of the model; more is an error, as it goes to every task
NUMBER = "#"
_TYPE_TRIM = ".,!?-"


class Model(NamedTuple):
    """What was learned: plain values."""

    abbreviations: frozenset[str]
    pairs: frozenset[tuple[str, str]]
    starters: frozenset[str]
    begins: dict[str, bool]  # type -> whether a capital shows a beginning; absent: cannot be told


# --- counting --------------------------------------------------------------------------------

def _type(word: Column) -> Column:
    bare = F.lower(F.btrim(word, F.lit(_TYPE_TRIM)))
    return F.when(F.regexp_like(bare, F.lit(r"^[0-9][0-9.,-]*$")), F.lit(NUMBER)).otherwise(bare)


def _stops(word: Column) -> Column:
    """Whether a full stop ends the word (and no other mark)."""
    return F.endswith(word, F.lit(".")) & ~F.endswith(word, F.lit(".."))


def _ends(word: Column) -> Column:
    return F.regexp_like(word, F.lit("[.!?]$"))


def word_rows(texts: DataFrame) -> DataFrame:
    """(before, word, after): every word of the cleaned texts with its neighbours."""
    listed = texts.select(F.filter(text.words_by_whitespace(F.col("text")), lambda w: w != "").alias("w"))
    places = F.sequence(F.lit(1), F.size("w"))
    zipped = F.transform(places, lambda i: F.struct(F.get("w", i - 2).alias("before"), F.get("w", i - 1).alias("word"), F.get("w", i).alias("after")))
    return listed.where(F.size("w") > 0).select(F.inline(zipped))


def type_counts(words: DataFrame) -> DataFrame:
    """(type, stopped, bare, lower, upper_inside): counts of each type, map-side combined."""
    first = F.substring(F.btrim("word", F.lit(_TYPE_TRIM)), 1, 1)
    upper = first != F.lower(first)
    inside = F.col("before").isNotNull() & ~_ends(F.col("before"))
    return words.select(
        _type(F.col("word")).alias("type"), _stops(F.col("word")).alias("stop"), (first != F.upper(first)).alias("lower"), (upper & inside).alias("upper_inside"),
    ).groupBy("type").agg(
        F.count_if("stop").alias("stopped"), F.count_if(~F.col("stop")).alias("bare"), F.count_if("lower").alias("lower"), F.count_if("upper_inside").alias("upper_inside"),
    ).where(F.col("type") != "")


def abbreviation_score(stopped: Column, bare: Column, name: Column, share: Column) -> Column:
    """The modified log-likelihood ratio of a full stop behind a type, scaled by length, inner stops and bare uses."""
    chance = stopped * F.log(share) + bare * F.log(1 - share)
    sure = stopped * F.log(F.lit(SURE)) + bare * F.log(F.lit(1 - SURE))
    letters = F.length(F.replace(name, F.lit("."), F.lit("")))
    inner = F.length(name) - letters + 1
    return -2 * (chance - sure) * F.exp(-letters) * inner * F.pow(letters.cast("double"), -bare)


def pair_ratio(one: Column, two: Column, both: Column, total: Column) -> Column:
    """Dunning's log-likelihood ratio of two events that meet."""

    def bits(hits: Column, tries: Column, p: Column) -> Column:
        misses = tries - hits
        return F.when(hits > 0, hits * F.log(p)).otherwise(0.0) + F.when(misses > 0, misses * F.log(1 - p)).otherwise(0.0)

    p, p1, p2 = two / total, both / one, (two - both) / (total - one)
    return -2 * (bits(both, one, p) + bits(two - both, total - one, p) - bits(both, one, p1) - bits(two - both, total - one, p2))


# --- learning --------------------------------------------------------------------------------

def learn(texts: DataFrame) -> Model:
    """The model of a table with ``text``; counts cover all texts."""
    words = word_rows(texts)
    counts = cut_lineage(type_counts(words))
    total, stops = counts.agg(F.sum(F.col("stopped") + F.col("bare")), F.sum("stopped")).first()
    if not total or not stops or stops == total:
        return Model(frozenset(), frozenset(), frozenset(), {})
    share, n = F.lit(stops / total), F.lit(float(total))
    scored = counts.where((F.col("stopped") > 0) & (F.col("type") != NUMBER) & F.regexp_like("type", F.lit(r"\p{L}")))
    score = abbreviation_score(F.col("stopped").cast("double"), F.col("bare").cast("double"), F.col("type"), share)
    short = cut_lineage(scored.where(score >= ABBREVIATION).select("type"))
    abbreviations = _listed(short)

    known = F.broadcast(short.withColumn("short", F.lit(True)))  # counted in _listed
    across = words.where(_stops(F.col("word")) & F.col("after").isNotNull()).select(_type(F.col("word")).alias("type"), F.col("after"))
    across = across.groupBy("type", _type(F.col("after")).alias("next")).agg(F.count(F.lit(1)).alias("both"))
    initial = F.regexp_like("type", F.lit(r"^\p{L}$")) | (F.col("type") == NUMBER)
    across = cut_lineage(across.join(known, "type", "left").select("type", "next", "both", F.coalesce("short", initial).alias("weak")).where(F.col("next") != ""))
    every = counts.select(F.col("type").alias("next"), (F.col("stopped") + F.col("bare")).alias("next_n"))

    # Words behind full stops that end a sentence for sure.
    sure = across.where(~F.col("weak"))
    ends = sure.agg(F.coalesce(F.sum("both"), F.lit(0))).first()[0]
    starters: frozenset[str] = frozenset()
    if ends:
        after = sure.groupBy("next").agg(F.sum("both").alias("both")).join(every, "next")
        ratio = pair_ratio(F.lit(float(ends)), F.col("next_n").cast("double"), F.col("both").cast("double"), n)
        frequent = after.where((ratio >= STARTER) & (F.col("both") * n > F.lit(float(ends)) * F.col("next_n")) & (F.col("next") != NUMBER))
        starters = frozenset(r["next"] for r in _rows(frequent.select("next")))

    own = counts.select("type", (F.col("stopped") + F.col("bare")).alias("n"))
    held = across.where("weak AND both > 1").join(own, "type").join(every, "next")
    ratio = pair_ratio(F.col("n").cast("double"), F.col("next_n").cast("double"), F.col("both").cast("double"), n)
    held = held.where((ratio >= COLLOCATION) & (F.col("both") * n > F.col("n") * F.col("next_n").cast("double")))
    pairs = frozenset((r["type"], r["next"]) for r in _rows(held.select("type", "next")) if r["next"] not in starters)

    # Case is asked only of words that follow an abbreviation, an initial or a number.
    asked = across.where("weak").select("next").distinct()
    cases = counts.join(asked, counts["type"] == asked["next"], "left_semi").where((F.col("lower") > 0) | (F.col("upper_inside") > 0))
    begins = {r["type"]: r["upper_inside"] == 0 for r in _rows(cases.select("type", "upper_inside"))}
    return Model(abbreviations, pairs, starters, begins)


def _rows(df: DataFrame) -> list:
    found = df.limit(MOST_ROWS + 1).collect()
    if len(found) > MOST_ROWS:
        raise ValueError(f"more than {MOST_ROWS} rows for the model of sentence boundaries")
    return found


def _listed(df: DataFrame) -> frozenset[str]:
    return frozenset(r[0] for r in _rows(df))


# --- splitting -------------------------------------------------------------------------------

_WORD = re.compile("[^" + re.escape(text.WHITESPACE_CHARS) + "]+")
_NUMERIC = re.compile(r"[0-9][0-9.,-]*")


def type_of(word: str) -> str:
    bare = word.strip(_TYPE_TRIM).lower()
    return NUMBER if _NUMERIC.fullmatch(bare) else bare


def ends_sentence(word: str, after: str, model: Model) -> bool:
    """Whether a sentence ends between two words."""
    if word.endswith(("!", "?")):
        return True
    if not word.endswith("."):
        return False
    first = after.strip(_TYPE_TRIM)[:1]
    upper = first != first.lower()
    if word.endswith(".."):
        return upper or not first
    name, following = type_of(word), type_of(after)
    initial = name == NUMBER or (len(name) == 1 and name.isalpha())
    if name not in model.abbreviations and not initial:
        return True
    if (name, following) in model.pairs or not upper:
        return False
    if following in model.starters:
        return True
    # A capital on a word that is seen without one, and never with one inside a sentence.
    return model.begins.get(following, False)


def split_text(cleaned: str, model: Model) -> list[str]:
    """The sentences of a cleaned text."""
    words = list(_WORD.finditer(cleaned))
    out, start = [], 0
    for at in range(1, len(words) + 1):
        if at == len(words) or ends_sentence(words[at - 1][0], words[at][0], model):
            out.append(cleaned[words[start].start():words[at - 1].end()])
            start = at
    return out


def sentences(texts: DataFrame, model: Model, id_cols: list[str], text_col: str = "text") -> DataFrame:
    """``(ids, pos, sentence)``: the sentences of each text, by a learned model."""
    shared = texts.sparkSession.sparkContext.broadcast((model.abbreviations, model.pairs, model.starters, model.begins))

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def split(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = Model(*shared.value)
        for cleaned in batches:
            yield pa.array([split_text(t, known) if t else [] for t in cleaned.to_pylist()], pa.list_(pa.string()))

    return texts.select(*id_cols, F.posexplode(split(text.clean(F.col(text_col)))).alias("pos", "sentence"))
