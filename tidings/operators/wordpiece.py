"""Word-piece tokens of a corpus, with a vocabulary that travels to the tasks or is joined.

A vocabulary of up to ``SHIPPED_TOKENS`` tokens goes to every task once, and an Arrow function spells the
distinct words of each batch in place: no word leaves its text. Up to ``TRIE_TOKENS`` it travels as a trie,
beyond that as a table of hashes, some 50 bytes a token. A larger one is joined.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.functions import unicode
from tidings.functions.binding import let
from tidings.operators import piecetable
from tidings.operators.joins import lookup_join
from tidings.operators.piecetrie import Links, Walker, build
from tidings.session import cut_lineage

# The special tokens and the mark of a continuation piece.
CLS, SEP, UNK, CONTINUATION = "[CLS]", "[SEP]", "[UNK]", "##"
PAD_ID = 0

ID_BITS = 40  # room for a token id next to a length in one number
STEPS = "array<struct<start:int,best:bigint>>"
TRIE_TOKENS = 50_000
SHIPPED_TOKENS = 8_000_000
SLICE = 1_000  # texts spelled at a time
HEAD_CHARS = 48  # a word of the text's head, with the space around it, is given so much room
PIECE = T.StructType([T.StructField("piece", T.StringType()), T.StructField("id", T.LongType())])
SPAN = T.StructType(
    [T.StructField("at", T.IntegerType()), T.StructField("part", T.IntegerType()), T.StructField("token", T.StringType()),
     T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]
)


class Vocabulary(NamedTuple):
    """The token table with the few numbers that plans need from it."""

    table: DataFrame
    cls_id: int | None
    sep_id: int | None
    unk_id: int | None
    longest: int
    size: int


def prepare(vocab: DataFrame) -> Vocabulary:
    """Look up the special ids and the longest token of a ``(token, id)`` table."""
    table = vocab.select("token", F.col("id").cast("bigint").alias("id"))
    special = {
        row.token: row.id for row in table.filter(F.col("token").isin(CLS, SEP, UNK)).collect()
    }
    longest, size = table.agg(F.coalesce(F.max(F.length("token")), F.lit(0)), F.count(F.lit(1))).first()
    unk = special.get(UNK)
    return Vocabulary(table, special.get(CLS, unk), special.get(SEP, unk), unk, longest, size)


Spell = Callable[[Sequence[str]], list[list[tuple[str, int | None, int, int]]]]


def _shipped(vocab: Vocabulary) -> Callable[[], Spell]:
    """The vocabulary as a broadcast of plain arrays, and how a task begins to spell with it; its size was counted."""
    rows, unknown = vocab.table.toArrow(), vocab.unk_id
    context = vocab.table.sparkSession.sparkContext
    if vocab.size > TRIE_TOKENS:
        tokens, ids = rows.column("token").combine_chunks(), rows.column("id").to_numpy()
        table = context.broadcast(tuple(piecetable.build(tokens, ids, CONTINUATION)))
        return lambda: piecetable.Speller(piecetable.Table(*table.value), CONTINUATION, unknown).pieces_of
    links = build(rows.column("token").to_pylist(), rows.column("id").to_pylist(), CONTINUATION)
    shared = context.broadcast(tuple(links))

    def begin() -> Spell:
        walker = Walker(Links(*shared.value), CONTINUATION, unknown)
        return lambda words: [walker.pieces(word) for word in words]

    return begin


def _taken(index: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs that ``index`` names lie end to end: the places of their elements, and where each run begins."""
    lengths = counts[index] if len(index) else np.zeros(0, np.int64)
    before = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(counts)])[:-1]
    shift = first[index] - before[:-1] if len(index) else np.zeros(0, np.int64)
    return np.arange(before[-1]) + np.repeat(shift, lengths), before


def _sliced(function: Callable[[pa.Array], pa.Array], batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """``function`` of few rows at a time, so that what it tells stays small."""
    for batch in batches:
        for low in range(0, len(batch), SLICE):
            yield function(batch.slice(low, SLICE))


def _list_offsets(lists: pa.Array) -> np.ndarray:
    return lists.offsets.to_numpy() - lists.offsets[0].as_py()


def _piece_function(vocab: Vocabulary) -> Callable[[Column], Column]:
    """A column function from a list of normalised words to the list of their pieces."""
    begin = _shipped(vocab)

    def spelled(words: pa.Array, spell_all: Spell) -> pa.Array:
        coded = words.flatten().dictionary_encode()
        found = spell_all(coded.dictionary.to_pylist())
        counts = np.array([len(f) for f in found], np.int64)
        texts = pa.array([p[0] for f in found for p in f], pa.string())
        ids = pa.array([p[1] for f in found for p in f], pa.int64())
        # Each occurrence takes the run of pieces of its word.
        taken, before = _taken(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), counts)
        offsets = before[_list_offsets(words)].astype(np.int32)
        structs = pa.StructArray.from_arrays([texts.take(pa.array(taken)), ids.take(pa.array(taken))], names=["piece", "id"])
        return pa.ListArray.from_arrays(pa.array(offsets), structs)

    @F.arrow_udf(T.ArrayType(PIECE))
    def spell(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        spell_all = begin()
        yield from _sliced(lambda words: spelled(words, spell_all), batches)

    return spell


def _normal(raw: str, cased: bool) -> str:
    """The normal form of ``unicode.normal_word``, on the side of a task."""
    if not cased:
        raw = "".join(c for c in unicodedata.normalize("NFD", raw) if unicodedata.category(c) != "Mn").lower()
    return "".join(c for c in raw if c != "\ufffd" and (c in "\n\r\t" or unicodedata.category(c) not in ("Cc", "Cf")))


def _span_function(vocab: Vocabulary, cased: bool) -> Callable[[Column], Column]:
    """A column function from a text's chunks (spaces and one word each) to the spans of its pieces."""
    begin = _shipped(vocab)

    def split(chunk: str) -> tuple[str, int, Sequence[int]]:
        """Normal form of the chunk's word, where the word begins, and the place in it of each character of the normal form."""
        skip = 0
        while skip < len(chunk) and (chunk[skip] in " \n\r\t\u2028\u2029" or unicodedata.category(chunk[skip]) == "Zs"):
            skip += 1
        raw = chunk[skip:]
        origin = range(len(raw)) if raw.isascii() and raw.isprintable() else [i for i, c in enumerate(raw) for _ in _normal(c, cased)]
        return _normal(raw, cased), skip, origin

    def spans_of(chunks: pa.Array, spell_all: Spell) -> pa.Array:
        coded = chunks.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        parted = [split(chunk) for chunk in distinct]
        found = spell_all([word for word, _, _ in parted])
        counts = np.array([len(f) for f in found], np.int64)
        # Of each piece of the distinct chunks: its number, its text, and its ends from the start of the chunk.
        parts = np.array([part for f in found for part in range(len(f))], np.int32)
        tokens = pa.array([piece for f in found for piece, _, _, _ in f], pa.string())
        lows = np.array([skip + origin[start] for f, (_, skip, origin) in zip(found, parted) for _, _, start, _ in f], np.int64)
        highs = np.array([skip + origin[start + size - 1] + 1 for f, (_, skip, origin) in zip(found, parted) for _, _, start, size in f], np.int64)
        index, offsets = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), _list_offsets(chunks)
        taken, before = _taken(index, counts)
        lengths = np.array([len(chunk) for chunk in distinct], np.int64)[index] if len(index) else np.zeros(0, np.int64)
        ends, in_list = np.cumsum(lengths), np.diff(offsets)
        # Chunks lie end to end: places count from the first chunk of the text.
        places = ends - lengths
        places = places - np.repeat(places[np.minimum(offsets[:-1], max(len(index) - 1, 0))] if len(index) else np.zeros(len(in_list), np.int64), in_list)
        owner = np.repeat(np.arange(len(index)), np.diff(before))
        at = np.arange(len(index)) - np.repeat(offsets[:-1], in_list)
        columns = [at[owner], parts[taken], tokens.take(pa.array(taken)), places[owner] + lows[taken], places[owner] + highs[taken]]
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int32()]
        structs = pa.StructArray.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, kind) for c, kind in zip(columns, kinds)], names=SPAN.names)
        return pa.ListArray.from_arrays(pa.array(before[offsets].astype(np.int32)), structs)

    @F.arrow_udf(T.ArrayType(SPAN))
    def spans(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        spell_all = begin()
        yield from _sliced(lambda chunks: spans_of(chunks, spell_all), batches)

    return spans


def split_words(words: DataFrame, vocab: Vocabulary, cased: bool = False) -> DataFrame:
    """``(raw, pieces)`` for distinct raw words: the longest vocabulary prefix at each step.

    Words are normalised here, once each. Every start of a word meets the vocabulary with every
    length up to the longest token, so the work is linear in the word's length and no word is
    too long. A character that no token matches is a piece of its own with the unknown id. All
    steps after ``distinct`` keep its partitioning by word.
    """
    normal = words.select("raw").distinct().withColumn("word", unicode.normal_word(F.col("raw"), cased))
    starts = normal.filter(F.col("word") != "").select(
        "raw", "word", F.explode(F.sequence(F.lit(0), F.length("word") - 1)).alias("start")
    )
    room = F.least(F.lit(max(vocab.longest, 1)), F.length("word") - F.col("start"))
    tries = starts.select("raw", "word", "start", F.explode(F.sequence(F.lit(1), room)).alias("len"))
    text = F.substring(F.col("word"), F.col("start") + 1, F.col("len"))
    prefix = F.when(F.col("start") > 0, CONTINUATION).otherwise("")
    tries = tries.select("raw", "start", "len", F.concat(prefix, text).alias("token"))
    matched = lookup_join(tries, vocab.table, "token")
    # Length and id in one number: the larger length wins, and numbers aggregate by hash where
    # structs would have to be sorted. An id of 0 here means that no token matched.
    packed = F.shiftleft(F.col("len").cast("bigint"), ID_BITS) + F.coalesce(F.col("id") + 1, F.lit(0))
    longest = (
        matched.filter(F.col("id").isNotNull() | (F.col("len") == 1))
        .groupBy("raw", "start")
        .agg(F.max(packed).alias("best"))
    )
    steps = longest.groupBy("raw").agg(F.sort_array(F.collect_list(F.struct("start", "best"))).alias("steps"))
    steps = steps.withColumn("word", unicode.normal_word(F.col("raw"), cased))

    def length(step: Column) -> Column:
        return F.shiftright(step.best, ID_BITS).cast("int")

    def walk(state: Column, step: Column) -> Column:
        return F.when(
            step.start == state.next,
            F.struct(
                (state.next + length(step)).alias("next"), F.array_append(state.kept, step).alias("kept")
            ),
        ).otherwise(state)

    def piece(step: Column) -> Column:
        number = step.best.bitwiseAND(F.lit((1 << ID_BITS) - 1)) - 1
        mark = F.when(step.start > 0, CONTINUATION).otherwise("")
        return F.struct(
            F.concat(mark, F.substring(F.col("word"), step.start + 1, length(step))).alias("piece"),
            F.when(number >= 0, number).otherwise(F.lit(vocab.unk_id).cast("bigint")).alias("id"),
            step.start.alias("start"),
            length(step).alias("len"),
        )

    # The walk only picks the steps it lands on; their pieces are built once, afterwards.
    begin = F.struct(F.lit(0).alias("next"), F.array().cast(STEPS).alias("kept"))
    kept = F.aggregate("steps", begin, walk, lambda state: state.kept)
    return steps.select("raw", F.transform(kept, piece).alias("pieces"))


def _with_pieces(tokens: DataFrame, vocab: Vocabulary, cased: bool) -> DataFrame:
    """Add ``pieces`` to rows with a ``raw`` word; NULL for words without a normal form."""
    pieces = cut_lineage(split_words(tokens.filter(F.col("raw").isNotNull()), vocab, cased))
    return lookup_join(tokens, pieces, "raw")


def _first_words(words: Column, cased: bool, most: int | None) -> Column:
    """The first ``most`` words that have a normal form: each has one piece at least."""
    if most is None:
        return words
    shown = F.filter(words, lambda raw: unicode.normal_word(raw, cased) != "")
    # Words without a normal form are rare; only a text that has more words than room pays for the test.
    return F.when(F.size(words) <= most, words).otherwise(F.slice(shown, 1, most))


def _head_words(text: Column, cased: bool, most: int) -> Column:
    """The first ``most`` words of ``unicode.pretokens``, from the head of the text where that shows them all.

    A word is whole where another one begins behind it. Only the lower case of a sigma depends on what follows,
    so a head that holds one is not enough.
    """

    head = F.substring(text, 1, (most + 1) * HEAD_CHARS)
    in_head = F.when((F.length(head) < F.length(text)) & ~F.contains(head, F.lit("\u03a3")), unicode.pretokens(head, cased))

    def chosen(words: Column) -> Column:
        return F.when(F.size(words) > most, words).otherwise(unicode.pretokens(text, cased))

    return F.slice(let(in_head, chosen), 1, most)


def word_tokens(
    texts: DataFrame, id_cols: Sequence[str], text_col: str, cased: bool = False, most: int | None = None
) -> DataFrame:
    """``(ids, at, raw)``: one row per word, one with NULL for a text without words."""
    words = _first_words(unicode.raw_words(F.col(text_col), cased), cased, most)
    return texts.select(*id_cols, F.posexplode_outer(words).alias("at", "raw"))


def piece_lists(
    texts: DataFrame,
    vocab: Vocabulary,
    id_cols: Sequence[str],
    text_cols: Sequence[str] = ("text",),
    cased: bool = False,
    most: int | None = None,
) -> DataFrame:
    """``(ids, pieces0[, pieces1])``: the pieces of each text column in order, of ``most`` words at most.

    With a vocabulary that travels, each text is spelled where it is. Otherwise words are spelled
    once each and the corpus meets the result by a join; the last grouping is by text, and a
    text's words leave the map side already gathered.
    """
    if vocab.size <= SHIPPED_TOKENS:
        spell = _piece_function(vocab)

        def spelled_here(column: str) -> Column:
            text = F.coalesce(F.col(column), F.lit(""))
            return spell(unicode.pretokens(text, cased) if most is None else _head_words(text, cased, most))

        return texts.select(*id_cols, *[spelled_here(c).alias(f"pieces{side}") for side, c in enumerate(text_cols)])
    sides = [
        word_tokens(texts, id_cols, column, cased, most).withColumn("side", F.lit(side))
        for side, column in enumerate(text_cols)
    ]
    tokens = sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])
    spelled = _with_pieces(tokens, vocab, cased)
    gathered = [
        F.collect_list(
            F.when((F.col("side") == side) & F.col("pieces").isNotNull(), F.struct("at", "pieces"))
        ).alias(f"_side{side}")
        for side in range(len(sides))
    ]
    per_text = spelled.groupBy(*id_cols).agg(*gathered)
    return per_text.select(
        *id_cols,
        *[
            F.flatten(F.sort_array(f"_side{side}").getField("pieces")).alias(f"pieces{side}")
            for side in range(len(sides))
        ],
    )


def kept_lengths(first: Column, second: Column, max_len: int) -> tuple[Column, Column]:
    """Lengths left when the longer list, or the second on a tie, loses its end until both fit.

    The room is ``max_len`` minus three special tokens. Either one list is short enough to stay
    whole and the other gets the rest, or both end at half the room.
    """
    room = max_len - 3
    upper, lower = (room + 1) // 2, room // 2
    fits = first + second <= room
    return (
        F.when(fits, first).when(second <= lower, room - second).when(first <= upper, first).otherwise(upper),
        F.when(fits, second).when(second <= lower, second).when(first <= upper, room - first).otherwise(lower),
    )


def encode(
    texts: DataFrame,
    vocab: Vocabulary,
    id_cols: Sequence[str],
    first: str = "text",
    second: str | None = None,
    max_len: int | None = None,
    cased: bool = False,
) -> DataFrame:
    """``(ids, tokens, token_ids, segments)``: special tokens, truncation and padding applied."""
    columns = [first] if second is None else [first, second]
    if max_len is not None and max_len < len(columns) + 1:
        raise ValueError("max_len leaves no room for the special tokens")
    # Words beyond the room cannot leave a piece in the result.
    room = None if max_len is None else max_len - 1 - len(columns)
    lists = piece_lists(texts, vocab, id_cols, columns, cased, room)

    def shortened(pieces: list[Column]) -> list[Column]:
        if max_len is None:
            return pieces
        if second is None:
            return [F.slice(pieces[0], 1, max_len - 2)]
        lengths = kept_lengths(F.size(pieces[0]), F.size(pieces[1]), max_len)
        return [F.slice(p, 1, n) for p, n in zip(pieces, lengths)]

    def packed(pieces: Column) -> Column:
        parts = [pieces.getField(f"pieces{side}") for side in range(len(columns))]

        def line_up(field: str, cls: Column, sep: Column) -> Column:
            ended = [x for part in parts for x in (part.getField(field), F.array(sep))]
            return F.concat(F.array(cls), *ended)

        used = sum((F.size(part) + 1 for part in parts), F.lit(1))
        missing = F.lit(0) if max_len is None else F.lit(max_len) - used
        segments = [F.array_repeat(F.lit(0), F.size(parts[0]) + 2)]
        if second is not None:
            segments.append(F.array_repeat(F.lit(1), F.size(parts[1]) + 1))
        cls_id, sep_id, pad_id = [F.lit(n).cast("bigint") for n in (vocab.cls_id, vocab.sep_id, PAD_ID)]
        return F.struct(
            line_up("piece", F.lit(CLS), F.lit(SEP)).alias("tokens"),
            F.concat(line_up("id", cls_id, sep_id), F.array_repeat(pad_id, missing)).alias("token_ids"),
            F.concat(*segments, F.array_repeat(F.lit(0), missing)).alias("segments"),
        )

    def cut(pieces: Column) -> Column:
        kept = shortened([pieces.getField(f"pieces{side}") for side in range(len(columns))])
        return F.struct(*[k.alias(f"pieces{side}") for side, k in enumerate(kept)])

    ordered = F.struct(*[F.col(f"pieces{side}") for side in range(len(columns))])
    out = lists.select(*id_cols, let(let(ordered, cut), packed).alias("_packed"))
    return out.select(*id_cols, "_packed.tokens", "_packed.token_ids", "_packed.segments")


def decode(encoded: DataFrame, vocab: DataFrame, id_cols: Sequence[str], ids_col: str = "token_ids") -> DataFrame:
    """``(ids, first, second)`` tokens of id lists; ``second`` is NULL for a single text.

    The first list ends at the first separator; a second one ends before the last token ahead of
    the padding. Of tokens that share an id the last in the vocabulary counts; ``vocab`` needs a
    ``line`` column for that. A list that is empty, without a separator or with an unknown id has no
    decoding: its row stays, with NULL.
    """
    sep = vocab.filter(F.col("token") == SEP).select("id").first()
    if sep is None:
        raise ValueError("the vocabulary has no separator token")
    inverse = vocab.groupBy(F.col("id").cast("bigint").alias("_id")).agg(F.max_by("token", "line").alias("_token"))
    inverse = cut_lineage(inverse)
    if inverse.count() <= SHIPPED_TOKENS:
        # Tokens are named where the lists are; only whole lists move, as rows of the same ids are one.
        listed = F.arrays_zip(F.col("_ids").alias("_id"), _name_function(inverse)(F.col("_ids")).alias("_token"))
        places = F.transform(listed, lambda x, i: F.struct(i.alias("_at"), x["_token"].alias("_token"), x["_id"].alias("_id")))
        nothing = F.array(F.struct(F.lit(None).cast("int").alias("_at"), F.lit(None).cast("string").alias("_token"), F.lit(None).cast("bigint").alias("_id")))
        rows = encoded.select(*id_cols, F.coalesce(F.col(ids_col), F.array()).cast("array<bigint>").alias("_ids"))
        rows = rows.select(*id_cols, F.when(F.size("_ids") == 0, nothing).otherwise(places).alias("_places"))
        merged = rows.groupBy(*id_cols).agg(F.flatten(F.collect_list("_places")).alias("_places"))
        met = lambda test: F.array_min(F.transform(F.filter("_places", test), lambda x: x["_at"]))
        lists = merged.select(
            *id_cols,
            F.transform(F.sort_array("_places"), lambda x: x["_token"]).alias("_tokens"),
            met(lambda x: x["_id"] == sep.id).alias("_sep"),
            F.coalesce(met(lambda x: x["_id"] == PAD_ID), F.size("_places")).alias("_stop"),
            F.forall("_places", lambda x: x["_token"].isNotNull()).alias("_known"),
        )
    else:
        lists = _joined_tokens(encoded, inverse, sep.id, id_cols, ids_col)

    def between(low: Column, high: Column) -> Column:
        return F.slice("_tokens", low + 1, F.greatest(high - low, F.lit(0)))

    sep_at, stop = F.col("_sep"), F.col("_stop")
    valid = F.col("_known") & sep_at.isNotNull()
    return lists.select(
        *id_cols,
        F.when(valid, between(F.lit(1), sep_at)).alias("first"),
        F.when(valid & (sep_at < stop - 1), between(sep_at + 1, stop - 1)).alias("second"),
    )


def _name_function(inverse: DataFrame) -> Callable[[Column], Column]:
    """A column function from a list of ids to their tokens, NULL for an unknown id; the table's size was counted."""
    rows = inverse.where("_id IS NOT NULL").toArrow()
    ids = rows.column("_id").to_numpy()
    order = np.argsort(ids)
    shared = inverse.sparkSession.sparkContext.broadcast((ids[order], rows.column("_token").combine_chunks().take(pa.array(order))))

    def named(lists: pa.Array) -> pa.Array:
        known, tokens = shared.value
        flat = lists.flatten()
        asked = flat.fill_null(0).to_numpy(zero_copy_only=False)
        at = np.minimum(np.searchsorted(known, asked), max(len(known) - 1, 0))
        missing = flat.is_null().to_numpy(zero_copy_only=False) | (known[at] != asked if len(known) else True)
        return pa.ListArray.from_arrays(pa.array(_list_offsets(lists).astype(np.int32)), tokens.take(pa.array(at, mask=missing)))

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def name(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from _sliced(named, batches)

    return name


def _joined_tokens(encoded: DataFrame, inverse: DataFrame, sep_id: int, id_cols: Sequence[str], ids_col: str) -> DataFrame:
    """The lists of ``decode`` by a join with a table of ids that does not travel."""
    rows = encoded.select(*id_cols, F.posexplode_outer(ids_col).alias("_at", "_id"))
    named = lookup_join(rows, inverse, "_id")
    return named.groupBy(*id_cols).agg(
        F.sort_array(F.collect_list(F.struct("_at", "_token"))).getField("_token").alias("_tokens"),
        F.min(F.when(F.col("_id") == sep_id, F.col("_at"))).alias("_sep"),
        F.coalesce(
            F.min(F.when(F.col("_id") == PAD_ID, F.col("_at"))), F.count(F.lit(1)).cast("int")
        ).alias("_stop"),
        F.bool_and(F.col("_token").isNotNull()).alias("_known"),
    )


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _ends(lengths: pa.Array) -> pa.Array:
    """Running sums inside each list."""
    flat = lengths.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = lengths.offsets.to_numpy() - lengths.offsets[0].as_py()
    total = np.concatenate([[0], np.cumsum(flat)])
    sums = total[1:] - np.repeat(total[offsets[:-1]], np.diff(offsets))
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(sums.astype(np.int32)))


def word_spans(texts: DataFrame, id_cols: Sequence[str], text_col: str = "text", cased: bool = False) -> DataFrame:
    """``(ids, at, raw, start)``: raw words with their place in the unchanged text."""
    chunked = texts.select(*id_cols, unicode.raw_chunks(F.col(text_col), cased).alias("_chunks"))
    lengths = F.transform("_chunks", lambda chunk: F.length(chunk))
    placed = chunked.withColumn("_ends", _ends(lengths))
    rows = placed.select(
        *id_cols, F.posexplode(F.arrays_zip("_chunks", "_ends")).alias("at", "_part")
    ).select(
        *id_cols, "at", unicode.chunk_word(F.col("_part._chunks")).alias("raw"), F.col("_part._ends").alias("_end")
    )
    return rows.select(*id_cols, "at", "raw", (F.col("_end") - F.length("raw")).alias("start"))


def token_spans(
    texts: DataFrame,
    vocab: Vocabulary,
    id_cols: Sequence[str],
    text_col: str = "text",
    cased: bool = False,
) -> DataFrame:
    """``(ids, at, part, token, start, end)``: word pieces with their place in the text."""
    if vocab.size <= SHIPPED_TOKENS:
        chunks = unicode.raw_chunks(F.col(text_col), cased)
        found = texts.select(*id_cols, F.explode(_span_function(vocab, cased)(chunks)).alias("_span"))
        return found.select(*id_cols, "_span.*")
    words = word_spans(texts, id_cols, text_col, cased)
    pieces = _with_pieces(words, vocab, cased).select(
        *id_cols, "at", "raw", "start", F.posexplode("pieces").alias("part", "piece")
    )
    raw, first = F.col("raw"), F.col("piece.start")
    last = first + F.col("piece.len") - 1

    def width(place: Column) -> Column:
        char = F.substring(raw, place + 1, F.lit(1))
        return F.length(unicode.normal_word(char, cased))

    # Position in the raw word of each character of the normalised one.
    origin = F.flatten(
        F.transform(
            F.sequence(F.lit(0), F.length(raw) - 1), lambda place: F.array_repeat(place, width(place))
        )
    )
    simple = F.regexp_like(raw, F.lit(r"^[\x21-\x7E]+$"))
    begin = F.when(simple, first).otherwise(F.get(origin, first))
    end = F.when(simple, last).otherwise(F.get(origin, last)) + 1
    return pieces.select(
        *id_cols, "at", "part", F.col("piece.piece").alias("token"),
        (F.col("start") + begin).alias("start"), (F.col("start") + end).alias("end"),
    )
