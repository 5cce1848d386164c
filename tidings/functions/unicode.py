"""Unicode normalisation and token boundaries as column functions.

Spark has no decomposition function. What decomposition without combining marks does to one
character is a fixed property of Unicode, so it becomes a ``translate`` table.
"""

from __future__ import annotations

import string
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# ASCII ranges counted as punctuation and the CJK blocks.
ASCII_PUNCTUATION = ((33, 47), (58, 64), (91, 96), (123, 126))
CJK_BLOCKS = (
    (0x4E00, 0x9FFF), (0x3400, 0x4DBF), (0x20000, 0x2A6DF), (0x2A700, 0x2B73F),
    (0x2B740, 0x2B81F), (0x2B820, 0x2CEAF), (0xF900, 0xFAFF), (0x2F800, 0x2FA1F),
)
# Fixed values of the Hangul syllable composition in the Unicode standard.
HANGUL_FIRST, HANGUL_LAST = 0xAC00, 0xD7A3
HANGUL_LEAD, HANGUL_VOWEL, HANGUL_TAIL = (0x1100, 19), (0x1161, 21), (0x11A8, 27)


def _plain(char: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", char) if unicodedata.category(c) != "Mn")


@lru_cache(maxsize=1)
def _tables() -> tuple[str, str, dict[str, str], str]:
    """Translate source and target, characters that become several, and hidden punctuation."""
    single, removed, several = {}, [], {}
    for code in range(0x80, 0x110000):
        if 0xD800 <= code <= 0xDFFF or HANGUL_FIRST <= code <= HANGUL_LAST:
            continue
        char = chr(code)
        plain = _plain(char)
        if plain == char:
            continue
        if len(plain) == 1:
            single[char] = plain
        elif plain:
            several[char] = plain
        else:
            removed.append(char)
    ascii_marks = {chr(c) for low, high in ASCII_PUNCTUATION for c in range(low, high + 1)}
    hidden = [
        c for c, p in single.items()
        if p in ascii_marks and not unicodedata.category(c).startswith("P")
    ]
    source = "".join(single) + "".join(removed)
    return source, "".join(single.values()), several, "".join(hidden)


def _hangul_parts(text: Column) -> Column:
    def part(table: tuple[int, int], index: Column) -> Column:
        first, count = table
        letters = F.lit("".join(chr(first + i) for i in range(count)))
        return F.substring(letters, index.cast("int"), F.lit(1))

    def decomposed(char: Column) -> Column:
        place = F.ascii(char) - HANGUL_FIRST
        vowels, tails = HANGUL_VOWEL[1], HANGUL_TAIL[1] + 1
        tail = F.pmod(place, F.lit(tails))
        return F.when(
            char.between(chr(HANGUL_FIRST), chr(HANGUL_LAST)),
            F.concat(
                part(HANGUL_LEAD, F.floor(place / (vowels * tails)) + 1),
                part(HANGUL_VOWEL, F.floor(F.pmod(place, F.lit(vowels * tails)) / tails) + 1),
                F.when(tail == 0, F.lit("")).otherwise(part(HANGUL_TAIL, tail)),
            ),
        ).otherwise(char)

    return F.array_join(F.transform(F.split(text, ""), decomposed), "")


def strip_marks(text: Column) -> Column:
    """Canonical decomposition without combining marks; ASCII text passes untouched."""
    source, target, several, _ = _tables()
    spelled = _hangul_parts(text)
    for char, plain in several.items():
        spelled = F.replace(spelled, F.lit(char), F.lit(plain))
    grows = rf"[\x{{{HANGUL_FIRST:X}}}-\x{{{HANGUL_LAST:X}}}{''.join(several)}]"
    one_each = F.when(F.regexp_like(text, F.lit(grows)), spelled).otherwise(text)
    return F.when(
        F.regexp_like(text, F.lit(r"[^\x00-\x7F]")), F.translate(one_each, source, target)
    ).otherwise(text)


def normalise(text: Column, cased: bool = False) -> Column:
    """What an uncased vocabulary expects: no marks, lower case."""
    return text if cased else F.lower(strip_marks(text))


def _ranges(blocks: tuple[tuple[int, int], ...]) -> str:
    return "".join(rf"\x{{{low:X}}}-\x{{{high:X}}}" for low, high in blocks)


ISOLATED = _ranges(ASCII_PUNCTUATION) + r"\p{P}" + _ranges(CJK_BLOCKS)
SPACES = r" \n\r\t\p{Zs}\x{2028}\x{2029}"
CONTROLS = r"\x{FFFD}\p{Cc}\p{Cf}"
# As in cleaning, a look-up class of the common characters stands before the classes of ranges.
_COMMON = string.ascii_letters + string.digits
REMOVED_PATTERN = rf"[[^{_COMMON} \n\r\t]&&[{CONTROLS}]]"


def _token_pattern(isolated: str) -> str:
    return f"[[^{_COMMON} ]&&[{isolated}]]|(?:[{_COMMON}]|[[^ ]&&[^{isolated}{SPACES}]])+"


def without_controls(text: Column) -> Column:
    """Drop control and format characters but line breaks and tabs; their neighbours join."""
    return F.regexp_replace(text, REMOVED_PATTERN, "")


def pretokens(text: Column, cased: bool = False) -> Column:
    """Words of the normalised text, each punctuation or CJK character a word of its own."""
    shown = without_controls(normalise(text, cased))
    return F.regexp_extract_all(shown, F.lit(_token_pattern(ISOLATED)), F.lit(0))


def _isolated(cased: bool) -> str:
    """Characters that only become punctuation by normalisation count as such in raw text."""
    return ISOLATED + ("" if cased else _tables()[3])


def raw_words(text: Column, cased: bool = False) -> Column:
    """The words of ``pretokens`` before normalisation, so that it can run once per word."""
    return F.regexp_extract_all(text, F.lit(_token_pattern(_isolated(cased))), F.lit(0))


def normal_word(raw: Column, cased: bool = False) -> Column:
    """Normal form of a raw word; empty when nothing but marks and controls was in it."""
    return without_controls(normalise(raw, cased))


def raw_chunks(text: Column, cased: bool = False) -> Column:
    """The text cut into leading spaces plus one raw word, without changing any character.

    The chunks lie end to end from the start of the text, so their lengths give offsets.
    """
    pattern = f"[{SPACES}]*(?:{_token_pattern(_isolated(cased))})"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def chunk_word(chunk: Column) -> Column:
    return F.regexp_replace(chunk, f"^[{SPACES}]+", "")
