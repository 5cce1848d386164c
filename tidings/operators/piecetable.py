"""Greedy word pieces against a vocabulary of millions of tokens, kept as sorted hashes.

A trie of such a vocabulary would fill a worker with nodes. Here a token takes one 64-bit hash, its id and
its bytes, and the words of a batch are looked up together: first each whole word, then, for the few that are
no token, every start of theirs with every length that tokens have, longest first. The hash of any part of a
word comes from running sums over the batch. A hash only proposes a token: its bytes are compared, so
results are exact.

Built once on the driver from a vocabulary whose size was counted; the arrays are plain values that go to
the tasks as a broadcast. Pieces are those of ``piecetrie``.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa

FIRST, LATER = 0, 1  # pieces that begin a word, and those behind them
CHUNK = 200_000  # tokens hashed at a time, and starts looked up at a time
SEEDS = 8  # two tokens of one hash are told apart by another seed


class Table(NamedTuple):
    """Entries sorted by hash, and the tokens that they name."""

    seed: int
    keys: np.ndarray
    entries: np.ndarray  # row of the token; kinds differ by their keys
    skips: np.ndarray  # bytes of the mark in front, which the word does not hold
    offsets: np.ndarray
    text: np.ndarray  # UTF-8 of all tokens
    ids: np.ndarray
    lengths: tuple[np.ndarray, np.ndarray]  # in bytes, longest first, by kind


def _flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 and the bytes of a column of strings."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2]
    text = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], text


class _Hashes:
    """Hashes of any parts of a text: polynomials modulo 2^64, from running sums."""

    def __init__(self, seed: int, text: np.ndarray):
        rng = np.random.default_rng(seed)
        letters = rng.integers(0, 1 << 64, 256, np.uint64)
        base = int(rng.integers(0, 1 << 62)) * 2 + 1
        self.kinds = rng.integers(0, 1 << 64, 2, np.uint64)

        def powers(number: int) -> np.ndarray:
            steps = np.full(len(text) + 1, number, np.uint64)
            steps[0] = 1
            return np.multiply.accumulate(steps)

        self.sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(letters[text] * powers(base)[:-1], out=self.sums[1:])
        self.back = powers(pow(base, -1, 1 << 64))

    def of(self, starts: np.ndarray, ends: np.ndarray, kinds: np.ndarray | int) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.back[starts] ^ self.kinds[kinds]


def _entries(offsets: np.ndarray, text: np.ndarray, mark: bytes, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, row, bytes skipped) of every form: tokens as they are written, and those that go on inside a word."""
    found = []
    for low in range(0, len(offsets) - 1, CHUNK):
        high = min(low + CHUNK, len(offsets) - 1)
        edges = offsets[low:high + 1]
        part = text[edges[0]:edges[-1]]
        starts, ends = edges[:-1] - edges[0], edges[1:] - edges[0]
        hashes, rows = _Hashes(seed, part), np.arange(low, high)
        some = ends > starts
        found.append((hashes.of(starts[some], ends[some], FIRST), rows[some], np.zeros(some.sum(), np.int32)))
        marked = ends - starts > len(mark)
        for place, byte in enumerate(mark):
            marked[marked] = part[starts[marked] + place] == byte
        found.append((hashes.of(starts[marked] + len(mark), ends[marked], LATER), rows[marked], np.full(marked.sum(), len(mark), np.int32)))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
    return tuple(np.concatenate(column) for column in zip(*found))


def build(tokens: pa.Array, ids: Sequence[int], mark: str) -> Table:
    """The table of a vocabulary; of a repeated token the last counts. Tokens that begin with ``mark`` go on inside
    a word, and may begin one as they are written."""
    offsets, text = _flat(tokens)
    for seed in range(SEEDS):
        keys, rows, skips = _entries(offsets, text, mark.encode(), seed)
        order = np.argsort(keys, kind="stable")
        keys, rows, skips = keys[order], rows[order], skips[order]
        same = np.flatnonzero(keys[1:] == keys[:-1])
        if all(skips[i] == skips[i + 1] and tokens[int(rows[i])] == tokens[int(rows[i + 1])] for i in same):
            break
    else:
        raise ValueError("tokens of the vocabulary cannot be told apart by their hashes")
    kept = np.ones(len(keys), bool)
    kept[same] = False
    keys, rows, skips = keys[kept], rows[kept], skips[kept]
    sizes = offsets[rows + 1] - offsets[rows] - skips
    lengths = tuple(np.unique(sizes[(skips > 0) == bool(kind)])[::-1] for kind in (FIRST, LATER))
    return Table(seed, keys, rows.astype(np.int32), skips.astype(np.uint8), offsets, text, np.asarray(ids, np.int64), lengths)


class Speller:
    """Pieces of many words at once, on the side of a task."""

    def __init__(self, table: Table, mark: str, unknown: int | None):
        self.table, self.mark, self.unknown = table, mark, unknown

    def _tokens(self, hashes: _Hashes, text: np.ndarray, starts: np.ndarray, ends: np.ndarray, kinds: np.ndarray | int) -> np.ndarray:
        """The row of the token that each part of the text is, or -1."""
        table, found = self.table, np.full(len(starts), -1, np.int64)
        if not len(table.keys) or not len(starts):
            return found
        keys = hashes.of(starts, ends, kinds)
        order = np.argsort(keys)  # neighbours are near each other in the table as well
        at = np.empty(len(keys), np.int64)
        at[order] = np.searchsorted(table.keys, keys[order])
        at = np.minimum(at, len(table.keys) - 1)
        met = np.flatnonzero(table.keys[at] == keys)
        entry = at[met]
        begin = table.offsets[table.entries[entry]] + table.skips[entry]
        sizes = ends[met] - starts[met]
        equal = table.offsets[table.entries[entry] + 1] - begin == sizes
        met, entry, begin, sizes = met[equal], entry[equal], begin[equal], sizes[equal]
        before = np.cumsum(sizes) - sizes
        inside = np.arange(sizes.sum()) - np.repeat(before, sizes)
        differ = text[inside + np.repeat(starts[met], sizes)] != table.text[inside + np.repeat(begin, sizes)]
        good = np.bincount(np.repeat(np.arange(len(met)), sizes), weights=differ, minlength=len(met)) == 0
        found[met[good]] = table.entries[entry[good]]
        return found

    def pieces_of(self, words: Sequence[str]) -> list[list[tuple[str, int | None, int, int]]]:
        """``(piece, id, start, length)`` of normalised words, in order: the longest token at each step."""
        offsets, text = _flat(pa.array(words, pa.large_string()))
        hashes = _Hashes(self.table.seed, text)
        whole = self._tokens(hashes, text, offsets[:-1], offsets[1:], FIRST)
        ids = np.where(whole >= 0, self.table.ids[whole] if len(self.table.ids) else 0, 0).tolist()
        out = [[(word, token_id, 0, len(word))] if row >= 0 else [] for word, row, token_id in zip(words, whole.tolist(), ids)]
        rest = np.flatnonzero((whole < 0) & (np.diff(offsets) > 0))
        sizes = np.cumsum(np.diff(offsets)[rest])
        # Words that no token spells as a whole, so many at a time that their starts are bounded.
        for some in np.split(rest, np.flatnonzero(np.diff(sizes // CHUNK)) + 1) if len(rest) else []:
            self._walk(words, some, offsets, text, hashes, out)
        return out

    def _walk(self, words: Sequence[str], some: np.ndarray, offsets: np.ndarray, text: np.ndarray, hashes: _Hashes, out: list) -> None:
        sizes = (offsets[1:] - offsets[:-1])[some]
        places = np.arange(sizes.sum()) + np.repeat(offsets[some] - (np.cumsum(sizes) - sizes), sizes)
        ends, begins = np.repeat(offsets[some + 1], sizes), np.repeat(offsets[some], sizes)
        starts_char = (text[places] & 0xC0) != 0x80
        places, ends, begins = places[starts_char], ends[starts_char], begins[starts_char]
        kinds = (places > begins).astype(np.int64)
        size, row = np.zeros(len(places), np.int64), np.full(len(places), -1, np.int64)
        for kind in (FIRST, LATER):
            left = np.flatnonzero(kinds == kind)
            room = ends[left] - places[left]
            for length in self.table.lengths[kind]:
                fits = np.flatnonzero(room >= length)
                if not len(fits):
                    continue
                at = left[fits]
                found = self._tokens(hashes, text, places[at], places[at] + length, kind)
                hit = found >= 0
                size[at[hit]], row[at[hit]] = length, found[hit]
                open_ = np.ones(len(left), bool)
                open_[fits[hit]] = False
                left, room = left[open_], room[open_]
        # Starts follow each other character by character: a step of so many bytes leads to the start there.
        after = np.where(row >= 0, np.searchsorted(places, places + size), np.arange(1, len(places) + 1)).tolist()
        ids = np.where(row >= 0, self.table.ids[row] if len(self.table.ids) else 0, 0).tolist()
        known, mark, unknown = (row >= 0).tolist(), self.mark, self.unknown
        low = 0
        for i in some.tolist():
            word, start, told = words[i], 0, out[i]
            while start < len(word):
                end = after[low + start] - low
                told.append(((mark if start else "") + word[start:end], ids[low + start] if known[low + start] else unknown, start, end - start))
                start = end
            low += len(word)
