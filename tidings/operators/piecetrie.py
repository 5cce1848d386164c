"""Greedy word pieces in one pass over a word: a trie of the vocabulary with failure links, in flat arrays.

A node stands for the characters of an open piece. Where the next character leaves the trie, the failure
link gives the node of what stays open after the longest pieces in front have been told; the pieces
told on the way are kept beside it. So each character is read once, however long the word and its tokens
are. Every single character is a piece, if need be of the unknown id, so no word fails.

Built once on the driver from a vocabulary whose size was counted; the arrays are plain values that go to
the tasks as a broadcast, and executors need no copy of this package.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np

CHAR_BITS = 21  # of a code point
ROOT, INNER = 0, 1  # at the start of a word, and behind its first piece


class Links(NamedTuple):
    """Edges sorted by (node, character), failure links, and the pieces told along them."""

    edges: np.ndarray  # node << CHAR_BITS | code point
    targets: np.ndarray
    fails: np.ndarray
    told_from: np.ndarray  # where a node's told pieces begin
    told_size: np.ndarray  # characters of each told piece
    told_id: np.ndarray  # -1 for the unknown id


def build(tokens: Sequence[str], ids: Sequence[int], mark: str) -> Links:
    """The trie of a vocabulary; tokens that begin with ``mark`` go on inside a word, and may begin one as they are written."""
    edges: dict[int, int] = {}
    ends: dict[int, int] = {}
    order: list[tuple[int, int]] = []  # (parent, code point) of each node but the first two
    count = 2

    def add(node: int, text: str, token_id: int) -> None:
        nonlocal count
        for char in text:
            key = node << CHAR_BITS | ord(char)
            if key not in edges:
                edges[key] = count
                order.append((node, ord(char)))
                count += 1
            node = edges[key]
        ends[node] = token_id

    for token, token_id in zip(tokens, ids):
        if token:
            add(ROOT, token, token_id)
        if token.startswith(mark) and len(token) > len(mark):
            add(INNER, token[len(mark):], token_id)
    depth = np.zeros(count, np.int64)
    for node, (parent, _) in enumerate(order, 2):
        depth[node] = depth[parent] + 1
    fails = [INNER] * count
    told: list[tuple[tuple[int, int], ...]] = [()] * count
    for node in np.argsort(depth, kind="stable").tolist():
        if node < 2:
            continue
        parent, char = order[node - 2]
        if node in ends or parent < 2:
            told[node] = ((int(depth[node]), ends.get(node, -1)),)
            continue
        state, pieces = fails[parent], told[parent]
        while (target := edges.get(state << CHAR_BITS | char)) is None:
            if state == INNER:
                target, pieces = INNER, (*pieces, (1, -1))
                break
            state, pieces = fails[state], pieces + told[state]
        fails[node], told[node] = target, pieces
    keys = np.fromiter(edges, np.int64, len(edges))
    at = np.argsort(keys)
    flat = [p for t in told for p in t]
    return Links(
        keys[at], np.fromiter(edges.values(), np.int32, len(edges))[at], np.array(fails, np.int32),
        np.cumsum([0, *map(len, told)]).astype(np.int32), np.array([p[0] for p in flat], np.int32), np.array([p[1] for p in flat], np.int64))


class Walker:
    """Pieces of words, on the side of a task."""

    def __init__(self, links: Links, mark: str, unknown: int | None):
        self.edges = dict(zip(links.edges.tolist(), links.targets.tolist()))
        self.fails, self.told_from = links.fails.tolist(), links.told_from.tolist()
        self.told = list(zip(links.told_size.tolist(), [unknown if i < 0 else i for i in links.told_id.tolist()]))
        self.mark, self.unknown = mark, unknown

    def pieces(self, word: str) -> list[tuple[str, int | None, int, int]]:
        """``(piece, id, start, length)`` of a normalised word, in order: the longest token at each step."""
        edges, fails, told_from, told = self.edges.get, self.fails, self.told_from, self.told
        found: list[tuple[int, int | None]] = []
        state = ROOT
        for char in word:
            code = ord(char)
            while (target := edges(state << CHAR_BITS | code)) is None:
                if state < 2:
                    found.append((1, self.unknown))
                    target = INNER
                    break
                found += told[told_from[state]:told_from[state + 1]]
                state = fails[state]
            state = target
        while state > 1:
            found += told[told_from[state]:told_from[state + 1]]
            state = fails[state]
        out, start = [], 0
        for size, token_id in found:
            out.append(((self.mark if start else "") + word[start:start + size], token_id, start, size))
            start += size
        return out
