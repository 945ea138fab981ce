"""Greedy segmentation under several vocabularies at once: one trie, all words of a batch advanced together."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa

# bytes whose positions are worked on together
WINDOW = 1 << 20


class Trie:
    """The pieces of several vocabularies, as bytes, in one table of edges.

    Edges are numbered in the order of ``(state, byte)``: edge i leads to state i + 1, and state 0 is the root, so the sorted keys are
    the whole structure.  ``held[v, state]`` says whether vocabulary v has the piece that ends in a state.
    """

    def __init__(self, vocabs: Sequence[Iterable[str]]) -> None:
        pieces = [(v, p.encode()) for v, vocab in enumerate(vocabs) for p in vocab if p]
        data = np.frombuffer(b"".join(p for _, p in pieces), np.uint8)
        which = np.array([v for v, _ in pieces], np.int64)
        sizes = np.array([len(p) for _, p in pieces], np.int64)
        starts = np.cumsum(sizes) - sizes
        state = np.zeros(len(pieces), np.int64)
        levels, edges, depth = [], 0, 0
        alive = np.arange(len(pieces))
        while alive.size:
            level, at = np.unique(state[alive] << 8 | data[starts[alive] + depth], return_inverse=True)
            state[alive] = edges + 1 + at
            levels.append(level)
            edges += len(level)
            depth += 1
            alive = alive[sizes[alive] > depth]
        self.edges = np.concatenate([np.zeros(0, np.int64), *levels])
        self.depth = depth
        self.held = np.zeros((len(vocabs), edges + 1), bool)
        self.held[which, state] = True

    def longest(self, data: np.ndarray, at: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Bytes of the longest piece at each position ``at`` and before ``end``, a row for each vocabulary; 0 where no piece fits."""
        best = np.zeros((len(self.held), len(at)), np.int64)
        who, state = np.arange(len(at)), np.zeros(len(at), np.int64)
        for depth in range(self.depth):
            inside = at[who] + depth < end[who]
            who, state = who[inside], state[inside]
            key = state << 8 | data[at[who] + depth]
            edge = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
            found = self.edges[edge] == key
            who, state = who[found], edge[found] + 1
            if not who.size:
                break
            for row, held in zip(best, self.held, strict=True):
                row[who[held[state]]] = depth + 1
        return best

    def piece_starts(self, data: np.ndarray, offsets: np.ndarray, window: int = WINDOW) -> np.ndarray:
        """Marks, a row for each vocabulary, the bytes at which a piece of a word starts.

        ``data`` holds the words in UTF-8, word i from ``offsets[i]`` to ``offsets[i + 1]``.  A word may be longer than a window.
        """
        marks = np.zeros((len(self.held), len(data)), bool)
        filled = offsets[:-1] < offsets[1:]
        word_starts, word_ends = offsets[:-1][filled], offsets[1:][filled]
        # where the word that spans the border goes on, in each vocabulary
        entries = np.full(len(self.held), -1)
        for a in range(0, len(data), window):
            b = min(a + window, len(data))
            at = a + np.flatnonzero(data[a:b] & 0xC0 != 0x80)
            lead = data[at]
            width = 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
            end = word_ends[np.searchsorted(word_starts, at, "right") - 1]
            best = self.longest(data, at, end)
            fresh = word_starts[np.searchsorted(word_starts, a) : np.searchsorted(word_starts, b)]
            for v, row in enumerate(best):
                following = at + np.where(row > 0, row, width)
                first = fresh if not a <= entries[v] < b else np.append(fresh, entries[v])
                mark = chain(first - a, at - a, np.where(following < np.minimum(end, b), following - a, b - a), b - a)
                marks[v, a:b] = mark
                if mark.any():
                    last = np.searchsorted(at, a + np.flatnonzero(mark)[-1])
                    entries[v] = following[last] if following[last] < end[last] else -1
        return marks


def chain(first: np.ndarray, at: np.ndarray, following: np.ndarray, size: int) -> np.ndarray:
    """Marks what is reached from the positions ``first`` where ``at[i]`` leads to ``following[i]``, and ``size`` to nothing.

    Pointers are doubled, so a chain of n steps takes log2(n) rounds.
    """
    jump = np.full(size + 1, size)
    jump[at] = following
    mark = np.zeros(size + 1, bool)
    mark[first] = True
    reached = 0
    while (marked := np.flatnonzero(mark)).size > reached:
        reached = marked.size
        mark[jump[marked]] = True
        mark[size] = False
        jump = jump[jump]
    return mark[:size]


def word_bytes(words: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Buffer]:
    """Words in UTF-8: their bytes, their offsets, and the buffer of the bytes; null words are empty."""
    words = words.cast(pa.string()).fill_null("")
    _, places, text = words.buffers()
    offsets = np.frombuffer(places, np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    text = (text or pa.py_buffer(b"")).slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
    return np.frombuffer(text, np.uint8), offsets - offsets[0], text


def piece_counts(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Pieces before each offset, from the marks of one vocabulary."""
    return np.concatenate([[0], np.cumsum(marks)])[offsets]


def piece_lists(words: pa.Array, trie: Trie) -> pa.ListArray:
    """The pieces of each word under the first vocabulary; null for a null word.  Pieces share the bytes of the words."""
    data, offsets, text = word_bytes(words)
    marks = trie.piece_starts(data, offsets)[0]
    starts = np.append(np.flatnonzero(marks), len(data)).astype(np.int32)
    pieces = pa.StringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts), text)
    return pa.ListArray.from_arrays(pa.array(piece_counts(marks, offsets), pa.int32()), pieces, mask=words.is_null())
