"""Segmentation by a trie in numpy equals the plain longest-piece rule."""

import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from loreweave.operators import vocab
from loreweave.operators.trie import Trie, piece_lists, word_bytes

ALPHABET = "abé語😀"


def cut(word, known):
    out = []
    while word:
        size = next((n for n in range(len(word), 0, -1) if word[:n] in known), 1)
        out.append(word[:size])
        word = word[size:]
    return out


texts = st.text(ALPHABET, max_size=12)


@settings(max_examples=200, deadline=None)
@given(st.lists(texts, max_size=8), st.lists(st.lists(texts, max_size=8), min_size=1, max_size=3), st.integers(1, 9))
def test_pieces_start_where_the_rule_says(words, vocabs, window):
    data, offsets, _ = word_bytes(pa.array(words, pa.string()))
    marks = Trie(vocabs).piece_starts(data, offsets, window)
    for mark, known in zip(marks, vocabs, strict=True):
        want, at = [], 0
        for word in words:
            for piece in cut(word, set(known)):
                want.append(at)
                at += len(piece.encode())
        assert list(np.flatnonzero(mark)) == want


def test_lists_with_nulls_and_slices():
    words = pa.array(["skipped", "abba", None, "", "é語x"])[1:]
    assert piece_lists(words, Trie([["ab", "語x", "", "b"]])).to_pylist() == [["ab", "b", "a"], None, [], ["é", "語x"]]
    assert piece_lists(pa.array([], pa.string()), Trie([[]])).to_pylist() == []


def test_word_longer_than_a_window():
    rng = random.Random(3)
    word = "".join(rng.choices("abcd", k=2_500_000))
    pieces = ["".join(rng.choices("abcd", k=rng.randint(1, 9))) for _ in range(3000)]
    known, got, at = set(pieces), piece_lists(pa.array([word]), Trie([pieces])).to_pylist()[0], 0
    assert "".join(got) == word
    for piece in got:
        assert not any(word[at : at + n] in known for n in range(len(piece) + 1, min(9, len(word) - at) + 1))
        assert piece in known or len(piece) == 1
        at += len(piece)


def test_counts_of_all_vocabularies_in_one_pass(spark):
    words = spark.createDataFrame([(1, "abba"), (2, None), (3, ""), (4, "é語x")], "id int, w string")
    vocabs = {"one": ["ab", "ba"], "two": ["abba", "é語"], "none": []}
    tables = {k: spark.createDataFrame([(p,) for p in v], "piece string") for k, v in vocabs.items()}
    counted = vocab.greedy_counts(words, "w", tables)
    got = {r.id: (r.one, r.two, r.none) for r in counted.collect()}
    assert got == {1: (2, 1, 4), 2: (0, 0, 0), 3: (0, 0, 0), 4: (3, 2, 3)}
    assert counted._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
