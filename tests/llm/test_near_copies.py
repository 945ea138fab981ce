"""Near copies against all pairs, and the limits that a fingerprint of 64 bits could not see."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loreweave.llm import near_copies, simhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def similarity(a, b):
    """Jaccard of five-word shingles by plain sets."""
    a, b = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (t.lower().split() for t in (a, b)))
    return len(a & b) / len(a | b)


def near_texts(n, seed):
    """Groups of an original and copies with one to six words replaced: similarities on both sides of 0.8."""
    rng = random.Random(seed)
    texts = []
    for _ in range(n):
        words = [f"w{rng.randrange(5_000)}" for _ in range(rng.randint(60, 120))]
        for edits in (0, 1, 2, 3, 6):
            new = list(words)
            for at in rng.sample(range(len(new)), edits):
                new[at] = f"x{rng.randrange(5_000)}"
            texts.append(" ".join(new))
    return texts


def kept_by_brute_force(texts):
    group = list(range(len(texts)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if similarity(texts[i], texts[j]) >= 0.8:
                a, b = sorted((top(i), top(j)))
                group[b] = a
    return {top(i) for i in range(len(texts))}


@pytest.mark.parametrize("chunk, chunk_shingles", [(1_024, 1 << 19), (2, 1 << 19), (1_024, 150)])
def test_near_dedup_equals_all_pairs(spark, chunk, chunk_shingles):
    texts = near_texts(12, 3)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], DOCS)
    got = near_copies.near_dedup(docs, chunk=chunk, chunk_shingles=chunk_shingles)
    assert {r.doc_id for r in got.collect()} == kept_by_brute_force(texts)


def test_pipeline_stage_drops_what_four_bits_keep(spark):
    texts = near_texts(12, 4)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], DOCS)
    got = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()}
    assert got == kept_by_brute_force(texts)
    assert got != {r.doc_id for r in simhash.near_dedup(docs).collect()}


def test_boilerplate_alone_links_nothing(spark):
    shared = " ".join(f"licence{i}" for i in range(40))
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.lit(shared), *[F.concat(F.lit(f" own{i}x"), "id") for i in range(60)]).alias("text"))
    assert near_copies.near_dedup(docs).count() == 300


def test_odd_texts(spark):
    texts = ["", None, " \n\t ", "one two", "one two", "ONE  two", "a", "word " * 30_000 + "x" * 3_000]
    rows = [(i, t, "en", None, i) for i, t in enumerate(texts)] + [(None, "a", None, None, None), (3, "one two", None, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    got = near_copies.near_dedup(docs)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == [0, 3, 3, 6, 7]
    assert near_copies.near_dedup(docs.filter("false")).count() == 0


def test_forest_links_through_a_middle():
    a = np.arange(100, dtype=np.uint64)
    sets = [a, a + np.uint64(8), a + np.uint64(16), a + np.uint64(500)]
    assert sorted(near_copies.forest(sets)) == [(0, 1), (1, 2)]


def test_bitmap_keeps_every_candidate(spark):
    wanted = spark.range(0, 100_000, 7).select((F.col("id") * 7_919 - 300_000).alias("mark"))
    every = spark.range(100_000).select((F.col("id") * 7_919 - 300_000).alias("mark"))
    kept = {r.mark for r in every.filter(near_copies.among(wanted, 20)).collect()}
    assert {r.mark for r in wanted.collect()} <= kept
    assert len(kept) < 20_000
    assert every.filter(near_copies.among(wanted.limit(0), 20)).count() == 0


def test_simhash_finds_what_no_band_does(spark, monkeypatch):
    rng = random.Random(6)
    words = [f"w{rng.randrange(5_000)}" for _ in range(3_000)]
    edited = [*words[:1_500], "edited", *words[1_501:]]
    other = [f"v{rng.randrange(5_000)}" for _ in range(3_000)]
    docs = spark.createDataFrame([(i, " ".join(t), "en", "s", 1) for i, t in enumerate([words, other, edited])], DOCS)
    # every text has keys of its own, so none meet in a band
    numbers = np.arange(1, 1 + near_copies.BANDS, dtype=np.uint64)
    monkeypatch.setattr(near_copies, "band_keys", lambda held: numbers * held.sum())
    assert {r.doc_id for r in near_copies.near_dedup(docs).collect()} == {0, 1}
