"""Tasks hold a bounded part of an Arrow batch as numbers or Python objects; where it is cut does not change results."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loreweave.functions import vectors
from loreweave.operators import chunking, search, training

TEXTS = [(0, "one two three\nfour five"), (1, None), (2, ""), (3, "a\n" * 30 + "w " * 40), (4, "dragon"), (5, "ä ö\nü " * 9)]


@pytest.fixture
def texts(spark):
    return spark.createDataFrame(TEXTS, "id long, text string").coalesce(1)


def test_slices_cover_all_rows():
    lengths = np.array([0, 5, 0, 100, 1, 1, 1])
    for most in (1, 4, 50, 1 << 20):
        cuts = list(vectors.token_slices(lengths, most))
        assert [x for a, b in cuts for x in range(a, b)] == list(range(7))
        assert all(b - a == 1 or (lengths[a:b] + 1).sum() <= most for a, b in cuts)
    assert list(vectors.token_slices(lengths[:0], 4)) == []


def test_chunks(texts, monkeypatch):
    cut = lambda: sorted(map(tuple, chunking.chunk_separator(texts, "text", "\n", 20, 5).collect()))
    whole = cut()
    monkeypatch.setattr(chunking, "SLICE_BYTES", 8)
    assert cut() == whole and len(whole) > 6


def test_vectors_and_ids(texts, monkeypatch):
    vocab = training.build_vocab(texts, F.col("text"), 5)

    def made():
        coded = training.encode_ids(texts, {"ids": F.col("text")}, vocab, counted={"n": F.col("text")})
        return sorted(map(str, coded.withColumn("vec", vectors.embed_text(F.col("text"))).collect()))

    whole = made()
    monkeypatch.setattr(vectors, "SLICE_TOKENS", 3)
    assert made() == whole


def test_hits(spark, monkeypatch):
    rng = np.random.default_rng(1)
    points = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(90, 4)).round(1))], "id long, vec array<double>").coalesce(1)
    asked = points.where("id < 7").withColumnRenamed("id", "qid")
    whole = sorted(map(tuple, search.knn_topk(points, asked, 5).collect()))
    monkeypatch.setattr(search, "SLICE_CHUNKS", 3)
    monkeypatch.setattr(search, "SLICE_PAIRS", 4)
    assert sorted(map(tuple, search.knn_topk(points, asked, 5).collect())) == whole
