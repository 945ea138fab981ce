"""Splitters against slow, plain versions on made-up texts."""

import random

import pytest
from pyspark.sql import functions as F

from loreweave.operators import chunking


def slow_merge(parts, sep, size, overlap):
    """All chunks of consecutive parts, looked up by index instead of kept in a queue."""
    out, lo, hi = [], 0, 0
    joined = lambda a, b: sep.join(parts[a:b])
    while lo < len(parts):
        hi = max(hi, lo + 1)
        while hi < len(parts) and len(joined(lo, hi + 1)) <= size:
            hi += 1
        out.append(joined(lo, hi))
        if hi == len(parts):
            break
        lo = next(s for s in range(lo + 1, hi + 1) if s == hi or (len(joined(s, hi)) <= overlap and len(joined(s, hi + 1)) <= size))
    return out


def slow_recursive(text, size, overlap, seps):
    seps = list(seps)
    while len(seps) > 1 and seps[0] not in text:
        seps.pop(0)
    sep, later = seps[0], seps[1:]
    parts = [p for p in (text.split(sep) if sep else list(text)) if p]
    out, run = [], []
    for p in parts:
        if len(p) <= size or not later:
            run.append(p)
        else:
            out += slow_merge(run, sep, size, overlap) + slow_recursive(p, size, overlap, later)
            run = []
    return out + slow_merge(run, sep, size, overlap)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(9)
    made = ["", " ", "a", "\n\n\n", "x" * 100, "龙兽\n\n🙂 b\n" * 20]
    for _ in range(150):
        words = ["".join(rng.choice("ab龙🙂") for _ in range(rng.choice([0, 1, 3, 9, 50]))) for _ in range(rng.randint(1, 60))]
        made.append("".join(w + rng.choice([" ", " ", "\n", "\n\n", ""]) for w in words))
    return made


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


def chunks_of(df):
    out = {}
    for r in df.orderBy("doc_id", "chunk_no").collect():
        out.setdefault(r.doc_id, []).append(r.text)
    return out


def cleaned(chunks):
    return [c.strip() for c in chunks if c.strip()]


@pytest.mark.parametrize("size,overlap", [(20, 5), (40, 0), (7, 6)])
def test_chunk_separator(spark, texts, size, overlap):
    got = chunks_of(chunking.chunk_separator(frame(spark, texts), "text", "\n", size, overlap))
    for i, t in enumerate(texts):
        assert got.get(i, []) == cleaned(slow_merge([p for p in t.split("\n") if p], "\n", size, overlap))


@pytest.mark.parametrize("size,overlap", [(20, 5), (40, 0), (7, 6)])
def test_chunk_recursive(spark, texts, size, overlap):
    df = chunking.chunk_recursive(frame(spark, texts), "text", size, overlap)
    got = chunks_of(df)
    for i, t in enumerate(texts):
        assert got.get(i, []) == cleaned(slow_recursive(t, size, overlap, ["\n\n", "\n", " ", ""]))
        assert all(len(c) <= size for c in got.get(i, []))
    assert df.where("too_long").count() == 0


@pytest.mark.parametrize("size,overlap", [(5, 1), (20, 0), (7, 6)])
def test_chunk_fixed(spark, texts, size, overlap):
    got = chunks_of(chunking.chunk_fixed(frame(spark, [*texts, "abcdefghij"]), "text", size, overlap))
    if (size, overlap) == (5, 1):
        assert got[len(texts)] == ["abcde", "efghi", "ij"]
    for i, t in enumerate(texts):
        held = got[i]
        assert held[0] + "".join(c[overlap:] for c in held[1:]) == t
        assert all(len(c) <= size for c in held) and all(len(c) > overlap for c in held[1:])


def test_measure_in_words(spark):
    df = spark.createDataFrame([(1, "a b\nc d e\nf")], "doc_id long, text string")
    words = lambda s: len(s.split())
    got = chunking.chunk_separator(df, "text", "\n", 4, 0, words).select("text", "too_long").collect()
    assert [r.text for r in got] == ["a b", "c d e\nf"]


def test_fixed_needs_progress(spark):
    with pytest.raises(ValueError):
        chunking.chunk_fixed(spark.range(1).select("id", F.lit("x").alias("text")), "text", 5, 5)
