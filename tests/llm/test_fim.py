import hashlib
import re

import numpy as np
import pytest

from loreweave.llm.fim import ERROR, RankIndex, fill_in_middle, fim_query, restored

MARKS = ("<P>", "<S>", "<M>")


def brute(key, text, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in MARKS) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


EDGES = [
    (None, "one\ntwo\nthree"),
    (1, None),
    (2, ""),
    (3, "\n"),
    (4, "\n\n\n\n"),
    (5, "no line break"),
    (6, "ends\n"),
    (7, "has a <S> mark\nand more\n"),
    (8, "<"),
    (9, "a<\n<S\n>P>\nM>\n<"),
    (10, "zażółć\ngęślą\n日本語 😀\n" * 50),
    (10, "zażółć\ngęślą\n日本語 😀\n" * 50),
    (11, "\r\n\x0b\x0c \x85\n\x00\n"),
    (12, "x" * 300_000 + "\n" + "y\n" * 100_000 + "z" * 200_000),
]


def test_edges_equal_brute_force(spark):
    # extra columns whose names clash with the new ones, and with each other
    rows = [(f"f{i}", k, t, i) for i, (k, t) in enumerate(EDGES)]
    df = spark.createDataFrame(rows, "form string, doc_id long, text string, n int")
    out = fill_in_middle(df, most=1 << 12)
    assert out.columns == ["form", "doc_id", "text", "n", "n", "form", "prefix_chars", "middle_chars", "output"]
    out = out.toDF("label", "doc_id", "text", "place", "n", "form", "prefix_chars", "middle_chars", "output")
    got = out.withColumn("back", restored(out["output"], out["form"])).orderBy("place").collect()
    assert len(got) == len(EDGES)
    for (key, text), r in zip(EDGES, got):
        assert (r.doc_id, r.text) == (key, text)
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute(key, text)
        assert r.back == (text or "")


def test_rates_are_parameters(spark):
    df = spark.createDataFrame([(i, "a\nb\nc\n") for i in range(300)], "doc_id long, text string")
    got = {r.doc_id: r for r in fill_in_middle(df, rate=30, spm_rate=100).collect()}
    for i, r in got.items():
        assert (r.form, r.output) == (brute(i, "a\nb\nc\n", 30, 100)[1], brute(i, "a\nb\nc\n", 30, 100)[4])
    assert {r.form for r in got.values()} == {"plain", "spm"}


def test_empty_table(spark):
    assert fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_equals_brute_force(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = fim_query(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        n, form, prefix, middle, output = brute(r.doc_id, texts[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, prefix, middle)
        assert r.output_sha256 == hashlib.sha256(output.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


@pytest.mark.parametrize("error", [0, 1, 16, ERROR])
def test_rank_index_is_exact_and_bounded(error):
    rng = np.random.default_rng(3)
    steps = np.concatenate([rng.integers(1, 120, 5_000), [900_000], np.zeros(50, np.int64), rng.integers(1, 3, 5_000)])
    offsets = np.cumsum(steps)
    index = RankIndex(offsets, error)
    ranks = rng.permutation(len(offsets))
    assert (index.lookup(ranks) == offsets[ranks]).all()
    # half a byte of rounding comes on top
    assert np.abs(index.residuals).max() <= error + 1
    assert index.residuals.dtype == np.int16
    if error == ERROR:
        assert len(index.starts) < 20


def test_a_straight_line_is_one_segment():
    index = RankIndex(np.arange(100_000) * 37)
    assert len(index.starts) == 1 and not index.residuals.any()
    assert len(RankIndex(np.empty(0, np.int64)).lookup(np.empty(0, np.int64))) == 0
