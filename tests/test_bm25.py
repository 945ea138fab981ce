import math
import random
import re
from collections import Counter

import pytest

from loreweave.operators import bm25

PATTERN = re.compile(r"\w+|[^\w\s]")


def brute(texts, questions, k):
    docs = {i: Counter(PATTERN.findall((t or "").lower())) for i, t in texts}
    mean = sum(sum(c.values()) for c in docs.values()) / len(docs)
    out = []
    for q, asked in questions:
        scores = {}
        for w in set(PATTERN.findall((asked or "").lower())):
            n = sum(w in c for c in docs.values())
            for i, c in docs.items():
                if w in c:
                    damped = c[w] + 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)
                    scores[i] = scores.get(i, 0.0) + math.log(1 + (len(docs) - n + 0.5) / (n + 0.5)) * c[w] * 2.2 / damped
        best = sorted(scores.items(), key=lambda x: (-round(x[1], 6), x[0]))[:k]
        out += [(q, i, r + 1, round(s, 5)) for r, (i, s) in enumerate(best)]
    return sorted(out)


TEXTS = [(i, t) for i, t in enumerate(["The dragon sleeps. The dragon wakes!", "a knight", None, "", "dragon dragon dragon", "the the the the", "Knight and dragon", "no match", "a knight"])]
QUESTIONS = [(1, "Where does the dragon sleep? The dragon!"), (2, "knight"), (3, None), (4, ""), (5, "zebra"), (6, "KNIGHT knight a")]


@pytest.mark.parametrize("sizes", [{}, {"limit": 0, "salt_rows": 1}])
def test_equals_brute_force(spark, sizes):
    index = bm25.postings(spark.createDataFrame(TEXTS, "id long, text string").repartition(3))
    got = bm25.bm25_topk(index, spark.createDataFrame(QUESTIONS, "qid long, question string"), 3, **sizes).collect()
    assert sorted((r.qid, r.id, r["rank"], round(r.score, 5)) for r in got) == brute(TEXTS, QUESTIONS, 3)


def test_empty_tables(spark):
    texts, questions = spark.createDataFrame(TEXTS, "id long, text string"), spark.createDataFrame(QUESTIONS, "qid long, question string")
    assert bm25.bm25_topk(bm25.postings(texts), questions.limit(0), 3).count() == 0
    assert bm25.bm25_topk(bm25.postings(texts.limit(0)), questions, 3).count() == 0


def test_postings_and_pairs_are_not_written(spark, monkeypatch):
    """Few questions: the texts are scored where they are, and each task gives out its k best, in slices of any size."""
    rng = random.Random(5)
    texts = [(f"t{i:03}", " ".join(rng.choices(["the", "a", "of", *[f"w{j}" for j in range(40)]], k=rng.randint(0, 30)))) for i in range(300)]
    questions = [(q, " ".join(["the", "a", *rng.choices([f"w{j}" for j in range(45)], k=4)])) for q in range(12)]
    monkeypatch.setattr(bm25, "written", None)
    index = bm25.postings(spark.createDataFrame(texts, "id string, text string").repartition(3))
    for rows, pairs in ((1 << 10, 1 << 20), (7, 5), (1, 1)):
        monkeypatch.setattr(bm25, "SLICE_ROWS", rows)
        monkeypatch.setattr(bm25, "PAIRS", pairs)
        hits = bm25.bm25_topk(index, spark.createDataFrame(questions, "qid int, question string"), 4)
        assert hits.schema["qid"].dataType.simpleString() == "int"
        got, want = sorted((r.qid, r.id, r["rank"], r.score) for r in hits.collect()), brute(texts, questions, 4)
        assert [r[:3] for r in got] == [r[:3] for r in want]
        assert [r[3] for r in got] == pytest.approx([r[3] for r in want], abs=1e-5)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan  # no pairs: the hits of each task are ranked, no more


def test_compare_retrievers_writes_no_table(spark, sf, monkeypatch):
    from loreweave.catalog import QUERIES

    monkeypatch.setattr(bm25, "written", None)
    rows = QUERIES["compare_retrievers"](spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/benchmark.parquet").count()
    assert all(r.hits_a == 5 and r.hits_b <= 5 and r.shared <= 5 for r in rows)
