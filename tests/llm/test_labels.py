"""Every language with a text is learned, however rare it is beside others."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loreweave.llm import langid


def tongue(k, rows):
    """``rows`` different texts of an invented language with letters of its own."""
    rng = np.random.default_rng(k)
    letters = [chr(0x4E00 + 20 * k + i) for i in range(20)]
    return [(f"l{k:03}", " ".join("".join(rng.choice(letters, 4)) for _ in range(12))) for _ in range(rows)]


def test_every_label_is_learned(spark):
    texts = [x for k in range(140) for x in tongue(k, 3)]
    model = langid.fit(spark.createDataFrame(texts, "lang string, text string"), "text", "lang")
    assert len(model.labels) == 140
    assert langid.predict(model, [t for _, t in texts])[0] == [k for k, _ in texts]


def test_rare_label_beside_hot_ones(spark):
    rare = tongue(7, 2)
    hot = spark.range(20_000).select(F.lit("hot").alias("lang"), F.concat(F.lit("plain words number "), "id").alias("text"))
    copies = spark.range(20_000).select(F.lit("copies").alias("lang"), F.lit("der eine satz").alias("text"))
    docs = spark.createDataFrame(rare, "lang string, text string").union(hot).union(copies)
    shares, taken = langid.sampled_texts(docs.select(F.col("lang").alias("label"), "text"), 300)
    assert [(r["label"], r["rows"], r["texts"]) for r in shares] == [("copies", 20_000, 1), ("hot", 20_000, 20_000), ("l007", 2, 2)]
    n = {r.label: r["count"] for r in taken.groupBy("label").count().collect()}
    assert n[0] == 1 and 60 < n[1] < 150 and n[2] == 2
    model = langid.fit(docs, "text", "lang", 300)
    assert langid.predict(model, [t for _, t in rare])[0] == ["l007", "l007"]


def test_too_many_labels_are_an_error(spark):
    docs = spark.range(langid.LABELS + 1).select(F.col("id").cast("string").alias("lang"), F.lit("text").alias("text"))
    with pytest.raises(ValueError, match="languages"):
        langid.fit(docs, "text", "lang")


def test_stage_fills_and_corrects_labels(spark):
    rows = [(i, t, k, "x") for i, (k, t) in enumerate(x for k in range(3) for x in tongue(k, 40))]
    wrong, unlabelled = (200, rows[3][1] + " " + rows[4][1], "l002", "x"), (201, rows[50][1], None, "x")
    odd = [wrong, unlabelled, (202, "123 !", "l000", "x"), (203, None, "l000", "x"), (204, "", None, "x"), wrong]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, found string")
    got = langid.keep_identified(docs)
    assert got.columns == docs.columns
    out = sorted(tuple(r) for r in got.collect())
    fixed = [(200, wrong[1], "l000", "x")] * 2 + [(201, unlabelled[1], "l001", "x")]
    assert out == sorted(rows + fixed)
    # a higher bar leaves labels alone, and rejects what is told with less
    assert ("l002",) in {tuple(r) for r in langid.keep_identified(docs, relabel=1.1).filter("doc_id = 200").select("lang").collect()}
    assert langid.keep_identified(docs, least=1.1).count() == 0
    assert langid.keep_identified(docs.limit(0)).count() == 0


def test_mixed_text_is_rejected_by_its_score(spark):
    model = langid.LanguageModel(["a", "b"], np.log([0.5, 0.5]), np.full((2, langid.BUCKETS), -1.0, np.float32))
    langs, scores = langid.predict(model, ["any words"])
    assert langs == ["a"] and abs(scores[0] - 0.5) < 1e-9
