from loreweave.llm.bpe import Bpe


def test_intact_is_told_with_the_ids(spark):
    texts = ["plain words", "", None, "日本語 😀\n\n  x", "long " * 40 + "y" * 300, "long " * 40 + "y" * 300]
    df = spark.createDataFrame([(i, t, "a", "b") for i, t in enumerate(texts)], "doc_id long, text string, ids string, intact string")
    for leaf in (1 << 15, 64):
        bpe = Bpe(spark, leaf=leaf)
        out = bpe.encode(df, "text", "found", intact="same")
        assert out.columns == [*df.columns, "found", "same"]
        want = {r.doc_id: (r.text, r.found) for r in Bpe(spark).encode(df, "text", "found").collect()}
        got = {r.doc_id: (r.text or None, r.found) for r in out.collect()}
        assert {k: (t or None, f) for k, (t, f) in want.items()} == got
        assert all(r.same for r in out.collect()) and out.count() == len(texts)
