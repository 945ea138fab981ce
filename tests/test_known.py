"""Small cases with known answers, one for every rule that is easy to get wrong."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from loreweave.catalog import QUERIES
from loreweave.functions import scores, templates, text, vectors
from loreweave.operators import chat, files, memory, search, training, vocab
from loreweave.operators.chunking import chunk_key
from loreweave.operators.ordered import Segments


def one(spark, column, **values):
    """Value of an expression over a one-row table."""
    return many(spark, column, [values])[0]


def many(spark, column, rows):
    types = {str: "string", int: "long", float: "double", bool: "boolean", dt.datetime: "timestamp_ntz"}
    kinds = {}
    for row in rows:
        for k, v in row.items():
            if v is not None:
                kinds[k] = types.get(type(v)) or f"array<{types[type(v[0])]}>"
            kinds.setdefault(k, "string")
    df = spark.createDataFrame([tuple(r[k] for k in kinds) for r in rows], ", ".join(f"{k} {t}" for k, t in kinds.items()))
    return [r[0] for r in df.coalesce(1).select(column).collect()]


def test_logistic_relevance(spark):
    got = many(spark, F.round(scores.logistic_relevance(F.col("d")), 6), [{"d": float(d)} for d in (0, 14000, 20000, 200000, 2000000)])
    assert got == [0.0, 0.034943, 0.049834, 0.380797, 0.5]
    assert one(spark, scores.logistic_relevance(F.col("d"), "inverse"), d=3.0) == 0.25
    with pytest.raises(ValueError):
        scores.relevance(F.col("d"), None)


def test_trim_history(spark):
    rows = [{"h": "abcdef"}, {"h": "a"}]
    assert many(spark, text.trim_history(F.col("h"), 2), rows) == ["abcd", ""]
    assert many(spark, text.trim_history(F.col("h"), 2, "keep_tail"), rows) == ["ef", "a"]


def test_parse_importance(spark):
    rows = [{"s": s} for s in ("9", "10", "x", "about 7", " 8 ", "12", "")]
    assert many(spark, text.parse_importance(F.col("s")), rows) == [0.9, 0.1, 0.0, None, 0.8, 0.1, 0.0]
    assert many(spark, text.parse_importance(F.col("s"), 1.0, "fixed"), rows) == [0.9, 1.0, 0.0, 0.7, 0.8, 1.0, 0.0]


def test_parse_rating(spark):
    rows = [{"s": s} for s in (" 7 \n", "seven", "7.5", "-3", "")]
    assert many(spark, text.parse_rating(F.col("s")), rows) == [7, None, None, -3, None]


def test_clean_reply(spark):
    rows = [{"r": "p### Response: a ###b"}, {"r": "no marker"}, {"r": "### Response:　 Npc: hi Player: x"}]
    assert many(spark, text.clean_reply(F.col("r"), "Npc", "Player"), rows) == ["a ", None, "hi "]
    assert many(spark, text.clean_reply_plain(F.col("r")), rows)[:2] == ["a ###b", None]


def test_strip_speakers(spark):
    a = text.strip_speaker_a(F.col("a"), "[N]", "[P]:")
    assert one(spark, a, a="[N]hi: you[P]: [N]x") == "hi you[P] x"
    assert one(spark, a, a="hi: you[P]: [N]x") == "hi you[P] [N]x"
    b = "[N]x: y"
    assert one(spark, text.strip_speaker_b(F.col("b"), F.col("a"), "[N]"), a="no colon", b=b) == "x: y"
    assert one(spark, text.strip_speaker_b(F.col("b"), F.col("a"), "[N]", "fixed"), a="no colon", b=b) == "x y"


def test_parse_dialogue(spark):
    rows = [{"r": r} for r in ("SAY: hi", "GOODBYE: bye", "hm", "SAY: Ann hello\nGOODBYE: x", "GOODBYE: SAY: a")]
    got = many(spark, text.parse_dialogue(F.col("r"), F.lit("Ann")), rows)
    assert [(x.goes_on, x.said) for x in got] == [(True, "hi"), (False, "bye"), (False, "hm"), (True, "hello"), (False, "SAY: a")]
    assert [x.reply for x in got][:3] == ["Ann said hi", "Ann said bye", "hm"]


def test_small_texts(spark):
    assert one(spark, text.mask_secret(F.col("s")), s="abcdefghij") == "abc************hij"
    assert one(spark, text.flatten_newlines(F.col("s")), s="a\nb\n") == "a b "
    assert one(spark, text.wrap_text(F.col("s"), 10), s="aaaa bbbb cccc well-known " + "x" * 12) == "aaaa bbbb\ncccc well-\nknown xxxx\nxxxxxxxx"
    assert one(spark, text.keep_last(F.col("s"), 0), s="abc") == "abc"
    assert one(spark, text.keep_last(F.col("s"), 2), s="龙兽abc") == "bc"


def test_templates(spark):
    fill = templates.fill_template("{{x}} {a}-{b}{a}", {"a": F.col("a"), "b": F.col("b")})
    assert one(spark, fill, a="{b}", b=None) == "{x} {b}-{b}"
    with pytest.raises(KeyError):
        templates.fill_template("{a}{c}", {"a": F.col("a")})
    optional = templates.fill_template_optional_input({"instruction": F.col("i"), "input": F.col("n")}, "I{instruction}N{input}", "I{instruction}")
    assert many(spark, optional, [{"i": "a", "n": ""}, {"i": "a", "n": "b"}]) == ["Ia", "IaNb"]
    persona = templates.persona_prompt(F.col("t"), F.lit("a/b&c"), F.lit("Bot"), F.col("at"))
    got = one(spark, persona, t="[AI_NAME] [[AI_NAME]] [[USER_NAME]] [[DATE_TIME]] [[DATE_YEAR]]", at=dt.datetime(2023, 5, 4, 7, 8))
    assert got == "[AI_NAME] Bot a/b&c 07:08 2023"


def test_hours_and_score(spark):
    now, then = F.col("now"), F.col("then")
    assert one(spark, scores.hours_passed(now, then), now="2023-05-04 12:30:00", then="2023-05-04T10:00:00") == 2.5
    assert one(spark, scores.hours_passed(now, then), now="x", then="2023-05-04") is None
    score = F.round(scores.memory_score(now, then, 0.01, [F.col("i")], None), 6)
    rows = [
        {"now": dt.datetime(2023, 5, 4, 12, 30), "then": dt.datetime(2023, 5, 4, 10), "i": None},
        {"now": dt.datetime(2023, 5, 4, 12, 30), "then": dt.datetime(2023, 5, 4, 10), "i": 0.5},
        {"now": dt.datetime(2023, 5, 4, 10), "then": dt.datetime(2023, 5, 4, 11), "i": 0.0},
    ]
    got = many(spark, score, rows)
    assert got[:2] == [0.975187, 1.475187] and got[2] > 1


def test_piece_to_bytes(spark):
    rows = [("<unk>", "unknown"), ("<s>", "control"), ("<0xAB>", "byte"), ("<0xA>", "byte"), ("▁a", "normal")]
    got = many(spark, text.piece_to_bytes(F.col("p"), F.col("k")), [{"p": p, "k": k} for p, k in rows])
    assert [None if g is None else bytes(g) for g in got] == [" ⁇ ".encode(), b"", b"\xab", None, b" a"]


def test_mask_labels(spark):
    df = spark.createDataFrame([([1, 5, 6, 7, 2], 3), ([1, 5, 6, 7, 8, 9, 9, 2], 40)], "ids array<int>, n int")
    m = [r[0] for r in df.coalesce(1).select(training.mask_labels(F.col("n"), F.col("ids"), 6)).collect()]
    assert m[0].labels == [-100, -100, 6, 7, 2, 0]
    assert m[0].input_ids == [1, 5, 6, 7, 2, 0] and m[0].attention_mask == [1] * 6 and m[0].real_mask == [1, 1, 1, 1, 1, 0]
    assert m[1].labels == [-100] * 6 and m[1].input_ids == [1, 5, 6, 7, 8, 9]


def test_encode_ids(spark):
    words = spark.createDataFrame([(3, "a"), (4, "b")], "id int, piece string")
    df = spark.createDataFrame([("a b c",), ("",), (None,), ("b, b",)], "t string").coalesce(1)
    got = [r[0] for r in training.encode_ids(df, {"ids": F.col("t")}, words).select("ids").collect()]
    assert got == [[1, 3, 4, 0, 2], [1, 2], [1, 2], [1, 4, 0, 4, 2]]


def test_unknown_tokens_are_spelled_in_bytes(spark):
    df = spark.createDataFrame([("a a a é b b 日x",), ("日 zz",), ("",), (None,)], "t string").coalesce(1)
    vocab = training.build_vocab(df, F.col("t"), 258, byte_pieces=True)
    ids = {r.piece: r.id for r in vocab.collect()}
    assert len(ids) == 258 and (ids["a"], ids["b"], ids["<0x00>"], ids["<0xFF>"]) == (259, 260, 3, 258)
    coded = training.encode_ids(df, {"ids": F.col("t")}, vocab, counted={"n": F.col("t")})
    got = coded.collect()

    def spelled(t):
        return [b + 3 for b in t.encode()]

    want = [[259] * 3 + spelled("é") + [260] * 2 + spelled("日x"), spelled("日") + spelled("zz"), [], []]
    assert [r.ids for r in got] == [[1, *w, 2] for w in want]
    assert [r.n for r in got] == [len(w) + 2 for w in want]


def test_registered_ids_lose_no_token(spark, sf):
    for name, column in (("encode_ids", "ids"), ("chat_prompt_budgeted", "prompt_ids")):
        rows = QUERIES[name](spark, sf).select(F.split(column, ",").alias("x"), "*")
        assert rows.count() and rows.where(F.array_contains("x", "0")).count() == 0
    # zeros of the training set are padding only
    rows = QUERIES["mask_labels"](spark, sf).select(F.split("input_ids", ",").alias("x"), "n_real")
    assert rows.where(F.size(F.filter("x", lambda i: i == "0")) != F.size("x") - F.col("n_real")).count() == 0


def test_training_plan_and_split(spark):
    plan = training.training_plan(spark.range(10000), 0.3, 64, 8, 10, 4).first()
    assert (plan.test, plan.train, plan.steps, plan.accumulation) == (3000, 7000, 1090, 2)
    ten = spark.range(10)
    once, again = (dict(training.exact_split(ten.repartition(n), "id", 0.3).collect()) for n in (1, 7))
    assert once == again and sorted(once.values()).count("test") == 3 and len(once) == 10
    assert set(dict(training.exact_split(ten, "id", 0.0).collect()).values()) == {"train"}


def test_global_index_equals_sort(spark):
    rows = spark.range(3000).withColumn("h", training.order_hash(F.col("id"), 1))
    got = {r.id: r.global_index for r in training.global_index(rows, "h", "id", digits=2).collect()}
    want = [r.id for r in rows.orderBy("h", "id").collect()]
    assert sorted(got, key=got.get) == want


def test_vocab_merge(spark):
    a = spark.createDataFrame([(0, "a"), (1, "b")], "id int, piece string")
    b = spark.createDataFrame([(0, "b"), (1, "c"), (2, "c")], "id int, piece string")
    for dedup, want in ((False, ["a", "b", "c", "c"]), (True, ["a", "b", "c"])):
        rows = vocab.vocab_merge(a, b, dedup).orderBy("id").collect()
        assert [r.piece for r in rows] == want and [r.id for r in rows] == list(range(len(want)))
        assert all(r.score == 0 for r in rows)


def test_encode_greedy(spark):
    v = spark.createDataFrame([(0, "ab"), (1, "abc"), (2, "c"), (3, "龙")], "id int, piece string")
    words = spark.createDataFrame([("abcab",), ("xabd龙龙",), ("",)], "w string").coalesce(1)
    got = [r.pieces for r in vocab.encode_greedy(words, "w", v).collect()]
    assert got == [["abc", "ab"], ["x", "ab", "d", "龙", "龙"], []]


def test_classify_and_prefer(spark):
    names = ["a.pth", "pytorch_model-1.bin", "x.safetensors", "ggml-q4.bin", "t.json", "tokenizer.model", "other.bin"]
    df = spark.createDataFrame([("m", n) for n in names] + [("l", "adapter_model.bin"), ("l", "b.pt")], "model string, path string")
    got = {r.path: (r["class"], r.is_lora) for r in files.classify_files(df).collect()}
    assert {k: v[0] for k, v in got.items()} == {
        "a.pth": "pt", "pytorch_model-1.bin": "pytorch", "x.safetensors": "safetensors", "ggml-q4.bin": "ggml",
        "t.json": "text", "tokenizer.model": "text", "adapter_model.bin": "pytorch", "b.pt": "pt",
    }
    assert got["b.pt"][1] and not got["a.pth"][1]
    kept = {r.path for r in files.prefer_format(files.classify_files(df)).collect()}
    assert kept == {"x.safetensors", "ggml-q4.bin", "t.json", "tokenizer.model", "adapter_model.bin", "b.pt"}


def test_shard_sets(spark):
    paths = ["x.00.pth", "x.01.pth", "x.03.pth", "y-00001-of-00002.bin", "y-00002-of-00002.bin", "z.bin", "z.bin.1", "z.bin.2", "w-00002-of-00003.bin", "v.0"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    got = {r.stem: (r.present, r.contiguous_prefix, r.expected, r.complete) for r in files.shard_sets(df).collect()}
    assert got == {
        "x.pth": (3, 2, None, False),
        "y-of-00002.bin": (2, 2, 2, True),
        "z.bin": (3, 3, None, True),
        "w-of-00003.bin": (1, 0, 3, False),
        "v": (1, 1, None, True),
    }


def test_fold_events(spark):
    acts = [("submit", "x"), ("cancel", None), ("cancel", None), ("submit", "y"), ("submit", "z"), ("clear", None), ("submit", "w")]
    df = spark.createDataFrame([(1, i, a, x) for i, (a, x) in enumerate(acts)], "conv_id long, event_id long, action string, input string")
    got = chat.fold_conversation_events(df, ["conv_id"], ["event_id"], Segments(2, 0)).collect()
    assert [(r.input, r.position) for r in got] == [("w", 0)]


def test_budgeted_prompt(spark):
    df = spark.createDataFrame([([1, 1], [5, 6, 7], [9]), ([1] * 5, [5], [9]), ([1, 1, 1], [5], [9])], "p array<int>, h array<int>, q array<int>")
    got = [r[0] for r in df.coalesce(1).select(chat.chat_prompt_budgeted(F.col("p"), F.col("h"), F.col("q"), 4)).collect()]
    assert [(g.prompt_ids, g.too_long) for g in got] == [([1, 1, 7, 9], False), (None, True), ([1, 1, 1, 9], False)]


def test_labeled_prompt(spark):
    df = spark.createDataFrame([(1, 0, "a", "b"), (1, 2, "c", "d"), (2, 0, "e", "f")], "conv_id long, turn long, input string, output string")
    def prompts(n):
        return {(r.conv_id, r.turn): r.prompt for r in chat.chat_prompt_labeled(df, "P", "N", n, "<{input}>").collect()}
    assert prompts(0) == {(1, 0): "<\nP:a\nN:>", (1, 2): "<P:a\nN:b\nP:c\nN:>", (2, 0): "<\nP:e\nN:>"}
    assert prompts(9)[(1, 2)] == "<:b\nP:c\nN:>" and prompts(3)[(1, 2)] == "<\nN:>"
    plain = {(r.conv_id, r.turn): r.prompt for r in chat.chat_prompt_plain(df, 0, "{input}").collect()}
    assert plain[(1, 2)] == "a\nb\n\nc\n" and plain[(1, 0)] == "\na\n"


def test_memory_digest(spark):
    at = dt.datetime(2023, 5, 4, 22, 58)
    rows = [(1, 0, " is hungry ", at), (1, 1, " is hungry ", at), (1, 2, "is hungry", at), (2, 3, "龙", dt.datetime(2023, 12, 1, 0, 5))]
    df = spark.createDataFrame(rows, "agent long, memory_id long, page_content string, created_at timestamp_ntz")
    got = {r.agent: r.text for r in memory.memory_digest(df, ["memory_id"]).collect()}
    line = "- May 04, 2023, 10:58 PM: is hungry"
    assert got == {1: f"{line}\n{line}", 2: "- December 01, 2023, 12:05 AM: 龙"}


def test_pack_recent(spark):
    df = spark.createDataFrame([(1, i, n) for i, n in enumerate([1, 9, 2, 3])] + [(2, 0, 9)], "agent long, i long, n int")
    got = memory.pack_recent(df, ["i"], F.col("n"), 6, Segments(2, 0)).collect()
    assert sorted((r.agent, r.i, r.used) for r in got) == [(1, 2, 5), (1, 3, 3)]


def test_buffer_index_fills_times(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, 5, t, None), (1, 6, t, t)], "agent long, memory_id long, ts timestamp_ntz, created_at timestamp_ntz")
    held = spark.createDataFrame([(1, 10)], "agent long, held long")
    now = dt.datetime(2025, 1, 1)
    got = memory.buffer_index(df, ["ts", "memory_id"], F.lit(now).cast("timestamp_ntz"), held).orderBy("memory_id").collect()
    assert [(r.buffer_idx, r.created_at, r.last_accessed_at) for r in got] == [(10, now, now), (11, t, now)]


def test_knn_small_and_empty(spark):
    points = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(3)], "id long, vec array<float>")
    q = spark.createDataFrame([(7, [0.0, 0.0])], "qid long, vec array<float>")
    got = search.knn_topk(points, q, 5).orderBy("rank").collect()
    assert [(r.qid, r.id, r.distance, r.rank) for r in got] == [(7, 0, 0.0, 1), (7, 1, 1.0, 2), (7, 2, 2.0, 3)]
    assert search.knn_topk(points.limit(0), q, 5).count() == 0
    assert search.knn_topk(points, q.limit(0), 5).count() == 0
    with pytest.raises(ValueError):
        search.relevance_scored_topk(points, None)


def test_distance_expression(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0]), ([1.0, 0.0], [0.0, 2.0])], "a array<double>, b array<double>").coalesce(1)
    for metric, want in (("l2", [5.0, 5**0.5]), ("l2sq", [25.0, 5.0]), ("cosine", [1.0, 1.0]), ("ip", [1.0, 1.0])):
        got = [r[0] for r in df.select(vectors.distance(F.col("a"), F.col("b"), metric)).collect()]
        assert got == pytest.approx(want)


def test_embedding_of_nothing(spark):
    df = spark.createDataFrame([("",), (None,), ("龙 🙂\nx",)], "t string").coalesce(1)
    got = [r[0] for r in df.select(vectors.embed_text(F.col("t"))).collect()]
    assert got[0] == got[1] == [0.0] * 64 and abs(sum(x * x for x in got[2]) - 1) < 1e-6


def test_q4_round_trip(spark):
    import random

    rng = random.Random(1)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(64)]) for i in range(50)] + [(50, [0.0] * 64)]
    df = spark.createDataFrame(rows, "id long, vec array<double>")
    for addends in (False, True):
        p = df.withColumn("p", vectors.vec_quant_q4(F.col("vec"), 32, addends)).withColumn(
            "back", vectors.vec_dequant_q4(F.col("p.q"), F.col("p.scales"), F.col("p.addends"))
        )
        for r in p.collect():
            step = max(r.p.scales)
            assert len(r.p.q) == 8 and max(abs(a - b) for a, b in zip(r.vec, r.back)) <= step / 2 + 1e-9
    levels = spark.createDataFrame([([0x76543210, -1], [2.0])], "q array<int>, s array<double>")
    got = levels.select(vectors.vec_dequant_q4(F.col("q"), F.col("s"))).first()[0]
    assert got == [2.0 * (i - 8) for i in range(8)] + [14.0] * 8
    again = spark.createDataFrame([([1.0, 2.0],)], "s array<double>").select(vectors.vec_regroup(F.col("s"), 2)).first()[0]
    assert again == [1.0, 1.0, 2.0, 2.0]


def test_touch_and_distinct(spark):
    t, now = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    df = spark.createDataFrame([(i, 1, "a" if i < 2 else "b", t) for i in range(3)], "memory_id long, agent long, page_content string, last_accessed_at timestamp_ntz")
    hits = df.where("memory_id = 1")
    got = {r.memory_id: r.last_accessed_at for r in memory.touch_memories(df, hits.union(hits), F.lit(now).cast("timestamp_ntz")).collect()}
    assert got == {0: t, 1: now, 2: t}
    assert {r.memory_id for r in memory.memory_distinct(df, ["memory_id"]).collect()} == {0, 2}


def test_chunk_keys_differ(spark):
    rows = [(1, 1 << 20), (2, 0), (1 << 44, 0), ((1 << 63) - 1, 5), (-(1 << 63), 5), (10, 0)]
    df = spark.createDataFrame(rows, "doc_id long, chunk_no int").withColumn("id", chunk_key("doc_id", "chunk_no"))
    got = {(r.doc_id, r.chunk_no): r.id for r in df.collect()}
    assert len(set(got.values())) == len(rows)
    assert got[(2, 0)] < got[(10, 0)] < got[(1 << 44, 0)]


def test_sft_written_in_order(spark, sf, tmp_path):
    from loreweave.catalog.training import doc_vocab, records
    from loreweave.plans.sft import write_sft_dataset

    held = records(spark, sf)
    path = str(tmp_path / "sft")
    done = write_sft_dataset(held, doc_vocab(spark, sf), path, length=32)
    n = held.count()
    test = done.where("split = 'test'")
    assert done.count() == n and test.count() == int(n * 0.3)
    assert sorted(r.position for r in test.collect()) == list(range(int(n * 0.3)))
    assert done.where("size(input_ids) <> 32 or size(labels) <> 32 or step <> position div 64").count() == 0
    # every file holds one run of positions, sorted
    for f in done.inputFiles():
        at = [r.position for r in spark.read.parquet(f).collect()]
        assert at == list(range(at[0], at[0] + len(at)))
