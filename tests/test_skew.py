"""Hot keys: tiny segments, parts and blocks give the same as one task per key."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loreweave.operators import chat, memory, search
from loreweave.operators.ordered import SEG, Segments, counted_segments, join_ordered, totals_before, with_next_row


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(3)
    rows = []
    for key, n in ((1, 200), (2, 3), (3, 1), (4, 40)):
        at = 0
        for _ in range(n):
            rows.append((key, at, rng.choice(["user", "assistant"]), "".join(rng.choice("ab龙\n") for _ in range(rng.randint(0, 9)))))
            at += rng.randint(1, 4)
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def segments(length, hot_rows):
    return counted_segments("turn", length) if hot_rows is None else Segments(max(length, 30), hot_rows)


def by_key(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


@pytest.mark.parametrize("length", [1, 7, 4096])
@pytest.mark.parametrize("hot_rows", [None, 0, 20, 1000])
@pytest.mark.parametrize("descending", [False, True])
def test_totals_before(spark, turns, length, hot_rows, descending):
    df = spark.createDataFrame(turns, SCHEMA).repartition(5)
    got = totals_before(
        df, ["conv_id"], ["turn"], segments(length, hot_rows), {"n": F.lit(1), "c": F.length("text")}, descending=descending
    )
    want = set()
    for key, rows in by_key(turns).items():
        chars = 0
        for i, r in enumerate(reversed(rows) if descending else rows):
            want.add((key, r[1], i, chars))
            chars += len(r[3])
    assert {(r.conv_id, r.turn, r.n, r.c) for r in got.collect()} == want


@pytest.mark.parametrize("length", [1, 7, 4096])
@pytest.mark.parametrize("hot_rows", [None, 0, 20, 1000])
def test_with_next_row(spark, turns, length, hot_rows):
    df = spark.createDataFrame(turns, SCHEMA).repartition(5)
    got = with_next_row(df, ["conv_id"], "turn", ["role", "text"], segments(length, hot_rows))
    want = set()
    for key, rows in by_key(turns).items():
        for r, after in zip(rows, [*rows[1:], (None,) * 4]):
            want.add((key, r[1], after[2], after[3]))
    assert {(r.conv_id, r.turn, r.next_role, r.next_text) for r in got.collect()} == want


def test_segments_are_bounded_by_rows(spark):
    """One key with 200,000 rows of one timestamp, as after a bulk import."""
    df = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 1000 == 0, F.col("id")).otherwise(F.lit(-1)).alias("agent"), F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"), (F.col("id") * 977).alias("i")
    )
    cut = Segments(5_000, 1_000).cut(df, ["agent"])
    marked = cut.mark(df, ["ts", "i"])
    sizes = marked.groupBy("agent", SEG).count().where(F.col(SEG).isNotNull()).collect()
    assert {r.agent for r in sizes} == {-1} and sum(r["count"] for r in sizes) == 199_800
    assert max(r["count"] for r in sizes) <= 5_000 and len(sizes) <= 80
    numbered = totals_before(df, ["agent"], ["ts", "i"], cut, {"n": F.lit(1)}).where("agent = -1")
    # ids that are multiples of 1000 are missing
    assert numbered.where(F.col("n") != F.col("i") / 977 - F.floor(F.col("i") / 977 / 1000) - 1).count() == 0
    assert numbered.count() == 199_800


@pytest.mark.parametrize("part_chars", [5, 64, 1 << 20])
@pytest.mark.parametrize("sep", ["", "\n", "--"])
def test_join_ordered(spark, turns, part_chars, sep):
    df = spark.createDataFrame(turns, SCHEMA)
    got = join_ordered(df, ["conv_id"], ["turn"], F.col("text"), sep, Segments(9, 10), part_chars)
    parts = by_key(sorted((r.conv_id, r.part, r.text) for r in got.collect()))
    for key, rows in by_key(turns).items():
        assert all(len(p[2]) <= part_chars for p in parts[key])
        assert [p[1] for p in parts[key]] == list(range(len(parts[key])))
        assert "".join(p[2] for p in parts[key]) == sep.join(r[3] for r in rows)


@pytest.mark.parametrize("part_chars", [8, 1 << 20])
@pytest.mark.parametrize("drop", [0, 13])
def test_history_before_turn(spark, turns, part_chars, drop):
    rows = [(k, t, text, role) for k, t, role, text in turns]
    df = spark.createDataFrame(rows, "conv_id long, turn long, input string, output string")
    line = chat.labelled("[P]", "[N]")
    got = chat.history_before_turn(df, line, drop_last=drop, part_chars=part_chars)
    parts = by_key(sorted(((r.conv_id, r.turn), r.part, r.history) for r in got.collect()))
    for key, group in by_key(rows).items():
        lines = [f"[P]{r[2]}\n[N]{r[3]}" for r in group]
        for i, r in enumerate(group):
            whole = "\n".join(lines[:i])
            assert "".join(p[2] for p in parts[(key, r[1])]) == whole[: max(len(whole) - drop, 0)]


def test_history_tail_over_parts(spark, turns, monkeypatch):
    monkeypatch.setattr(chat, "TAIL_CHARS", 16)
    rows = [(k, t, text, role) for k, t, role, text in turns]
    df = spark.createDataFrame(rows, "conv_id long, turn long, input string, output string")
    line = chat.labelled("[P]", "[N]")
    for most in (1, 10, 40):
        got = {(r.conv_id, r.turn): r.tail for r in chat.history_tail(df, line, "\n", F.lit(most), most).collect()}
        for key, group in by_key(rows).items():
            lines = [f"[P]{r[2]}\n[N]{r[3]}" for r in group]
            for i, r in enumerate(group):
                assert got[(key, r[1])] == "\n".join(lines[:i])[-most:]


@pytest.mark.parametrize("length", [50, 1000])
@pytest.mark.parametrize("hot_rows", [0, 150, 1000])
def test_fold_events(spark, length, hot_rows):
    rng = random.Random(5)
    rows = [(rng.choice([1, 1, 1, 2, 3]), i, rng.choices(["submit", "cancel", "clear"], [5, 4, 0.2])[0]) for i in range(600)]
    df = spark.createDataFrame(rows, "conv_id long, event_id long, action string").repartition(7)
    want = {}
    for key, i, action in rows:
        stack = want.setdefault(key, [])
        if action == "submit":
            stack.append(i)
        elif action == "cancel":
            del stack[-1:]
        else:
            stack.clear()
    got = chat.fold_conversation_events(df, ["conv_id"], ["event_id"], Segments(length, hot_rows)).collect()
    assert {(r.conv_id, r.position, r.event_id) for r in got} == {(k, p, e) for k, s in want.items() for p, e in enumerate(s)}


def brute_reflections(rows, limit):
    total, out = {}, []
    for agent, i, v in rows:
        total[agent] = total.get(agent, 0) + round(v * 1_000_000)
        if total[agent] > limit * 1_000_000:
            out.append((agent, i, round(total[agent] / 1e6, 6)))
            total[agent] = 0
    return set(out)


@pytest.mark.parametrize("fold_rows", [1, 5, 64, 65536])
@pytest.mark.parametrize("hot_rows", [0, 300, 1000, -1])
def test_reflections(spark, fold_rows, hot_rows, monkeypatch):
    if hot_rows < 0:  # more hot agents than can be listed
        monkeypatch.setattr(memory, "hot_keys", lambda *a: None)
    rng = random.Random(11)
    rows = [(rng.choice([1, 1, 1, 2, 3]), i, rng.choice([0.0, 0.1, 0.25, 0.5, rng.random(), 4.0 if i % 90 == 0 else 0.3])) for i in range(900)]
    df = spark.createDataFrame(rows, "agent long, i long, importance double").repartition(6)
    df = df.withColumn("ts", F.timestamp_seconds(F.col("i") * 600)).select("agent", "ts", "i", "importance")
    got = memory.reflection_trigger(df, ["ts", "i"], 2.0, fold_rows=fold_rows, hot_rows=hot_rows, segment_rows=100).collect()
    assert {(r.agent, r.i, r.reached) for r in got} == brute_reflections(rows, 2.0)


@pytest.mark.parametrize("hot_rows", [0, 200, 1000])
def test_pack_recent_hot_agent(spark, hot_rows):
    rng = random.Random(2)
    rows = [(rng.choice([1, 1, 2]), i, rng.randint(0, 5)) for i in range(500)]
    df = spark.createDataFrame(rows, "agent long, i long, n int").withColumn("ts", F.timestamp_seconds(F.col("i") * 60))
    got = memory.pack_recent(df, ["ts", "i"], F.col("n"), 40, Segments(64, hot_rows)).collect()
    want = set()
    for agent in (1, 2):
        used = 0
        for a, i, n in reversed([r for r in rows if r[0] == agent]):
            used += n
            if used > 40:
                break
            want.add((a, i, used))
    assert {(r.agent, r.i, r.used) for r in got} == want


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(4)
    base = rng.normal(size=(300, 8)).astype(np.float32)
    base[100:220] = base[0]  # a third and more are copies of one vector
    return base


def brute(points, queries, k, metric="l2"):
    d = search.pairwise(queries.astype(np.float64), points.astype(np.float64), metric)
    out = set()
    for q in range(len(queries)):
        order = sorted(range(len(points)), key=lambda i: (d[q, i], i))[:k]
        out |= {(q, i, float(d[q, i]), r + 1) for r, i in enumerate(order)}
    return out


def frame(spark, points, name):
    return spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], f"{name} long, vec array<float>").repartition(5)


@pytest.mark.parametrize("metric", ["l2", "l2sq", "cosine", "ip"])
@pytest.mark.parametrize("query_rows", [1000, 0])
def test_knn_both_ways(spark, points, metric, query_rows):
    chunks, queries = frame(spark, points, "id"), frame(spark, points[:40], "qid")
    got = search.knn_topk(chunks, queries, 7, metric, query_rows=query_rows, block_chunks=50, block_queries=9).collect()
    assert {(r.qid, r.id, r.distance, r.rank) for r in got} == brute(points, points[:40], 7, metric)


def test_mmr(spark, points):
    chunks, queries = frame(spark, points, "id"), frame(spark, points[:10], "qid")
    got = sorted((r.qid, r.pick, r.id) for r in search.mmr_topk(chunks, queries, 4, 30, 0.5).collect())
    p = points.astype(np.float64)
    among = 1 - search.pairwise(p, p, "cosine")
    want = []
    for q in range(10):
        cand = sorted(range(len(p)), key=lambda i: (round(1 - among[q, i], 6), i))[:30]
        picked = []
        while len(picked) < 4:
            gain = {c: round(0.5 * among[q, c] - 0.5 * (max(among[c, s] for s in picked) if picked else 0), 6) for c in cand if c not in picked}
            picked.append(min(gain, key=lambda c: (-gain[c], c)))
        want += [(q, n + 1, c) for n, c in enumerate(picked)]
    assert got == sorted(want)


def test_similarity_range_and_relevance(spark, points):
    chunks, queries = frame(spark, points, "id"), frame(spark, points[:5], "qid")
    three = search.knn_topk(chunks, queries, 3)
    five = search.knn_topk(chunks, queries, 5)
    assert three.select("qid", "id").exceptAll(five.select("qid", "id")).count() == 0
    both = search.compare_retrievers(three, five).collect()
    assert all((r.hits_a, r.hits_b, r.shared, r.same_first) == (3, 5, 3, True) for r in both)


@pytest.mark.parametrize("query_rows", [1000, 0])
def test_knn_with_text_ids(spark, points, query_rows):
    name = F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 4, "0"))
    chunks = frame(spark, points, "id").withColumn("id", name)
    queries = chunks.where("id < 'k0005'").select(F.col("id").alias("qid"), "vec")
    got = search.knn_topk(chunks, queries, 3, query_rows=query_rows, block_chunks=50).collect()
    want = {(f"k{q:04}", f"k{i:04}", d, r) for q, i, d, r in brute(points, points[:5], 3)}
    assert {(r.qid, r.id, r.distance, r.rank) for r in got} == want
