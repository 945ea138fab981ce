"""Streams over several micro-batches give what their batch twins give."""

import time
import uuid

import pandas as pd
from pyspark.sql import functions as F

from loreweave.catalog.chat import conversation_events
from loreweave.catalog.memory import memories_of
from loreweave.operators import chat, memory
from loreweave.operators.ordered import Segments
from loreweave.streaming import dialogue, folders, ingest, state


def in_batches(spark, sf, tmp_path, n=4):
    """The events as a stream of n micro-batches in event order."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    folder = tmp_path / "events"
    total = events.count()
    step = -(-total // n)
    for i in range(n):
        events.where((F.col("event_id") >= i * step) & (F.col("event_id") < (i + 1) * step)).coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def run(stream, tmp_path):
    return state.run_to_parquet(stream, str(tmp_path / f"out-{uuid.uuid4().hex}"), str(tmp_path / f"check-{uuid.uuid4().hex}"))


def test_conversation_state(spark, sf, tmp_path):
    got = run(state.stream_conversation_state(conversation_events(in_batches(spark, sf, tmp_path))), tmp_path)
    events = conversation_events(spark.read.parquet(f"{sf}/events.parquet"))
    kept = events.where((F.col("action") != "submit") | (F.col("reply") != ""))
    folded = chat.fold_conversation_events(kept, ["conv_id"], ["ts", "event_id"], Segments())
    depth = {r.conv_id: (r.n, r.top) for r in folded.groupBy("conv_id").agg(F.count("*").alias("n"), F.max_by("event_id", "position").alias("top")).collect()}
    last = got.groupBy("conv_id").agg(F.max_by(F.struct("depth", "top_event_id"), "event_id").alias("x")).collect()
    assert {r.conv_id: (r.x.depth, r.x.top_event_id) for r in last if r.x.depth} == depth
    assert got.where("late").count() == 0


def conversation(spark, tmp_path, *batches):
    """Events of conversation 1 as a stream of one micro-batch for each list of (event_id, action)."""
    schema = "conv_id long, ts timestamp_ntz, event_id long, action string, input string, reply string"
    for rows in batches:
        rows = [(1, f"2024-01-01 00:00:{i:02d}", i, action, f"said {i}", "x") for i, action in rows]
        df = spark.createDataFrame(rows, schema.replace("timestamp_ntz", "string")).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))


def test_cancel_and_clear_reach_inputs_of_earlier_batches(spark, tmp_path):
    stream = conversation(
        spark,
        tmp_path,
        [(1, "submit"), (2, "submit"), (3, "submit")],
        [(4, "cancel"), (5, "cancel"), (6, "submit")],  # position 1 is written again, position 2 is removed
        [(7, "cancel"), (8, "cancel"), (9, "cancel"), (10, "submit")],  # one cancel too many
        [(11, "clear"), (12, "cancel"), (13, "submit"), (14, "submit")],
        [(15, "cancel"), (16, "cancel")],
    )
    got = {r.event_id: (r.depth, r.top_event_id) for r in run(state.stream_conversation_state(stream), tmp_path).collect()}
    assert got == {
        1: (1, 1), 2: (2, 2), 3: (3, 3), 4: (2, 2), 5: (1, 1), 6: (2, 6), 7: (1, 1), 8: (0, None), 9: (0, None), 10: (1, 10),
        11: (0, None), 12: (0, None), 13: (1, 13), 14: (2, 14), 15: (1, 13), 16: (0, None),
    }


def test_idle_conversation_is_forgotten(spark, tmp_path):
    out = str(tmp_path / "out")
    stream = state.stream_conversation_state(conversation(spark, tmp_path, [(1, "submit")]), idle_seconds=1)
    running = (
        stream.writeStream.option("checkpointLocation", str(tmp_path / "check")).trigger(processingTime="2 seconds").start(out, "parquet")
    )

    def depths(n):
        for _ in range(120):
            time.sleep(0.5)
            if (tmp_path / "out" / "_spark_metadata").exists():
                got = {r.event_id: r.depth for r in spark.read.schema(stream.schema).parquet(out).collect()}
                if len(got) == n:
                    return got
        raise AssertionError(running.lastProgress)

    try:
        depths(1)
        time.sleep(6)  # batches without data let the timer expire
        conversation(spark, tmp_path, [(2, "submit")])
        assert depths(2) == {1: 1, 2: 1}
    finally:
        running.stop()


class CountingMap(dict):
    """A map state that counts what is done to it."""

    calls = 0

    def getValue(self, key):
        self.calls += 1
        return self[key]

    def updateValue(self, key, value):
        self.calls += 1
        self[key] = value

    def removeKey(self, key):
        self.calls += 1
        del self[key]


class Value:
    held = None

    def exists(self):
        return self.held is not None

    def get(self):
        return self.held

    def update(self, value):
        self.held = value


def test_state_touched_by_an_event_does_not_grow(spark):
    p = state._Conversation(None)
    p.standing, p.head = CountingMap(), Value()

    def apply(first, actions):
        ids = range(first, first + len(actions))
        rows = pd.DataFrame({"ts": pd.to_datetime(ids, unit="s"), "event_id": ids, "action": actions, "input": "a", "reply": "b"})
        before = p.standing.calls
        list(p.handleInputRows((1,), iter([rows]), None))
        return p.standing.calls - before

    apply(0, ["submit"] * 5000)
    assert len(p.standing) == 5000 and apply(6000, ["submit", "cancel", "cancel"]) <= 6 and apply(7000, ["submit"]) <= 2
    assert sorted(p.standing) == [(i,) for i in range(5000)] and p.standing[(4999,)][0] == 7000


def test_late_event_is_flagged(spark, tmp_path):
    schema = "conv_id long, ts timestamp_ntz, event_id long, action string, input string, reply string"
    for i, rows in enumerate(([(1, "2024-01-02", 2, "submit", "b", "x")], [(1, "2024-01-01", 1, "submit", "a", "x"), (1, "2024-01-03", 3, "submit", "c", "")])):
        df = spark.createDataFrame(rows, schema.replace("timestamp_ntz", "string")).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = {r.event_id: (r.depth, r.top_event_id, r.late) for r in run(state.stream_conversation_state(stream), tmp_path).collect()}
    assert got == {2: (1, 2, False), 1: (2, 1, True), 3: (2, 1, False)}


def test_memory_ingest(spark, sf, tmp_path):
    """An agent with a third of the rows, cut into segments; four batches, merged by twos, run twice, are numbered like one table."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    hot = events.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(7)).otherwise(F.col("user_id")))
    hot.write.parquet(str(tmp_path / "hot" / "events.parquet"))
    held = memories_of(hot)
    seen = memories_of(in_batches(spark, str(tmp_path / "hot"), tmp_path)).drop("importance", "last_accessed_at")
    now = F.lit("2024-02-01").cast("timestamp_ntz")

    def client():
        return lambda prompts: [str(len(p) % 10) for p in prompts]

    for attempt in ("a", "b"):  # a lost checkpoint runs every batch again
        ingest.stream_memory_ingest(
            seen, lambda df: ingest.rate_importance(df, client), now, str(tmp_path / "out"), str(tmp_path / attempt), Segments(20, 60), 2
        ).awaitTermination()
    schema = "agent long, memory_id long, buffer_idx long, created_at timestamp_ntz, page_content string, importance double"
    got = folders.batch_rows(spark, str(tmp_path / "out" / "memories"), schema)
    assert got.count() == held.count()
    step = -(-events.count() // 4)
    order = sorted(((r.agent, r.memory_id // step, r.created_at, r.memory_id) for r in held.collect()))
    numbers, last = {}, None
    for agent, _, _, memory_id in order:
        last = (agent, last[1] + 1) if last and last[0] == agent else (agent, 0)
        numbers[memory_id] = last[1]
    assert {r.memory_id: r.buffer_idx for r in got.collect()} == numbers
    assert got.where("importance is null").count() == 0 and got.select("importance").distinct().count() > 3


def test_failed_rating_is_kept(spark):
    def client():
        def answer(prompts):
            if any("bad" in p for p in prompts):
                raise ValueError("no")
            return ["7"] * len(prompts)

        return answer

    df = spark.createDataFrame([(1, "good"), (2, "bad"), (3, None)], "memory_id int, page_content string")
    got = {r.memory_id: (r.importance, r.error) for r in ingest.rate_importance(df, client).collect()}
    assert got[1] == got[3] == (0.7 * 0.15, None) and got[2][0] is None and "no" in got[2][1]


def test_reflection(spark, sf, tmp_path):
    def importance(df):
        return df.withColumn("importance", F.coalesce("importance", F.lit(0.0)))

    stream = importance(memories_of(in_batches(spark, sf, tmp_path))).withColumnsRenamed({"created_at": "ts", "memory_id": "event_id"})
    got = run(state.stream_reflection(stream, 0.3), tmp_path).select("agent", "event_id", "reached")
    held = importance(memories_of(spark.read.parquet(f"{sf}/events.parquet")))
    want = memory.reflection_trigger(held, ["created_at", "memory_id"], 0.3).select("agent", "memory_id", "reached")
    assert want.count() > 50 and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_folders_hold_every_earlier_batch_once():
    for merged in (2, 3, 8):
        made = set()
        for batch in range(200):
            for level, number in folders.merges_before(batch, merged):
                assert {(level - 1, number * merged + i) for i in range(merged)} <= made
                made.add((level, number))
            read = list(folders.folders_before(batch, merged))
            assert set(read) <= made and len(read) <= (merged - 1) * 8
            held = [b for level, n in read for b in range(n * merged**level, (n + 1) * merged**level)]
            assert sorted(held) == list(range(batch))
            made.add((0, batch))


def test_dialogue_remembers_what_it_said(spark, tmp_path):
    """Five batches of one agent, merged by twos; each answer says how many memories there were. A lost checkpoint runs them all again."""
    turn = "event_id long, agent long, name string, ts timestamp_ntz, heard string"
    for i in range(5):
        rows = spark.createDataFrame([(i, 1, "Ann", "2024-01-01", f"word{i}"), (100 + i, 2, "Bob", "2024-01-01", "FAIL")], turn.replace("timestamp_ntz", "string"))
        rows.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    turns = spark.readStream.schema(turn).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    columns = "memory_id long, agent long, page_content string, created_at timestamp_ntz, last_accessed_at timestamp_ntz, importance double, vec array<float>"
    base = spark.createDataFrame([(900, 1, "the base", None, None, 0.5, None), (901, 3, "of another", None, None, 0.5, None)], columns)

    def client():
        def answer(prompts):
            if any("FAIL" in p for p in prompts):
                raise ValueError("no answer")
            return [f"SAY: {p.count('- ')} known" for p in prompts]

        return answer

    prompt = F.concat(F.coalesce("relevant_memories", F.lit("")), F.lit("\n"), "heard")

    def reply(batch, memories):
        # lines need a time
        memories = memories.withColumn("created_at", F.coalesce("created_at", F.lit("2023-01-01").cast("timestamp_ntz")))
        return dialogue.remembered_replies(batch, memories, F.lit("2024-02-01").cast("timestamp_ntz"), 50, client, prompt=prompt)

    for attempt in ("a", "b"):
        dialogue.stream_dialogue(turns, base, reply, str(tmp_path / "out"), str(tmp_path / attempt), merged=2).awaitTermination()
        rows = folders.batch_rows(spark, str(tmp_path / "out"), "event_id long, reply string, page_content string, error string").collect()
        assert {r.event_id: r.reply for r in rows if r.event_id < 100} == {i: f"Ann said {i + 1} known" for i in range(5)}
        failed = [r for r in rows if r.event_id >= 100]
        assert len(failed) == 5 and all(r.reply is None and r.page_content is None and "no answer" in r.error for r in failed)


def test_stream_reads_a_table_of_one_file_or_of_a_folder(spark, sf, tmp_path):
    table = spark.read.parquet(f"{sf}/conversations.parquet")
    table.repartition(3).write.parquet(str(tmp_path / "in" / "conversations.parquet"))
    table.limit(1).write.parquet(str(tmp_path / "in" / "xconversations.parquet"))
    for folder in (sf, str(tmp_path / "in")):
        assert run(state.read_stream(spark, folder, "conversations", 2), tmp_path).count() == table.count()
