"""Streaming queries; each runs over the events there are and returns what it wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from loreweave.catalog.base import embedding_sql, query, table
from loreweave.catalog.chat import conversation_events, folded_sql
from loreweave.catalog.compare import FLAGGED, exchanges, flag_tries, read_log
from loreweave.catalog.memory import DIGEST_LINE, MEMORIES, REFLECTED, SEARCHED, THRESHOLD, K, memories_of, now, retrieved_sql
from loreweave.catalog.training import template_sql
from loreweave.functions.templates import IMPORTANCE_TEMPLATE
from loreweave.functions.vectors import embed_text
from loreweave.operators.compare import flag_filter
from loreweave.session import scratch_path, written
from loreweave.sources import flags
from loreweave.streaming import state
from loreweave.streaming.dialogue import remembered_replies, stream_dialogue
from loreweave.streaming.folders import batch_rows
from loreweave.streaming.ingest import IMPORTANCE_WEIGHT, rate_importance, stream_memory_ingest

FILES = 1000  # files of a micro-batch


def arrivals(events):
    """The events in the two waves they arrive in: every fourth comes after the others, so many come late."""
    second = F.col("event_id") % 4 == 3
    return [events.where(~second), events.where(second)]


WAVE = "(event_id % 4 = 3)::INTEGER"


@query(
    "stream_conversation_state",
    f"""WITH RECURSIVE {folded_sql(f"{WAVE}, ts, event_id")},
before AS (SELECT conv_id, max((ts, event_id)) AS newest FROM acts WHERE {WAVE} = 0 GROUP BY 1),
whole AS (SELECT a.conv_id, a.event_id, a.event_id % 4 = 3 AND coalesce((a.ts, a.event_id) < b.newest, false) AS late, (
  SELECT max(k.rn) FROM kept k WHERE k.conv_id = a.conv_id AND ((k.event_id % 4 = 3)::INTEGER, k.ts, k.event_id) <= ((a.event_id % 4 = 3)::INTEGER, a.ts, a.event_id)) AS rn
  FROM acts a LEFT JOIN before b ON b.conv_id = a.conv_id)
SELECT w.conv_id, w.event_id, coalesce(len(f.stack), 0) AS depth, f.stack[-1] AS top_event_id, late FROM whole w LEFT JOIN fold f ON f.conv_id = w.conv_id AND f.rn = w.rn""",
)
def _stream_conversation_state(spark, sf):
    events = table(spark, sf, "events")
    folder, out, checkpoint = (scratch_path(spark, name) for name in ("events", "out", "checkpoint"))
    for wave in arrivals(events):
        wave.write.mode("append").parquet(folder)
        # each wave starts the stream again, from the state that the last one left
        arrived = conversation_events(state.read_arrivals(spark, folder, events.schema, FILES))
        done = state.run_to_parquet(state.stream_conversation_state(arrived), out, checkpoint)
    return done


@query(
    "stream_flag_log",
    f"""WITH {FLAGGED} SELECT input AS "Input", answer_a AS ggml, answer_b AS chatgpt, flag, username, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time FROM flagged""",
)
def _stream_flag_log(spark, sf):
    path = scratch_path(spark, "log")
    tries = flag_tries(state.read_stream(spark, sf, "conversations", FILES))
    rows = flags.log_rows(flag_filter(exchanges(spark, sf), tries))
    flags.stream_flag_log(rows, path, scratch_path(spark, "checkpoint")).awaitTermination()
    return read_log(spark, path)


def rating_client():
    """Stands in for a model: rates a prompt by its length."""
    return lambda prompts: [str(len(p) % 10) for p in prompts]


@query(
    "stream_memory_ingest",
    f"""WITH {MEMORIES}, rated AS (SELECT *, length({template_sql(IMPORTANCE_TEMPLATE, memory_content="page_content")}) % 10 AS rating FROM mem)
SELECT agent, memory_id, page_content, round(rating / 10.0 * {IMPORTANCE_WEIGHT}, 6)::DOUBLE AS importance, strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') AS created_at,
  row_number() OVER (PARTITION BY agent ORDER BY memory_id % 4 = 3, created_at, memory_id) - 1 AS buffer_idx FROM rated""",
)
def _stream_memory_ingest(spark, sf):
    events = table(spark, sf, "events")
    folder, out, checkpoint = (scratch_path(spark, name) for name in ("events", "memories", "checkpoint"))
    for wave in arrivals(events):
        wave.write.mode("append").parquet(folder)
        seen = memories_of(state.read_arrivals(spark, folder, events.schema, FILES)).drop("importance", "last_accessed_at")
        stream_memory_ingest(seen, lambda df: rate_importance(df, rating_client), now(), out, checkpoint).awaitTermination()
    schema = "agent long, memory_id long, page_content string, importance double, created_at timestamp_ntz, buffer_idx long"
    stamp = F.date_format("created_at", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return (
        batch_rows(spark, f"{out}/memories", schema)
        .withColumns({"created_at": stamp, "importance": F.round("importance", 6)})
        .select("agent", "memory_id", "page_content", "importance", "created_at", "buffer_idx")
    )


@query(
    "stream_reflection",
    f"WITH RECURSIVE {REFLECTED} SELECT agent, memory_id AS event_id, round(total / 1e6, 6) AS reached FROM run WHERE total > {round(THRESHOLD * 1_000_000)}",
)
def _stream_reflection(spark, sf):
    held = memories_of(state.read_stream(spark, sf, "events", FILES)).select(
        "agent",
        F.col("created_at").alias("ts"),
        F.col("memory_id").alias("event_id"),
        F.coalesce("importance", F.lit(0.0)).alias("importance"),
    )
    done = state.run_to_parquet(
        state.stream_reflection(held, THRESHOLD), scratch_path(spark, "out"), scratch_path(spark, "checkpoint")
    )
    return done.select("agent", "event_id", "reached")


def told_sql(name: str, turns: str) -> str:
    """``<name>_told``: what is said and remembered for the turns, from the memories ``<name>_top``."""
    return f"""{name}_lines AS (SELECT query_no, string_agg({DIGEST_LINE}, chr(10) ORDER BY rank) AS relevant FROM (
  SELECT *, row_number() OVER (PARTITION BY query_no, page_content ORDER BY rank) AS first FROM {name}_top) WHERE first = 1 GROUP BY 1),
{name}_prompt AS (SELECT t.*, name || ' remembers:' || chr(10) || coalesce(relevant, 'nothing') || chr(10) || 'and hears ' || query AS prompt
  FROM {turns} t LEFT JOIN {name}_lines l ON l.query_no = t.query_no),
{name}_told AS (SELECT qkey AS event_id, agent, ts, name || ' said ' || said AS reply, name || ' observed ' || query || ' and said ' || said AS memory_text
  FROM (SELECT *, length(prompt) || ' characters, first ' || split_part(prompt, chr(10), 2) AS said FROM {name}_prompt))"""


def recalling_client():
    """Stands in for a model: says how long the prompt was and what is remembered first."""
    return lambda prompts: [f"SAY: {len(p)} characters, first {p.split(chr(10))[1]}" for p in prompts]


# a click is a turn that an agent hears, every other event is a memory from before; what the first wave says is remembered in the second
HEARD = f"""{MEMORIES.replace("mem AS", "every AS")},
mem AS (SELECT v.* FROM every v JOIN events e ON e.event_id = v.memory_id WHERE event_type <> 'click'),
heard AS (SELECT event_id AS qkey, user_id AS agent, event_id AS query_no, 'Agent' || user_id AS name, props AS query, ts FROM events WHERE event_type = 'click'),
t0 AS (SELECT * FROM heard WHERE query_no % 4 <> 3), t1 AS (SELECT * FROM heard WHERE query_no % 4 = 3),
{embedding_sql("mvec", "mem", "memory_id", "page_content")}, {retrieved_sql("a", "t0")}, {told_sql("a", "t0")},
later AS (SELECT * FROM mem UNION ALL SELECT event_id, agent, memory_text, ts, ts, NULL FROM a_told),
{embedding_sql("lvec", "later", "memory_id", "page_content")}, {retrieved_sql("b", "t1", "later", "lvec")}, {told_sql("b", "t1")}"""


@query(
    "stream_dialogue",
    f"""WITH {HEARD} SELECT event_id, reply, memory_text, NULL::VARCHAR AS error
FROM (SELECT * FROM a_told UNION ALL SELECT * FROM b_told)""",
)
def _stream_dialogue(spark, sf):
    events = table(spark, sf, "events")
    clicks = F.col("event_type") == "click"
    base = memories_of(events.where(~clicks)).withColumn("vec", embed_text(F.col("page_content")))
    base = written(base, "base")  # embedded once, for all batches
    folder, out, checkpoint = (scratch_path(spark, name) for name in ("turns", "memories", "checkpoint"))
    known = F.coalesce("relevant_memories", F.lit("nothing"))
    prompt = F.concat("name", F.lit(" remembers:\n"), known, F.lit("\nand hears "), "heard")

    def reply(turns, memories):
        return remembered_replies(turns, memories, now(), K, recalling_client, prompt=prompt, search_k=SEARCHED)

    for wave in arrivals(events.where(clicks)):
        wave.write.mode("append").parquet(folder)
        turns = state.read_arrivals(spark, folder, events.schema, FILES).select(
            "event_id",
            F.col("user_id").alias("agent"),
            F.concat(F.lit("Agent"), F.col("user_id").cast("string")).alias("name"),
            "ts",
            F.col("props").alias("heard"),
        )
        stream_dialogue(turns, base, reply, out, checkpoint).awaitTermination()
    return batch_rows(spark, out, "event_id long, reply string, page_content string, error string").withColumnRenamed(
        "page_content", "memory_text"
    ).select("event_id", "reply", "memory_text", "error")
