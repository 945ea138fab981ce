"""Queries over agent memories; every event is a memory of its user."""

from __future__ import annotations

from pyspark.sql import functions as F

from loreweave.catalog.base import embedding_sql, query, table, tokens_sql
from loreweave.catalog.training import template_sql
from loreweave.functions.scores import memory_score
from loreweave.functions.templates import ACTION_FRAME, DIALOGUE_FRAME, ENTITY_FRAME, RELATION_FRAME, SELF_FRAME, SPEAKER_FRAME
from loreweave.operators import memory
from loreweave.operators.ordered import Segments
from loreweave.plans import agent

NOW = "2024-02-01 00:00:00"
K, BUDGET, THRESHOLD = 15, 120, 2.0

MEMORIES = """mem AS (SELECT event_id AS memory_id, user_id AS agent, ' ' || event_type || ' ' || props AS page_content, ts AS created_at,
  CASE WHEN event_type = 'view' THEN ts + INTERVAL 36 HOUR ELSE ts END AS last_accessed_at,
  CASE WHEN event_type = 'error' THEN NULL ELSE value / 500 END AS importance FROM events)"""


def now():
    return F.lit(NOW).cast("timestamp_ntz")


def memories(spark, sf):
    return memories_of(table(spark, sf, "events"))


def memories_of(events):
    kind = F.col("event_type")
    return events.select(
        F.col("event_id").alias("memory_id"),
        F.col("user_id").alias("agent"),
        F.concat(F.lit(" "), kind, F.lit(" "), F.col("props")).alias("page_content"),
        F.col("ts").alias("created_at"),
        F.when(kind == "view", F.col("ts") + F.expr("INTERVAL 36 HOURS")).otherwise(F.col("ts")).alias("last_accessed_at"),
        F.when(kind != "error", F.col("value") / 500).alias("importance"),
    )


@query(
    "buffer_index",
    """WITH old AS (SELECT user_id, count(*) AS held FROM events WHERE event_type = 'signup' GROUP BY 1),
new AS (SELECT event_id, user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS r FROM events WHERE event_type <> 'signup')
SELECT event_id AS memory_id, n.user_id AS agent, r + coalesce(held, 0) AS buffer_idx, strftime(ts, '%Y-%m-%d %H:%M:%S') AS created_at,
  '2024-02-01 00:00:00' AS last_accessed_at FROM new n LEFT JOIN old o ON o.user_id = n.user_id""",
)
def _buffer_index(spark, sf):
    events = table(spark, sf, "events")
    existing = (
        events.where(F.col("event_type") == "signup")
        .groupBy(F.col("user_id").alias("agent"))
        .agg(F.count(F.lit(1)).alias("held"))
    )
    new = memories_of(events.where(F.col("event_type") != "signup")).drop("last_accessed_at")
    done = memory.buffer_index(new, ["created_at", "memory_id"], now(), existing)
    stamp = "yyyy-MM-dd HH:mm:ss"
    return done.select(
        "memory_id",
        "agent",
        "buffer_idx",
        F.date_format("created_at", stamp).alias("created_at"),
        F.date_format("last_accessed_at", stamp).alias("last_accessed_at"),
    )


SEARCHED = 20  # nearest memories a query adds; few enough that the choice shows in the result


def retrieved_sql(name: str, queries: str, mem: str = "mem", mvec: str = "mvec") -> str:
    """Tables ``<name>_top`` and ``<name>_digest`` for the queries ``(qkey, agent, query_no, query)`` of table ``queries`` over the memories ``mem``."""
    return f"""{embedding_sql(f"{name}_q", queries, "qkey", "query")},
{name}_dot AS (SELECT s.qkey, m.memory_id, sum(q.val * c.val) AS dot FROM {queries} s JOIN {mem} m ON m.agent = s.agent JOIN {name}_q q ON q.key = s.qkey
  JOIN {mvec} c ON c.key = m.memory_id AND c.dim = q.dim GROUP BY 1, 2),
{name}_near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qkey ORDER BY distance, memory_id) AS r FROM (
  SELECT s.qkey, m.memory_id, round(greatest(qn.n2 + cn.n2 - 2 * coalesce(d.dot, 0), 0), 6) AS distance FROM {queries} s JOIN {mem} m ON m.agent = s.agent
  JOIN {name}_q_norm qn ON qn.key = s.qkey JOIN {mvec}_norm cn ON cn.key = m.memory_id LEFT JOIN {name}_dot d ON d.qkey = s.qkey AND d.memory_id = m.memory_id)) WHERE r <= {SEARCHED}),
{name}_last AS (SELECT * FROM (SELECT agent, memory_id, row_number() OVER (PARTITION BY agent ORDER BY created_at DESC, memory_id DESC) AS r FROM {mem}) WHERE r <= {K}),
{name}_found AS (SELECT qkey, memory_id, max(rel) AS rel FROM (SELECT qkey, memory_id, 1 / (1 + exp(-distance / 100000.0)) - 0.5 AS rel FROM {name}_near
  UNION ALL SELECT s.qkey, l.memory_id, NULL FROM {name}_last l JOIN {queries} s ON s.agent = l.agent) GROUP BY 1, 2),
{name}_top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY agent, query_no ORDER BY score DESC, memory_id) AS rank FROM (
  SELECT s.agent, s.query_no, m.memory_id, m.page_content, m.created_at, round(pow(0.99, (epoch_us(TIMESTAMP '{NOW}') - epoch_us(m.last_accessed_at)) / 3.6e9)
    + coalesce(importance, 0) + coalesce(rel, 0), 6) AS score FROM {name}_found f JOIN {queries} s ON s.qkey = f.qkey JOIN {mem} m ON m.memory_id = f.memory_id)) WHERE rank <= {K}),
{name}_digest AS (SELECT agent, string_agg({DIGEST_LINE}, chr(10) ORDER BY query_no, rank) AS relevant FROM (
  SELECT *, row_number() OVER (PARTITION BY agent, page_content ORDER BY query_no, rank) AS first FROM {name}_top) WHERE first = 1 GROUP BY 1)"""


DIGEST_LINE = "'- ' || strftime(created_at, '%B %d, %Y, %I:%M %p') || ': ' || trim(page_content)"
VECTORS = f"""{MEMORIES}, {embedding_sql("mvec", "mem", "memory_id", "page_content")},
turns AS (SELECT user_id AS agent, 'Agent' || user_id AS name, count(*) || ' events' AS status, 'Saw ' || count(DISTINCT event_type) || ' kinds' AS summary,
  arg_max(event_type, event_id) AS speaker, arg_max(props, event_id) AS observation FROM events GROUP BY 1)"""
# what was last seen, and what it was
ASKED = "asked AS (SELECT agent * 10 + i AS qkey, agent, i AS query_no, CASE WHEN i = 0 THEN observation ELSE speaker END AS query FROM turns, unnest(range(2)) t(i))"
SCORED = f"{VECTORS}, {ASKED}, {retrieved_sql('a', 'asked')}"


def agent_turns(spark, sf):
    """One turn per agent; the speaker is the kind of the last event, what it says are its properties."""
    return (
        table(spark, sf, "events")
        .groupBy(F.col("user_id").alias("agent"))
        .agg(
            F.concat(F.lit("Agent"), F.first("user_id").cast("string")).alias("name"),
            F.concat(F.count(F.lit(1)).cast("string"), F.lit(" events")).alias("status"),
            F.concat(F.lit("Saw "), F.count_distinct("event_type").cast("string"), F.lit(" kinds")).alias("summary"),
            F.max_by("event_type", "event_id").alias("speaker"),
            F.max_by("props", "event_id").alias("observation"),
        )
    )


def top_memories(spark, sf):
    queries = agent.queries_of(agent_turns(spark, sf), F.col("observation"), F.col("speaker"))
    return memory.retrieve_memories(memories(spark, sf), queries, now(), K, search_k=SEARCHED, split_queries=None)


@query("time_weighted_topk", f"WITH {SCORED} SELECT agent, query_no, memory_id, score, rank FROM a_top")
def _time_weighted_topk(spark, sf):
    return top_memories(spark, sf).select("agent", "query_no", "memory_id", "score", "rank")


@query(
    "memory_score",
    f"WITH {MEMORIES} SELECT memory_id, round(pow(0.98, (epoch_us(TIMESTAMP '{NOW}') - epoch_us(last_accessed_at)) / 3.6e9) + coalesce(importance, 0), 6) AS score FROM mem",
)
def _memory_score(spark, sf):
    score = memory_score(now(), F.col("last_accessed_at"), 0.02, [F.col("importance")])
    return memories(spark, sf).select("memory_id", F.round(score, 6).alias("score"))


@query(
    "touch_memories",
    f"""WITH {SCORED} SELECT m.memory_id, strftime(CASE WHEN t.memory_id IS NOT NULL THEN TIMESTAMP '{NOW}' ELSE m.last_accessed_at END, '%Y-%m-%d %H:%M:%S') AS last_accessed_at
FROM mem m LEFT JOIN (SELECT DISTINCT memory_id FROM a_top) t ON t.memory_id = m.memory_id""",
)
def _touch_memories(spark, sf):
    touched = memory.touch_memories(memories(spark, sf), top_memories(spark, sf), now())
    return touched.select("memory_id", F.date_format("last_accessed_at", "yyyy-MM-dd HH:mm:ss").alias("last_accessed_at"))


@query(
    "memory_distinct",
    f"WITH {MEMORIES} SELECT agent, page_content, memory_id FROM (SELECT *, row_number() OVER (PARTITION BY agent, page_content ORDER BY created_at, memory_id) AS r FROM mem) WHERE r = 1",
)
def _memory_distinct(spark, sf):
    kept = memory.memory_distinct(memories(spark, sf), ["created_at", "memory_id"])
    return kept.select("agent", "page_content", "memory_id")


@query(
    "memory_digest",
    f"""WITH {MEMORIES}, d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY agent, page_content ORDER BY created_at, memory_id) AS r FROM mem) WHERE r = 1)
SELECT agent, 0 AS part, string_agg({DIGEST_LINE}, chr(10) ORDER BY created_at, memory_id) AS text FROM d GROUP BY 1""",
)
def _memory_digest(spark, sf):
    return memory.memory_digest(
        memories(spark, sf), ["created_at", "memory_id"], segments=Segments()
    )


@query(
    "pack_recent",
    f"""WITH {MEMORIES}, s AS (SELECT agent, memory_id, sum(len({tokens_sql('page_content')})) OVER (PARTITION BY agent ORDER BY created_at DESC, memory_id DESC) AS used FROM mem)
SELECT agent, memory_id, used::BIGINT AS used FROM s WHERE used <= {BUDGET}""",
)
def _pack_recent(spark, sf):
    from loreweave.functions.vectors import tokens

    packed = memory.pack_recent(
        memories(spark, sf),
        ["created_at", "memory_id"],
        F.size(tokens(F.col("page_content"))),
        BUDGET,
        Segments(),
    )
    return packed.select("agent", "memory_id", "used")


# the running sum with reset, one event after another
REFLECTED = f"""{MEMORIES}, imp AS (SELECT agent, memory_id, created_at, round(coalesce(importance, 0) * 1000000)::BIGINT AS u,
  row_number() OVER (PARTITION BY agent ORDER BY created_at, memory_id) AS rn FROM mem),
run(agent, rn, memory_id, total) AS (
  SELECT agent, 0::BIGINT, NULL::BIGINT, 0::BIGINT FROM (SELECT DISTINCT agent FROM imp)
  UNION ALL SELECT i.agent, i.rn, i.memory_id, CASE WHEN r.total > {round(THRESHOLD * 1_000_000)} THEN 0 ELSE r.total END + i.u
  FROM run r JOIN imp i ON i.agent = r.agent AND i.rn = r.rn + 1)"""


@query(
    "reflection_trigger",
    f"WITH RECURSIVE {REFLECTED} SELECT agent, memory_id, round(total / 1e6, 6) AS reached FROM run WHERE total > {round(THRESHOLD * 1_000_000)}",
)
def _reflection_trigger(spark, sf):
    held = memories(spark, sf).withColumn("importance", F.coalesce("importance", F.lit(0.0)))
    return memory.reflection_trigger(held, ["created_at", "memory_id"], THRESHOLD).select("agent", "memory_id", "reached")


TURN_BUDGET = 160


def say_client():
    """Stands in for a model: says how long the prompt was."""
    return lambda prompts: [f"SAY: I read {len(p)} characters\nand more" for p in prompts]


SAID = "'SAY: I read ' || length({}) || ' characters' || chr(10) || 'and more'"
AGENT_COLUMNS = {
    "summary": "summary",
    "current_time": "'February 01, 2024, 12:00 AM'",
    "name": "name",
    "status": "status",
    "relevant_memories": "relevant",
    "speaker": "speaker",
    "observation": "observation",
}


def framed_sql(frame: str, **columns: str) -> str:
    return f"('### ' || {template_sql(frame, **columns)} || chr(10) || '### Response:')"


def step_sql(name: str, source: str, prompt: str) -> str:
    """Table ``source`` with the answer to a prompt in column ``name``."""
    return f"{name}_step AS (SELECT * EXCLUDE (prompt), {SAID.format('prompt')} AS {name} FROM (SELECT *, {prompt} AS prompt FROM {source}))"


SPEAKER_SQL = f"""sq AS (SELECT agent AS qkey, agent, 0 AS query_no, speaker AS query FROM turns), {retrieved_sql("s", "sq")},
s_base AS (SELECT t.*, coalesce(relevant, '') AS relevant FROM turns t LEFT JOIN s_digest d ON d.agent = t.agent),
{step_sql("speaker_summary", "s_base", framed_sql(SPEAKER_FRAME, name="name", speaker="speaker", relevant_memories="relevant"))}"""
SELF_SQL = f"""cq AS (SELECT agent AS qkey, agent, 0 AS query_no, name || chr(39) || 's core characteristics' AS query FROM turns), {retrieved_sql("c", "cq")},
c_base AS (SELECT t.*, coalesce(relevant, '') AS relevant FROM turns t LEFT JOIN c_digest d ON d.agent = t.agent),
{step_sql("self_summary", "c_base", framed_sql(SELF_FRAME, name="name", relevant_memories="relevant"))}"""


@query("speaker_summary", f"WITH {VECTORS}, {SPEAKER_SQL} SELECT agent, speaker_summary, NULL::VARCHAR AS error FROM speaker_summary_step")
def _speaker_summary(spark, sf):
    return agent.speaker_summary(memories(spark, sf), agent_turns(spark, sf), now(), say_client, k=K, search_k=SEARCHED)


@query("self_summary", f"WITH {VECTORS}, {SELF_SQL} SELECT agent, self_summary, NULL::VARCHAR AS error FROM self_summary_step")
def _self_summary(spark, sf):
    return agent.self_summary(memories(spark, sf), agent_turns(spark, sf), now(), say_client, k=K, search_k=SEARCHED)


@query(
    "related_memories",
    f"""WITH {VECTORS}, {step_sql("entity", "turns", framed_sql(ENTITY_FRAME, observation="observation"))},
{step_sql("action", "entity_step", framed_sql(ACTION_FRAME, entity="entity", observation="observation"))},
rq AS (SELECT agent * 10 + i AS qkey, agent, i AS query_no, CASE WHEN i = 0 THEN 'What is the relationship between ' || name || ' and ' || entity
  ELSE entity || ' is ' || action END AS query FROM action_step, unnest(range(2)) t(i)), {retrieved_sql("r", "rq")},
r_base AS (SELECT t.*, coalesce(relevant, '') AS relevant FROM action_step t LEFT JOIN r_digest d ON d.agent = t.agent),
{step_sql("relation", "r_base", template_sql(RELATION_FRAME, name="name", entity="entity", relevant_memories="relevant"))}
SELECT agent, entity, action, relation, NULL::VARCHAR AS error FROM relation_step""",
)
def _related_memories(spark, sf):
    return agent.related_memories(memories(spark, sf), agent_turns(spark, sf), now(), say_client, k=K, search_k=SEARCHED)


@query(
    "agent_turn",
    f"""WITH {VECTORS}, {SPEAKER_SQL}, {SELF_SQL},
base AS (SELECT t.* EXCLUDE (summary), t.summary || chr(10) || c.self_summary AS summary, s.speaker_summary AS relevant FROM turns t
  JOIN speaker_summary_step s ON s.agent = t.agent JOIN self_summary_step c ON c.agent = t.agent),
used AS (SELECT agent, len({tokens_sql(template_sql(DIALOGUE_FRAME, most_recent_memories="''", **AGENT_COLUMNS))}) AS used FROM base),
run AS (SELECT agent, memory_id, created_at, page_content, sum(greatest(len({tokens_sql(DIGEST_LINE)}), 1)) OVER (PARTITION BY agent ORDER BY created_at DESC, memory_id DESC) AS s FROM mem),
recent AS (SELECT r.agent, string_agg(page_content, '; ' ORDER BY created_at DESC, memory_id DESC) AS recent FROM run r JOIN used u ON u.agent = r.agent WHERE s <= {TURN_BUDGET * 4} - used GROUP BY 1),
p AS (SELECT b.*, {template_sql(DIALOGUE_FRAME, most_recent_memories="coalesce(recent, '')", **AGENT_COLUMNS)} AS prompt FROM base b LEFT JOIN recent r ON r.agent = b.agent)
SELECT agent, md5(prompt) AS prompt_md5, true AS goes_on, name || ' said I read ' || length(prompt) || ' characters' AS reply,
  name || ' observed ' || observation || ' and said I read ' || length(prompt) || ' characters' AS memory_text, NULL::VARCHAR AS error FROM p""",
)
def _agent_turn(spark, sf):
    turns = agent_turns(spark, sf)
    done = agent.agent_turn(memories(spark, sf), turns, now(), say_client, k=K, budget=TURN_BUDGET * 4, search_k=SEARCHED)
    return done.select("agent", F.md5("prompt").alias("prompt_md5"), "goes_on", "reply", "memory_text", "error")
