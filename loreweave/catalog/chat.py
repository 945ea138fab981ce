"""Queries over conversations: histories, prompts, replies, event folding."""

from __future__ import annotations

from pyspark.sql import functions as F

from loreweave.catalog.base import FULL_VOCAB, PAIRS, RECORDS, ids_sql, joined, query, table
from loreweave.catalog.training import full_vocab, quoted, records, template_sql
from loreweave.functions import text as txt
from loreweave.functions.scores import hours_passed, logistic_relevance
from loreweave.functions.templates import (
    ACTION_FRAME,
    COMPARE_TEMPLATE,
    DIALOGUE_FRAME,
    ENTITY_FRAME,
    IMPORTANCE_TEMPLATE,
    RATING_TEMPLATE,
    RELATION_FRAME,
    SELF_FRAME,
    SPEAKER_FRAME,
    TIME_FORMAT,
    agent_prompts,
    compare_prompt,
    fill_template,
    persona_prompt,
)
from loreweave.operators import chat
from loreweave.operators.ordered import PART_CHARS, Segments
from loreweave.operators.training import encode_ids
from loreweave.sources.readers import concat_pages

PLAYER, NPC = "Player", "Npc"
CHAT_TEMPLATE = "You are a character of the game and talk to the player.\n{input}\n### Response:"
PERSONA = "[AI_NAME]'s persona: it is [[DATE_TIME]] in [[DATE_YEAR]].\n[[USER_NAME]] talks to [[AI_NAME]]: "


def pairs(spark, sf):
    return chat.turn_pairs(table(spark, sf, "conversations"))


def marked_line():
    return chat.labelled(f"[{PLAYER}]", f"[{NPC}]")


MARKED = f"'[{PLAYER}]' || input || chr(10) || '[{NPC}]' || output"


def parts_sql(source: str, key: str) -> str:
    """Rows (key, text) cut into parts."""
    return f"""SELECT {key}, part, substr(text, part * {PART_CHARS} + 1, {PART_CHARS}) AS text FROM (
  SELECT *, unnest(range(0, greatest(length(text) - 1, 0) // {PART_CHARS} + 1)) AS part FROM {source})"""


@query(
    "concat_pages",
    r"""WITH whole AS (SELECT regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, string_agg(html, '' ORDER BY page_id) AS text FROM pages GROUP BY 1) """
    + parts_sql("whole", "host"),
)
def _concat_pages(spark, sf):
    host = F.regexp_extract("url", r"^https?://([^/?#]+)", 1)
    return concat_pages(table(spark, sf, "pages").withColumn("host", host), "host", "page_id", "html")


@query(
    "history_text",
    f"WITH {PAIRS}, whole AS (SELECT conv_id, string_agg({MARKED}, chr(10) ORDER BY turn) AS text FROM pairs GROUP BY 1) "
    + parts_sql("whole", "conv_id"),
)
def _history_text(spark, sf):
    return chat.history_text(pairs(spark, sf), marked_line())


def before_sql(line: str = MARKED, sep: str = "chr(10)") -> str:
    return f"""{PAIRS}, before AS (SELECT conv_id, turn, input, output, coalesce(string_agg({line}, {sep})
  OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS history FROM pairs)"""


def before_parts_sql(history: str) -> str:
    return f"""WITH {before_sql()}, kept AS (SELECT conv_id, turn, {history} AS h FROM before)
SELECT conv_id, turn, part, substr(h, part * {PART_CHARS} + 1, {PART_CHARS}) AS history FROM (
  SELECT *, unnest(range(0, greatest(length(h) - 1, 0) // {PART_CHARS} + 1)) AS part FROM kept)"""


@query("history_before_turn", before_parts_sql("history"))
def _history_before_turn(spark, sf):
    return chat.history_before_turn(pairs(spark, sf), marked_line())


@query("trim_history", before_parts_sql("substr(history, 1, greatest(length(history) - 256, 0))"))
def _trim_history(spark, sf):
    return chat.history_before_turn(pairs(spark, sf), marked_line(), drop_last=256)


@query("history_tail", f"WITH {before_sql()} SELECT conv_id, turn, right(history, 512) AS tail FROM before")
def _history_tail(spark, sf):
    held = chat.history_tail(pairs(spark, sf), marked_line(), "\n", F.lit(512), 512)
    return held.select("conv_id", "turn", "tail")


def prompt_sql(line: str, sep: str, opening: str, most: int) -> str:
    return f"""WITH {before_sql(line, sep)}, whole AS (SELECT conv_id, turn, right(history || {opening}, {most}) AS input FROM before)
SELECT conv_id, turn, {template_sql(CHAT_TEMPLATE, input="input")} AS prompt FROM whole"""


@query(
    "chat_prompt_labeled",
    prompt_sql(
        f"'{PLAYER}:' || input || chr(10) || '{NPC}:' || output",
        "chr(10)",
        f"chr(10) || '{PLAYER}:' || input || chr(10) || '{NPC}:'",
        800,
    ),
)
def _chat_prompt_labeled(spark, sf):
    return chat.chat_prompt_labeled(pairs(spark, sf), PLAYER, NPC, 800, CHAT_TEMPLATE)


@query(
    "chat_prompt_plain",
    prompt_sql("input || chr(10) || output || chr(10)", "''", "chr(10) || input || chr(10)", 1024),
)
def _chat_prompt_plain(spark, sf):
    return chat.chat_prompt_plain(pairs(spark, sf), 1024, CHAT_TEMPLATE)


def marked_sql(out: str, source: str, text: str) -> str:
    return f"{out} AS (SELECT s.id, [1] || coalesce(k.ids, []) || [2] AS ids FROM {source} s LEFT JOIN ({ids_sql(source, text)}) k ON s.id = k.id)"


BUDGET = 220


@query(
    "chat_prompt_budgeted",
    f"""WITH {RECORDS}, {FULL_VOCAB},
{marked_sql('p', 'records', 'instruction')}, {marked_sql('h', 'records', 'output')}, {marked_sql('q', 'records', 'input')},
j AS (SELECT p.id, p.ids AS p, h.ids AS h, q.ids AS q, {BUDGET} - len(p.ids) - len(q.ids) AS rest FROM p JOIN h USING (id) JOIN q USING (id))
SELECT id, CASE WHEN rest >= 0 THEN array_to_string(p || h[len(h) - least(rest, len(h)) + 1:] || q, ',') END AS prompt_ids, rest < 0 AS too_long FROM j""",
)
def _chat_prompt_budgeted(spark, sf):
    vocab = full_vocab(spark, sf)
    texts = {"p": F.col("instruction"), "h": F.col("output"), "q": F.col("input")}
    held = encode_ids(records(spark, sf).select("id", "instruction", "input", "output"), texts, vocab)
    packed = chat.chat_prompt_budgeted(F.col("p"), F.col("h"), F.col("q"), BUDGET)
    return held.select("id", packed.alias("x")).select(
        "id", joined(F.col("x.prompt_ids")).alias("prompt_ids"), F.col("x.too_long").alias("too_long")
    )


@query(
    "last_exchange",
    f"WITH {PAIRS} SELECT conv_id, max(turn) AS turn, arg_max(input, turn) AS input, arg_max(output, turn) AS output FROM pairs GROUP BY 1",
)
def _last_exchange(spark, sf):
    return chat.last_exchange(pairs(spark, sf), ["input", "output"])


@query(
    "persona_prompt",
    f"""SELECT event_id, replace(replace(replace(replace({quoted(PERSONA)}, '[[USER_NAME]]', 'user/' || user_id), '[[AI_NAME]]', event_type || '&co'),
  '[[DATE_TIME]]', strftime(ts, '%H:%M')), '[[DATE_YEAR]]', strftime(ts, '%Y')) AS prompt FROM events""",
)
def _persona_prompt(spark, sf):
    user = F.concat(F.lit("user/"), F.col("user_id").cast("string"))
    ai = F.concat("event_type", F.lit("&co"))
    return table(spark, sf, "events").select(
        "event_id", persona_prompt(F.lit(PERSONA), user, ai, F.col("ts")).alias("prompt")
    )


COMPARE_SQL = """, given AS (SELECT id, input AS question, instruction AS background, output AS chat_history, turn % 4 >= 2 AS use_b, turn % 3 > 0 AS use_h FROM records)
SELECT id, CASE WHEN use_b THEN background ELSE '' END || CASE WHEN use_h THEN chat_history ELSE '' END || question AS prompt_b,
  'Background:' || chr(10) || background || chr(10) || 'History:' || chr(10) || chat_history || chr(10) || '[Player]: ' || question AS prompt_a FROM given"""
SIDE_A_TEMPLATE = "Background:\n{background}\nHistory:\n{chat_history}\n[Player]: {question}"


@query("compare_prompt", f"WITH {RECORDS}{COMPARE_SQL}")
def _compare_prompt(spark, sf):
    q, b, h = F.col("input"), F.col("instruction"), F.col("output")
    use_b, use_h = F.col("turn") % 4 >= 2, F.col("turn") % 3 > 0
    return records(spark, sf).select(
        "id",
        compare_prompt(q, b, h, template=SIDE_A_TEMPLATE).alias("prompt_a"),
        compare_prompt(q, b, h, template=COMPARE_TEMPLATE, use_background=use_b, use_history=use_h).alias("prompt_b"),
    )


# Conversation events from the event stream: three types submit, one cancels, one clears.
EVENT_ACTIONS = """acts AS (SELECT user_id AS conv_id, ts, event_id, props AS input, CASE WHEN value < 5 THEN '' ELSE event_type END AS reply,
  CASE event_type WHEN 'error' THEN 'cancel' WHEN 'signup' THEN 'clear' ELSE 'submit' END AS action FROM events)"""
# the list of standing (event_id, input) after each event
def folded_sql(order: str = "ts, event_id") -> str:
    """What stands after each kept event of a conversation, applied in the given order."""
    return f"""{EVENT_ACTIONS}, kept AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY {order}) AS rn
  FROM acts WHERE action <> 'submit' OR reply <> ''),
fold(conv_id, rn, event_id, stack) AS (
  SELECT conv_id, 0::BIGINT, NULL::BIGINT, []::BIGINT[] FROM (SELECT DISTINCT conv_id FROM kept)
  UNION ALL SELECT f.conv_id, k.rn, k.event_id, CASE k.action WHEN 'submit' THEN list_append(f.stack, k.event_id)
    WHEN 'cancel' THEN f.stack[:greatest(len(f.stack) - 1, 0)] ELSE []::BIGINT[] END
  FROM fold f JOIN kept k ON k.conv_id = f.conv_id AND k.rn = f.rn + 1)"""


FOLDED = folded_sql()


def conversation_events(events):
    """``events`` as submits, cancels and clears keyed by user."""
    kind = F.col("event_type")
    action = F.when(kind == "error", "cancel").when(kind == "signup", "clear").otherwise("submit")
    return events.select(
        F.col("user_id").alias("conv_id"),
        "ts",
        "event_id",
        F.col("props").alias("input"),
        F.when(F.col("value") < 5, "").otherwise(kind).alias("reply"),
        action.alias("action"),
    )


@query(
    "fold_conversation_events",
    f"""WITH RECURSIVE {FOLDED}, done AS (SELECT conv_id, arg_max(stack, rn) AS stack FROM fold GROUP BY 1),
standing AS (SELECT conv_id, unnest(stack) AS event_id, unnest(range(len(stack))) AS position FROM done)
SELECT s.conv_id, s.position, s.event_id, k.input FROM standing s JOIN kept k ON k.event_id = s.event_id""",
)
def _fold_conversation_events(spark, sf):
    events = conversation_events(table(spark, sf, "events"))
    kept = events.where((F.col("action") != "submit") | (F.col("reply") != ""))
    return chat.fold_conversation_events(kept, ["conv_id"], ["ts", "event_id"], Segments()).select(
        "conv_id", "position", "event_id", "input"
    )


# Raw replies as a model would give them: some without the mark, some with labels and further marks.
RAW = f"""{RECORDS}, raw AS (SELECT id, turn, input, CASE turn % 4
  WHEN 0 THEN 'prompt### Response: ' || chr(10) || ' {NPC}: ' || output || chr(10) || '{PLAYER}: and then?'
  WHEN 2 THEN 'prompt### Response:' || output || ' ### more' ELSE output END AS reply FROM records)"""


def raw_replies(spark, sf):
    n, out = F.col("turn") % 4, F.col("output")
    reply = (
        F.when(n == 0, F.concat(F.lit(f"prompt### Response: \n {NPC}: "), out, F.lit(f"\n{PLAYER}: and then?")))
        .when(n == 2, F.concat(F.lit("prompt### Response:"), out, F.lit(" ### more")))
        .otherwise(out)
    )
    return records(spark, sf).select("id", "turn", "input", reply.alias("reply"))


STRIPPED = r"regexp_replace(string_split(reply, '### Response:')[2], '^\s+|\s+$', '', 'g')"


@query("clean_reply_plain", f"WITH {RAW} SELECT id, {STRIPPED} AS reply FROM raw")
def _clean_reply_plain(spark, sf):
    return raw_replies(spark, sf).select("id", txt.clean_reply_plain(F.col("reply")).alias("reply"))


@query(
    "clean_reply",
    f"WITH {RAW} SELECT id, string_split(string_split(replace({STRIPPED}, '{NPC}: ', ''), '###')[1], '{PLAYER}')[1] AS reply FROM raw",
)
def _clean_reply(spark, sf):
    return raw_replies(spark, sf).select("id", txt.clean_reply(F.col("reply"), NPC, PLAYER).alias("reply"))


ANSWERS = f"""{RECORDS}, answers AS (SELECT id, CASE WHEN turn % 4 = 0 THEN '[{NPC}]' || output ELSE output END || '[{PLAYER}]: [{NPC}] a: b' AS a,
  '[{NPC}]: ' || output AS b FROM records),
cleaned AS (SELECT *, replace(CASE WHEN contains(string_split(a, '[{PLAYER}]:')[1], '[{NPC}]') THEN replace(a, '[{NPC}]', '') ELSE a END, ':', '') AS clean_a FROM answers)"""


def two_answers(spark, sf):
    out = F.col("output")
    first = F.when(F.col("turn") % 4 == 0, F.concat(F.lit(f"[{NPC}]"), out)).otherwise(out)
    return records(spark, sf).select(
        "id",
        F.concat(first, F.lit(f"[{PLAYER}]: [{NPC}] a: b")).alias("a"),
        F.concat(F.lit(f"[{NPC}]: "), out).alias("b"),
    )


@query("strip_speaker_a", f"WITH {ANSWERS} SELECT id, clean_a FROM cleaned")
def _strip_speaker_a(spark, sf):
    return two_answers(spark, sf).select(
        "id", txt.strip_speaker_a(F.col("a"), f"[{NPC}]", f"[{PLAYER}]:").alias("clean_a")
    )


@query(
    "strip_speaker_b",
    f"""WITH {ANSWERS}, b AS (SELECT id, clean_a, replace(b, '[{NPC}]', '') AS b FROM cleaned)
SELECT id, CASE WHEN contains(clean_a, ':') THEN replace(b, ':', '') ELSE b END AS as_is, replace(b, ':', '') AS fixed FROM b""",
)
def _strip_speaker_b(spark, sf):
    clean_a = txt.strip_speaker_a(F.col("a"), f"[{NPC}]", f"[{PLAYER}]:")
    return two_answers(spark, sf).select(
        "id",
        txt.strip_speaker_b(F.col("b"), clean_a, f"[{NPC}]").alias("as_is"),
        txt.strip_speaker_b(F.col("b"), clean_a, f"[{NPC}]", "fixed").alias("fixed"),
    )


RATED = """rated AS (SELECT event_id, CASE event_type WHEN 'click' THEN ' ' || floor(value / 50)::BIGINT || ' ' WHEN 'view' THEN 'about ' || floor(value)::BIGINT
  WHEN 'purchase' THEN 'none' WHEN 'error' THEN '10' ELSE '-3' END AS answer FROM events)"""


def rated(spark, sf):
    kind, value = F.col("event_type"), F.col("value")
    answer = (
        F.when(kind == "click", F.concat(F.lit(" "), F.floor(value / 50).cast("string"), F.lit(" ")))
        .when(kind == "view", F.concat(F.lit("about "), F.floor(value).cast("string")))
        .when(kind == "purchase", "none")
        .when(kind == "error", "10")
        .otherwise("-3")
    )
    return table(spark, sf, "events").select("event_id", answer.alias("answer"))


@query(
    "parse_importance",
    rf"""WITH {RATED}, n AS (SELECT event_id, trim(answer) AS t, regexp_extract(answer, '^\D*([0-9]+)', 1) AS d FROM rated)
SELECT event_id, round(CASE WHEN d = '' THEN 0.0 ELSE try_cast(substr(t, 1, 1) AS DOUBLE) / 10 * 0.15 END, 6) AS as_is,
  round(CASE WHEN d = '' THEN 0.0 ELSE least(greatest(try_cast(d AS DOUBLE), 1), 10) / 10 * 0.15 END, 6) AS fixed FROM n""",
)
def _parse_importance(spark, sf):
    a = F.col("answer")
    return rated(spark, sf).select(
        "event_id",
        F.round(txt.parse_importance(a, 0.15), 6).alias("as_is"),
        F.round(txt.parse_importance(a, 0.15, "fixed"), 6).alias("fixed"),
    )


@query(
    "parse_rating",
    rf"WITH {RATED} SELECT event_id, CASE WHEN regexp_matches(trim(answer), '^[+-]?[0-9]+$') THEN try_cast(trim(answer) AS INTEGER) END AS rating FROM rated",
)
def _parse_rating(spark, sf):
    return rated(spark, sf).select("event_id", txt.parse_rating(F.col("answer")).alias("rating"))


SPOKEN = f"""{RECORDS}, spoken AS (SELECT id, 'Agent' || conv_id AS name, input, CASE turn % 6
  WHEN 0 THEN ' SAY: Agent' || conv_id || ' ' || replace(output, chr(10), ' ') || chr(10) || 'GOODBYE: x'
  WHEN 2 THEN 'GOODBYE: SAY: ' || output ELSE output END AS result FROM records),
lines AS (SELECT *, string_split(regexp_replace(result, '^\\s+|\\s+$', '', 'g'), chr(10))[1] AS line FROM spoken),
cut AS (SELECT *, CASE WHEN contains(line, 'GOODBYE:') THEN string_split(line, 'GOODBYE:')[-1] WHEN contains(line, 'SAY:') THEN string_split(line, 'SAY:')[-1] END AS w0 FROM lines),
own AS (SELECT *, trim(CASE WHEN starts_with(trim(w0), name || ' ') THEN substr(trim(w0), length(name) + 2) ELSE w0 END) AS w FROM cut)"""


@query(
    "parse_dialogue",
    f"""WITH {SPOKEN} SELECT id, contains(line, 'SAY:') AND NOT contains(line, 'GOODBYE:') AS goes_on, coalesce(w, line) AS said,
  CASE WHEN w IS NULL THEN line ELSE name || ' said ' || w END AS reply, name || ' observed ' || input || ' and said ' || coalesce(w, line) AS memory FROM own""",
)
def _parse_dialogue(spark, sf):
    n, out = F.col("turn") % 6, F.col("output")
    name = F.concat(F.lit("Agent"), F.col("conv_id").cast("string"))
    result = (
        F.when(n == 0, F.concat(F.lit(" SAY: "), name, F.lit(" "), F.replace(out, F.lit("\n"), F.lit(" ")), F.lit("\nGOODBYE: x")))
        .when(n == 2, F.concat(F.lit("GOODBYE: SAY: "), out))
        .otherwise(out)
    )
    parsed = records(spark, sf).select("id", "input", name.alias("name"), txt.parse_dialogue(result, name).alias("d"))
    return parsed.select(
        "id", "d.*", txt.observed_memory(F.col("name"), F.col("input"), F.col("d.said")).alias("memory")
    )


@query(
    "observed_memory",
    "SELECT event_id, 'Agent' || user_id || ' observed ' || event_type || ' and said ' || props AS memory FROM events",
)
def _observed_memory(spark, sf):
    name = F.concat(F.lit("Agent"), F.col("user_id").cast("string"))
    return table(spark, sf, "events").select(
        "event_id", txt.observed_memory(name, F.col("event_type"), F.col("props")).alias("memory")
    )


@query("flatten_newlines", "SELECT doc_id, md5(replace(text, chr(10), ' ')) AS text_md5 FROM documents")
def _flatten_newlines(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(txt.flatten_newlines(F.col("text"))).alias("text_md5"))


@query("mask_secret", "SELECT page_id, left(url, 3) || '************' || right(url, 3) AS masked FROM pages")
def _mask_secret(spark, sf):
    return table(spark, sf, "pages").select("page_id", txt.mask_secret(F.col("url")).alias("masked"))


@query("rating_prompt", f"WITH {RECORDS} SELECT id, {template_sql(RATING_TEMPLATE, answer='output')} AS prompt FROM records")
def _rating_prompt(spark, sf):
    return records(spark, sf).select("id", fill_template(RATING_TEMPLATE, {"answer": F.col("output")}).alias("prompt"))


@query(
    "importance_prompt",
    f"SELECT event_id, {template_sql(IMPORTANCE_TEMPLATE, memory_content='props')} AS prompt FROM events",
)
def _importance_prompt(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", fill_template(IMPORTANCE_TEMPLATE, {"memory_content": F.col("props")}).alias("prompt")
    )


AGENT_FIELDS = {
    "name": "name",
    "speaker": "speaker",
    "entity": "event_type",
    "observation": "props",
    "relevant_memories": "props",
    "most_recent_memories": "event_type",
    "summary": "props",
    "status": "event_type",
    "current_time": "time_now",
}


@query(
    "agent_prompts",
    """WITH g AS (SELECT event_id, props, event_type, 'Agent' || user_id AS name, 'User' || event_id AS speaker, strftime(ts, '%B %d, %Y, %I:%M %p') AS time_now FROM events)
SELECT event_id, """
    + ", ".join(
        (f"'### ' || {template_sql(t, **AGENT_FIELDS)} || chr(10) || '### Response:'" if framed else template_sql(t, **AGENT_FIELDS))
        + f" AS {n}_prompt"
        for n, t, framed in (
            ("entity", ENTITY_FRAME, True),
            ("action", ACTION_FRAME, True),
            ("relation", RELATION_FRAME, False),
            ("speaker", SPEAKER_FRAME, True),
            ("self", SELF_FRAME, True),
            ("dialogue", DIALOGUE_FRAME, False),
        )
    )
    + " FROM g",
)
def _agent_prompts(spark, sf):
    held = table(spark, sf, "events").select(
        "event_id",
        "props",
        "event_type",
        F.concat(F.lit("Agent"), F.col("user_id").cast("string")).alias("name"),
        F.concat(F.lit("User"), F.col("event_id").cast("string")).alias("speaker"),
        F.date_format("ts", TIME_FORMAT).alias("time_now"),
    )
    prompts = agent_prompts({k: F.col(v) for k, v in AGENT_FIELDS.items()})
    return held.select("event_id", *[p.alias(f"{n}_prompt") for n, p in prompts.items()])


@query(
    "hours_passed",
    "SELECT event_id, round((epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(ts)) / 3.6e9, 6) AS hours FROM events",
)
def _hours_passed(spark, sf):
    now = F.lit("2024-02-01 00:00:00")
    return table(spark, sf, "events").select("event_id", F.round(hours_passed(now, F.col("ts")), 6).alias("hours"))


@query(
    "logistic_relevance",
    "SELECT event_id, round(1 / (1 + exp(-(value * 1000) / 100000)) - 0.5, 6) AS as_is, round(1 / (1 + value * 1000), 6) AS inverse FROM events",
)
def _logistic_relevance(spark, sf):
    d = F.col("value") * 1000
    return table(spark, sf, "events").select(
        "event_id",
        F.round(logistic_relevance(d), 6).alias("as_is"),
        F.round(logistic_relevance(d, "inverse"), 6).alias("inverse"),
    )
