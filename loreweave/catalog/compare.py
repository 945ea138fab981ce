"""Queries over competing answers, ratings, flags and generated records."""

from __future__ import annotations

from pyspark.sql import functions as F

from loreweave.catalog.base import PAIRS, query, table
from loreweave.catalog.chat import pairs
from loreweave.catalog.training import template_sql
from loreweave.functions.hooks import echo_client, generate_text
from loreweave.functions.templates import RATING_TEMPLATE
from loreweave.operators import compare
from loreweave.plans.bakeoff import model_bakeoff
from loreweave.session import scratch_path
from loreweave.sources import flags
from loreweave.sources.readers import parse_generated_records, read_model_registry

# The registry lists every document source as a model; every fourth has no name of its own.
MODELS = """models AS (SELECT DISTINCT source AS model_id FROM documents),
registry AS (SELECT CASE WHEN model_id LIKE '%4' THEN 'model_rating' ELSE 'model ' || model_id END AS name, model_id,
  CASE WHEN model_id LIKE '%1' THEN model_id || '-lora' END AS lora_id FROM models)"""


def registry(spark, sf):
    source = F.col("source")
    entry = F.struct(
        F.when(~source.endswith("4"), F.concat(F.lit("model "), source)).alias("name"),
        source.alias("model_id"),
        F.when(source.endswith("1"), F.concat(source, F.lit("-lora"))).alias("lora_id"),
    )
    path = scratch_path(spark, "registry")
    models = table(spark, sf, "documents").select("source").distinct()
    # a registry is a small configuration file: one JSON array
    models.agg(F.to_json(F.collect_list(entry)).alias("value")).write.text(path)
    return read_model_registry(spark, path)


def asked(spark, sf):
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("qid"), F.col("text").alias("question"))


@query("read_model_registry", f"WITH {MODELS} SELECT * FROM registry")
def _read_model_registry(spark, sf):
    return registry(spark, sf)


NAMES = f"{MODELS}, names AS (SELECT DISTINCT name AS model FROM registry)"


@query(
    "answer_matrix",
    f"WITH {NAMES} SELECT item_id AS qid, model, md5(model || ': ' || text) AS answer_md5 FROM benchmark CROSS JOIN names",
)
def _answer_matrix(spark, sf):
    matrix = compare.answer_matrix(asked(spark, sf), registry(spark, sf))
    prompts = matrix.withColumn("prompt", F.concat("model", F.lit(": "), "question"))
    answers = generate_text(prompts, "prompt", "answer", echo_client)
    return answers.select("qid", "model", F.md5("answer").alias("answer_md5"))


RATED = """rated AS (SELECT source AS model, CASE WHEN l.doc_id % 5 = 4 THEN 'about ' ELSE ' ' END || (quality * 5 + toxic * 2 + 1) || chr(10) AS rating_text
  FROM labels l JOIN documents d ON d.doc_id = l.doc_id)"""


@query(
    "ratings_by_model",
    f"""WITH {RATED}, r AS (SELECT model, try_cast(regexp_replace(rating_text, '^\\s+|\\s+$', '', 'g') AS INTEGER) AS rating FROM rated)
SELECT model, count(rating) AS ratings, count(*) - count(rating) AS unparsed, round(avg(rating), 6) AS avg_rating FROM r GROUP BY 1""",
)
def _ratings_by_model(spark, sf):
    rated = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "source"), "doc_id")
    start = F.when(F.col("doc_id") % 5 == 4, "about ").otherwise(" ")
    number = (F.col("quality") * 5 + F.col("toxic") * 2 + 1).cast("string")
    text = F.concat(start, number, F.lit("\n"))
    return compare.ratings_by_model(rated.withColumn("model", F.col("source")), text)


LANGS = ["de", "en", "es", "fr"]


@query(
    "answers_wide",
    "SELECT source, " + ", ".join(f"count(*) FILTER (WHERE lang = '{x}') > 0 AS has_{x}, min(CASE WHEN lang = '{x}' THEN doc_id END) AS first_{x}" for x in LANGS) + " FROM documents GROUP BY 1",
)
def _answers_wide(spark, sf):
    # "models" are the languages, the answer of a source is its first document in each
    first = table(spark, sf, "documents").groupBy("source", F.col("lang").alias("model")).agg(F.min("doc_id").alias("doc"))
    names = compare.model_names(first.where(F.col("model").isNotNull()).select(F.col("model").alias("name")))
    wide = compare.answers_wide(first, names, "source", "doc")
    columns = [c for x in names for c in (F.col(x).isNotNull().alias(f"has_{x}"), F.col(x).alias(f"first_{x}"))]
    return wide.select("source", *columns)


# Flags: every question of a conversation is a flag attempt; some inputs are empty, some conversations have no answer.
FLAGGED = f"""{PAIRS}, last AS (SELECT conv_id, arg_max(output, turn) AS answer_a, arg_max('B: ' || output, turn) AS answer_b FROM pairs GROUP BY 1),
tries AS (SELECT conv_id, CASE WHEN length(text) % 5 = 0 THEN '' ELSE text END AS input, role AS flag, 'user' || conv_id AS username,
  TIMESTAMP '2024-01-01 00:00:00' + to_seconds(turn * 60) AS ts, turn FROM conversations),
flagged AS (SELECT t.*, answer_a, answer_b FROM tries t JOIN last l ON l.conv_id = t.conv_id WHERE input <> '')"""


def exchanges(spark, sf):
    answer_b = F.concat(F.lit("B: "), "output")
    return pairs(spark, sf).select("conv_id", "turn", F.col("output").alias("answer_a"), answer_b.alias("answer_b"))


def flagged(spark, sf):
    return compare.flag_filter(exchanges(spark, sf), flag_tries(table(spark, sf, "conversations")))


def flag_tries(conversations):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return conversations.select(
        "conv_id",
        F.when(F.length("text") % 5 == 0, "").otherwise(F.col("text")).alias("input"),
        F.col("role").alias("flag"),
        F.concat(F.lit("user"), F.col("conv_id").cast("string")).alias("username"),
        (start + F.make_dt_interval(F.lit(0), F.lit(0), F.col("turn").cast("int"))).alias("ts"),
        "turn",
    )


@query("flag_filter", f"WITH {FLAGGED} SELECT conv_id, turn, input, answer_a, answer_b FROM flagged")
def _flag_filter(spark, sf):
    return flagged(spark, sf).select("conv_id", "turn", "input", "answer_a", "answer_b")


LOG_SQL = f"""WITH {FLAGGED} SELECT input AS "Input", answer_a AS ggml, answer_b AS chatgpt, flag, username, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time FROM flagged"""


def read_log(spark, path):
    return flags.flag_log_read(spark, path).select(
        "Input", "ggml", "chatgpt", "flag", "username", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("time")
    )


@query("flag_log_append", LOG_SQL + " UNION ALL " + "SELECT input, answer_b, answer_a, flag, username, strftime(ts, '%Y-%m-%d %H:%M:%S') FROM flagged")
def _flag_log_append(spark, sf):
    path = scratch_path(spark, "log")
    rows = flagged(spark, sf)
    flags.flag_log_append(flags.log_rows(rows), path)
    swapped = rows.select(
        F.col("answer_b").alias("answer_a"), F.col("answer_a").alias("answer_b"), "input", "flag", "username", "ts"
    )
    flags.flag_log_append(flags.log_rows(swapped), path)
    return read_log(spark, path)


@query("flag_log_read", LOG_SQL)
def _flag_log_read(spark, sf):
    path = scratch_path(spark, "log")
    flags.flag_log_append(flags.log_rows(flagged(spark, sf)), path)
    return read_log(spark, path)


INSTRUCTION = "Suppose you are a character of the game; talk to the player"
GENERATED = f"""{PAIRS}, numbered AS (SELECT conv_id, turn // 20 AS block, (row_number() OVER (PARTITION BY conv_id, turn // 20 ORDER BY turn) - 1) AS record_no, input, output FROM pairs),
sized AS (SELECT conv_id, turn // 20 AS block, count(*) AS n FROM pairs GROUP BY 1, 2),
rows AS (SELECT conv_id, block, record_no, CASE WHEN conv_id % 3 = 1 AND record_no = 1 THEN 'Other' ELSE '{INSTRUCTION}' END AS instruction, input, output, n FROM numbered JOIN sized USING (conv_id, block))"""


@query(
    "parse_generated_records",
    f"""WITH {GENERATED} SELECT conv_id, block, record_no, instruction, input, output, CASE WHEN instruction = 'Other' THEN 'other instruction' END AS reason FROM rows WHERE n = 2 AND conv_id % 7 <> 0
UNION ALL SELECT conv_id, block, NULL, NULL, NULL, NULL, CASE WHEN conv_id % 7 = 0 THEN 'not a JSON array' ELSE 'wrong size' END FROM sized WHERE n <> 2 OR conv_id % 7 = 0""",
)
def _parse_generated_records(spark, sf):
    # a model's output per twenty turns of a conversation: its exchanges as a JSON array, some broken off
    from pyspark.sql import Window as W

    row = F.row_number().over(W.partitionBy("conv_id", "block").orderBy("turn")) - 1
    instruction = F.when((F.col("conv_id") % 3 == 1) & (F.col("record_no") == 1), "Other").otherwise(INSTRUCTION)
    record = F.struct("record_no", F.struct(instruction.alias("instruction"), "input", "output").alias("r"))
    blocks = pairs(spark, sf).withColumn("block", F.expr("turn div 20")).withColumn("record_no", row)
    held = blocks.groupBy("conv_id", "block").agg(F.array_sort(F.collect_list(record)).alias("rs"))
    whole = F.to_json(F.transform("rs", lambda x: x["r"]))
    text = F.when(F.col("conv_id") % 7 == 0, F.substring(whole, 1, 10)).otherwise(whole)
    texts = held.select("conv_id", "block", text.alias("generated"))
    return parse_generated_records(texts, F.col("generated"), INSTRUCTION, 2).drop("generated")


def length_client():
    """Stands in for a rater: the length of the prompt as a number, or no number."""
    return lambda prompts: [str(len(p) % 10 + 1) if len(p) % 3 else "good" for p in prompts]


PROMPTED = f"{NAMES}, asked AS (SELECT item_id AS qid, model, model || chr(10) || text AS answer FROM benchmark CROSS JOIN names)"


@query(
    "model_bakeoff",
    f"""WITH {PROMPTED}, p AS (SELECT model, length({template_sql(RATING_TEMPLATE, answer='answer')}) AS n, qid FROM asked)
SELECT model, count(*) FILTER (WHERE n % 3 > 0) AS ratings, count(*) FILTER (WHERE n % 3 = 0) AS unparsed,
  round(avg(CASE WHEN n % 3 > 0 THEN n % 10 + 1 END), 6) AS avg_rating FROM p GROUP BY 1""",
)
def _model_bakeoff(spark, sf):
    return model_bakeoff(asked(spark, sf), registry(spark, sf), echo_client, length_client)[1]


@query(
    "generate_text",
    "SELECT doc_id, CASE WHEN lang = 'de' THEN NULL ELSE md5(text) END AS answer_md5, lang = 'de' AS failed FROM documents",
)
def _generate_text(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.concat("lang", F.lit(":"), "text").alias("prompt"))
    done = generate_text(docs, "prompt", "answer", no_german)
    return done.select("doc_id", F.md5("answer").alias("answer_md5"), F.col("error").isNotNull().alias("failed"))


def no_german():
    """Stands in for a model that fails on some prompts: answers with the text behind the language."""

    def ask(prompts):
        if any(p.startswith("de:") for p in prompts):
            raise RuntimeError("unknown language")
        return [p.split(":", 1)[1] for p in prompts]

    return ask
