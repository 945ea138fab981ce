"""Queries over instruction records, splits, vocabularies and token ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from loreweave.catalog.base import FULL_SIZE, FULL_VOCAB, PAIRS, RECORDS, ids_sql, joined, query, table, tokens_sql, vocab_sql
from loreweave.functions.templates import (
    INSTRUCTION_TEMPLATE,
    NO_INPUT_TEMPLATE,
    TRAIN_TEMPLATE,
    fill_template,
    fill_template_optional_input,
)
from loreweave.functions.text import ADDED_TOKEN_SCORE, piece_to_bytes
from loreweave.functions.vectors import tokens
from loreweave.operators import training, vocab
from loreweave.operators.chat import turn_pairs
from loreweave.plans.sft import DEFAULT_INSTRUCTION, instruction_records, sft_dataset
from loreweave.session import scratch_path, spread, written
from loreweave.sources import readers

VOCAB_SIZE = 2000
LENGTH = 2048
RATIO, SEED, SHUFFLE_SEED = 0.3, 42, 7


def fields():
    return {c: F.col(c) for c in ("instruction", "input", "output")}


def records(spark, sf):
    return instruction_records(table(spark, sf, "conversations"))


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def template_sql(template: str, **columns: str) -> str:
    """SQL concatenation that fills a template; written apart from the Spark expression it checks."""
    out = quoted(template)
    for name, column in columns.items():
        out = out.replace("{" + name + "}", f"' || {column} || '")
    return f"({out})"


TRAIN_SQL = template_sql(TRAIN_TEMPLATE, instruction="instruction", input="input", output="output")


@query("turn_pairs", f"WITH {PAIRS} SELECT * FROM pairs")
def _turn_pairs(spark, sf):
    return turn_pairs(table(spark, sf, "conversations"))


@query("read_instructions", f"WITH {RECORDS} SELECT instruction, input, output FROM records")
def _read_instructions(spark, sf):
    path = scratch_path(spark, "records")
    records(spark, sf).select("instruction", "input", "output").write.json(path)
    return readers.good_records(readers.read_instructions(spark, path))


@query("load_template", f"WITH {RECORDS} SELECT id, {TRAIN_SQL} AS prompt FROM records")
def _load_template(spark, sf):
    path = scratch_path(spark, "template")
    spark.createDataFrame([(TRAIN_TEMPLATE,)], "value string").coalesce(1).write.option("lineSep", "\u0000").text(path)
    stored = readers.load_template(spark, path).rstrip("\u0000")
    return records(spark, sf).select("id", fill_template(stored, fields()).alias("prompt"))


@query("fill_template", f"WITH {RECORDS} SELECT id, {TRAIN_SQL} AS prompt FROM records")
def _fill_template(spark, sf):
    return records(spark, sf).select("id", fill_template(TRAIN_TEMPLATE, fields()).alias("prompt"))


@query(
    "fill_template_optional_input",
    f"""WITH {RECORDS}, given AS (SELECT id, instruction, CASE WHEN instruction = '{DEFAULT_INSTRUCTION}' THEN input ELSE '' END AS input FROM records)
SELECT id, CASE WHEN input = '' THEN {template_sql(NO_INPUT_TEMPLATE, instruction="instruction")}
  ELSE {template_sql(INSTRUCTION_TEMPLATE, instruction="instruction", input="input")} END AS prompt FROM given""",
)
def _fill_optional(spark, sf):
    given = records(spark, sf).withColumn(
        "input", F.when(F.col("instruction") == DEFAULT_INSTRUCTION, F.col("input")).otherwise("")
    )
    return given.select("id", fill_template_optional_input(fields()).alias("prompt"))


SHUFFLED = "row_number() OVER (ORDER BY md5('{seed}:' || id), id) - 1"
SPLIT = f"""{RECORDS}, ranked AS (SELECT id, {SHUFFLED.format(seed=SEED)} AS r, count(*) OVER () AS n FROM records),
split AS (SELECT id, CASE WHEN r < floor(n * {RATIO}::DOUBLE) THEN 'test' ELSE 'train' END AS split FROM ranked)"""
POSITIONED = f"""{SPLIT}, positioned AS (SELECT id, split,
  row_number() OVER (PARTITION BY split ORDER BY md5('{SHUFFLE_SEED}:' || id), id) - 1 AS position FROM split)"""


@query("exact_split", f"WITH {SPLIT} SELECT id, split FROM split")
def _exact_split(spark, sf):
    return training.exact_split(records(spark, sf).select("id"), "id", RATIO, SEED)


@query("seeded_shuffle", f"WITH {RECORDS} SELECT id, {SHUFFLED.format(seed=SHUFFLE_SEED)} AS position FROM records")
def _seeded_shuffle(spark, sf):
    return training.seeded_shuffle(records(spark, sf).select("id"), "id", SHUFFLE_SEED)


@query(
    "global_index",
    "SELECT doc_id, row_number() OVER (ORDER BY md5('1:' || doc_id), doc_id) - 1 AS global_index FROM documents",
)
def _global_index(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", training.order_hash(F.col("doc_id"), 1).alias("h"))
    return training.global_index(docs, "h", "doc_id").select("doc_id", "global_index")


@query(
    "assign_batches",
    f"WITH {POSITIONED} SELECT id, split, position, position // 8 AS micro_batch, position // 64 AS step FROM positioned",
)
def _assign_batches(spark, sf):
    split = training.exact_split(records(spark, sf).select("id"), "id", RATIO, SEED)
    hashed = split.withColumn("h", training.order_hash(F.col("id"), SHUFFLE_SEED))
    placed = training.global_index(hashed, "h", "id", "position", by=["split"]).drop("h")
    return training.assign_batches(placed, "position", 8, 64)


@query(
    "training_plan",
    f"""WITH {RECORDS}, c AS (SELECT count(*) AS n, floor(count(*) * {RATIO}::DOUBLE)::BIGINT AS test FROM records)
SELECT n, test, n - test AS train, greatest(((n - test) // 64) * 10, 10) AS steps, 64 // 8 // 2 AS accumulation FROM c""",
)
def _training_plan(spark, sf):
    return training.training_plan(records(spark, sf), RATIO, 64, 8, 10, 2)


@query("build_vocab", f"WITH {FULL_VOCAB} SELECT * FROM v UNION ALL SELECT (i + 3)::INTEGER, printf('<0x%02X>', i), 0 FROM unnest(range(256)) t(i)")
def _build_vocab(spark, sf):
    return training.build_vocab(documents(spark, sf), F.col("text"), FULL_SIZE, byte_pieces=True)


def documents(spark, sf):
    return spread(table(spark, sf, "documents"), "doc_id")


def doc_vocab(spark, sf):
    """Vocabulary of the documents as a stored table: it is small and used several times."""
    return written(training.build_vocab(documents(spark, sf), F.col("text"), VOCAB_SIZE), "vocab")


def full_vocab(spark, sf):
    """A vocabulary of production size that spells what it lacks, so no token is lost."""
    return written(training.build_vocab(documents(spark, sf), F.col("text"), FULL_SIZE, byte_pieces=True), "vocab")


def chat_vocab(spark, sf):
    return written(training.build_vocab(table(spark, sf, "conversations"), F.col("text"), VOCAB_SIZE), "vocab")


@query(
    "encode_ids",
    f"""WITH {RECORDS}, {FULL_VOCAB}, k AS ({ids_sql("records", "input || chr(10) || output")})
SELECT r.id, array_to_string([1] || coalesce(ids, []) || [2], ',') AS ids, coalesce(len(ids), 0) AS n FROM records r LEFT JOIN k ON k.id = r.id""",
)
def _encode_ids(spark, sf):
    text = F.concat("input", F.lit("\n"), "output")
    coded = training.encode_ids(records(spark, sf).select("id", "input", "output"), {"ids": text}, full_vocab(spark, sf))
    return coded.select("id", joined("ids").alias("ids"), (F.size("ids") - 2).cast("long").alias("n"))


# prompt p and full f ids as lists, then the masked labels
MASK = f"""{RECORDS}, {FULL_VOCAB}, prompts AS (SELECT id, {TRAIN_SQL} AS prompt, {TRAIN_SQL} || output AS full FROM records),
pk AS ({ids_sql("prompts", "prompt")}), fk AS ({ids_sql("prompts", '"full"')}),
coded AS (SELECT p.id, coalesce(len(pk.ids), 0) + 2 AS n_prompt, coalesce(fk.ids, []) AS ids FROM prompts p LEFT JOIN pk ON pk.id = p.id LEFT JOIN fk ON fk.id = p.id),
cut AS (SELECT id, least(n_prompt, {LENGTH + 1}) - 1 AS p,
  list_resize(([1] || ids || [2])[1:{LENGTH}], {LENGTH}, 0) AS input_ids, least(len(ids) + 2, {LENGTH}) AS n_real FROM coded),
masked AS (SELECT id, input_ids, n_real, list_concat(list_transform(range(p), lambda x: -100), input_ids[p + 1:]) AS labels FROM cut)"""


@query(
    "mask_labels",
    f"""WITH {MASK} SELECT id, array_to_string(input_ids, ',') AS input_ids, array_to_string(labels, ',') AS labels,
  {LENGTH} AS n_attended, n_real FROM masked""",
)
def _mask_labels(spark, sf):
    held = records(spark, sf).withColumn("prompt", fill_template(TRAIN_TEMPLATE, fields()))
    coded = training.encode_ids(held, {"full_ids": F.concat("prompt", "output")}, full_vocab(spark, sf), counted={"n_prompt": F.col("prompt")})
    masked = coded.select("id", training.mask_labels(F.col("n_prompt"), F.col("full_ids"), LENGTH).alias("m"))
    total = lambda c: F.aggregate(c, F.lit(0), lambda a, x: a + x)
    return masked.select(
        "id",
        joined(F.col("m.input_ids")).alias("input_ids"),
        joined(F.col("m.labels")).alias("labels"),
        total(F.col("m.attention_mask")).alias("n_attended"),
        total(F.col("m.real_mask")).alias("n_real"),
    )


@query(
    "answer_twice_check",
    f"""WITH {RECORDS} SELECT instruction, count(*) AS rows, count(*) FILTER (WHERE length(output) > 0 AND contains({TRAIN_SQL}, output)) AS leaking
FROM records GROUP BY 1""",
)
def _answer_twice(spark, sf):
    return training.answer_twice_check(
        records(spark, sf), fill_template(TRAIN_TEMPLATE, fields()), F.col("output"), ["instruction"]
    )


@query(
    "sft_dataset",
    f"""WITH {MASK}, ranked AS (SELECT id, {SHUFFLED.format(seed=SEED)} AS r, count(*) OVER () AS n FROM records),
split AS (SELECT id, CASE WHEN r < floor(n * {RATIO}::DOUBLE) THEN 'test' ELSE 'train' END AS split FROM ranked),
positioned AS (SELECT id, split, row_number() OVER (PARTITION BY split ORDER BY md5('{SHUFFLE_SEED}:' || id), id) - 1 AS position FROM split)
SELECT id, split, position, position // 8 AS micro_batch, position // 64 AS step,
  md5(array_to_string(input_ids, ',')) AS input_md5, md5(array_to_string(labels, ',')) AS labels_md5, n_real
FROM positioned JOIN masked USING (id)""",
)
def _sft_dataset(spark, sf):
    data = sft_dataset(
        written(records(spark, sf), "records"), full_vocab(spark, sf), length=LENGTH, ratio=RATIO, seed=SEED, shuffle_seed=SHUFFLE_SEED
    )
    return data.select(
        "id",
        "split",
        "position",
        "micro_batch",
        "step",
        F.md5(joined("input_ids")).alias("input_md5"),
        F.md5(joined("labels")).alias("labels_md5"),
        F.aggregate("real_mask", F.lit(0), lambda a, x: a + x).alias("n_real"),
    )


VOCABS = f"{vocab_sql('a', 'documents', VOCAB_SIZE)}, {vocab_sql('b', 'conversations', VOCAB_SIZE)}"
MERGED = f"""{VOCABS}, fresh AS (SELECT b.piece, row_number() OVER (ORDER BY b.id) AS r FROM b WHERE b.piece NOT IN (SELECT piece FROM a)),
merged AS (SELECT id, piece, 0.0::FLOAT AS score FROM a UNION ALL SELECT ((SELECT count(*) FROM a) + r - 1)::INTEGER, piece, 0.0::FLOAT FROM fresh)"""


@query("vocab_new_pieces", f"WITH {VOCABS} SELECT id, piece, n FROM b WHERE piece NOT IN (SELECT piece FROM a)")
def _vocab_new_pieces(spark, sf):
    return vocab.vocab_new_pieces(doc_vocab(spark, sf), chat_vocab(spark, sf))


@query("vocab_merge", f"WITH {MERGED} SELECT * FROM merged")
def _vocab_merge(spark, sf):
    return vocab.vocab_merge(doc_vocab(spark, sf), chat_vocab(spark, sf))


@query(
    "vocab_stats",
    f"""WITH {MERGED}, s AS (SELECT 'before' AS stage, piece FROM a UNION ALL SELECT 'after', piece FROM merged)
SELECT stage, count(*) AS pieces, count(DISTINCT piece) AS distinct_pieces,
  count(*) FILTER (WHERE piece IN ('<unk>', '<s>', '</s>')) AS special_pieces FROM s GROUP BY 1""",
)
def _vocab_stats(spark, sf):
    a = doc_vocab(spark, sf)
    return vocab.vocab_stats(a, vocab.vocab_merge(a, chat_vocab(spark, sf)))


def greedy_sql(vocab_name: str, out: str) -> str:
    """Longest piece at every position of every word, then the chain of pieces from position 1."""
    return f"""{out}_best AS (
  SELECT w.word, p.pos, coalesce(max(length(v.piece)), 1) AS n
  FROM (SELECT DISTINCT word FROM words) w, unnest(range(1, length(w.word) + 1)) p(pos),
       unnest(range(1, least(length(w.word) - p.pos + 1, (SELECT max(length(piece)) FROM {vocab_name})) + 1)) l(len)
  LEFT JOIN {vocab_name} v ON v.piece = substr(w.word, p.pos, l.len) GROUP BY 1, 2),
{out}_chain(word, pos, k, pieces) AS (
  SELECT DISTINCT word, 1::BIGINT, 0, '' FROM words
  UNION ALL SELECT c.word, c.pos + b.n, c.k + 1, c.pieces || CASE WHEN c.k > 0 THEN '|' ELSE '' END || substr(c.word, c.pos, b.n)
  FROM {out}_chain c JOIN {out}_best b ON b.word = c.word AND b.pos = c.pos),
{out} AS (SELECT word, k, pieces FROM {out}_chain WHERE pos > length(word))"""


def greedy_count_sql(vocab_name: str, out: str) -> str:
    """How many pieces each word gives: walk the best lengths by position, skipping what is covered."""
    return f"""{out} AS (SELECT word, list_reduce(list(pos * 10000 + n ORDER BY pos), lambda acc, e:
    CASE WHEN e // 10000 >= acc // 1000000 THEN (e // 10000 + e % 10000) * 1000000 + acc % 1000000 + 1 ELSE acc END, 1000000::BIGINT) % 1000000 AS k
  FROM (SELECT w.word, p.pos, coalesce(max(length(v.piece)), 1) AS n
    FROM (SELECT DISTINCT word FROM words) w, unnest(range(1, length(w.word) + 1)) p(pos),
         unnest(range(1, least(length(w.word) - p.pos + 1, (SELECT max(length(piece)) FROM {vocab_name})) + 1)) l(len)
    LEFT JOIN {vocab_name} v ON v.piece = substr(w.word, p.pos, l.len) GROUP BY 1, 2) GROUP BY 1)"""


CHAT_WORDS = f"words AS (SELECT unnest({tokens_sql('text')}) AS word FROM conversations)"


@query(
    "encode_greedy",
    f"WITH RECURSIVE {vocab_sql('a', 'documents', VOCAB_SIZE)}, {CHAT_WORDS}, {greedy_sql('a', 'g')} SELECT word, pieces FROM g",
)
def _encode_greedy(spark, sf):
    words = table(spark, sf, "conversations").select(F.explode(tokens(F.col("text"))).alias("word")).distinct()
    cut = vocab.encode_greedy(words, "word", doc_vocab(spark, sf))
    return cut.select("word", F.array_join("pieces", "|").alias("pieces"))


@query(
    "vocab_fertility",
    f"""WITH {VOCABS}, words AS (SELECT lang, unnest({tokens_sql('text')}) AS word FROM documents),
counted AS (SELECT lang, word, count(*) AS n FROM words GROUP BY 1, 2), {greedy_count_sql('a', 'ga')}, {greedy_count_sql('b', 'gb')},
cut AS (SELECT 'documents' AS vocab, word, k FROM ga UNION ALL SELECT 'conversations', word, k FROM gb)
SELECT lang, vocab, sum(k * n)::BIGINT AS pieces, sum(length(word) * n)::BIGINT AS chars,
  round(sum(k * n)::DOUBLE / sum(length(word) * n), 6) AS fertility
FROM counted JOIN cut USING (word) GROUP BY 1, 2""",
)
def _vocab_fertility(spark, sf):
    vocabs = {"documents": doc_vocab(spark, sf), "conversations": chat_vocab(spark, sf)}
    return vocab.vocab_fertility(documents(spark, sf), F.col("text"), "lang", vocabs)


@query(
    "piece_to_bytes",
    f"""WITH {vocab_sql('a', 'documents', VOCAB_SIZE)}, p AS (
  SELECT id, '▁' || piece AS piece, 'normal' AS kind, 0.0 AS score FROM a
  UNION ALL SELECT id, '<0x' || upper(substr(md5(piece), 1, 2)) || '>', 'byte', 0.0 FROM a
  UNION ALL SELECT id, '<' || piece || '>', 'control', 0.0 FROM a
  UNION ALL SELECT id, piece, 'added', {ADDED_TOKEN_SCORE} FROM a)
SELECT id, kind, piece, score::DOUBLE AS score, CASE kind WHEN 'byte' THEN substr(piece, 4, 2) WHEN 'control' THEN ''
  ELSE hex(encode(replace(piece, '▁', ' '))) END AS bytes FROM p""",
)
def _piece_to_bytes(spark, sf):
    a = doc_vocab(spark, sf)
    score = F.when(F.col("kind") == "added", ADDED_TOKEN_SCORE).otherwise(0.0)
    code = F.upper(F.substring(F.md5("piece"), 1, 2))
    kinds = F.array(
        F.struct(F.lit("normal").alias("kind"), F.concat(F.lit("▁"), "piece").alias("piece")),
        F.struct(F.lit("byte").alias("kind"), F.concat(F.lit("<0x"), code, F.lit(">")).alias("piece")),
        F.struct(F.lit("control").alias("kind"), F.concat(F.lit("<"), "piece", F.lit(">")).alias("piece")),
        F.struct(F.lit("added").alias("kind"), F.col("piece")),
    )
    pieces = a.select("id", F.inline(kinds))
    return pieces.select(
        "id", "kind", "piece", score.alias("score"), F.hex(piece_to_bytes(F.col("piece"), F.col("kind"))).alias("bytes")
    )
