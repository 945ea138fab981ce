"""Registry of the queries that run over the given tables, and SQL pieces their checks share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loreweave.functions.vectors import TOKEN_PATTERN
from loreweave.plans.sft import DEFAULT_INSTRUCTION

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = sql
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def joined(array) -> F.Column:
    return F.array_join(F.transform(array, lambda x: x.cast("string")), ",")


def tokens_sql(text: str) -> str:
    return f"regexp_extract_all({text}, '{TOKEN_PATTERN}')"


PAIRS = """pairs AS (
  SELECT conv_id, turn, text AS input, next_text AS output FROM (
    SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text
    FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
  WHERE role = 'user' AND next_role = 'assistant')"""

RECORDS = f"""{PAIRS}, records AS (
  SELECT conv_id || '/' || turn AS id, p.conv_id, p.turn, coalesce(s.text, '{DEFAULT_INSTRUCTION}') AS instruction, input, output
  FROM pairs p LEFT JOIN (SELECT conv_id AS c, arg_min(text, turn) AS text FROM conversations WHERE role = 'system' GROUP BY 1) s
  ON p.conv_id = s.c)"""

def vocab_sql(name: str, source: str, size: int) -> str:
    return f"""{name} AS (
  SELECT CAST(row_number() OVER (ORDER BY n DESC, piece) + 2 AS INTEGER) AS id, piece, n FROM (
    SELECT piece, count(*) AS n FROM (SELECT unnest({tokens_sql("text")}) AS piece FROM {source})
    GROUP BY 1 ORDER BY n DESC, piece LIMIT {size}))"""


FULL_SIZE = 32_000
# ids 3 to 258 spell bytes, the others are the most frequent tokens
FULL_VOCAB = f"""v AS (
  SELECT CAST(row_number() OVER (ORDER BY n DESC, piece) + 258 AS INTEGER) AS id, piece, n FROM (
    SELECT piece, count(*) AS n FROM (SELECT unnest({tokens_sql("text")}) AS piece FROM documents)
    GROUP BY 1 ORDER BY n DESC, piece LIMIT {FULL_SIZE - 256}))"""


def ids_sql(source: str, text: str) -> str:
    """``(id, ids)``: ids of all tokens of a text without marks, tokens that ``v`` lacks spelled in bytes; no row for a text without tokens."""
    spelled = "list_transform(range(octet_length(encode(t.piece))), lambda i: ('0x' || substr(hex(encode(t.piece)), 2 * i + 1, 2))::INTEGER + 3)"
    return f"""SELECT t.id, flatten(list(CASE WHEN v.id IS NULL THEN {spelled} ELSE [v.id] END ORDER BY pos)) AS ids FROM (
    SELECT id, unnest(toks) AS piece, unnest(range(len(toks))) AS pos FROM (SELECT id, {tokens_sql(text)} AS toks FROM {source})) t
  LEFT JOIN v ON t.piece = v.piece GROUP BY t.id"""


CHUNK_SIZE, CHUNK_OVERLAP = 600, 100

CHUNKS = f"""chunks AS (
  SELECT lpad(doc_id::VARCHAR, 20, '0') || '-' || lpad(chunk_no::VARCHAR, 10, '0') AS id, doc_id, chunk_no, lang, source,
         substr(text, chunk_no * {CHUNK_SIZE - CHUNK_OVERLAP} + 1, {CHUNK_SIZE}) AS text
  FROM (SELECT *, unnest(range(0, CAST(ceil(greatest(length(text) - {CHUNK_SIZE}, 0) / {CHUNK_SIZE - CHUNK_OVERLAP}.0) AS BIGINT) + 1)) AS chunk_no
        FROM documents))"""


def embedding_sql(name: str, source: str, key: str, text: str) -> str:
    """Sparse vector components ``(key, dim, val)`` and squared norms of a text column."""
    tok = tokens_sql(f"replace({text}, chr(10), ' ')")
    return f"""{name}_raw AS (
  SELECT key, ('0x' || substr(h, 1, 15))::BIGINT % 64 AS dim, sum(1 - 2 * (('0x' || substr(h, 16, 1))::BIGINT % 2)) AS s
  FROM (SELECT {key} AS key, md5(unnest({tok})) AS h FROM {source}) GROUP BY 1, 2),
{name} AS (
  SELECT r.key, dim, (s::DOUBLE / norm)::FLOAT::DOUBLE AS val
  FROM {name}_raw r JOIN (SELECT key, sqrt(sum(s * s)::DOUBLE) AS norm FROM {name}_raw GROUP BY 1) n ON r.key = n.key WHERE s <> 0),
{name}_norm AS (SELECT t.{key} AS key, coalesce(n.n2, 0.0) AS n2 FROM {source} t
  LEFT JOIN (SELECT key, sum(val * val) AS n2 FROM {name} GROUP BY 1) n ON t.{key} = n.key)"""


# questions q_ against chunks c_: distance and rank
KNN = f"""{CHUNKS}, {embedding_sql("cvec", "chunks", "id", "text")}, {embedding_sql("qvec", "benchmark", "item_id", "text")},
dots AS (SELECT q.key AS qid, c.key AS id, sum(q.val * c.val) AS dot FROM qvec q JOIN cvec c ON q.dim = c.dim GROUP BY 1, 2),
dist AS (
  SELECT q.key AS qid, c.key AS id,
         round(sqrt(greatest(q.n2 + c.n2 - 2 * coalesce(d.dot, 0), 0)), 6) + 0.0 AS distance,
         round(CASE WHEN q.n2 = 0 OR c.n2 = 0 THEN 1.0 ELSE 1 - coalesce(d.dot, 0) / (sqrt(q.n2) * sqrt(c.n2)) END, 6) + 0.0 AS cosine
  FROM qvec_norm q CROSS JOIN cvec_norm c LEFT JOIN dots d ON d.qid = q.key AND d.id = c.key),
hits AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY distance, id) AS rank FROM dist) WHERE rank <= 20)"""
