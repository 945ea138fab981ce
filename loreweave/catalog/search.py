"""Queries over chunks, vectors and retrieval prompts.

Questions are the ``benchmark`` texts, the collection is every document in chunks of 600 characters.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from loreweave.operators.chat import ends_of_histories

from loreweave.catalog.base import CHUNK_OVERLAP, CHUNK_SIZE, CHUNKS, KNN, embedding_sql, joined, query, table, tokens_sql
from loreweave.catalog.training import documents, template_sql
from loreweave.functions.hooks import echo_client, generate_text
from loreweave.functions.scores import logistic_relevance
from loreweave.functions.templates import FIRST_ANSWER_TEMPLATE, REFINE_TEMPLATE, STUFF_TEMPLATE
from loreweave.functions.text import wrap_text
from loreweave.functions.vectors import DIMS, embed_text, vec_dequant_q4, vec_quant_q4, vec_regroup
from loreweave.operators import bm25, cells, chunking, search
from loreweave.plans import rag
from loreweave.session import scratch_path, written

K = 4


def chunks(spark, sf):
    return rag.embedded_chunks(documents(spark, sf), CHUNK_SIZE, CHUNK_OVERLAP)


def chunk_texts(spark, sf):
    return rag.document_chunks(table(spark, sf, "documents"), CHUNK_SIZE, CHUNK_OVERLAP)


def asked(spark, sf):
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("qid"), F.col("text").alias("question"))


def questions(spark, sf):
    return rag.embedded_questions(asked(spark, sf))


def vectors(spark, sf):
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), "label")


def vector_queries(spark, sf):
    """The query set of every search: rows whose id is divisible by 100, asked against all rows."""
    asked = table(spark, sf, "embeddings").where(F.col("vec_id") % 100 == 0)
    return asked.select(F.col("vec_id").alias("qid"), F.col("embedding").alias("vec"))


def rounded(array):
    return joined(F.transform(array, lambda x: F.round(x.cast("double") * 1e6).cast("long")))


@query(
    "embed_text",
    f"""WITH {embedding_sql("e", "documents", "doc_id", "text")}, full_vec AS (
  SELECT d.doc_id, i.dim, coalesce(e.val, 0) AS val FROM documents d CROSS JOIN (SELECT unnest(range({DIMS})) AS dim) i
  LEFT JOIN e ON e.key = d.doc_id AND e.dim = i.dim)
SELECT doc_id, string_agg(round(val * 1e6)::BIGINT, ',' ORDER BY dim) AS vec FROM full_vec GROUP BY 1""",
)
def _embed_text(spark, sf):
    return documents(spark, sf).select("doc_id", rounded(embed_text(F.col("text"))).alias("vec"))


@query("chunk_fixed", f"WITH {CHUNKS} SELECT doc_id, chunk_no, text FROM chunks")
def _chunk_fixed(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return chunking.chunk_fixed(docs, "text", CHUNK_SIZE, CHUNK_OVERLAP)


# The check walks from chunk to chunk.  `parts` are the pieces of a run in order, all joined by one character.  A chunk
# from part `lo` ends before part `hi`, the first that does not fit; the next one starts `keep` parts before `hi`, those that
# are within the overlap and fit together with part `hi`.
def walk_sql(size: int, overlap: int) -> str:
    return f"""sums AS (SELECT *, length(p) AS n, sum(length(p) + 1) OVER w AS upto, lead(length(p)) OVER w AS next_n FROM parts WINDOW w AS (PARTITION BY run ORDER BY k)),
kept AS (SELECT *, upto - n - 1 AS start, least({overlap}, {size} - 1 - coalesce(next_n, 0)) AS room FROM sums),
step AS (SELECT run, k, k + count(*) OVER (PARTITION BY run ORDER BY upto RANGE BETWEEN CURRENT ROW AND greatest({size} - n, 0) FOLLOWING) AS hi,
  CASE WHEN room >= n THEN count(*) OVER (PARTITION BY run ORDER BY start RANGE BETWEEN greatest(room - n, 0) PRECEDING AND CURRENT ROW) ELSE 0 END AS keep FROM kept),
walk(run, no, lo, hi) AS (SELECT run, 0, 0::BIGINT, hi FROM step WHERE k = 0
  UNION ALL SELECT w.run, w.no + 1, w.hi - l.keep, s.hi FROM walk w JOIN step l ON l.run = w.run AND l.k = w.hi - 1
  JOIN step s ON s.run = w.run AND s.k = w.hi - l.keep WHERE EXISTS (SELECT 1 FROM step e WHERE e.run = w.run AND e.k = w.hi)),
cut AS (SELECT w.run, w.no, any_value(s.doc_id) AS doc_id, trim(substr(string_agg(s.sep || s.p, '' ORDER BY s.k), 2)) AS text FROM walk w
  JOIN parts s ON s.run = w.run AND s.k >= w.lo AND s.k < w.hi GROUP BY 1, 2)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY run, no) - 1 AS chunk_no, md5(text) AS text_md5, length(text) AS n_chars,
  length(text) > {size} AS too_long FROM cut WHERE text <> ''"""


LINES = """lines AS (SELECT doc_id, i, line, contains(text, chr(10)) AS has_lines FROM (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents) WHERE line <> '')"""


@query(
    "chunk_separator",
    f"""WITH RECURSIVE {LINES}, parts AS (SELECT doc_id, doc_id AS run, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS k, line AS p, chr(10) AS sep FROM lines),
{walk_sql(1000, 200)}""",
)
def _chunk_separator(spark, sf):
    docs = documents(spark, sf).select("doc_id", "text")
    return chunk_facts(chunking.chunk_separator(docs, "text", "\n", 1000, 200))


def chunk_facts(cut):
    return cut.select("doc_id", "chunk_no", F.md5("text").alias("text_md5"), F.length("text").alias("n_chars"), "too_long")


# Short lines that follow each other are one run, joined by newlines; a long line is a run of its words.  The documents hold
# no blank line and no word above 600 characters, so paragraphs and characters never come up; tests cover both.
@query(
    "chunk_recursive",
    f"""WITH RECURSIVE {LINES}, sized AS (SELECT *, NOT has_lines OR length(line) > {CHUNK_SIZE} AS long FROM lines),
flagged AS (SELECT *, coalesce(lag(long) OVER (PARTITION BY doc_id ORDER BY i), true) AS after_long FROM sized),
runs AS (SELECT *, doc_id * 1000000 + sum(CASE WHEN long OR after_long THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM flagged),
pieces AS (SELECT doc_id, run, i, 0 AS j, line AS p, chr(10) AS sep FROM runs WHERE NOT long
  UNION ALL SELECT doc_id, run, i, unnest(range(len(string_split(line, ' ')))), unnest(string_split(line, ' ')), ' ' FROM runs WHERE long),
parts AS (SELECT doc_id, run, p, sep, row_number() OVER (PARTITION BY run ORDER BY i, j) - 1 AS k FROM pieces WHERE p <> ''),
{walk_sql(CHUNK_SIZE, CHUNK_OVERLAP)}""",
)
def _chunk_recursive(spark, sf):
    docs = documents(spark, sf).select("doc_id", "text")
    return chunk_facts(chunking.chunk_recursive(docs, "text", CHUNK_SIZE, CHUNK_OVERLAP))


@query(
    "wrap_text",
    r"""SELECT conv_id, turn, list_reduce(regexp_extract_all(text, '\S+'), lambda acc, w: acc || CASE WHEN length(string_split(acc, chr(10))[-1]) + 1 + length(w) <= 80
  THEN ' ' ELSE chr(10) END || w) AS wrapped FROM conversations""",
)
def _wrap_text(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", wrap_text(F.col("text"), 80).alias("wrapped"))


@query("knn_topk", f"WITH {KNN} SELECT qid, id, distance, rank FROM hits WHERE rank <= {K}")
def _knn_topk(spark, sf):
    return search.knn_topk(chunks(spark, sf), questions(spark, sf), K)


def all_pairs_sql(metric: str) -> str:
    return f"""pts AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS v FROM embeddings),
near AS (SELECT q.id AS qid, c.id, q.label AS q_label, c.label, round({metric}, 6) + 0.0 AS distance FROM pts q CROSS JOIN pts c WHERE q.id % 100 = 0)"""


L2 = "sqrt(greatest(list_dot_product(q.v, q.v) + list_dot_product(c.v, c.v) - 2 * list_dot_product(q.v, c.v), 0))"


@query(
    "knn_join",
    f"""WITH {all_pairs_sql(L2)} SELECT qid, id, distance, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY distance, id) AS rank FROM near WHERE qid <> id) WHERE rank <= 5""",
)
def _knn_join(spark, sf):
    # both sides grow, so both are cut into blocks
    near = search.knn_topk(vectors(spark, sf), vector_queries(spark, sf), 6, query_rows=0, block_chunks=2000)
    return search.topk_per_query(near.drop("rank").where(F.col("qid") != F.col("id")), 5)


@query(
    "topk_per_query",
    "SELECT user_id, event_id, value, rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rank FROM events) WHERE rank <= 3",
)
def _topk_per_query(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "value")
    return search.topk_per_query(events, 3, ["user_id"], [F.desc("value"), F.col("event_id")])


@query(
    "metadata_filter",
    f"WITH {KNN} SELECT qid, id, distance, rank FROM (SELECT d.qid, d.id, d.distance, row_number() OVER (PARTITION BY d.qid ORDER BY d.distance, d.id) AS rank "
    f"FROM dist d JOIN chunks c ON c.id = d.id WHERE c.lang = 'fr') WHERE rank <= {K}",
)
def _metadata_filter(spark, sf):
    french = search.metadata_filter(chunks(spark, sf), {"lang": "fr"})
    return search.knn_topk(french, questions(spark, sf), K)


@query(
    "relevance_scored_topk",
    f"WITH {KNN} SELECT qid, id, rank, round(1 / (1 + exp(-distance * 100000 / 100000)) - 0.5, 5) AS relevance, round(1 / (1 + distance), 5) AS inverse FROM hits WHERE rank <= {K}",
)
def _relevance_scored(spark, sf):
    hits = search.knn_topk(chunks(spark, sf), questions(spark, sf), K)
    scored = search.relevance_scored_topk(hits, lambda d: F.round(logistic_relevance(d * 100000), 5))
    inverse = F.round(logistic_relevance(F.col("distance"), "inverse"), 5)
    return scored.select("qid", "id", "rank", "relevance", inverse.alias("inverse"))


@query(
    "top1_background",
    f"WITH {KNN} SELECT h.qid, substr(c.text, 1, 512) AS background FROM hits h JOIN chunks c ON c.id = h.id WHERE rank = 1",
)
def _top1_background(spark, sf):
    index = chunks(spark, sf)
    hits = search.knn_topk(index, questions(spark, sf), 1)
    return search.top1_background(hits, chunk_texts(spark, sf), 512, None)


@query(
    "retrieve_or_empty",
    f"""WITH {KNN}, near AS (SELECT h.qid, substr(c.text, 1, 200) AS bg FROM hits h JOIN chunks c ON c.id = h.id WHERE rank = 1 AND distance < 0.5)
SELECT b.item_id AS qid, b.text AS question, coalesce(n.bg, '') AS background FROM benchmark b LEFT JOIN near n ON n.qid = b.item_id""",
)
def _retrieve_or_empty(spark, sf):
    hits = search.knn_topk(chunks(spark, sf), questions(spark, sf), 1).where(F.col("distance") < 0.5)
    return search.retrieve_or_empty(asked(spark, sf), search.top1_background(hits, chunk_texts(spark, sf), 200, None))


def mmr_sql(k: int, fetch: int, lam: float) -> str:
    """Greedy picks one after another; every pick is a CTE over at most ``fetch`` candidates per query."""
    out = f"""{all_pairs_sql("1 - list_dot_product(q.v, c.v) / (sqrt(list_dot_product(q.v, q.v)) * sqrt(list_dot_product(c.v, c.v)))")},
cand AS (SELECT qid, id, 1 - distance AS sim FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY distance, id) AS r FROM near) WHERE r <= {fetch}),
among AS (SELECT p.id AS a, c.id AS b, round(1 - list_dot_product(p.v, c.v) / (sqrt(list_dot_product(p.v, p.v)) * sqrt(list_dot_product(c.v, c.v))), 6) + 0.0 AS distance
  FROM pts p JOIN pts c ON p.id IN (SELECT id FROM cand) AND c.id IN (SELECT id FROM cand)),
pick1 AS (SELECT qid, id, 1 AS pick FROM (SELECT qid, id, row_number() OVER (PARTITION BY qid ORDER BY round({lam} * sim, 6) DESC, id) AS r FROM cand) WHERE r = 1),
done1 AS (SELECT * FROM pick1)"""
    for n in range(2, k + 1):
        out += f""", pick{n} AS (SELECT qid, id, {n} AS pick FROM (
  SELECT qid, id, row_number() OVER (PARTITION BY qid ORDER BY round({lam} * any_value(sim) - {1 - lam} * max(near_sim), 6) DESC, id) AS r FROM (
    SELECT c.qid, c.id, c.sim, 1 - s.distance AS near_sim FROM cand c JOIN done{n - 1} d ON d.qid = c.qid JOIN among s ON s.a = d.id AND s.b = c.id
    WHERE NOT EXISTS (SELECT 1 FROM done{n - 1} x WHERE x.qid = c.qid AND x.id = c.id)) GROUP BY qid, id) WHERE r = 1),
done{n} AS (SELECT * FROM done{n - 1} UNION ALL SELECT * FROM pick{n})"""
    return out + f" SELECT qid, id, pick FROM done{k}"


@query("mmr_topk", "WITH " + mmr_sql(4, 20, 0.5))
def _mmr_topk(spark, sf):
    return search.mmr_topk(vectors(spark, sf), vector_queries(spark, sf), 4, 20, 0.5)


NEAREST = f"WITH {all_pairs_sql(L2)}, ann AS (SELECT qid, id, distance, row_number() OVER (PARTITION BY qid ORDER BY distance, id) AS rank FROM near)"


def ann_hits(spark, sf, k):
    index = cells.build_index(vectors(spark, sf), scratch_path(spark, "cells"))
    return cells.ann_join(index, vector_queries(spark, sf), k)


# cells are left out only where the triangle inequality proves them useless, so the check is a full search
@query("ann_join", f"{NEAREST} SELECT * FROM ann WHERE rank <= 5")
def _ann_join(spark, sf):
    return ann_hits(spark, sf, 5)


EXACT = "exact AS (SELECT * FROM (SELECT qid, id, row_number() OVER (PARTITION BY qid ORDER BY distance, id) AS rank FROM near) WHERE rank <= 5)"


@query(
    "ann_recall",
    f"{NEAREST} SELECT qid, count(*) AS wanted, count(*) AS found, 1.0::DOUBLE AS recall FROM ann WHERE rank <= 5 GROUP BY 1",
)
def _ann_recall(spark, sf):
    exact = search.knn_topk(vectors(spark, sf), vector_queries(spark, sf), 5)
    return search.recall(ann_hits(spark, sf, 5), exact)


# words of every chunk and question, lower-cased; a word counts ln(1 + (N - n + 0.5) / (n + 0.5))
BM25 = f"""cw AS (SELECT id, unnest({tokens_sql("lower(text)")}) AS term FROM chunks),
ct AS (SELECT id, term, count(*) AS times FROM cw GROUP BY 1, 2), cl AS (SELECT id, count(*) AS length FROM cw GROUP BY 1),
cn AS (SELECT count(*) AS n, (SELECT sum(length) FROM cl)::DOUBLE / count(*) AS mean FROM chunks),
cd AS (SELECT term, count(*) AS texts_with FROM ct GROUP BY 1),
qw AS (SELECT DISTINCT item_id AS qid, unnest({tokens_sql("lower(text)")}) AS term FROM benchmark),
bm AS (SELECT q.qid, ct.id, round(sum(ln(1 + (n - texts_with + 0.5) / (texts_with + 0.5)) * times * {bm25.SATURATION + 1}
    / (times + {bm25.SATURATION} * (1 - {bm25.LENGTH_WEIGHT} + {bm25.LENGTH_WEIGHT} * length / mean))), 6) + 0.0 AS score
  FROM qw q JOIN ct USING (term) JOIN cd USING (term) JOIN cl ON cl.id = ct.id CROSS JOIN cn GROUP BY 1, 2),
words AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM bm) WHERE rank <= 5)"""


@query("bm25_topk", f"WITH {CHUNKS}, {BM25} SELECT qid, id, score, rank FROM words")
def _bm25_topk(spark, sf):
    return bm25.bm25_topk(bm25.postings(rag.document_chunks(documents(spark, sf), CHUNK_SIZE, CHUNK_OVERLAP).select("id", "text")), asked(spark, sf), 5)


@query(
    "compare_retrievers",
    f"""WITH {KNN}, {BM25}, a AS (SELECT qid, id, rank FROM hits WHERE rank <= 5), b AS (SELECT qid, id, rank FROM words),
j AS (SELECT coalesce(a.qid, b.qid) AS qid, a.rank AS ra, b.rank AS rb FROM a FULL JOIN b ON a.qid = b.qid AND a.id = b.id)
SELECT qid, count(ra) AS hits_a, count(rb) AS hits_b, count(*) FILTER (WHERE ra IS NOT NULL AND rb IS NOT NULL) AS shared,
  coalesce(bool_or(ra = 1 AND rb = 1), false) AS same_first FROM j GROUP BY 1""",
)
def _compare_retrievers(spark, sf):
    # two retrievers over all chunks: nearest vectors, and words
    near = search.knn_topk(chunks(spark, sf), questions(spark, sf), 5)
    return search.compare_retrievers(near, _bm25_topk(spark, sf))


@query(
    "index_build_or_load",
    f"WITH {KNN} SELECT qid, id, distance, rank, c.doc_id, c.chunk_no FROM hits h JOIN chunks c USING (id) WHERE rank <= {K}",
)
def _index_build_or_load(spark, sf):
    path = scratch_path(spark, "index")
    docs = documents(spark, sf)
    rag.chunk_index(spark, path, docs, CHUNK_SIZE, CHUNK_OVERLAP)
    index = rag.chunk_index(spark, path, docs, CHUNK_SIZE, CHUNK_OVERLAP)
    hits = search.knn_topk(index, questions(spark, sf), K)
    return hits.join(index.select("id", "doc_id", "chunk_no"), "id")


CONTEXT = "context AS (SELECT h.qid, string_agg(c.text, chr(10) || chr(10) ORDER BY rank) AS context FROM hits h JOIN chunks c USING (id) WHERE rank <= 3 GROUP BY 1)"


@query(
    "qa_prompt_stuff",
    f"WITH {KNN}, {CONTEXT} SELECT b.item_id AS qid, {template_sql(STUFF_TEMPLATE, context='context', question='b.text')} AS prompt FROM benchmark b JOIN context c ON c.qid = b.item_id",
)
def _qa_prompt_stuff(spark, sf):
    hits = search.knn_topk(chunks(spark, sf), questions(spark, sf), 3)
    return rag.qa_prompt_stuff(asked(spark, sf), hits, chunk_texts(spark, sf))


@query(
    "qa_prompt_refine",
    f"""WITH {KNN}, h AS (SELECT qid, rank, c.text AS ctx FROM hits JOIN chunks c USING (id)),
s1 AS (SELECT qid, b.text AS question, {template_sql(FIRST_ANSWER_TEMPLATE, context_str='ctx', question='b.text')} AS prompt FROM h JOIN benchmark b ON b.item_id = qid WHERE rank = 1),
s2 AS (SELECT s1.qid, {template_sql(REFINE_TEMPLATE, context_str='ctx', question='question', existing_answer='prompt')} AS prompt FROM s1 JOIN h ON h.qid = s1.qid AND rank = 2)
SELECT qid, 1 AS step, md5(prompt) AS prompt_md5, md5(prompt) AS answer_md5 FROM s1 UNION ALL SELECT qid, 2, md5(prompt), md5(prompt) FROM s2""",
)
def _qa_prompt_refine(spark, sf):
    hits = search.knn_topk(chunks(spark, sf), questions(spark, sf), 2)
    steps = rag.qa_prompt_refine(
        asked(spark, sf),
        hits,
        chunk_texts(spark, sf),
        2,
        lambda df: generate_text(df, "prompt", "answer", echo_client),
    )
    return steps.select("qid", "step", F.md5("prompt").alias("prompt_md5"), F.md5("answer").alias("answer_md5"))


RAG_TEMPLATE = "Background:\n{background}\nHistory:\n{chat_history}\n[Player]: {question}\n"
HISTORY_SQL = "history AS (SELECT conv_id, right(string_agg('[' || role || ']' || text, chr(10) ORDER BY turn), 512) AS chat FROM conversations GROUP BY 1)"


@query(
    "rag_prompts",
    f"""WITH {KNN}, {HISTORY_SQL}, bg AS (SELECT h.qid, substr(c.text, 1, 512) AS background FROM hits h JOIN chunks c USING (id) WHERE rank = 1)
SELECT b.item_id AS qid, {template_sql(RAG_TEMPLATE, background="coalesce(background, '')", chat_history="coalesce(chat, '')", question='b.text')} AS prompt
FROM benchmark b LEFT JOIN bg ON bg.qid = b.item_id LEFT JOIN history y ON y.conv_id = b.item_id""",
)
def _rag_prompts(spark, sf):
    # the history of the conversation that shares the question's number, cut to its end
    line = F.concat(F.lit("["), F.col("role"), F.lit("]"), F.col("text"))
    histories = ends_of_histories(table(spark, sf, "conversations").select("conv_id", "turn", line.alias("line")), 512)
    histories = histories.select(F.col("conv_id").alias("qid"), F.col("tail").alias("history"))
    return rag.rag_prompts(chunks(spark, sf), asked(spark, sf), histories, wrap=None, template=RAG_TEMPLATE)


# 4-bit vectors: level per component, then the packed words and the error of the way back.
Q4 = """comp AS (SELECT vec_id, i, i // 32 AS g, embedding[i + 1]::DOUBLE AS x FROM embeddings, unnest(range(len(embedding))) t(i)),
grp AS (SELECT vec_id, g, max(abs(x)) / 7.0 AS s, min(x) AS lo, (max(x) - min(x)) / 15.0 AS s2 FROM comp GROUP BY 1, 2),
lev AS (SELECT vec_id, i, g, x, s, lo, s2,
  least(greatest(CASE WHEN s = 0 THEN 0 ELSE floor(x / s + 0.5) END + 8, 0), 15)::BIGINT AS q,
  least(greatest(CASE WHEN s2 = 0 THEN 0 ELSE floor((x - lo) / s2 + 0.5) END, 0), 15)::BIGINT AS q2 FROM comp JOIN grp USING (vec_id, g)),
words AS (SELECT vec_id, i // 8 AS w, sum(q * (1::BIGINT << (4 * (i % 8)))) AS u FROM lev GROUP BY 1, 2)"""


@query(
    "vec_quant_q4",
    f"""WITH {Q4}, p AS (SELECT vec_id, string_agg(CASE WHEN u >= 2147483648 THEN u - 4294967296 ELSE u END, ',' ORDER BY w) AS q FROM words GROUP BY 1),
s AS (SELECT vec_id, string_agg(round(s * 1e6)::BIGINT, ',' ORDER BY g) AS scales FROM grp GROUP BY 1) SELECT * FROM p JOIN s USING (vec_id)""",
)
def _vec_quant_q4(spark, sf):
    packed = table(spark, sf, "embeddings").select("vec_id", vec_quant_q4(F.col("embedding")).alias("p"))
    return packed.select("vec_id", joined(F.col("p.q")).alias("q"), rounded(F.col("p.scales")).alias("scales"))


@query(
    "vec_dequant_q4",
    f"""WITH {Q4} SELECT vec_id, string_agg(round(s * (q - 8) * 1e6)::BIGINT, ',' ORDER BY i) AS vec, round(max(abs(s * (q - 8) - x)), 6) AS max_error,
  round(max(abs(s2 * q2 + lo - x)), 6) AS max_error_addends FROM lev GROUP BY 1""",
)
def _vec_dequant_q4(spark, sf):
    held = table(spark, sf, "embeddings").select("vec_id", "embedding").withColumn("p", vec_quant_q4(F.col("embedding")))
    held = held.withColumn("pa", vec_quant_q4(F.col("embedding"), addends=True))
    held = held.withColumn("vec", vec_dequant_q4(F.col("p.q"), F.col("p.scales"))).withColumn(
        "vec_a", vec_dequant_q4(F.col("pa.q"), F.col("pa.scales"), F.col("pa.addends"))
    )

    def error(v):
        return F.round(F.array_max(F.zip_with("embedding", v, lambda x, y: F.abs(x.cast("double") - y))), 6)

    return held.select(
        "vec_id", rounded(F.col("vec")).alias("vec"), error("vec").alias("max_error"), error("vec_a").alias("max_error_addends")
    )


@query(
    "vec_regroup",
    f"""WITH {Q4} SELECT vec_id, string_agg(round(s * 1e6)::BIGINT, ',' ORDER BY g, f) AS scales FROM grp, unnest(range(4)) t(f) GROUP BY 1""",
)
def _vec_regroup(spark, sf):
    packed = table(spark, sf, "embeddings").select("vec_id", vec_quant_q4(F.col("embedding")).alias("p"))
    return packed.select("vec_id", rounded(vec_regroup(F.col("p.scales"), 4)).alias("scales"))


@query(
    "q4_recall",
    f"""WITH {Q4}, back AS (SELECT vec_id AS id, list(s * (q - 8) ORDER BY i) AS w FROM lev GROUP BY 1),
{all_pairs_sql(L2)}, {EXACT},
rough AS (SELECT qid, id, row_number() OVER (PARTITION BY qid ORDER BY distance, id) AS rank FROM (
  SELECT q.id AS qid, c.id, round(sqrt(greatest(list_dot_product(q.v, q.v) + list_dot_product(c.w, c.w) - 2 * list_dot_product(q.v, c.w), 0)), 6) + 0.0 AS distance
  FROM pts q CROSS JOIN back c WHERE q.id % 100 = 0))
SELECT e.qid, count(*) AS wanted, count(r.id) AS found, round(count(r.id)::DOUBLE / count(*), 6) AS recall
FROM exact e LEFT JOIN (SELECT * FROM rough WHERE rank <= 5) r ON r.qid = e.qid AND r.id = e.id GROUP BY 1""",
)
def _q4_recall(spark, sf):
    queries = vector_queries(spark, sf)
    points = vectors(spark, sf)
    packed = points.select("id", vec_quant_q4(F.col("vec")).alias("p"))
    back = packed.select("id", vec_dequant_q4(F.col("p.q"), F.col("p.scales")).alias("vec"))
    return search.recall(search.knn_topk(back, queries, 5), search.knn_topk(points, queries, 5))


