"""Documents and questions to retrieval prompts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loreweave.functions.templates import (
    FIRST_ANSWER_TEMPLATE,
    REFINE_TEMPLATE,
    STUFF_TEMPLATE,
    compare_prompt,
    fill_template,
)
from loreweave.functions.vectors import embed_text
from loreweave.operators.chunking import chunk_fixed, chunk_key
from loreweave.operators.search import knn_topk, retrieve_or_empty, top1_background
from loreweave.session import written
from loreweave.sources.readers import index_build_or_load


def document_chunks(documents: DataFrame, size: int, overlap: int) -> DataFrame:
    """``(id, doc_id, chunk_no, text, lang, source)``."""
    cut = chunk_fixed(documents.select("doc_id", "lang", "source", "text"), "text", size, overlap)
    return cut.withColumn("id", chunk_key("doc_id", "chunk_no"))


def embedded_chunks(documents: DataFrame, size: int, overlap: int, embed=embed_text) -> DataFrame:
    """Chunks with their vectors: what an index holds."""
    return document_chunks(documents, size, overlap).withColumn("vec", embed(F.col("text")))


def chunk_index(spark: SparkSession, path: str, documents: DataFrame, size: int, overlap: int) -> DataFrame:
    return index_build_or_load(spark, path, lambda: embedded_chunks(documents, size, overlap))


def embedded_questions(questions: DataFrame, embed=embed_text) -> DataFrame:
    """``(qid, question, vec)`` from ``(qid, question)``."""
    return questions.withColumn("vec", embed(F.col("question")))


def rag_prompts(
    index: DataFrame,
    questions: DataFrame,
    histories: DataFrame | None = None,
    *,
    max_chars: int = 512,
    wrap: int | None = 80,
    template: str | None = None,
    use_background: Column | None = None,
    use_history: Column | None = None,
) -> DataFrame:
    """``(qid, prompt)``: question, start of the nearest chunk and history in one template.

    ``histories`` is ``(qid, history)``; a question without one has an empty history.
    """
    asked = embedded_questions(questions)
    hits = knn_topk(index, asked, 1)
    held = retrieve_or_empty(asked, top1_background(hits, index, max_chars, wrap))
    if histories is not None:
        held = held.join(histories, "qid", "left")
    else:
        held = held.withColumn("history", F.lit(""))
    return held.select(
        "qid",
        compare_prompt(
            F.col("question"),
            F.col("background"),
            F.coalesce("history", F.lit("")),
            template=template,
            use_background=use_background,
            use_history=use_history,
        ).alias("prompt"),
    )


def hit_texts(hits: DataFrame, texts: DataFrame) -> DataFrame:
    return hits.join(texts.select("id", "text"), "id")


def qa_prompt_stuff(questions: DataFrame, hits: DataFrame, texts: DataFrame, sep: str = "\n\n") -> DataFrame:
    """``(qid, prompt)``: all hits of a question, best first, in one prompt.

    A question has at most k hits, so a group is small.
    """
    ranked = F.array_sort(F.collect_list(F.struct("rank", "text")))
    context = hit_texts(hits, texts).groupBy("qid").agg(
        F.array_join(F.transform(ranked, lambda x: x["text"]), sep).alias("context")
    )
    return questions.join(context, "qid", "left").select(
        "qid", fill_template(STUFF_TEMPLATE, {"context": F.col("context"), "question": F.col("question")}).alias("prompt")
    )


def qa_prompt_refine(questions: DataFrame, hits: DataFrame, texts: DataFrame, k: int, answer) -> DataFrame:
    """``(qid, step, prompt, answer)``: step 1 asks with the first hit, every later one refines the last answer.

    ``answer`` is the model call: it maps ``(qid, question, prompt)`` to the same with ``answer``.  The k steps are k
    passes over the questions; a question with fewer hits stops earlier.
    """
    found = hit_texts(hits, texts).select("qid", "rank", "text")
    out, last = None, None
    for step in range(1, k + 1):
        context = found.where(F.col("rank") == step).select("qid", F.col("text").alias("context_str"))
        if step == 1:
            asked = questions.join(context, "qid", "left")
            template = FIRST_ANSWER_TEMPLATE
        else:
            asked = last.select("qid", "question", F.col("answer").alias("existing_answer")).join(context, "qid")
            template = REFINE_TEMPLATE
        fields = {c: F.col(c) for c in asked.columns}
        prompts = asked.select("qid", "question", fill_template(template, fields).alias("prompt"))
        # read by the next step and by the result: the model must not be asked twice
        last = written(answer(prompts), "answers")
        one = last.select("qid", F.lit(step).alias("step"), "prompt", "answer")
        out = one if out is None else out.unionByName(one)
    return out
