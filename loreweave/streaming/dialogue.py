"""Answers to a stream of turns, from memories to which every answer adds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loreweave.functions.hooks import Client, generate_text
from loreweave.functions.text import observed_memory, parse_dialogue
from loreweave.functions.vectors import embed_text
from loreweave.operators.memory import SEARCH_K, retrieve_memories
from loreweave.plans.agent import digests
from loreweave.streaming.folders import MERGED, BatchFolders


def remembered_replies(
    turns: DataFrame,
    memories: DataFrame,
    now: Column,
    k: int,
    make_client: Callable[[], Client],
    *,
    prompt: Column,
    search_k: int = SEARCH_K,
    embed: Callable[[Column], Column] = embed_text,
) -> DataFrame:
    """Each turn ``(event_id, agent, name, ts, heard)`` answered from the best memories of its agent, with the memory of the exchange.

    ``prompt`` is made of the columns of the turn and ``relevant_memories`` (null where the agent has none).  A failed call keeps its row
    and its error, without a reply and without a memory.
    """
    queries = turns.select("agent", F.col("event_id").alias("query_no"), F.col("heard").alias("query")).withColumn("vec", embed(F.col("query")))
    top = retrieve_memories(memories, queries, now, k, search_k=search_k)
    known = digests(top, ("agent", "query_no")).withColumnRenamed("query_no", "event_id")
    asked = turns.join(known, ["agent", "event_id"], "left").withColumn("prompt", prompt)
    told = generate_text(asked, "prompt", "answer", make_client)
    told = told.withColumn("d", F.when(F.col("error").isNull(), parse_dialogue(F.col("answer"), F.col("name"))))
    return told.select(
        "event_id",
        "agent",
        F.col("d.reply").alias("reply"),
        "error",
        F.col("event_id").alias("memory_id"),
        observed_memory(F.col("name"), F.col("heard"), F.col("d.said")).alias("page_content"),
        F.col("ts").alias("created_at"),
        F.col("ts").alias("last_accessed_at"),
        F.lit(None).cast("double").alias("importance"),
    ).withColumn("vec", embed(F.col("page_content")))


def stream_dialogue(
    turns: DataFrame,
    base: DataFrame,
    reply: Callable[[DataFrame, DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    merged: int = MERGED,
) -> StreamingQuery:
    """Answer a stream of turns from the memories ``base`` and those that earlier batches wrote.

    ``reply`` maps the turns of a batch, and the memories of their agents, to rows that hold the columns of ``base``; a row without
    ``page_content`` is no memory.  Turns of one batch are answered from what was known before it.  A batch writes a folder of its own and
    reads folders of earlier batches alone, so a batch that is run again writes the same rows once.  Every ``merged`` folders of a
    level are copied into one of the next, which later batches read instead (``folders.py``).
    """

    def is_memory(df: DataFrame) -> DataFrame:
        return df.where(F.col("page_content").isNotNull())

    told = BatchFolders(turns.sparkSession, path, base.schema, is_memory, merged)

    def answer(batch: DataFrame, batch_id: int) -> None:
        before = told.before(batch_id)
        memories = base if before is None else base.unionByName(before)
        told.write(reply(batch, memories.join(batch.select("agent").distinct(), "agent", "left_semi")), batch_id)

    return turns.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
