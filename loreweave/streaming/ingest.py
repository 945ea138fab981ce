"""Observations become memories as they arrive: rated, dated and numbered per agent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loreweave.functions.hooks import Client, generate_text
from loreweave.functions.templates import IMPORTANCE_TEMPLATE, fill_template
from loreweave.functions.text import parse_importance
from loreweave.operators.memory import buffer_index
from loreweave.operators.ordered import Cut, Segments
from loreweave.session import written
from loreweave.streaming.folders import MERGED, BatchFolders

IMPORTANCE_WEIGHT = 0.15


def rate_importance(
    observations: DataFrame, make_client: Callable[[], Client], weight: float = IMPORTANCE_WEIGHT, mode: str = "reference"
) -> DataFrame:
    """Observations with the ``importance`` that a model gives their ``page_content``; a failed call gives null and its ``error``.

    A null content is rated as an empty one.
    """
    prompt = fill_template(IMPORTANCE_TEMPLATE, {"memory_content": F.col("page_content")})
    rated = generate_text(observations.withColumn("_prompt", prompt), "_prompt", "_rating", make_client)
    return rated.withColumn("importance", parse_importance(F.col("_rating"), weight, mode)).drop("_prompt", "_rating")


def held_by_agent(counts: DataFrame) -> DataFrame:
    return counts.groupBy("agent").agg(F.sum("held").alias("held"))


def stream_memory_ingest(
    observations: DataFrame,
    rate: Callable[[DataFrame], DataFrame],
    now: Column,
    path: str,
    checkpoint: str,
    segments: Segments | Cut | None = None,
    merged: int = MERGED,
) -> StreamingQuery:
    """Write the observations of each batch below ``path/memories``: with importance, times filled in, numbered on from what an agent has.

    ``observations`` is a stream of ``(memory_id, agent, page_content, created_at)``; ``rate`` adds their importance and is asked once for a
    row and run of its batch. Within a batch memories are numbered by ``(created_at, memory_id)``; an agent that is long there is cut into
    segments that run in several tasks. How many memories an agent has is the sum of small counts that earlier batches wrote below
    ``path/held``, so a batch that is run again gives the same numbers.
    """
    spark = observations.sparkSession
    agent = observations.schema["agent"].dataType.simpleString()
    held = BatchFolders(spark, f"{path}/held", f"agent {agent}, held long", held_by_agent, merged)

    def ingest(batch: DataFrame, batch_id: int) -> None:
        new = written(rate(batch), "rated")
        existing = held.before(batch_id)
        if existing is not None:
            existing = existing.join(new.select("agent").distinct(), "agent", "left_semi")
        numbered = buffer_index(new, ["created_at", "memory_id"], now, existing, segments)
        done = BatchFolders(spark, f"{path}/memories", numbered.schema).write(numbered, batch_id)
        held.write(done.groupBy("agent").agg(F.count(F.lit(1)).alias("held")), batch_id)

    return observations.writeStream.foreachBatch(ingest).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
