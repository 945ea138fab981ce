"""What the physical plans may and may not contain."""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from loreweave.catalog.base import table
from loreweave.operators import memory, search
from loreweave.operators.chat import turn_pairs


def plan_of(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


STREAMS = [n for n in queries() if n.startswith("stream_")]


@pytest.mark.parametrize("name", [n for n in queries() if n not in STREAMS])
def test_no_cross_join_and_no_row_udf(spark, sf, name):
    plan = plan_of(queries()[name](spark, sf))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in plan


def test_filter_reaches_the_scan(spark, sf):
    english = search.metadata_filter(table(spark, sf, "documents"), {"lang": "en"}).select("doc_id")
    plan = plan_of(english)
    assert "EqualTo(lang,en)" in plan and "ReadSchema: struct<doc_id:bigint,lang:string>" in plan


@pytest.mark.parametrize("name", ["history_before_turn", "trim_history", "chat_prompt_labeled"])
def test_histories_read_their_spans_twice(spark, sf, name):
    plan = plan_of(queries()[name](spark, sf)).split("\n\n")[0]
    assert plan.count("Scan parquet") <= 4 and plan.count("Exchange") <= 8


def test_pairs_prune_the_text(spark, sf):
    plan = plan_of(turn_pairs(table(spark, sf, "conversations")).select("conv_id", "turn"))
    assert "text" not in plan
    # without long conversations the carry branch is filtered out in the scan
    assert "Or(GreaterThanOrEqual(turn,4096),LessThanOrEqual(turn,-4096))" in plan


def test_topk_is_limited_before_the_shuffle(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "value")
    plan = plan_of(search.topk_per_query(events, 3, ["user_id"], [F.desc("value"), F.col("event_id")]))
    assert "Partial" in plan and "WindowGroupLimit" in plan
    held = events.select(F.col("user_id").alias("agent"), F.col("event_id").alias("memory_id"), F.lit("2024-01-01").alias("last_accessed_at"), F.col("value").alias("importance"))
    assert "WindowGroupLimit" in plan_of(memory.time_weighted_topk(held, F.lit("2024-02-01"), 5))


def test_collection_is_not_shuffled_for_few_queries(spark, sf):
    points = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    queries_ = points.limit(5).select(F.col("id").alias("qid"), "vec")
    hits = search.knn_topk(points, queries_, 3)
    plan = plan_of(search.top1_background(hits, points.withColumn("text", F.lit("x")), 10, None))
    assert plan.count("BroadcastHashJoin") >= 1 and "SortMergeJoin" not in plan
