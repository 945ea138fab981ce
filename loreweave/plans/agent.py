"""One turn of many agents: remember, summarise, prompt, answer, store.

Every step is one pass of the model hook over all agents. An agent whose call failed in any step is asked no further; it stays in the
result with its error and without an answer.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loreweave.functions.hooks import generate_text
from loreweave.functions.templates import DIALOGUE_FRAME, TIME_FORMAT, agent_prompts, fill_template
from loreweave.functions.text import observed_memory, parse_dialogue, strip
from loreweave.functions.vectors import embed_text, tokens
from loreweave.operators.memory import SEARCH_K, memory_distinct, memory_line, pack_recent, retrieve_memories
from loreweave.operators.ordered import Segments
from loreweave.session import written

FRAME_FIELDS = "observation entity name speaker relevant_memories summary current_time status most_recent_memories".split()


def queries_of(turns: DataFrame, *texts: Column, embed=embed_text) -> DataFrame:
    """``(agent, query_no, query, vec)``: the questions each agent asks its memory."""
    asked = turns.select("agent", F.posexplode(F.array(*texts)).alias("query_no", "query"))
    return asked.withColumn("vec", embed(F.col("query")))


def digests(top: DataFrame, by: tuple[str, ...] = ("agent",)) -> DataFrame:
    """``(by, relevant_memories)``: the retrieved memories as dated lines, question by question, best first, each content once."""
    order = [c for c in ("query_no", "rank") if c not in by]
    if order == ["rank"]:
        # a list of at most k lines: copies are told apart in it, without another sort of all lines
        line = F.struct("rank", "page_content", memory_line().alias("line"))
        found = top.groupBy(*by).agg(F.array_sort(F.collect_list(line)).alias("lines"))
        contents = F.transform("lines", lambda x: x["page_content"])
        first = F.filter("lines", lambda x, i: F.array_position(contents, x["page_content"]) == i + 1)
        return found.select(*by, F.array_join(F.transform(first, lambda x: x["line"]), "\n").alias("relevant_memories"))
    distinct = memory_distinct(top.select("agent", "query_no", "rank", "page_content", "created_at"), order, by)
    # at most k lines per query
    lines = F.array_sort(F.collect_list(F.struct("query_no", "rank", memory_line().alias("line"))))
    text = F.array_join(F.transform(lines, lambda x: x["line"]), "\n")
    return distinct.groupBy(*by).agg(text.alias("relevant_memories"))


def relevant_memories(memories: DataFrame, queries: DataFrame, now: Column, k: int, decay: float = 0.01, search_k: int = SEARCH_K) -> DataFrame:
    """``(agent, relevant_memories)``: digest of the best memories of the few queries of an agent, query by query, best first."""
    return digests(retrieve_memories(memories, queries, now, k, decay=decay, search_k=search_k, split_queries=None))


def recent_memories(memories: DataFrame, budgets: DataFrame) -> DataFrame:
    """``(agent, most_recent_memories)``: the newest memories that fit into the token ``budget`` of each agent."""
    size = F.greatest(F.size(tokens(memory_line())), F.lit(1))
    packed = pack_recent(memories, ["created_at", "memory_id"], size, budgets, Segments())
    # every kept memory has a token, so at most `budget` rows per agent
    lines = F.array_sort(F.collect_list(F.struct("created_at", "memory_id", "page_content")))
    newest_first = F.reverse(F.transform(lines, lambda x: x["page_content"]))
    return packed.groupBy("agent").agg(F.array_join(newest_first, "; ").alias("most_recent_memories"))


def frame_prompt(frame: str, names: list[str]) -> Column:
    """One of the six frames, filled from the columns there are."""
    return agent_prompts({c: F.col(c) if c in names else F.lit("") for c in FRAME_FIELDS})[frame]


def step(turns: DataFrame, frame: str, answer: str, make_client: Callable) -> DataFrame:
    """Ask with one of the six frames, filled from the columns there are; adds the stripped ``answer``, keeps the first ``error``.

    The answers are stored, so later steps do not ask again.
    """
    if "error" not in turns.columns:
        turns = turns.withColumn("error", F.lit(None).cast("string"))
    names = turns.columns
    going = turns.where(F.col("error").isNull()).drop("error").withColumn("_prompt", frame_prompt(frame, names))
    told = generate_text(going, "_prompt", "_answer", make_client).select(*names, strip(F.col("_answer")).alias(answer))
    stopped = turns.where(F.col("error").isNotNull()).withColumn(answer, F.lit(None).cast("string"))
    return written(told.unionByName(stopped), frame)


def related_memories(
    memories: DataFrame, turns: DataFrame, now: Column, make_client: Callable, *, k: int = 15, decay: float = 0.01, search_k: int = SEARCH_K
) -> DataFrame:
    """``(agent, entity, action, relation, error)`` from turns ``(agent, name, observation)``.

    The model names the entity of the observation and what it does; two questions made of both search the memory; the model
    answers the first from what was found.
    """
    named = step(turns.select("agent", "name", "observation"), "entity", "entity", make_client)
    acted = step(named, "action", "action", make_client)
    first = F.concat(F.lit("What is the relationship between "), F.col("name"), F.lit(" and "), F.col("entity"))
    second = F.concat(F.col("entity"), F.lit(" is "), F.col("action"))
    found = relevant_memories(memories, queries_of(acted, first, second), now, k, decay, search_k)
    return step(acted.join(found, "agent", "left"), "relation", "relation", make_client).select("agent", "entity", "action", "relation", "error")


def speaker_summary(
    memories: DataFrame, turns: DataFrame, now: Column, make_client: Callable, *, k: int = 15, decay: float = 0.01, search_k: int = SEARCH_K
) -> DataFrame:
    """``(agent, speaker_summary, error)``: what the agent's memories say of the speaker, from turns ``(agent, name, speaker)``."""
    asked = turns.select("agent", "name", "speaker")
    found = relevant_memories(memories, queries_of(asked, F.col("speaker")), now, k, decay, search_k)
    return step(asked.join(found, "agent", "left"), "speaker", "speaker_summary", make_client).select("agent", "speaker_summary", "error")


def self_summary(
    memories: DataFrame, turns: DataFrame, now: Column, make_client: Callable, *, k: int = 15, decay: float = 0.01, search_k: int = SEARCH_K
) -> DataFrame:
    """``(agent, self_summary, error)``: the agent's character as its memories show it, from turns ``(agent, name)``."""
    asked = turns.select("agent", "name")
    core = F.concat(F.col("name"), F.lit("'s core characteristics"))
    found = relevant_memories(memories, queries_of(asked, core), now, k, decay, search_k)
    return step(asked.join(found, "agent", "left"), "self", "self_summary", make_client).select("agent", "self_summary", "error")


def summaries(
    memories: DataFrame, turns: DataFrame, now: Column, make_client: Callable, *, k: int = 15, decay: float = 0.01, search_k: int = SEARCH_K
) -> DataFrame:
    """``(agent, self_summary, speaker_summary, error)``: ``self_summary`` and ``speaker_summary`` by one search and one pass of the model.

    Both questions of an agent are answered from the same pass over its memories; the first error counts.
    """
    asked = turns.select("agent", "name", "speaker")
    questions = queries_of(asked, F.concat(F.col("name"), F.lit("'s core characteristics")), F.col("speaker"))
    top = retrieve_memories(memories, questions, now, k, decay=decay, search_k=search_k, split_queries=None)
    each = asked.withColumn("query_no", F.explode(F.array(F.lit(0), F.lit(1))))
    found = each.join(digests(top, ("agent", "query_no")), ["agent", "query_no"], "left")
    about_self = F.col("query_no") == 0
    prompt = F.when(about_self, frame_prompt("self", found.columns)).otherwise(frame_prompt("speaker", found.columns))
    told = generate_text(found.select("agent", "query_no", prompt.alias("_prompt")), "_prompt", "_answer", make_client)
    answer = strip(F.col("_answer"))
    both = told.groupBy("agent").agg(
        F.max(F.when(about_self, answer)).alias("self_summary"),
        F.max(F.when(~about_self, answer)).alias("speaker_summary"),
        F.coalesce(F.max(F.when(about_self, F.col("error"))), F.max(F.when(~about_self, F.col("error")))).alias("error"),
    )
    return written(both, "summaries")


def agent_prompts_for(
    memories: DataFrame,
    turns: DataFrame,
    now: Column,
    make_client: Callable,
    *,
    k: int = 15,
    budget: int = 1200,
    decay: float = 0.01,
    search_k: int = SEARCH_K,
) -> DataFrame:
    """``turns`` ``(agent, name, status, summary, speaker, observation)`` with their dialogue ``prompt`` and ``error``.

    There is one turn per agent. ``summary`` is the fixed description; what the agent thinks of itself follows it.
    """
    thought = summaries(memories, turns, now, make_client, k=k, decay=decay, search_k=search_k)
    base = turns.join(thought, "agent").withColumns(
        {
            "summary": F.concat_ws("\n", "summary", "self_summary"),
            "relevant_memories": F.col("speaker_summary"),
            "current_time": F.date_format(now, TIME_FORMAT),
        }
    )
    fields = {c: F.col(c) for c in (*base.columns, "most_recent_memories")}
    empty = {**fields, "most_recent_memories": F.lit("")}
    left = F.lit(budget) - F.size(tokens(fill_template(DIALOGUE_FRAME, empty)))
    # one row per agent, read twice below
    counted = written(base.withColumn("budget", left), "turns")
    recent = recent_memories(memories.drop("vec"), counted.select("agent", "budget"))
    return counted.join(recent, "agent", "left").withColumn("prompt", fill_template(DIALOGUE_FRAME, fields))


def agent_turn(
    memories: DataFrame,
    turns: DataFrame,
    now: Column,
    make_client: Callable,
    *,
    k: int = 15,
    budget: int = 1200,
    decay: float = 0.01,
    search_k: int = SEARCH_K,
) -> DataFrame:
    """``(agent, prompt, goes_on, reply, memory_text, error)``: summaries, prompt, model call, parsed reply and the new memory."""
    prompts = agent_prompts_for(memories, turns, now, make_client, k=k, budget=budget, decay=decay, search_k=search_k)
    told = step(prompts.select("agent", "name", "observation", "prompt", *FRAME_FIELDS[3:], "error"), "dialogue", "answer", make_client)
    parsed = told.withColumn("_d", F.when(F.col("error").isNull(), parse_dialogue(F.col("answer"), F.col("name"))))
    return parsed.select(
        "agent",
        "prompt",
        F.col("_d.goes_on").alias("goes_on"),
        F.col("_d.reply").alias("reply"),
        F.when(F.col("error").isNull(), observed_memory(F.col("name"), F.col("observation"), F.col("_d.said"))).alias("memory_text"),
        "error",
    )
