"""Memories found by a query, and the steps of an agent, against plain loops."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from loreweave.operators import memory
from loreweave.plans import agent

NOW = dt.datetime(2024, 2, 1)
WORDS = "wolf tower river gate sword bread".split()


def now():
    return F.lit(NOW).cast("timestamp_ntz")


@pytest.fixture(scope="module")
def held():
    rng = random.Random(8)
    rows = []
    for i in range(300):
        at = NOW - dt.timedelta(hours=rng.randint(0, 400))
        rows.append((i, rng.choice([1, 1, 1, 2, 3]), " ".join(rng.choices(WORDS, k=3)), at, at, rng.choice([None, 0.1, 0.5]), [rng.randint(-2, 2) / 2 for _ in range(4)]))
    return rows


def frame(spark, rows):
    schema = "memory_id long, agent long, page_content string, created_at timestamp_ntz, last_accessed_at timestamp_ntz, importance double, vec array<float>"
    return spark.createDataFrame(rows, schema).repartition(5)


@pytest.fixture
def batch_rows(spark, request):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, request.param)
    yield
    spark.conf.set(name, before)


@pytest.mark.parametrize("split_rows, split_queries, batch_rows", [(10, 1, 10000), (1000, 1000, 10000), (1000, 1000, 7), (40, 1, 3)], indirect=["batch_rows"])
def test_retrieved_memories(spark, held, split_rows, split_queries, batch_rows):
    queries = [(1, 0, [0.5, 0.0, 1.0, -1.0]), (1, 1, [0.0] * 4), (2, 0, [1.0, 1.0, 0.0, 0.0]), (9, 0, [1.0] * 4)]
    asked = spark.createDataFrame(queries, "agent long, query_no int, vec array<float>")
    options = {"search_k": 12, "relevance": lambda d: 1 / (1 + d), "split_rows": split_rows, "split_queries": split_queries}
    got = memory.retrieve_memories(frame(spark, held), asked, now(), 6, **options)
    want = set()
    for who, no, q in queries:
        own = [r for r in held if r[1] == who]
        d = {r[0]: round(sum((x - y) ** 2 for x, y in zip(r[6], q)), 6) for r in own}
        near = sorted(own, key=lambda r: (d[r[0]], r[0]))[:12]
        last = sorted(own, key=lambda r: (r[3], r[0]), reverse=True)[:6]
        scores = {}
        for r in near + last:
            base = 0.99 ** ((NOW - r[4]).total_seconds() / 3600) + (r[5] or 0.0)
            scores[r[0]] = round(base + (1 / (1 + d[r[0]]) if r in near else 0.0), 6)
        best = sorted(scores, key=lambda m: (-scores[m], m))[:6]
        want |= {(who, no, m, i + 1) for i, m in enumerate(best)}
        assert all(math.isfinite(s) for s in scores.values())
    assert {(r.agent, r.query_no, r.memory_id, r.rank) for r in got.collect()} == want
    assert not any(w[0] == 9 for w in want)  # an agent without memories finds none


def test_retrieved_without_vectors(spark, held):
    """A memory without a vector is found as one of the newest only; a question without a vector finds the newest; ids may be strings."""
    rows = [(f"m{r[0]:03}", str(r[1]), *r[2:6], None if r[0] % 2 else r[6]) for r in held]
    schema = "memory_id string, agent string, page_content string, created_at timestamp_ntz, last_accessed_at timestamp_ntz, importance double, vec array<float>"
    asked = spark.createDataFrame([("1", 0, [0.5, 0.0, 1.0, -1.0]), ("2", 0, None)], "agent string, query_no int, vec array<float>")
    memories = spark.createDataFrame(rows, schema)
    got = memory.retrieve_memories(memories, asked, now(), 5, search_k=4, relevance=lambda d: F.lit(100.0)).collect()
    near = {r.memory_id for r in got if r.agent == "1" and r.score >= 100}
    q = [0.5, 0.0, 1.0, -1.0]
    own = sorted((round(sum((x - y) ** 2 for x, y in zip(r[6], q)), 6), r[0]) for r in rows if r[1] == "1" and r[6])
    assert near == {i for _, i in own[:4]}
    newest = sorted((r for r in rows if r[1] == "2"), key=lambda r: (r[3], r[0]), reverse=True)[:5]
    assert {r.memory_id for r in got if r.agent == "2"} == {r[0] for r in newest}
    nothing = memory.retrieve_memories(memories.limit(0), asked, now(), 5)
    assert nothing.count() == 0 and memory.retrieve_memories(memories, asked.limit(0), now(), 5).count() == 0


def test_vectors_stay_in_their_block(spark, held):
    """One exchange carries vectors, to the block that scores them; the rows ranked afterwards have none."""
    asked = spark.createDataFrame([(1, 0, [0.0] * 4)], "agent long, query_no int, vec array<float>")
    found = memory.retrieve_memories(frame(spark, held), asked, now(), 3)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("MapInArrow")]
    assert "vec" not in above.lower() and "vec" not in found.columns


@pytest.mark.parametrize("batch_rows", [10000, 7, 1], indirect=True)
def test_blocks_of_ordinary_agents_rank_for_good(spark, held, batch_rows):
    """One window, over what the blocks give; an agent with more rows than are held together takes the two others, with the same result."""
    queries = [(a, 10 * a + i, [i / 2, 0.0, 1.0, -1.0]) for a in (1, 2, 3) for i in range(6)] + [(2, 99, None)]
    asked = spark.createDataFrame(queries, "agent long, query_no int, vec array<float>")
    found, windows = [], []
    for rows in (1 << 14, 20):
        top = memory.retrieve_memories(frame(spark, held), asked, now(), 6, search_k=12, whole_rows=rows)
        windows.append(top._jdf.queryExecution().optimizedPlan().toString().count("Window ["))
        found.append(sorted((r.agent, r.query_no, r.rank, r.memory_id, r.score) for r in top.collect()))
    assert windows[0] == 1 < windows[1]
    assert found[0] == found[1] and len(found[0]) == 6 * len(queries)


def test_digest_of_a_question_holds_each_content_once(spark):
    rows = [(1, q, rank, text, NOW - dt.timedelta(hours=rank)) for q in (7, 8) for rank, text in enumerate([" a", "b", None, " a", "a", "b"], 1)]
    top = spark.createDataFrame(rows, "agent long, query_no int, rank int, page_content string, created_at timestamp_ntz")
    lines = agent.digests(top, ("agent", "query_no"))
    stamps = [(NOW - dt.timedelta(hours=h)).strftime("%B %d, %Y") for h in (1, 2, 5)]
    for r in lines.collect():
        told = r.relevant_memories.split("\n")
        assert [t[-1] for t in told] == ["a", "b", "a"] and all(s[:3] in t for s, t in zip(stamps, told))
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and lines.count() == 2


def test_one_pass_for_both_summaries(spark, held, tmp_path):
    def client():
        def answer(prompts):
            (tmp_path / f"{len(list(tmp_path.iterdir()))}-{id(prompts)}").write_text(str(len(prompts)))
            return [p.split("?")[0][-20:] for p in prompts]

        return answer

    turns = spark.createDataFrame([(i, n, "", "", "Tom", "hello") for i, n in ((1, "Anna"), (2, "Bea"))], TURNS)
    both = agent.summaries(frame(spark, held).drop("vec"), turns.coalesce(1), now(), client, k=3)
    assert sum(int(p.read_text()) for p in tmp_path.iterdir()) == 4
    for name in ("self_summary", "speaker_summary"):
        alone = getattr(agent, name)(frame(spark, held).drop("vec"), turns, now(), client, k=3)
        assert {(r.agent, r[name]) for r in alone.collect()} == {(r.agent, r[name]) for r in both.collect()}


TURNS = "agent long, name string, status string, summary string, speaker string, observation string"


def test_failed_step_stops_one_agent(spark, held):
    def client():
        def answer(prompts):
            if any("Anna" in p and "core characteristics" in p for p in prompts):
                raise RuntimeError("no answer")
            return ["SAY: yes" if "What would" in p else f" {len(p)} " for p in prompts]

        return answer

    turns = spark.createDataFrame([(i, n, "idle", "a smith", "Tom", "hello") for i, n in ((1, "Anna"), (2, "Bea"), (9, "Eve"))], TURNS)
    got = {r.agent: r for r in agent.agent_turn(frame(spark, held), turns, now(), client, k=3).collect()}
    assert set(got) == {1, 2, 9}
    assert got[1].reply is None and got[1].memory_text is None and "no answer" in got[1].error
    assert got[2].reply == "Bea said yes" and got[2].memory_text == "Bea observed hello and said yes" and got[2].error is None
    assert got[9].reply == "Eve said yes"


def test_related_memories_steps(spark, held):
    def client():
        def answer(prompts):
            return ["wolf" if "Extract the entity" in p else "running" if "doing" in p else p for p in prompts]

        return answer

    turns = spark.createDataFrame([(1, "Anna", "", "", "Tom", "a wolf runs"), (9, "Eve", "", "", "Tom", "a wolf runs")], TURNS)
    plain = frame(spark, held).drop("vec")
    got = {r.agent: r for r in agent.related_memories(plain, turns, now(), client, k=4).collect()}
    assert {(r.entity, r.action, r.error) for r in got.values()} == {("wolf", "running", None)}
    assert got[1].relation.startswith("What is the relationship between Anna and wolf?\nContext from memory:\n- ")
    lines = [x for x in got[1].relation.split("\n") if x.startswith("- ")]
    assert 4 <= len(lines) <= 8
    assert "- " not in got[9].relation
