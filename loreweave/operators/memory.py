"""Scored, time-decaying memories of many agents.

A memory is ``(memory_id, agent, page_content, created_at, last_accessed_at, importance, ...)``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loreweave.functions.scores import logistic_relevance, memory_score
from loreweave.functions.templates import TIME_FORMAT
from loreweave.functions.text import strip
from loreweave.functions.vectors import embed_text
from loreweave.operators.ordered import (
    PART_CHARS,
    SEGMENT_ROWS,
    Cut,
    Segments,
    hot_keys,
    join_ordered,
    totals_before,
)
from loreweave.session import small_rows

REFLECTION_THRESHOLD = 8.0
UNITS = 1_000_000
FOLD_ROWS = 65_536
# nearest memories that a query adds to the newest ones
SEARCH_K = 100
# memories and questions of one agent that meet in one block; pairs that are scored at a time
SPLIT_ROWS = 1 << 18
SPLIT_QUERIES = 1 << 10
PAIRS = 1 << 17
HOT_ROWS = 1 << 20
# memories of one agent that a task holds together, so that no window has to rank them again
WHOLE_ROWS = 1 << 14


def buffer_index(
    new: DataFrame,
    order: Sequence[str],
    now: Column,
    existing: DataFrame | None = None,
    segments: Segments | Cut | None = None,
) -> DataFrame:
    """Number new memories after the ones an agent has, and fill in missing times.

    ``existing`` is ``(agent, held)`` with the counts so far.
    """
    numbered = totals_before(new, ["agent"], order, segments or Segments(), {"buffer_idx": F.lit(1)})
    if existing is not None:
        numbered = (
            numbered.join(existing, "agent", "left")
            .withColumn("buffer_idx", F.col("buffer_idx") + F.coalesce(F.col("held"), F.lit(0)))
            .drop("held")
        )
    for column in ("created_at", "last_accessed_at"):
        given = F.col(column) if column in numbered.columns else F.lit(None).cast("timestamp_ntz")
        numbered = numbered.withColumn(column, F.coalesce(given, now))
    return numbered


def time_weighted_topk(
    memories: DataFrame,
    now: Column,
    k: int,
    *,
    decay: float = 0.01,
    other_scores: Sequence[str] = ("importance",),
    relevance: Column | None = None,
    by: Sequence[str] = ("agent",),
) -> DataFrame:
    """The k memories of each agent with the highest recency plus importance plus relevance."""
    score = memory_score(now, F.col("last_accessed_at"), decay, [F.col(c) for c in other_scores], relevance)
    rank = F.row_number().over(W.partitionBy(*by).orderBy(F.desc("score"), "memory_id"))
    return memories.withColumn("score", F.round(score, 6)).withColumn("rank", rank).where(F.col("rank") <= k)


def dealt_out(
    memories: DataFrame, queries: DataFrame, split_rows: int, split_queries: int | None, whole_rows: int = WHOLE_ROWS
) -> tuple[DataFrame, DataFrame, bool]:
    """Both sides with the block ``(_m, _q)`` they meet in: the memories of a long agent are dealt out over blocks of about ``split_rows``,
    its questions over blocks of about ``split_queries``, and every pair of blocks meets once. Other agents are one block.

    The third says whether no block parts the memories of an agent and none has more than ``whole_rows`` of them."""

    def sizes(df: DataFrame, rows: int, name: str, *more: Column) -> DataFrame:
        return df.groupBy("agent").agg(F.ceil(F.count(F.lit(1)) / F.lit(rows)).cast("int").alias(name), *more)

    one, grid = F.lit(1), sizes(memories, split_rows, "_ms", (F.count(F.lit(1)) > whole_rows).alias("_large"))
    grid = grid.withColumn("_qs", one) if split_queries is None else grid.join(sizes(queries, split_queries, "_qs"), "agent")
    parted = (F.col("_ms") > 1) | (F.col("_qs") > 1)
    long, found = grid.where(parted).drop("_large"), small_rows(grid.where(parted | F.col("_large")))
    whole = found is not None and not any(r["_ms"] > 1 or r["_large"] for r in found)
    if found is not None:
        found = [(r["agent"], r["_ms"], r["_qs"]) for r in found if r["_ms"] > 1 or r["_qs"] > 1]
    if found == []:
        return *(df.withColumns({"_m": F.lit(0), "_q": F.lit(0)}) for df in (memories, queries)), whole
    if found is not None:
        long = F.broadcast(memories.sparkSession.createDataFrame(found, long.select("agent", "_ms", "_qs").schema))

    def deal(df: DataFrame, key: str, own: str, splits: str, other: str, other_splits: str) -> DataFrame:
        joined = df.join(long, "agent", "left").withColumn(own, F.pmod(F.xxhash64(key), F.coalesce(splits, one)).cast("int"))
        return joined.withColumn(other, F.explode(F.sequence(F.lit(0), F.coalesce(other_splits, one) - 1))).drop("_ms", "_qs")

    return deal(memories, "memory_id", "_m", "_ms", "_q", "_qs"), deal(queries, "query_no", "_q", "_qs", "_m", "_ms"), whole


def whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches that end where a block does: the last block of a batch waits for its other rows."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        at = [batch.column(c) for c in ("agent", "_m", "_q")]
        inside = np.ones(n, dtype=bool)
        for column in at:
            codes = column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            inside &= codes == codes[-1]
        last = n - int(np.argmin(inside[::-1])) if not inside.all() else 0
        if waiting and (last or any(c[0] != w for c, w in zip(at, [waiting[-1].column(c)[-1] for c in ("agent", "_m", "_q")]))):
            waiting.append(batch.slice(0, last))
            yield from one_batch(waiting)
            waiting = []
        elif last:
            yield batch.slice(0, last)
        waiting.append(batch.slice(last))
    if waiting:
        yield from one_batch(waiting)


def one_batch(batches: Sequence[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from pa.Table.from_batches(batches).combine_chunks().to_batches()


def _vectors(column: pa.Array) -> np.ndarray:
    """One row per vector, of NaN where there is none."""
    held = column.drop_null()
    flat = held.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    width = len(flat) // max(len(held), 1)
    out = np.full((len(column), width), np.nan)
    out[column.is_valid().to_numpy(zero_copy_only=False)] = flat.reshape(len(held), width)
    return out


def _ranks(column: pa.Array, order: str) -> np.ndarray:
    return pc.rank(column, sort_keys=order, null_placement="at_end", tiebreaker="dense").to_numpy().astype(np.int64)


def _candidates(names: Sequence[str], k: int, search_k: int, whole: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches of blocks, the questions of each before its memories, to the rows that can be among the ``search_k`` nearest to a question or
    among the ``k`` newest, with their distance.

    Only the questions of one block are kept from batch to batch. A block that spans batches gives candidates from each. Where every block
    is ``whole`` its rows wait for each other, so what it gives is final.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, open_no, open_q = None, None, None
        for batch in whole_blocks(batches) if whole else batches:
            n = batch.num_rows
            if not n:
                continue
            keys = [batch.column(c) for c in ("agent", "_m", "_q")]
            codes = [c.dictionary_encode().indices.to_numpy(zero_copy_only=False) for c in keys]
            starts = np.flatnonzero(np.concatenate([[True], np.any([np.diff(c) != 0 for c in codes], axis=0)]))
            block = np.zeros(n, dtype=np.int64)
            block[starts[1:]] = 1
            block = np.cumsum(block)
            ends = np.append(starts[1:], n)
            asking = batch.column("_asks").to_numpy(zero_copy_only=False)
            asks, tells = np.flatnonzero(asking), np.flatnonzero(~asking)
            firsts = starts + np.bincount(block[asks], minlength=len(starts))
            no, of = batch.column("query_no").take(pa.array(asks)), block[asks]
            q, told = (_vectors(batch.column("vec").take(pa.array(rows))) for rows in (asks, tells))
            if open_no is not None and len(open_no) and tuple(c[0].as_py() for c in keys) == open_key:
                no, of = pa.concat_arrays([open_no, no]), np.concatenate([np.zeros(len(open_no), dtype=np.int64), of])
                width = max(open_q.shape[1], q.shape[1])  # 0 where none has a vector
                q = np.concatenate([x if x.shape[1] == width else np.full((len(x), width), np.nan) for x in (open_q, q)])
            open_key, still = tuple(c[n - 1].as_py() for c in keys), np.flatnonzero(of == block[-1])
            open_no, open_q = no.take(pa.array(still)), q[still]
            vec = np.full((n, q.shape[1]), np.nan)
            if told.shape[1] == q.shape[1]:  # vectors of another length are near to nothing
                vec[tells] = told
            ids, made = _ranks(batch.column("memory_id"), "ascending"), _ranks(batch.column("created_at"), "descending")
            by_age = np.lexsort((-ids, made, asking, block))
            newest = np.zeros(n, dtype=bool)
            newest[by_age] = np.arange(n) - starts[block[by_age]] < k  # the memories of a block come before its questions here
            rows = (ends - firsts)[of]
            upto = np.concatenate([[0], np.cumsum(rows)])
            at = 0
            while at < len(of):
                to = max(at + 1, int(np.searchsorted(upto, upto[at] + PAIRS, side="right")) - 1)
                size = rows[at:to]
                before = np.repeat(np.cumsum(size) - size, size)
                qi = np.repeat(np.arange(at, to), size)
                ri = np.arange(len(qi)) - before + np.repeat(firsts[of[at:to]], size)
                d = np.empty(len(qi))
                for i in range(0, len(qi), 1 << 15):
                    part = slice(i, i + (1 << 15))
                    gap = vec[ri[part]] - q[qi[part]]
                    d[part] = np.einsum("ij,ij->i", gap, gap)
                d = np.round(d, 6)
                near = np.zeros(len(qi), dtype=bool)
                near[np.lexsort((ids[ri], d, qi))] = np.arange(len(qi)) - before < search_k
                kept = np.flatnonzero((near & ~np.isnan(d)) | newest[ri])
                taken = batch.select(names).take(pa.array(ri[kept]))
                found = [*taken.columns, no.take(pa.array(qi[kept])), pa.array(d[kept], pa.float64(), mask=np.isnan(d[kept])), pa.array(near[kept])]
                yield pa.RecordBatch.from_arrays(found, [*names, "query_no", "_distance", "_nearest"])
                at = to

    return run


def retrieve_memories(
    memories: DataFrame,
    queries: DataFrame,
    now: Column,
    k: int,
    *,
    search_k: int = SEARCH_K,
    decay: float = 0.01,
    other_scores: Sequence[str] = ("importance",),
    relevance: Callable[[Column], Column] = logistic_relevance,
    split_rows: int = SPLIT_ROWS,
    split_queries: int | None = SPLIT_QUERIES,
    whole_rows: int = WHOLE_ROWS,
    embed: Callable[[Column], Column] = embed_text,
) -> DataFrame:
    """The k best memories for each query ``(agent, query_no, vec)`` of an agent, with ``score`` and ``rank``.

    Candidates are the k newest memories of the agent and the ``search_k`` nearest to the query (squared distance of the vectors
    ``vec``, six digits, ties to the smaller id); only the latter have a relevance. Score is recency plus other scores plus relevance.
    A memory or a query without a vector, or with one of another length, is near to nothing.

    Every memory is moved once, to the block it meets its questions in; vectors are read there and go no further. Memories without a
    column ``vec`` are moved as texts, and their ``page_content`` and the ``query`` are embedded in the block. Where the caller knows
    that an agent asks a few questions only, ``split_queries=None`` saves counting them. Where no agent has more than ``whole_rows`` memories
    its block ranks them for good; otherwise windows rank the candidates of all blocks again.
    """
    by, held = ["agent", "query_no"], [c for c in memories.columns if c != "vec"]
    texts = "vec" not in memories.columns
    told = memories.withColumn("_text", F.col("page_content")) if texts else memories
    asked = queries.select(*by, F.col("query").alias("_text") if texts else "vec")
    left, right, whole = dealt_out(told, asked, split_rows, split_queries, whole_rows)
    met = left.withColumn("_asks", F.lit(False)).unionByName(right.withColumn("_asks", F.lit(True)), allowMissingColumns=True)
    block = ["agent", "_m", "_q"]
    sorted_blocks = met.repartition(*block).sortWithinPartitions(*block, F.desc("_asks"))
    if texts:
        sorted_blocks = sorted_blocks.withColumn("vec", embed(F.col("_text"))).drop("_text")
    types = {f.name: f for f in met.schema.fields}
    found_fields = [T.StructField("_distance", T.DoubleType()), T.StructField("_nearest", T.BooleanType())]
    schema = T.StructType([types[c] for c in (*held, "query_no")] + found_fields)
    ranked = sorted_blocks.mapInArrow(_candidates(held, k, search_k, whole), schema)
    if not whole:
        # candidates hold the nearest and the newest of each block and batch, so ranks among them are ranks among all
        nearest = F.row_number().over(W.partitionBy(*by).orderBy(F.asc_nulls_last("_distance"), "memory_id"))
        newest = F.row_number().over(W.partitionBy(*by).orderBy(F.desc("created_at"), F.desc("memory_id")))
        ranked = ranked.withColumns({"_nearest": (nearest <= search_k) & F.col("_distance").isNotNull(), "_new": newest}).where(F.col("_nearest") | (F.col("_new") <= k))
    near = F.when(F.col("_nearest"), relevance(F.col("_distance")).cast("double"))
    scored = ranked.select(*by, *[c for c in held if c != "agent"], F.when(F.col("_distance").isNotNull(), near).alias("_relevance"))
    best = time_weighted_topk(scored, now, k, decay=decay, other_scores=other_scores, relevance=F.col("_relevance"), by=by)
    return best.drop("_relevance")


def touch_memories(memories: DataFrame, retrieved: DataFrame, now: Column) -> DataFrame:
    """New snapshot in which every retrieved memory was last accessed now."""
    hits = retrieved.select("memory_id").distinct().withColumn("_hit", F.lit(True))
    return (
        memories.join(hits, "memory_id", "left")
        .withColumn("last_accessed_at", F.when(F.col("_hit"), now).otherwise(F.col("last_accessed_at")))
        .select(*memories.columns)
    )


def memory_distinct(memories: DataFrame, order: Sequence[str], by: Sequence[str] = ("agent",)) -> DataFrame:
    """The first memory of every content; copies are combined before the shuffle."""
    others = [c for c in memories.columns if c not in (*by, "page_content", *order)]
    first = F.min_by(F.struct(*order, *others), F.struct(*order)).alias("_first")
    kept = memories.groupBy(*by, "page_content").agg(first)
    return kept.select(*by, "page_content", "_first.*").select(*memories.columns)


def memory_line() -> Column:
    return F.concat(
        F.lit("- "), F.date_format("created_at", TIME_FORMAT), F.lit(": "), strip(F.col("page_content"))
    )


def memory_digest(
    memories: DataFrame,
    order: Sequence[str],
    by: Sequence[str] = ("agent",),
    segments: Segments | Cut | None = None,
    part_chars: int = PART_CHARS,
) -> DataFrame:
    """Dated lines of the distinct memories in order: ``(by, part, text)``.

    Contents are compared before they are stripped.
    """
    # hot keys are counted before the copies are removed: that reads the key alone
    cut = (segments or Segments()).cut(memories, by)
    return join_ordered(memory_distinct(memories, order, by), by, order, memory_line(), "\n", cut, part_chars)


def pack_recent(
    memories: DataFrame,
    order: Sequence[str],
    size: Column,
    budget: int | DataFrame,
    segments: Segments | Cut,
    by: Sequence[str] = ("agent",),
) -> DataFrame:
    """The newest memories of each agent, as many in a row as fit into ``budget``.

    ``budget`` is one number or a table ``(by, budget)``.  Adds ``used``: what the kept memory and all newer ones take.
    """
    sized = memories.withColumn("_size", size)
    summed = totals_before(sized, by, order, segments, {"_newer": F.col("_size")}, descending=True)
    used = F.col("_newer") + F.col("_size")
    packed = summed.withColumn("used", used).drop("_newer", "_size")
    if isinstance(budget, int):
        return packed.where(F.col("used") <= budget)
    return packed.join(budget, list(by)).where(F.col("used") <= F.col("budget")).drop("budget")


# Reflection: importance adds up; an event that takes the sum above the threshold starts a reflection and
# resets it.  Importance is counted in millionths, so sums do not depend on the order of addition.


def units(importance: Column) -> Column:
    return F.greatest(F.round(importance * UNITS), F.lit(0)).cast("long")


def _transfer(values: np.ndarray, limit: int) -> tuple[list[int], list[int], int]:
    """How a segment maps the sum it starts with to the sum it ends with.

    Returns the running sums up to the first above the limit, the final sum if the first reflection is at that
    position, and the total.
    """
    sums = np.cumsum(values)
    n = len(sums)
    stop = min(int(np.searchsorted(sums, limit, side="right")), n - 1)
    after = np.searchsorted(sums, sums + limit, side="right")
    last = np.where(after < n, np.minimum(after, n - 1), np.arange(n))
    # pointer doubling: every position jumps to the last reflection reached from it
    while not np.array_equal(last[last], last):
        last = last[last]
    ends = sums[-1] - sums[last[: stop + 1]]
    return sums[: stop + 1].tolist(), ends.tolist(), int(sums[-1])


def _fold_sorted(df: DataFrame, keys: Sequence[str], order: Sequence[str], limit: int) -> DataFrame:
    """Walk the rows of every key in order, starting from ``_entry``, and keep those that pass the limit."""
    keys, order = list(keys), list(order)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, total = None, 0
        for batch in batches:
            at, reached = [], []
            sums, entries = np.cumsum(batch["_v"].to_numpy()), batch["_entry"].to_numpy()
            changes = (batch[keys] != batch[keys].shift()).any(axis=1).to_numpy()
            changes[:1] = True
            starts = np.flatnonzero(changes)
            for a, b in zip(starts, [*starts[1:], len(batch)]):
                key = tuple(batch[k].iloc[a] for k in keys)
                if key != last:
                    last, total = key, int(entries[a])
                # from one reflection to the next; `base` is what the running sum was when the count began
                base = (sums[a - 1] if a else 0) - total
                while (i := int(np.searchsorted(sums[a:b], base + limit, side="right")) + a) < b:
                    at.append(i)
                    reached.append(int(sums[i] - base))
                    base = sums[i]
                total = int(sums[b - 1] - base)
            yield batch.iloc[at].assign(reached=reached)[[keys[0], *order, "reached"]]

    schema = T.StructType([df.schema[c] for c in (keys[0], *order)] + [T.StructField("reached", T.LongType())])
    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(fold, schema)


def _entries(runs: DataFrame, limit: int) -> DataFrame:
    """``(agent, _fold, _entry)``: the sum every run of a hot agent starts with.

    Each run is reduced, in parallel, to the map from the sum it starts with to the sum it ends with; only these maps are
    chained per agent.
    """
    agent = runs.schema["agent"]

    def reduce_run(run: pd.DataFrame) -> pd.DataFrame:
        run = run.sort_values("_idx")
        sums, ends, total = _transfer(run["_v"].to_numpy(), limit)
        return pd.DataFrame(
            {"agent": run["agent"].iloc[:1], "_fold": run["_fold"].iloc[:1], "sums": [sums], "ends": [ends], "total": total}
        )

    maps = runs.groupBy("agent", "_fold").applyInPandas(
        reduce_run,
        T.StructType([agent, *T.StructType.fromDDL("_fold long, sums array<long>, ends array<long>, total long").fields]),
    )

    def chain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now_agent, carry = None, 0
        for batch in batches:
            entry = []
            for a, sums, ends, total in zip(batch["agent"], batch["sums"], batch["ends"], batch["total"], strict=True):
                if a != now_agent:
                    now_agent, carry = a, 0
                entry.append(carry)
                j = int(np.searchsorted(sums, limit - carry, side="right"))
                carry = int(ends[j]) if j < len(sums) else carry + int(total)
            yield pd.DataFrame({"agent": batch["agent"], "_fold": batch["_fold"], "_entry": entry})

    return (
        maps.repartition("agent")
        .sortWithinPartitions("agent", "_fold")
        .mapInPandas(chain, T.StructType([agent, *T.StructType.fromDDL("_fold long, _entry long").fields]))
    )


def reflection_trigger(
    memories: DataFrame,
    order: Sequence[str],
    threshold: float = REFLECTION_THRESHOLD,
    *,
    fold_rows: int = FOLD_ROWS,
    hot_rows: int = HOT_ROWS,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """Memories at which an agent reflects, with the sum reached: ``(agent, order..., reached)``.

    Ordinary agents are walked through in one task each.  The rows of an agent with more
    than ``hot_rows`` are numbered and cut into runs of ``fold_rows``, which are walked through in parallel.
    """
    limit = round(threshold * UNITS)
    order = list(order)
    rows = memories.select("agent", *order, units(F.col("importance")).alias("_v"))
    hot = hot_keys(rows, ["agent"], hot_rows)
    if hot == []:
        folded = _fold_sorted(rows.withColumn("_entry", F.lit(0).cast("long")), ["agent"], order, limit)
    else:
        # None: too many to list, so every agent is cut
        long = rows if hot is None else rows.join(F.broadcast(hot), "agent", "left_semi")
        runs = totals_before(long, ["agent"], order, Cut(["agent"], segment_rows, None), {"_idx": F.lit(1)}).withColumn(
            "_fold", F.expr(f"_idx div {int(fold_rows)}")
        )
        started = runs.join(_entries(runs.select("agent", "_fold", "_idx", "_v"), limit), ["agent", "_fold"])
        folded = _fold_sorted(started, ["agent", "_fold"], order, limit)
        if hot is not None:
            rest = rows.join(F.broadcast(hot), "agent", "left_anti").withColumn("_entry", F.lit(0).cast("long"))
            folded = folded.unionByName(_fold_sorted(rest, ["agent"], order, limit))
    return folded.withColumn("reached", F.round(F.col("reached") / F.lit(float(UNITS)), 6))
