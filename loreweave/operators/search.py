"""Nearest neighbours: exact, diversified, and what is built on the hits (by cells: ``cells``).

Vectors come as ``(id, vec)``, queries as ``(qid, vec)``; hits are ``(qid, id, distance, rank)``.  Distances are
computed in double and rounded to six digits before ranking; ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loreweave.functions.text import wrap_text
from loreweave.session import SMALL_ROWS, small_rows

DIGITS = 6
QUERY_ROWS = 4096
BLOCK_CHUNKS = 20_000
BLOCK_QUERIES = 2_000
# chunks, and pairs of a chunk and a query, that a task scores at a time where the queries are broadcast
SLICE_CHUNKS, SLICE_PAIRS = 1 << 11, 1 << 19


def pairwise(q: np.ndarray, c: np.ndarray, metric: str) -> np.ndarray:
    """All distances between the rows of two blocks, rounded."""
    dot = q @ c.T
    if metric == "ip":
        out = 1.0 - dot
    elif metric == "cosine":
        norms = np.sqrt((q * q).sum(1))[:, None] * np.sqrt((c * c).sum(1))[None, :]
        out = np.where(norms == 0, 1.0, 1.0 - dot / np.where(norms == 0, 1.0, norms))
    elif metric in ("l2", "l2sq"):
        out = np.maximum((q * q).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2.0 * dot, 0.0)
        out = np.sqrt(out) if metric == "l2" else out
    else:
        raise ValueError(f"unknown metric {metric!r}")
    # adding 0.0 turns -0.0 into 0.0
    return np.round(out, DIGITS) + 0.0


def _best(hits: pd.DataFrame, k: int) -> pd.DataFrame:
    hits = hits.sort_values(["qid", "distance", "id"], kind="stable")
    return hits[hits.groupby("qid").cumcount() < k]


def _block_hits(qid: np.ndarray, q: np.ndarray, ids: np.ndarray, c: np.ndarray, k: int, metric: str, most: np.ndarray | None = None, pairs: int = 4_000_000) -> pd.DataFrame:
    """The k best chunks of this block for each query, none beyond ``most``, in slices that keep the distance matrix small."""
    found = []
    step = max(1, pairs // max(1, len(ids)))
    for at in range(0, len(qid), step):
        d = pairwise(q[at : at + step], c, metric)
        if len(ids) > k:
            # everything up to the k-th distance stays, so that ties are decided by id
            near = d <= np.partition(d, k - 1, axis=1)[:, k - 1 : k]
        else:
            near = np.ones(d.shape, dtype=bool)
        if most is not None:
            near &= d <= most[at : at + step, None]
        row, col = np.nonzero(near)
        found.append(_best(pd.DataFrame({"qid": qid[at + row], "id": ids[col], "distance": d[row, col]}), k))
    if not found:
        return pd.DataFrame({"qid": qid[:0], "id": ids[:0], "distance": np.zeros(0)})
    return pd.concat(found, ignore_index=True)


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in vectors]) if len(vectors) else np.zeros((0, 1))


def arrow_matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _hit_schema(chunks: DataFrame, queries: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("qid", queries.schema["qid"].dataType),
            T.StructField("id", chunks.schema["id"].dataType),
            T.StructField("distance", T.DoubleType()),
        ]
    )


def topk_per_query(hits: DataFrame, k: int, by: Sequence[str] = ("qid",), order: Sequence[Column | str] = ("distance", "id")) -> DataFrame:
    """Rank within each query and keep k; every task keeps only k rows per query before the shuffle."""
    rank = F.row_number().over(W.partitionBy(*by).orderBy(*order))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k)


def _hits_with_broadcast(chunks: DataFrame, queries: DataFrame, rows: list, k: int, metric: str) -> DataFrame:
    """Chunks stay where they are; each task keeps its k best per query and only those are shuffled."""
    qid = np.array([r["qid"] for r in rows])
    held = chunks.sparkSession.sparkContext.broadcast((qid, _matrix(pd.Series([r["vec"] for r in rows], dtype=object))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, q = held.value
        best = None
        for batch in batches:
            if batch.num_rows == 0 or len(qids) == 0:
                continue
            for at in range(0, batch.num_rows, SLICE_CHUNKS):
                part = batch.slice(at, SLICE_CHUNKS)
                ids = part.column("id").to_numpy(zero_copy_only=False)
                hits = _block_hits(qids, q, ids, arrow_matrix(part.column("vec")), k, metric, pairs=SLICE_PAIRS)
                best = hits if best is None else _best(pd.concat([best, hits], ignore_index=True), k)
        if best is not None:
            yield pa.RecordBatch.from_pandas(best[["qid", "id", "distance"]], preserve_index=False)

    return chunks.select("id", "vec").mapInArrow(run, _hit_schema(chunks, queries))


def hits_by_block(chunks: DataFrame, queries: DataFrame, k: int, metric: str) -> DataFrame:
    """Score blocks: both sides carry ``_cell, _c, _q``; a block holds a bounded share of each. Queries may carry ``most``, a
    distance beyond which a hit is of no use."""
    block = ["_cell", "_c", "_q"]

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"qid": right["qid"][:0], "id": left["id"][:0], "distance": np.zeros(0)})
        most = right["most"].to_numpy() if "most" in right else None
        return _block_hits(
            right["qid"].to_numpy(), _matrix(right["vec"]), left["id"].to_numpy(), _matrix(left["vec"]), k, metric, most
        )

    return (
        chunks.groupBy(*block)
        .cogroup(queries.groupBy(*block))
        .applyInPandas(score, _hit_schema(chunks, queries))
    )


def _spread(df: DataFrame, id_column: str, own: str, splits: Column, other: str, other_splits: Column) -> DataFrame:
    """Put each row into one split of its own side, and copy it to every split of the other."""
    return (
        df.withColumn(own, F.pmod(F.xxhash64(id_column), splits).cast("int"))
        .withColumn(other, F.explode(F.sequence(F.lit(0), other_splits.cast("int") - 1)))
        .select(id_column, "vec", *[c for c in df.columns if c == "most"], "_cell", "_c", "_q")
    )


def _in_one_grid(chunks: DataFrame, queries: DataFrame, chunk_rows: int, query_rows: int) -> tuple[DataFrame, DataFrame]:
    """Cut both sides into blocks of about the given sizes; every pair of blocks meets once."""

    def splits(df: DataFrame, rows: int) -> Column:
        return F.greatest(df.agg(F.ceil(F.count(F.lit(1)) / F.lit(rows))).scalar(), F.lit(1))

    nc, nq = splits(chunks, chunk_rows), splits(queries, query_rows)
    left = chunks.select("id", "vec", F.lit(0).alias("_cell"))
    right = queries.select("qid", "vec", F.lit(0).alias("_cell"))
    return _spread(left, "id", "_c", nc, "_q", nq), _spread(right, "qid", "_q", nq, "_c", nc)


def grid_by_cell(chunks: DataFrame, queries: DataFrame, chunk_rows: int, query_rows: int) -> tuple[DataFrame, DataFrame]:
    """The same within every ``_cell``, by the sizes of its two sides, however uneven the cells are."""

    def sizes(df: DataFrame, name: str, rows: int) -> DataFrame:
        return df.groupBy("_cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(rows)).alias(name))

    # one row per cell; cells are numbered by centres, of which there is a bounded number
    grid = F.broadcast(sizes(chunks, "_nc", chunk_rows).join(sizes(queries, "_nq", query_rows), "_cell"))
    nc, nq = F.col("_nc"), F.col("_nq")
    left, right = chunks.join(grid, "_cell"), queries.join(grid, "_cell")
    return _spread(left, "id", "_c", nc, "_q", nq), _spread(right, "qid", "_q", nq, "_c", nc)


def knn_topk(
    chunks: DataFrame,
    queries: DataFrame,
    k: int,
    metric: str = "l2",
    *,
    query_rows: int = QUERY_ROWS,
    block_chunks: int = BLOCK_CHUNKS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """The k nearest chunks of every query, exact; fewer where the collection is smaller.

    Up to ``query_rows`` queries are broadcast and the collection is not shuffled.  Beyond that both sides
    are cut into blocks of bounded size and every pair of blocks is one group.
    """
    rows = small_rows(queries.select("qid", "vec"), query_rows)
    if rows is not None:
        top = topk_per_query(_hits_with_broadcast(chunks, queries, rows, k, metric), k)
        # at most k hits for each of the counted queries: later joins need not move the collection
        return F.broadcast(top) if len(rows) * k <= SMALL_ROWS else top
    blocks = _in_one_grid(chunks, queries, block_chunks, block_queries)
    return topk_per_query(hits_by_block(*blocks, k, metric), k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact hits that were found, per query."""
    both = exact.select("qid", "id").join(found.select("qid", "id", F.lit(1).alias("_hit")), ["qid", "id"], "left")
    return both.groupBy("qid").agg(
        F.count(F.lit(1)).alias("wanted"), F.count("_hit").alias("found")
    ).withColumn("recall", F.round(F.col("found") / F.col("wanted"), DIGITS))


def metadata_filter(df: DataFrame, where: Mapping[str, object]) -> DataFrame:
    """Keep rows that meet every equality, before any search.

    Top-level columns are compared directly, so the filter reaches the scan; other keys are looked up
    in ``metadata``.
    """
    for key, value in where.items():
        column = F.col(key) if key in df.columns else F.col("metadata")[key]
        df = df.where(column == F.lit(value))
    return df


def relevance_scored_topk(hits: DataFrame, score: Callable[[Column], Column] | None) -> DataFrame:
    """Hits with ``relevance`` computed from the distance; a missing function is an error."""
    if score is None:
        raise ValueError("a relevance function is required")
    return hits.withColumn("relevance", score(F.col("distance")))


def top1_background(hits: DataFrame, texts: DataFrame, max_chars: int, wrap: int | None = 80) -> DataFrame:
    """``(qid, background)``: the start of the first hit's text, word-wrapped."""
    first = hits.where(F.col("rank") == 1).select("qid", "id")
    text = F.substring("text", 1, max_chars)
    return first.join(texts.select("id", "text"), "id").select(
        "qid", (wrap_text(text, wrap) if wrap else text).alias("background")
    )


def retrieve_or_empty(questions: DataFrame, background: DataFrame) -> DataFrame:
    """Every question with its background, or an empty one."""
    return questions.join(background, "qid", "left").withColumn(
        "background", F.coalesce(F.col("background"), F.lit(""))
    )


def compare_retrievers(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two top-k results side by side, per query: sizes, shared hits, whether the first hits agree."""
    left = a.select("qid", "id", F.col("rank").alias("rank_a"))
    right = b.select("qid", "id", F.col("rank").alias("rank_b"))
    both = left.join(right, ["qid", "id"], "full")
    return both.groupBy("qid").agg(
        F.count("rank_a").alias("hits_a"),
        F.count("rank_b").alias("hits_b"),
        F.count_if(F.col("rank_a").isNotNull() & F.col("rank_b").isNotNull()).alias("shared"),
        F.coalesce(F.bool_or((F.col("rank_a") == 1) & (F.col("rank_b") == 1)), F.lit(False)).alias("same_first"),
    )


def mmr_topk(chunks: DataFrame, queries: DataFrame, k: int = 4, fetch_k: int = 20, lam: float = 0.5) -> DataFrame:
    """Diversified hits ``(qid, id, pick)``: each pick maximises ``lam * sim(query) - (1 - lam) * max sim(picked)``.

    Similarity is cosine, rounded; ties go to the smaller id.  A group holds at most ``fetch_k`` rows.
    """
    near = knn_topk(chunks, queries, fetch_k, "cosine").select("qid", "id", (1 - F.col("distance")).alias("sim"))
    held = near.join(chunks.select("id", "vec"), "id")
    types = _hit_schema(chunks, queries)
    schema = T.StructType([types["qid"], types["id"], T.StructField("pick", T.IntegerType())])

    def pick(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        order = np.argsort(group.column("id").to_numpy(), kind="stable")
        vec = arrow_matrix(group.column("vec").chunk(0))[order]
        among = 1.0 - pairwise(vec, vec, "cosine")
        sim = group.column("sim").to_numpy()[order]
        worst = np.zeros(len(order))
        left, picked = np.ones(len(order), dtype=bool), []
        while left.any() and len(picked) < k:
            gain = np.where(left, np.round(lam * sim - (1 - lam) * worst, DIGITS), -np.inf)
            at = int(np.argmax(gain))
            left[at] = False
            worst = np.maximum(worst, among[at]) if picked else among[at]
            picked.append(at)
        rows = group.select(["qid", "id"]).take(order[picked])
        return rows.append_column("pick", pa.array(range(1, len(picked) + 1), pa.int32()))

    return held.groupBy("qid").applyInArrow(pick, schema)

