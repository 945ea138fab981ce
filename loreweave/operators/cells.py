"""Nearest neighbours by cells, exact by the triangle inequality, approximate only by a stated budget.

Every vector lies in the cell of its nearest centre, and a cell knows its radius. A query is at least |query, centre| - radius
away from any vector of a cell. It reads the nearest cells until they hold k vectors, which gives it a distance to beat, and then
every cell that could hold something nearer: the result is that of a full search. Where vectors have no structure that is most
cells; ``budget`` then bounds the share of the collection that one query reads, nearest cells first.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loreweave.operators.search import BLOCK_CHUNKS, arrow_matrix, grid_by_cell, hits_by_block, pairwise, topk_per_query
from loreweave.session import SMALL_ROWS, bounded_rows, written

MAX_CELLS = 4_096
CELL_ROWS = 64  # rows of a cell while there are fewer cells than that
FIT_ROWS = SMALL_ROWS  # rows that centres are fitted on
ROUNDS = 8
BLOCK_QUERIES = 16_384  # queries of a block: the rows of a cell are copied once for each such block
HELD = 1 << 22  # distances that a task holds at a time
SLACK = 2e-6  # distances are rounded to six digits; bounds give way by more than that


def cells_for(n: int) -> int:
    return min(MAX_CELLS, max(1, n // CELL_ROWS))


def distances(a: np.ndarray, b: np.ndarray):
    """Runs ``(start, squared distances)`` of the rows of ``a`` to all rows of ``b``, bounded in size."""
    step = max(1, HELD // max(1, len(b)))
    for at in range(0, len(a), step):
        yield at, pairwise(a[at : at + step], b, "l2sq")


def kmeans(points: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centres of ``cells`` groups, from the first points as a start; a centre without points stays."""
    centres = points[:cells].copy()
    for _ in range(rounds):
        nearest = np.concatenate([d.argmin(1) for _, d in distances(points, centres)])
        order = np.argsort(nearest, kind="stable")
        at = np.flatnonzero(np.diff(nearest[order], prepend=-1))
        centres[nearest[order][at]] = np.add.reduceat(points[order], at) / np.diff(np.append(at, len(order)))[:, None]
    return centres


def fit_centres(chunks: DataFrame, cells: int | None = None, fit_rows: int = FIT_ROWS, seed: int = 42) -> DataFrame:
    """``(cell, centre)``: k-means over a sample of ``fit_rows`` vectors, those whose seeded id hash is smallest."""
    cells = cells or cells_for(chunks.count())
    marked = chunks.where("vec IS NOT NULL").select("id", "vec", F.md5(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string"))).alias("_h"))
    sample = marked.orderBy("_h", "id").limit(fit_rows).select("vec").toArrow()
    points = arrow_matrix(sample["vec"].combine_chunks()) if sample.num_rows else np.zeros((0, 1))
    centres = kmeans(points, min(cells, MAX_CELLS, len(points))) if len(points) else points
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(centres)]
    return chunks.sparkSession.createDataFrame(rows, "cell int, centre array<double>")


class CellIndex:
    """Vectors ``(id, vec, cell, away)`` with centres, radius and size of every cell."""

    def __init__(self, rows: DataFrame, centres: DataFrame) -> None:
        self.rows = rows
        held = sorted(bounded_rows(centres, "cell centres", MAX_CELLS), key=lambda r: r["cell"])
        self.centres = np.array([r["centre"] for r in held], np.float64)
        self.radius, self.count = np.zeros(len(held)), np.zeros(len(held), np.int64)
        facts = rows.groupBy("cell").agg(F.max("away").alias("radius"), F.count(F.lit(1)).alias("n"))
        for r in bounded_rows(facts, "cells", MAX_CELLS):
            self.radius[r["cell"]], self.count[r["cell"]] = r["radius"], r["n"]

    def share(self, probes: DataFrame) -> DataFrame:
        """``(qid, share)``: the part of the collection in the cells that a query reads, from ``(qid, cell)``."""
        sizes = F.broadcast(self.rows.sparkSession.createDataFrame([(i, int(n)) for i, n in enumerate(self.count)], "cell int, n long"))  # MAX_CELLS rows
        return probes.join(sizes, "cell").groupBy("qid").agg((F.sum("n") / F.lit(max(1, int(self.count.sum())))).alias("share"))


def place(chunks: DataFrame, centres: DataFrame) -> DataFrame:
    """``chunks`` with the ``cell`` of every vector and how far ``away`` its centre is; vectors that are null are left out."""
    held = sorted(bounded_rows(centres, "cell centres", MAX_CELLS), key=lambda r: r["cell"])
    shared = chunks.sparkSession.sparkContext.broadcast(np.array([r["centre"] for r in held], np.float64))

    @F.arrow_udf("struct<cell: int, away: double>")
    def nearest(batch: pa.Array) -> pa.Array:
        cell, away = np.empty(len(batch), np.int32), np.empty(len(batch))
        if len(batch):
            for at, d in distances(arrow_matrix(batch), shared.value):
                best = d.argmin(1)
                cell[at : at + len(d)], away[at : at + len(d)] = best, np.sqrt(d[np.arange(len(d)), best])
        return pa.StructArray.from_arrays([pa.array(cell), pa.array(away)], ["cell", "away"])

    placed = chunks.where("vec IS NOT NULL").withColumn("_at", nearest.asNondeterministic()(F.col("vec")))
    return placed.select(*chunks.columns, F.col("_at.cell").alias("cell"), F.col("_at.away").alias("away"))


def build_index(chunks: DataFrame, path: str, centres: DataFrame | None = None) -> CellIndex:
    """Fit centres if none are given, and write the collection clustered by cell below ``path``."""
    centres = centres if centres is not None else fit_centres(chunks)
    place(chunks.select("id", "vec"), centres).repartitionByRange("cell", "id").sortWithinPartitions("cell").write.parquet(path)
    return CellIndex(chunks.sparkSession.read.parquet(path), centres)


def probes_of(index: CellIndex, queries: DataFrame, k: int, budget: float | None, most: bool) -> DataFrame:
    """``(qid, vec, [most,] _cell)``: the cells that each query reads, at first or, with a distance ``most`` to beat, after that."""
    shared = queries.sparkSession.sparkContext.broadcast((index.centres, index.radius, index.count))
    limit = None if budget is None else max(1, math.ceil(budget * int(index.count.sum())))

    def cells(vecs: pa.Array, mosts: np.ndarray | None) -> pa.Array:
        centres, radius, count = shared.value
        lists: list[np.ndarray] = []
        filled = np.flatnonzero(count)
        if not len(vecs) or not len(filled):
            return pa.array([[]] * len(vecs), pa.list_(pa.int32()))
        for at, d in distances(arrow_matrix(vecs), centres[filled]):
            away = np.sqrt(d)
            floor = np.maximum(away - radius[filled], 0.0)
            order = np.lexsort((away, floor), axis=1)
            upto = np.cumsum(count[filled][order], axis=1)
            # the cells up to the one that completes k vectors
            first = upto - count[filled][order] < k
            if mosts is None:
                lists += [filled[o[f]] for o, f in zip(order, first)]
                continue
            reach = np.take_along_axis(floor, order, 1) <= (mosts[at : at + len(d)] + SLACK * (1 + mosts[at : at + len(d)]))[:, None]
            take = reach & ~first
            if limit is not None:
                take &= upto <= limit
            lists += [filled[o[t]] for o, t in zip(order, take)]
        ends = np.cumsum([0, *map(len, lists)])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *lists]).astype(np.int32)))

    @F.arrow_udf("array<int>")
    def first(vecs: pa.Array) -> pa.Array:
        return cells(vecs, None)

    @F.arrow_udf("array<int>")
    def rest(vecs: pa.Array, mosts: pa.Array) -> pa.Array:
        return cells(vecs, mosts.to_numpy(zero_copy_only=False))

    if most:
        return queries.select("qid", "vec", "most", F.explode(rest("vec", "most")).alias("_cell"))
    return queries.select("qid", "vec", F.explode(first("vec")).alias("_cell"))


def score(index: CellIndex, probes: DataFrame, k: int, block_chunks: int, block_queries: int) -> DataFrame:
    placed = index.rows.select("id", "vec", F.col("cell").alias("_cell"))
    return hits_by_block(*grid_by_cell(placed, probes, block_chunks, block_queries), k, "l2")


def ann_join(
    index: CellIndex, queries: DataFrame, k: int, budget: float | None = None, *, block_chunks: int = BLOCK_CHUNKS, block_queries: int = BLOCK_QUERIES
) -> DataFrame:
    """The k nearest vectors of every query by Euclidean distance: ``(qid, id, distance, rank)``.

    Exact without a ``budget``; with one, a query reads cells that hold up to that share of the collection, and the first ones in any
    case. Null vectors take no part. Blocks are bounded whatever the size of a cell.
    """
    asked = queries.where("vec IS NOT NULL").select("qid", "vec")
    near = written(topk_per_query(score(index, written(probes_of(index, asked, k, budget, False), "probes"), k, block_chunks, block_queries), k), "near")
    known = near.where(F.col("rank") == k).select("qid", F.col("distance").alias("most"))
    bounded = asked.join(known, "qid", "left").withColumn("most", F.coalesce("most", F.lit(math.inf)))
    more = written(probes_of(index, bounded, k, budget, True), "probes")
    return topk_per_query(near.drop("rank").unionByName(score(index, more, k, block_chunks, block_queries)), k)


def probed(index: CellIndex, queries: DataFrame, k: int, near: DataFrame, budget: float | None = None) -> DataFrame:
    """``(qid, cell)``: all cells that ``ann_join`` reads for a query, given its first hits ``near``; for reports."""
    asked = queries.where("vec IS NOT NULL").select("qid", "vec")
    first = probes_of(index, asked, k, budget, False)
    known = near.where(F.col("rank") == k).select("qid", F.col("distance").alias("most"))
    more = probes_of(index, asked.join(known, "qid", "left").withColumn("most", F.coalesce("most", F.lit(math.inf))), k, budget, True)
    return first.select("qid", F.col("_cell").alias("cell")).union(more.select("qid", F.col("_cell").alias("cell")))
