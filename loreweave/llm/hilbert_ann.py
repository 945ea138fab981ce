"""Approximate nearest neighbours by shifted space-filling curves.

Every vector is projected to ``AXES`` random directions, shifted, and placed on a Hilbert curve; this is done ``CURVES``
times with other directions and shifts. Each curve is range-partitioned into cells of equal row counts. A query visits the
cells around its own key on every curve: ``SHARE`` of the collection per curve. Each visit keeps the best few by
cosine on the original vectors; the visits of all curves are merged and ranked again.

The window is a share, not a number of rows, so recall does not fall as the collection grows. How wide it must be depends on the data:
vectors without structure (all neighbours at about the same cosine) need most of the collection. Queries and cells meet in
blocks of bounded size.

Rules: vectors that are null, zero, of another length than most, or that hold null or non-finite components take no part,
neither as queries nor as candidates; so do null ids. Of exact copies only the ``k + 1`` with the smallest ids can be
among any ``k`` nearest (ties go to the smaller id), so only those become candidates; every copy is answered as a query.
Rows that repeat an id are one candidate. Empty tables give empty results.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from loreweave.llm.common import sample_of
from loreweave.llm.queries import query, table
from loreweave.session import written

NEAREST = 5
CURVES = 6
AXES = 3
BITS = 14
SHARE = 0.28
SEED = 11
# rows that the borders of the cells are fitted on; cells of a curve, and rows that a cell has at least if there are fewer cells
FIT_ROWS = 20_000
CELLS = 64
CELL_ROWS = 512
# vectors and queries that meet at a time: larger cells are dealt out by the hash of the id
BLOCK_ROWS = 32_768
QUERY_BLOCK = 8_192
# scores closer than this count as a tie until they are computed exactly
TIE_DIGITS = 12


def directions(size: int, curves: int = CURVES, axes: int = AXES, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal directions ``(curves, size, axes)`` and shifts ``(curves, axes)`` as parts of the unit cube."""
    rng = np.random.default_rng(seed)
    axes = min(axes, size)
    bases = np.stack([np.linalg.qr(rng.normal(size=(size, size)))[0][:, :axes] for _ in range(curves)])
    return bases, rng.uniform(0, 0.5, size=(curves, axes))


def hilbert_keys(cube: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position on the Hilbert curve of points ``(n, axes)`` with whole coordinates below ``2**bits``.

    The coordinates are turned into the transposed Hilbert index (Gray decoding with conditional swaps, from the highest bit
    down), whose bits, taken in turn from all axes, are the position.
    """
    x = cube.astype(np.int64).T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        q = 1 << level
        low = q - 1
        for i in range(n):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[n - 1] & (1 << level), (1 << level) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> level) & 1)
    return key


def curve_keys(vectors: np.ndarray, bases: np.ndarray, shifts: np.ndarray, bits: int = BITS) -> np.ndarray:
    """``(n, curves)`` keys of unit vectors."""
    size = vectors.shape[1]
    keys = []
    for base, shift in zip(bases, shifts):
        # a coordinate of a random unit vector has a deviation of 1 / sqrt(size); six of them fill half the cube, the shift moves it
        at = np.clip((vectors @ base) * math.sqrt(size) / 12 + 0.25, 0, 0.5) + shift
        keys.append(hilbert_keys(np.minimum((at * (1 << bits)).astype(np.int64), (1 << bits) - 1), bits))
    return np.stack(keys, axis=1) if keys else np.empty((len(vectors), 0), np.int64)


def usable(vector: Column, size: int) -> Column:
    """Whether a vector has ``size`` finite components that are not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) == size) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.ListArray, size: int) -> np.ndarray:
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]].astype(np.float64).reshape(-1, size)


def exact_cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row; equal rows give equal results whatever stands beside them."""
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


def best_in_block(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, v: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``keep`` nearest of a block for each query, ties to the smaller id."""
    order = np.argsort(ids, kind="stable")
    ids, v = ids[order], v[order]
    close = np.round((q / np.linalg.norm(q, axis=1)[:, None]) @ (v / np.linalg.norm(v, axis=1)[:, None]).T, TIE_DIGITS)
    if close.shape[1] > keep:
        least = np.partition(close, close.shape[1] - keep, axis=1)[:, close.shape[1] - keep]
        rows, cols = np.nonzero(close >= least[:, None])
    else:
        rows, cols = (x.ravel() for x in np.indices(close.shape))
    score = exact_cosine(q[rows], v[cols])
    by = np.lexsort((ids[cols], -score, rows))
    rows, cols, score = rows[by], cols[by], score[by]
    first = np.searchsorted(rows, rows, side="left")
    kept = np.arange(len(rows)) - first < keep
    return q_ids[rows[kept]], ids[cols[kept]], score[kept]


def nearest(df: DataFrame, key: str, vector: str, is_query: Column, k: int = NEAREST, curves: int = CURVES, share: float = SHARE, cells: int = CELLS) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found for each query row; ``is_query`` is a condition on ``df``."""
    rows = df.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vec"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    sizes = rows.filter("vec_id IS NOT NULL AND vec IS NOT NULL").groupBy(F.size("vec").alias("size")).count()
    most = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    size = most["size"] if most and most["size"] > 0 else 1
    bases, shifts = directions(size, curves)

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def keys_of(vectors: pa.Array) -> pa.Array:
        x = matrix(vectors, size)
        keys = curve_keys(x / np.linalg.norm(x, axis=1)[:, None], bases, shifts)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * curves, pa.int32()), pa.array(keys.ravel()))

    # the key and a hash of the id below it: copies of one vector spread over the cells that their number deserves
    keyed = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("vec"), size)).select("*", keys_of("vec").alias("plain"))
    tie = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20))
    held = written(keyed.select("vec_id", "vec", "asks", F.transform("plain", lambda x: F.shiftleft(x, 20) + tie).alias("keys")), "curves")
    # among exact copies only the k + 1 smallest ids can be an answer
    copies = Window.partitionBy("vec").orderBy("vec_id")
    candidates = held.groupBy("vec_id", "vec").agg(F.first("keys").alias("keys")).withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= k + 1)
    # one question for all queries with the same vector
    asking = held.filter("asks").select("vec_id", "vec", "keys").distinct()
    questions = asking.groupBy("vec").agg(F.min(F.struct("vec_id", "keys")).alias("first")).select("vec", "first.vec_id", "first.keys")
    questions = written(questions, "questions")
    n, n_questions = held.count(), questions.count()

    cells = max(1, min(cells, n // CELL_ROWS))
    sample = np.array([r["keys"] for r in sample_of(held, F.col("vec_id"), FIT_ROWS).select("keys").collect()], np.int64).reshape(-1, curves)
    borders = np.sort(sample, axis=0)[(np.arange(1, cells) * len(sample)) // cells].T if len(sample) else np.empty((curves, 0), np.int64)
    blocks = max(1, -(-n // (cells * BLOCK_ROWS)))
    reach = max(1, -int(-share * cells // 2))
    query_blocks = max(1, -(-n_questions * min(cells, 2 * reach + 1) // (cells * QUERY_BLOCK)))
    border_lists = F.array(*[F.array(*[F.lit(int(x)) for x in b]).cast("array<bigint>") for b in borders])

    def placed(t: DataFrame) -> DataFrame:
        """A row for each curve, with the cell of its key: the borders at or below it."""
        each = t.select("vec_id", "vec", F.posexplode("keys").alias("curve", "key"))
        at = F.size(F.filter(F.element_at(border_lists, F.col("curve") + 1), lambda b: b <= F.col("key")))
        return each.withColumn("cell", at)

    block = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(blocks)).cast("int")
    query_block = F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(query_blocks)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    index = placed(candidates).select("curve", "cell", block.alias("block"), every(query_blocks).alias("query_block"), "vec_id", "vec")
    low, high = F.greatest(F.col("cell") - reach, F.lit(0)), F.least(F.col("cell") + reach, F.lit(cells - 1))
    asked = (
        placed(questions)
        .select("curve", F.explode(F.sequence(low, high)).alias("cell"), query_block.alias("query_block"), "vec_id", "vec")
        .select("curve", "cell", every(blocks).alias("block"), "query_block", "vec_id", "vec")
    )
    schema = T.StructType([T.StructField("question", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())])

    def meet(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        if not len(vectors) or not len(queries):
            found = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        else:
            v, q = (matrix(t["vec"].combine_chunks(), size) for t in (vectors, queries))
            found = best_in_block(queries["vec_id"].to_numpy(), q, vectors["vec_id"].to_numpy(), v, k + 1)
        return pa.table([pa.array(x) for x in found], ["question", "vec_id", "score"])

    keys = ["curve", "cell", "block", "query_block"]
    met = index.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(meet, schema)
    merged = met.groupBy("question", "vec_id").agg(F.max("score").alias("score"))
    ranked = merged.withColumn("rank", F.row_number().over(Window.partitionBy("question").orderBy(F.desc("score"), "vec_id"))).filter(F.col("rank") <= k + 1)
    # back to every query row: without itself, ranked anew
    members = asking.select(F.col("vec_id").alias("query_id"), "vec").join(questions.select(F.col("vec_id").alias("question"), "vec"), "vec").select("query_id", "question")
    own = members.join(ranked.select("question", "vec_id", "score"), "question").filter("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return own.select("query_id", rank.alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)


@query("op4_hilbert_ann")
def hilbert_query(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"), "vec_id", "embedding", F.pmod(F.col("vec_id"), F.lit(50)) == 0)
