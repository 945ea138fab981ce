"""Hard negatives by lists that all anchors of a cluster share (after MAXIMUS), exact for the integer inner product.

Anchors are grouped around centres fitted on a bounded sample. For a cluster, a row's score with any member is at most
|anchor| |row| cos(max(0, angle(row, centre) - widest angle(member, centre))); rows are sorted by that bound once, and every
member walks the one list until the bound cannot reach what it still needs. A list exists in parts, so that no task holds a
whole one: rows lie in cells (nearest centre; the widest angle and the longest row bound the whole cell). Small neighbouring
cells share a shelf, a large cell is a shelf of several slices; clusters and their members are bundled in the same way. A
part of a bundle meets a slice of a shelf as one group, in two rounds: the shelves of the bundle's own cells first, which give
every member a floor, then the shelves whose bound still reaches the floor of some member; the others are never read.

The same walk is done twice: over rows of the anchor's label for its positives, then over rows of other labels for the best ones
inside each positive's window, ``MARGIN`` of the positive's score. Both are certified, so results equal brute force.

Rules: rows with a null id, label or vector, or with a null or non-finite component, take no part; nor do vectors of another length
than most (of equally frequent lengths the smaller), nor those whose squared integer length reaches 2^56, whose scores could
leave 64 bits. Of rows that repeat an id, the one with the smallest label and then vector counts. Ties go to the smaller id. Zero
vectors score 0 and take part. Of equal vectors with one label only the few smallest ids can be among the best, so only those
become candidates; every copy remains an anchor. An anchor or positive without a row inside the window gives no rows; empty
tables give none. Other columns are not read, whatever their names. A vector is one cell, however long.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from loreweave.llm.common import sample_of
from loreweave.llm.queries import query, table
from loreweave.session import written

POSITIVES, NEGATIVES = 5, 3
LEVELS = 256  # a component x becomes floor(LEVELS * x)
MARGIN = (50, 95)  # percent of the positive's score that a negative's must lie between
MOST_SQUARE = float(1 << 56)
# anchors that the centres are fitted on, anchors a cluster should have, clusters at most (their summaries are held on the driver)
FIT_ROWS, MEMBERS, CLUSTERS, ROUNDS, SEED = 8_192, 32, 1_024, 8, 11
# members of a bundle's part and rows of a shelf's slice, about: what one task holds at a time
PART, SLICE = 2_048, 8_192
STEP = 512  # rows of a list that are scored at a time
CELLS = 1 << 20  # scores that are held at a time
SLACK = 1e-6  # share by which bounds are raised against rounding of angles
LOWEST = np.int64(-(1 << 62))

ROW = "id long, label long, v array<long>, norm double"


def integer_rows(df: DataFrame, key: str, vector: str, label: Column, levels: int = LEVELS) -> DataFrame:
    """``(id, label, v, norm)``: the rows that take part, one for each id."""
    x = F.transform(F.col(vector), lambda c: F.floor(c.cast("double") * levels))
    finite = ~F.exists(F.col(vector), lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) >= 2.0**55))
    square = F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    rows = df.select(F.col(key).cast("long").alias("id"), label.cast("long").alias("label"), F.when(finite, x).alias("v"))
    rows = rows.filter("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").withColumn("norm", F.sqrt(square)).filter(F.col("norm") < math.sqrt(MOST_SQUARE))
    most = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    if most:
        rows = rows.filter(F.size("v") == most[0]["size"])
    return rows.groupBy("id").agg(F.min(F.struct("label", "v", "norm")).alias("r")).select("id", "r.label", "r.v", "r.norm")


def units(v: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return v / np.where(norm > 0, norm, 1.0)[:, None]


def spherical_centres(points: np.ndarray, clusters: int, rounds: int = ROUNDS, seed: int = SEED) -> np.ndarray:
    """Unit centres by k-means on angles; a centre that loses all its points stays where it was."""
    rng = np.random.default_rng(seed)
    centres = points[np.sort(rng.choice(len(points), min(clusters, len(points)), replace=False))].copy()
    for _ in range(rounds):
        at = (points @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, at, points)
        size = np.linalg.norm(sums, axis=1)
        moved = size > 0
        centres[moved] = sums[moved] / size[moved, None]
    return centres


def chain(centres: np.ndarray) -> np.ndarray:
    """The centres in an order in which neighbours are close: each is followed by the nearest one left."""
    left = np.ones(len(centres), bool)
    out = [0]
    left[0] = False
    while left.any():
        near = centres @ centres[out[-1]]
        near[~left] = -np.inf
        out.append(int(near.argmax()))
        left[out[-1]] = False
    return np.array(out)


def packed(sizes: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """The group of each item: neighbours in ``order`` share one while they have ``most`` rows together; a larger item is alone."""
    group = np.zeros(len(sizes), np.int64)
    at, held = 0, 0
    for i in order:
        if held and held + sizes[i] > most:
            at, held = at + 1, 0
        group[i] = at
        held += sizes[i]
    return group


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def place(spark: SparkSession, centres: np.ndarray, v: Column, norm: Column) -> Column:
    """Struct ``(cell, angle)``: the nearest centre and the angle to it; a zero vector lies on centre 0."""
    held = spark.sparkContext.broadcast(centres)  # CLUSTERS rows at most

    @F.arrow_udf("struct<cell: int, angle: double>")
    def nearest(vs: pa.Array, norms: pa.Array) -> pa.Array:
        if len(vs) == 0:
            return pa.StructArray.from_arrays([pa.array([], pa.int32()), pa.array([], pa.float64())], ["cell", "angle"])
        n = norms.to_numpy(zero_copy_only=False)
        cosines = units(matrix(vs).astype(np.float64), n) @ held.value.T
        cell = cosines.argmax(1)
        angle = np.where(n > 0, np.arccos(np.clip(cosines[np.arange(len(cell)), cell], -1, 1)), 0.0)
        return pa.StructArray.from_arrays([pa.array(np.where(n > 0, cell, 0), pa.int32()), pa.array(angle)], ["cell", "angle"])

    return nearest(v, norm)


def reach(centres: np.ndarray, widest: np.ndarray, cells: dict[str, np.ndarray]) -> np.ndarray:
    """(clusters, cells): the largest score that a row of the cell can have with a member, as a multiple of the member's length."""
    between = np.arccos(np.clip(centres @ centres[cells["cell"]].T, -1, 1))
    cosine = np.cos(np.maximum(between - widest[:, None] - cells["widest"][None, :], 0.0))
    return np.where(cosine > 0, cells["longest"], cells["shortest"]) * cosine + SLACK * (1.0 + cells["longest"])


def integer_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in floating point where every partial sum is below 2^53, else in integers."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2.0**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def best_of(seeker: np.ndarray, score: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first ``k`` entries of each seeker, highest scores first, ties to the smaller row id."""
    order = np.lexsort((row, -score, seeker))
    s = seeker[order]
    first = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1]))) if len(s) else np.empty(0, np.int64)
    rank = np.arange(len(s)) - np.repeat(first, np.diff(np.append(first, len(s))))
    return order[rank < k]


def walk(members: dict, seekers: dict, rows: dict, centre: np.ndarray, widest: float, k: int, same: bool, step: int = STEP) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Members of one cluster along the shared list of these rows: ``(seeker, score, row id)`` of the best ``k`` of each seeker, and the
    number of scores computed.

    ``members``: ``id, label, v, norm``. ``seekers``: the ``member`` each belongs to, the lowest and highest score it takes, and the
    k-th best it has already, ``floor``. ``rows``: ``id, label, v, norm`` and the vectors at length one, ``unit``.
    """
    cosine = rows["unit"] @ centre
    angle = np.where(rows["norm"] > 0, np.arccos(np.clip(cosine, -1, 1)), 0.0)
    bound = rows["norm"] * np.cos(np.maximum(angle - widest, 0.0)) + SLACK * (1.0 + rows["norm"])
    order = np.argsort(-bound, kind="stable")
    bound = bound[order]
    ids, labels, v = rows["id"][order], rows["label"][order], rows["v"][order]
    need = np.maximum(seekers["low"], seekers["floor"])
    length = members["norm"][seekers["member"]]
    found = [np.empty(0, np.int64)] * 3
    scored = 0
    for at in range(0, len(ids), step):
        # certified: nothing from here on reaches what the others need
        active = np.flatnonzero((seekers["low"] <= seekers["high"]) & (bound[at] * length * (1 + SLACK) + SLACK >= need))
        if not len(active):
            break
        part = slice(at, at + step)
        for x in range(0, len(active), max(1, CELLS // step)):
            some = active[x : x + max(1, CELLS // step)]
            used, back = np.unique(seekers["member"][some], return_inverse=True)
            scores = integer_scores(members["v"][used], v[part])
            scored += scores.size
            fits = members["label"][used][:, None] == labels[part][None, :]
            fits = fits & (members["id"][used][:, None] != ids[part][None, :]) if same else ~fits
            mine = scores[back]
            keep = fits[back] & (mine >= need[some][:, None]) & (mine <= seekers["high"][some][:, None])
            i, j = np.nonzero(keep)
            found = [np.concatenate(p) for p in zip(found, (some[i], mine[i, j], ids[part][j]))]
        kept = best_of(*found, k)
        found = [p[kept] for p in found]
        counts = np.bincount(found[0], minlength=len(need))
        last = np.full(len(need), LOWEST)
        ends = np.append(np.flatnonzero(np.diff(found[0])), len(found[0]) - 1) if len(found[0]) else np.empty(0, np.int64)
        last[found[0][ends]] = found[1][ends]
        need = np.where(counts >= k, np.maximum(need, last), need)
    return (*found, scored)


def as_rows(t: pa.Table) -> dict:
    return {n: t[n].to_numpy() for n in ("id", "label", "norm")} | {"v": matrix(t["v"])}


def walker(held, k: int, same: bool) -> Callable:
    """For ``applyInArrow``: the seekers of a bundle's part and the rows of a slice to the best of each seeker in the slice."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        # a seeker's target is the positive it belongs to, or null
        out = [np.empty(0, np.int64)] * 3
        targets = []
        if left.num_rows and right.num_rows:
            centres, widest = held.value
            rows = as_rows(right)
            rows["unit"] = units(rows["v"].astype(np.float64), rows["norm"])
            clusters = left["cluster"].to_numpy()
            for cluster in np.unique(clusters):
                some = left.take(np.flatnonzero(clusters == cluster))
                ids, first, member = np.unique(some["id"].to_numpy(), return_index=True, return_inverse=True)
                seekers = {n: some[n].to_numpy() for n in ("low", "high", "floor")} | {"member": member}
                s, score, row, _ = walk(as_rows(some.take(first)), seekers, rows, centres[cluster], widest[cluster], k, same)
                out = [np.concatenate(x) for x in zip(out, (ids[member[s]], row, score))]
                targets += some["target"].take(pa.array(s)).to_pylist()
        return pa.Table.from_arrays([pa.array(out[0]), pa.array(targets, pa.int64()), pa.array(out[1]), pa.array(out[2])], ["anchor", "target", "row", "score"])

    return run


class Lists:
    """The shared lists: centres, bundles of clusters with their members, shelves of cells with their rows."""

    def __init__(self, rows: DataFrame, is_anchor: Column, fit_rows: int = FIT_ROWS, members: int = MEMBERS, part: int = PART, slice_rows: int = SLICE, copies: int = POSITIVES + 1) -> None:
        self.spark = spark = rows.sparkSession
        anchors = rows.filter(is_anchor)
        n = anchors.count()
        sample = sample_of(anchors.filter("norm > 0"), F.col("id"), fit_rows).select("id", "v", "norm").toArrow().sort_by("id")
        dims = len(sample["v"][0]) if sample.num_rows else 1
        points = units(matrix(sample["v"]).astype(np.float64), sample["norm"].to_numpy()) if sample.num_rows else np.zeros((1, dims))
        self.centres = spherical_centres(points, min(CLUSTERS, max(1, n // members)))
        if not sample.num_rows:  # zero vectors only, or none at all
            first = rows.select(F.size("v").alias("size")).limit(1).collect()
            self.centres = np.zeros((1, first[0]["size"] if first else 1))
        spot = place(spark, self.centres, F.col("v"), F.col("norm"))
        placed = anchors.withColumn("p", spot).select("id", "label", "v", "norm", F.col("p.cell").alias("cluster"), F.col("p.angle").alias("angle"))
        members_at = written(placed, "members")
        clusters = len(self.centres)
        order = chain(self.centres)
        self.widest, sizes = np.zeros(clusters), np.zeros(clusters, np.int64)
        for r in members_at.groupBy("cluster").agg(F.max("angle").alias("widest"), F.count("*").alias("n")).collect():  # CLUSTERS rows at most
            self.widest[r["cluster"]], sizes[r["cluster"]] = r["widest"], r["n"]
        self.bundle = packed(sizes, order, part)
        self.parts = np.ceil(np.bincount(self.bundle, sizes) / part).astype(np.int64)
        self.members = members_at.join(self.groups(self.bundle, "cluster", "bundle"), "cluster")
        # of copies with one label only the smallest ids can be among the best
        rank = F.row_number().over(Window.partitionBy("label", "v").orderBy("id"))
        kept = rows.withColumn("copy", rank).filter(F.col("copy") <= copies).withColumn("p", spot)
        rows_at = written(kept.select("id", "label", "v", "norm", F.col("p.cell").alias("cell"), F.col("p.angle").alias("angle")), "cells")
        facts = [F.max("angle").alias("widest"), F.max("norm").alias("longest"), F.min("norm").alias("shortest"), F.count("*").alias("n")]
        found = rows_at.groupBy("cell").agg(*facts).toArrow()  # CLUSTERS rows at most
        cells = {"cell": np.arange(clusters)} | {n: np.zeros(clusters) for n in ("widest", "longest", "shortest", "n")}
        for n in ("widest", "longest", "shortest", "n"):
            cells[n][found["cell"].to_numpy()] = found[n].to_numpy()
        self.shelf = packed(cells["n"], order, slice_rows)
        self.slices = np.ceil(np.bincount(self.shelf, cells["n"]) / slice_rows).astype(np.int64)
        self.rows = rows_at.join(self.groups(self.shelf, "cell", "shelf"), "cell")
        self.reach = np.where(cells["n"] > 0, reach(self.centres, self.widest, cells), -np.inf)
        self.own = self.pairs(np.eye(clusters, dtype=bool))
        self.held = spark.sparkContext.broadcast((self.centres, self.widest))

    def groups(self, numbers: np.ndarray, item: str, group: str) -> DataFrame:
        """The group of every cluster or cell, as a table of CLUSTERS rows at most."""
        return F.broadcast(self.spark.createDataFrame([(i, int(g)) for i, g in enumerate(numbers)], f"{item} int, {group} int"))

    def pairs(self, wanted: np.ndarray) -> np.ndarray:
        """(bundles, shelves): those that hold a wanted pair of a cluster and a cell."""
        out = np.zeros((len(self.parts), len(self.slices)), bool)
        c, x = np.nonzero(wanted)
        out[self.bundle[c], self.shelf[x]] = True
        return out

    def meet(self, seekers: DataFrame, wanted: np.ndarray, k: int, same: bool) -> DataFrame:
        """Walk the wanted (bundle, shelf) pairs: one group for a part of the bundle and a slice of the shelf."""
        pairs = [(int(b), int(s), int(self.parts[b]), int(self.slices[s])) for b, s in zip(*np.nonzero(wanted)) if self.parts[b] and self.slices[s]]
        # CLUSTERS x CLUSTERS short rows at most
        known = F.broadcast(self.spark.createDataFrame(pairs, "bundle int, shelf int, parts int, slices int"))
        group = ["bundle", "part", "shelf", "slice"]
        left = seekers.join(known, "bundle").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
        left = left.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        right = self.rows.join(known, "shelf").withColumn("slice", F.pmod(F.xxhash64("id"), F.col("slices")).cast("int"))
        right = right.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        left = left.select(*group, "cluster", "id", "target", "label", "v", "norm", "low", "high", "floor")
        right = right.select(*group, "id", "label", "v", "norm")
        schema = "anchor long, target long, row long, score long"
        return left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(walker(self.held, k, same), schema)

    def search(self, seekers: DataFrame, k: int, same: bool) -> DataFrame:
        """``(anchor, target, rank, row, score)``: the best ``k`` of every seeker ``(id, target, low, high)``."""
        by = ["anchor", "target"]
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "row"))

        def top(found: DataFrame) -> DataFrame:
            return found.withColumn("rank", rank).filter(F.col("rank") <= k)

        asked = self.members.join(seekers, "id")
        own = written(top(self.meet(asked.withColumn("floor", F.lit(int(LOWEST))), self.own, k, same)), "own")
        floors = own.filter(F.col("rank") == k).select(F.col("anchor").alias("id"), "target", F.col("score").alias("floor"))
        on = (F.col("a.id") == F.col("f.id")) & F.col("a.target").eqNullSafe(F.col("f.target"))
        asked = asked.alias("a").join(floors.alias("f"), on, "left").select("a.*", F.coalesce("f.floor", F.lit(int(LOWEST))).alias("floor"))
        asked = written(asked, "floors")
        # the least that a member of a cluster still needs, as a multiple of its length; zero vectors need to see every row
        need = F.when(F.col("norm") > 0, F.greatest("low", "floor") / F.col("norm")).otherwise(F.lit(-math.inf))
        least = asked.filter(F.col("low") <= F.col("high")).groupBy("cluster").agg(F.min(need).alias("need")).collect()  # CLUSTERS rows at most
        wanted = np.zeros(self.reach.shape, bool)
        for r in least:
            wanted[r["cluster"]] = self.reach[r["cluster"]] * (1 + SLACK) >= r["need"]
        rest = self.meet(asked, self.pairs(wanted) & ~self.own, k, same)
        return top(own.drop("rank").unionByName(rest))


def hard_negatives(
    df: DataFrame,
    key: str,
    vector: str,
    label: Column,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    margin: tuple[int, int] = MARGIN,
    **sizes: int,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``; ``is_anchor`` is a condition on ``id``."""
    rows = written(integer_rows(df, key, vector, label), "rows")
    lists = Lists(rows, is_anchor, copies=max(positives + 1, negatives), **sizes)
    whatever = F.lit(int(LOWEST)).alias("low"), F.lit(-int(LOWEST)).alias("high")
    everyone = lists.members.select("id", F.lit(None).cast("long").alias("target"), *whatever)
    near = lists.search(everyone, positives, True).select(F.col("anchor").alias("id"), F.col("row").alias("target"), F.col("score").alias("positive_score"))
    near = written(near, "positives")
    if max(abs(m) for m in margin) > 100:
        raise ValueError("a margin is a share of the positive's score, in percent")
    # whole scores inside the window: the smallest from its lower end on, the largest up to its upper end
    low = F.expr(f"(positive_score * {margin[0]} + pmod(-positive_score * {margin[0]}, 100)) div 100")
    high = F.expr(f"(positive_score * {margin[1]} - pmod(positive_score * {margin[1]}, 100)) div 100")
    found = lists.search(near.select("id", "target", low.alias("low"), high.alias("high")), negatives, False)
    out = found.join(near.withColumnRenamed("id", "anchor"), ["anchor", "target"])
    return out.select(
        F.col("anchor").alias("anchor_id"),
        F.col("target").alias("positive_id"),
        "rank",
        F.col("row").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


LABEL = "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"

SQL = f"""WITH r AS (SELECT vec_id AS id, {LABEL} AS label,
  list_transform(embedding, lambda x: floor({LEVELS} * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS anchor, r.id, a.label = r.label AS same, list_dot_product(a.v, r.v)::BIGINT AS score FROM r a JOIN r ON a.id % 50 = 0 AND a.id <> r.id),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) AS k FROM s WHERE same) WHERE k <= {POSITIVES}),
n AS (SELECT p.anchor AS anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
  row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY s.score DESC, s.id) AS rank FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same
  AND {MARGIN[0]} * p.score <= 100 * s.score AND 100 * s.score <= {MARGIN[1]} * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {NEGATIVES}"""


@query("op11_hard_negatives", SQL)
def hard_negatives_query(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives(table(spark, folder, "embeddings"), "vec_id", "embedding", F.expr(LABEL), F.col("id") % 50 == 0)
