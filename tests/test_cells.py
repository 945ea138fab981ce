"""The search by cells against full searches: exact without a budget, whatever the cells are."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loreweave.catalog import QUERIES
from loreweave.operators import cells, search
from loreweave.session import scratch_path, written


def frame(spark, vectors, name):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in enumerate(vectors)], f"{name} long, vec array<float>").repartition(3)


def brute(points, queries, k):
    d = search.pairwise(queries.astype(np.float64), points.astype(np.float64), "l2")
    return {(q, i, float(row[i]), r) for q, row in enumerate(d) for r, i in enumerate(sorted(range(len(points)), key=lambda i: (row[i], i))[:k], 1)}


def clustered(n, dims, groups, spread, seed):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(groups, dims))[rng.integers(0, groups, n)] + spread * rng.normal(size=(n, dims))).astype(np.float32)


def found(index, queries, k, **options):
    return {(r.qid, r.id, r.distance, r.rank) for r in cells.ann_join(index, queries, k, **options).collect()}


@pytest.mark.parametrize("kind", ["clustered", "random", "ties", "copies"])
def test_equals_a_full_search(spark, kind):
    rng = np.random.default_rng(4)
    points = {
        "clustered": clustered(600, 8, 9, 0.1, 1),
        "random": rng.normal(size=(400, 8)).astype(np.float32),
        "ties": rng.integers(0, 2, (400, 4)).astype(np.float32),
        "copies": np.concatenate([np.ones((200, 4)), rng.normal(size=(200, 4))]).astype(np.float32),
    }[kind]
    chunks = frame(spark, points, "id")
    index = cells.build_index(chunks, scratch_path(spark, "cells"), cells.fit_centres(chunks, 12))
    assert found(index, frame(spark, points[:30], "qid"), 7, block_chunks=50, block_queries=7) == brute(points, points[:30], 7)


def test_cells_of_any_make_lose_nothing(spark):
    points = clustered(300, 6, 5, 0.3, 2)
    chunks = frame(spark, points, "id")
    # centres far from everything, and two that are the same
    odd = spark.createDataFrame([(0, [100.0] * 6), (1, [0.0] * 6), (2, [0.0] * 6), (3, points[0].tolist())], "cell int, centre array<double>")
    index = cells.build_index(chunks, scratch_path(spark, "cells"), odd)
    assert found(index, frame(spark, points[:20], "qid"), 5) == brute(points, points[:20], 5)


def test_few_rows_null_vectors_and_empty_tables(spark):
    points = clustered(4, 3, 2, 0.1, 3)
    chunks = frame(spark, [*points, None], "id")
    index = cells.build_index(chunks, scratch_path(spark, "cells"))
    assert found(index, frame(spark, [points[0], None], "qid"), 9) == brute(points, points[:1], 9)
    assert found(index, frame(spark, [], "qid"), 3) == set()
    none = cells.build_index(chunks.limit(0), scratch_path(spark, "cells"))
    assert found(none, frame(spark, points, "qid"), 3) == set()


@pytest.fixture(scope="module")
def many(spark):
    """50,000 vectors in groups, stored by cell, with 500 queries."""
    points = clustered(50_000, 64, 400, 0.15, 5)
    chunks = written(frame(spark, points, "id"), "points")
    queries = chunks.where("id % 100 = 0").select(F.col("id").alias("qid"), "vec")
    return chunks, queries, cells.build_index(chunks, scratch_path(spark, "cells"))


def test_structure_is_used(spark, many):
    chunks, queries, index = many
    exact = written(search.knn_topk(chunks, queries, 5), "exact")
    hits = written(cells.ann_join(index, queries, 5), "hits")
    assert hits.exceptAll(exact.select(*hits.columns)).count() == 0 and hits.count() == 2_500
    share = index.share(cells.probed(index, queries, 5, hits)).agg(F.avg("share"), F.max("share")).first()
    assert share[0] < 0.1, share


def test_a_budget_bounds_what_is_read(spark, many):
    chunks, queries, index = many
    exact = search.knn_topk(chunks, queries, 5)
    hits = written(cells.ann_join(index, queries, 5, budget=0.02), "hits")
    assert search.recall(hits, exact).agg(F.avg("recall")).first()[0] >= 0.9
    shares = index.share(cells.probed(index, queries, 5, hits, budget=0.02))
    first = F.lit(float(index.count.max()) / float(index.count.sum()))
    assert shares.where(F.col("share") > F.lit(0.02) + first).count() == 0


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.1"])
def test_registered_recall(spark, folder):
    rows = QUERIES["ann_recall"](spark, f"/root/testdata/{folder}").collect()
    assert rows and min(r.recall for r in rows) >= 0.9


def test_a_cell_is_read_by_its_own_files(spark, many):
    # the stored rows lie by cell, so row groups of other cells are left out
    _, _, index = many
    assert "PushedFilters: [IsNotNull(cell), EqualTo(cell,3)]" in index.rows.where("cell = 3")._jdf.queryExecution().executedPlan().toString()
