import math

import numpy as np
from pyspark.sql import functions as F

from loreweave.llm.hard_negatives import LABEL, LOWEST, hard_negatives, integer_scores, reach, spherical_centres, units, walk

SCHEMA = "vec_id long, embedding array<float>, label int, score string, id string"


def brute(rows, every=50, positives=5, negatives=3, margin=(50, 95)):
    """All pairs, in Python numbers of any size."""
    held = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ints = [math.floor(256 * float(np.float32(x))) for x in v]
        label = (label + 1) % 10 if i % 7 == 0 else label
        held[i] = min(held.get(i, (label, ints)), (label, ints))
    out = []
    for a in sorted(held):
        if a % every:
            continue
        label, v = held[a]
        scores = sorted((-sum(x * y for x, y in zip(v, w)), i, k == label) for i, (k, w) in held.items() if i != a)
        for s, p, _ in [x for x in scores if x[2]][:positives]:
            hard = [(t, n) for t, n, same in scores if not same and margin[0] * -s <= 100 * -t <= margin[1] * -s]
            out += [(a, p, r, n, -s, -t) for r, (t, n) in enumerate(hard[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, every=50, **sizes):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    return sorted(tuple(r) for r in hard_negatives(df, "vec_id", "embedding", F.expr(LABEL), F.col("id") % every == 0, **sizes).collect())


def clustered(n, dims, groups, spread, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dims))
    v = centres[rng.integers(0, groups, n)] + spread * rng.normal(size=(n, dims))
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32), rng.integers(0, 10, n)


def test_parts_and_slices_equal_brute_force(spark):
    v, labels = clustered(700, 8, 12, 0.3, 1)
    rows = [(i, v[i].tolist(), int(labels[i])) for i in range(700)]
    want = brute(rows, 10)
    assert len(want) > 300
    assert mined(spark, rows, 10, part=3, slice_rows=20, members=4) == want


def test_copies_ties_and_odd_rows(spark):
    rng = np.random.default_rng(2)
    # a third of the rows are one vector, few distinct vectors among the rest, so nearly every score is a tie
    few = rng.integers(-2, 3, (6, 4)).astype(float).tolist()
    rows = [(i, [0.5, 0.5, 0.0, -0.25] if i % 3 == 0 else few[int(rng.integers(6))], int(rng.integers(10))) for i in range(400)]
    rows += [(1000, None, 1), (1050, [1.0, 1.0, 1.0, 1.0], None), (None, [1.0, 1.0, 1.0, 1.0], 1), (1100, [None, 1.0, 1.0, 1.0], 1)]
    rows += [(1150, [float("nan"), 1.0, 1.0, 1.0], 1), (1200, [float("inf"), 1.0, 1.0, 1.0], 1), (1250, [0.0] * 4, 2), (1251, [0.0] * 4, 3)]
    rows += [(0, [0.5, 0.5, 0.0, -0.25], 0)] * 3 + [(50, [9.0, 0.0, 0.0, 0.0], 9)]  # ids that repeat
    assert mined(spark, rows, part=4, slice_rows=16, members=2) == brute(rows)
    # of another length than most
    assert mined(spark, [*rows, (1300, [1.0], 1), (1350, [], 1)]) == brute(rows)


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=4) * 2.0**18).tolist(), int(rng.integers(3))) for i in range(200)]
    assert mined(spark, rows, 10) == brute(rows, 10)
    # too long for a score of 64 bits: no part
    assert mined(spark, [*rows, (300, [2.0**22] * 4, 1)], 10) == brute(rows, 10)


def test_empty_and_lonely(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0, 2.0], 1)]) == []
    assert mined(spark, [(0, [0.0, 0.0], 1), (1, [0.0, 0.0], 1), (2, [0.0, 0.0], 2)]) == brute([(0, [0.0, 0.0], 1), (1, [0.0, 0.0], 1), (2, [0.0, 0.0], 2)])


def test_scores_beyond_doubles_are_integers():
    a = np.array([[1 << 27, 3]], np.int64)
    assert integer_scores(a, a).tolist() == [[(1 << 54) + 9]]


def test_walk_ends_early_and_loses_nothing():
    v, labels = clustered(20_000, 64, 40, 0.04, 7)
    ints = np.floor(256 * v.astype(np.float64)).astype(np.int64)
    norm = np.sqrt((ints.astype(float) ** 2).sum(1))
    ids = np.arange(len(v))
    unit = units(ints.astype(float), norm)
    anchors = ids[::50]
    centres = spherical_centres(unit[anchors], 40)
    cell = (unit[anchors] @ centres.T).argmax(1)
    rows = {"id": ids, "label": labels, "v": ints, "norm": norm, "unit": unit}
    scored = 0
    for c in np.unique(cell):
        mine = anchors[cell == c]
        widest = float(np.arccos(np.clip(unit[mine] @ centres[c], -1, 1)).max())
        members = {"id": mine, "label": labels[mine], "v": ints[mine], "norm": norm[mine]}
        n = len(mine)
        seekers = {"member": np.arange(n), "low": np.full(n, LOWEST), "high": np.full(n, -LOWEST), "floor": np.full(n, LOWEST)}
        who, score, row, work = walk(members, seekers, rows, centres[c], widest, 5, True)
        scored += work
        scores = ints[mine] @ ints.T
        for i, a in enumerate(mine):
            same = ids[(labels == labels[a]) & (ids != a)]
            want = same[np.lexsort((same, -scores[i][same]))][:5]
            assert row[who == i].tolist() == want.tolist()
    # the lists end after a small share of the rows
    assert scored < 0.1 * len(anchors) * len(v)


def test_no_row_of_a_cell_is_beyond_its_reach():
    v, _ = clustered(3_000, 16, 10, 0.2, 9)
    norm = np.linalg.norm(v, axis=1) * np.random.default_rng(1).uniform(0.1, 3, len(v))
    unit = units(v.astype(float), np.linalg.norm(v, axis=1))
    centres = spherical_centres(unit, 10)
    cell = (unit @ centres.T).argmax(1)
    angle = np.arccos(np.clip((unit * centres[cell]).sum(1), -1, 1))
    numbers = np.unique(cell)
    cells = {"cell": numbers, "widest": np.array([angle[cell == c].max() for c in numbers])}
    cells |= {"longest": np.array([norm[cell == c].max() for c in numbers]), "shortest": np.array([norm[cell == c].min() for c in numbers])}
    widest = np.array([angle[cell == c].max() if (cell == c).any() else 0.0 for c in range(len(centres))])
    bound = reach(centres, widest, cells)
    scores = unit @ (unit * norm[:, None]).T
    for x, c in enumerate(numbers):
        assert (scores[:, cell == c].max(1) <= bound[cell, x]).all()
