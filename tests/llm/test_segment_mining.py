"""Segment bounds, and mined negatives against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cytoframe.llm.segment_mining import NO, Side, mine, scored_pairs, summaries

SCHEMA = "vec_id long, label int, v array<long>, place long, anchor string, score string, slot int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 5, "x", "y", 1) for r in rows], SCHEMA)


def brute(rows, positives=5, negatives=5, percent=80):
    held = [(k, *r) for k, r in enumerate(rows) if None not in r[:3] and None not in r[2]]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for k, i, label, v in held:
        if i % 10:
            continue
        others = sorted((-dot(v, w), j, m == label) for n, j, m, w in held if n != k)
        for s, j, _ in [o for o in others if o[2]][:positives]:
            fits = [(-t, n) for t, n, same in others if not same and percent * -s <= 100 * -t <= 100 * -s][:negatives]
            out += [(i, j, rank, n, -s, t) for rank, (t, n) in enumerate(fits, 1)]
    return sorted(out)


def mined(spark, rows, **options):
    return sorted(tuple(r) for r in mine(frame(spark, rows), F.col("vec_id") % 10 == 0, **options).collect())


def test_bounds_hold_and_levels_refine():
    rng = np.random.default_rng(0)
    make = lambda n: (rng.integers(-300, 300, (n, 1)) + rng.integers(-40, 40, (n, 64)))
    side = lambda v: Side(np.arange(len(v)), np.arange(len(v)), np.zeros(len(v), int), v.astype(np.int32), *(x.astype(float) for x in summaries(v)))
    a, b = make(40), make(500)
    truth = a @ b.T
    low = np.sort(truth, axis=1)[:, -20]
    counts = []
    ai, bi, score = scored_pairs(side(a), side(b), np.ones((40, 500), bool), low, counts=counts)
    assert (score == truth[ai, bi]).all()
    assert set(zip(*np.nonzero(truth >= low[:, None]), strict=True)) <= set(zip(ai, bi, strict=True))
    assert counts[0] == 20_000 > counts[1] >= counts[2] >= 40 * 20
    ai, bi, _ = scored_pairs(side(a), side(b), np.ones((40, 500), bool), np.full(40, NO), low)
    assert set(zip(*np.nonzero(truth <= low[:, None]), strict=True)) <= set(zip(ai, bi, strict=True)) and len(ai) < 20_000


@pytest.mark.parametrize("options", [{}, {"per_pass": 3, "sample_rows": 40}, {"positives": 2, "negatives": 9, "percent": 30}])
def test_mined_as_brute_force(spark, options):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(4, 20)) * 60
    rows = [(i, int(i % 4), (centres[i % 4] * rng.uniform(0.2, 1.2) + rng.normal(size=20) * 40).astype(int).tolist()) for i in range(-5, 200)]
    limits = {k: v for k, v in options.items() if k in ("positives", "negatives", "percent")}
    assert mined(spark, rows, **options) == brute(rows, **limits)


def test_awkward_rows(spark):
    rows = [(None, 1, [1, 2]), (10, None, [1, 2]), (20, 1, None), (30, 1, [1, None]), (40, 1, [3, 4]), (40, 1, [3, 4]), (40, 1, [3, 4]), (41, 1, []), (42, 2, [3, 4]), (42, 2, [3, 4]), (43, 2, [2, 3, 9]),
            (50, 2, [-1, -1]), (51, 2, [1, 0]), (60, 3, [0, 0]), (61, 3, [5, 5]), (62, 2, [7, -7])]
    assert mined(spark, rows) == brute(rows)


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, i % 3, rng.integers(-(1 << 28), 1 << 28, 33).tolist()) for i in range(80)]
    assert mined(spark, rows) == brute(rows)


def test_empty_table_and_no_anchor(spark):
    assert mined(spark, []) == [] and mined(spark, [(1, 1, [1, 2]), (2, 2, [1, 2])]) == []
