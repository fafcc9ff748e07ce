import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import filedrop.llm.hard_negatives as module
from filedrop.llm.hard_negatives import Best, hard_negatives, scores, trees

SCHEMA = "vec_id bigint, embedding array<double>, label int, anchor_id string, vector string"


def brute(rows, is_anchor, positives=5, negatives=3, window=(50, 95, 100)):
    """From rows of id, vector, label."""
    low, high, of = window
    kept = []
    for i, v, c in rows:
        if i is None or v is None or c is None or any(x is None or not math.isfinite(256.0 * x) for x in v):
            continue
        kept.append((i, tuple(math.floor(256.0 * x) for x in v), c))
    out = []
    for i, v, c in sorted({r for r in kept if is_anchor(r[0])}):
        met = sorted((-max(min(sum(x * y for x, y in zip(v, w)), 2**63 - 1), -(2**63)), j, d)
                     for j, w, d in kept if j != i and len(w) == len(v))
        for s, j, _ in [m for m in met if m[2] == c][:positives]:
            fits = [(t, k) for t, k, d in met if d != c and low * -s <= of * -t <= high * -s][:negatives]
            out += [(i, j, r + 1, k, -s, -t) for r, (t, k) in enumerate(fits)]
    return sorted(out)


def found(spark, rows, anchors="vec_id % 5 = 0", **limits):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in hard_negatives(df, F.expr(anchors), **limits).collect())


def clustered(n, rng, dims=8, spread=0.05):
    centres = [[rng.uniform(-1, 1) for _ in range(dims)] for _ in range(4)]
    return [
        (i, [x + rng.gauss(0, spread) for x in rng.choice(centres)], rng.randrange(4)) for i in range(n)
    ]


def test_rows_equal_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    # Coarse components give many ties; labels cross the clusters.
    rows = clustered(300, rng) + [(1000 + i, [rng.randrange(-2, 3) / 256 for _ in range(8)], rng.randrange(3)) for i in range(200)]
    want = brute(rows, lambda i: i % 5 == 0)
    assert found(spark, rows) == want and len(want) > 500
    monkeypatch.setattr(module, "BLOCK", 64)
    monkeypatch.setattr(module, "TREE", 7)
    assert found(spark, rows) == want
    assert found(spark, rows, positives=2, negatives=4, window=(1, 2, 3)) == brute(rows, lambda i: i % 5 == 0, 2, 4, (1, 2, 3))


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [0.9, 0.1], 1), (1, [0.9, 0.1], 1), (2, [0.7, 0.3], 2), (2, [0.7, 0.3], 2),
        (3, None, 1), (4, [0.8, None], 2), (5, [0.8, nan], 1), (6, [0.8, inf], 2), (7, [0.8, -1.7e308], 2), (None, [0.8, 0.0], 2),
        (8, [0.8, 0.2], None), (9, [0.8], 2), (10, [], 1), (15, [], 1), (20, [], 2), (25, [1.0, 0.0], 1), (30, [0.85, 0.0], 3),
        (35, [-1.0, 0.0], 1),
    ]
    got = found(spark, rows)
    assert got == brute(rows, lambda i: i % 5 == 0)
    assert (0, 1, 1, 30, 256 * 230, 256 * 217) in got and got.count((0, 1, 2, 2, 256 * 230, 256 * 179)) == 2
    # Equal scores of zero lie in a window of zero width.
    assert (10, 15, 1, 20, 0, 0) in got
    assert found(spark, [(1, [1.0], 1)]) == [] and found(spark, []) == []
    assert found(spark, rows, anchors="cast(null as boolean)") == []


@pytest.mark.parametrize("size", [1.0, 2.0**12, 2.0**25, 2.0**40])
def test_scores_are_exact_at_any_size(spark, size):
    rng = random.Random(int(size))
    rows = [(i, [rng.uniform(0.5, 1) * size for _ in range(5)], i % 3) for i in range(40)]
    assert found(spark, rows, window=(1, 99, 100)) == brute(rows, lambda i: i % 5 == 0, window=(1, 99, 100))


def test_bounds_spare_scores_and_lose_none(monkeypatch):
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 200, (3, 16)).round()
    a = (centres[rng.integers(0, 3, 120)] + rng.normal(0, 3, (120, 16))).round()
    x = (centres[rng.integers(0, 3, 500)] + rng.normal(0, 30, (500, 16))).round()
    (tree,) = trees(np.arange(120), np.zeros(120, np.int64), list(a))
    whole = a[tree.number] @ x.T
    products = []
    monkeypatch.setattr(module, "scores", lambda p, q: products.append(len(p)) or scores(p, q))
    low, high = np.full(120, int(whole.max() * 0.9)), np.full(120, int(whole.max() * 0.95))
    got = sorted(zip(*(v.tolist() for v in tree.within(x, low, high))))
    r, c = np.nonzero((whole >= low[0]) & (whole <= high[0]))
    assert got == sorted(zip(r.tolist(), c.tolist(), whole[r, c].astype(int).tolist())) and len(got) > 100
    assert sum(products) < 60


def test_best_keeps_the_first_of_ties():
    best = Best(2)
    for score, ids in (([5, 5], [9, 8]), ([5, 7], [1, 4])):
        best.add(np.zeros(2, np.int64), np.array(score), np.array(ids))
    assert best.score.tolist() == [7, 5] and best.id.tolist() == [4, 1] and best.least(2).tolist() == [5, -(2**63)]
