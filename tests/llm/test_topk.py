"""Exact top-k against all products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from carelake.llm import cover_tree, topk


def brute(rows, queries, k, scale=64):
    usable = [
        (i, [math.floor(scale * x) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for n, (q, own) in enumerate(usable):
        if q in queries:
            scores = sorted((-sum(a * b for a, b in zip(own, v)), i) for m, (i, v) in enumerate(usable) if m != n)
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def found(spark, rows, k=5, every=3, **blocks):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    vectors = df.select("vec_id", topk.whole_numbers(df["embedding"], 64).alias("vector"))
    got = topk.search(vectors, F.col("vec_id") % every == 0, k=k, **blocks)
    return sorted(tuple(r)[:4] for r in got.collect())


def f32(x):
    return float(np.float32(x))


@pytest.mark.parametrize("blocks", [{}, {"query_block": 20, "data_block": 30}])
def test_clusters_copies_and_ties(spark, blocks):
    rng = random.Random(1)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i, [f32(c + rng.gauss(0, 0.1)) for c in rng.choice(centres)]) for i in range(240)]
    rows += [(i, rows[0][1]) for i in range(300, 400)] + [(500, [0.0] * 6)]
    assert found(spark, rows, **blocks) == brute(rows, [i for i, _ in rows if i % 3 == 0], 5)


def test_awkward_vectors(spark):
    rows = [(0, [1.0, 2.0]), (3, None), (6, [1.0, None]), (9, [float("nan"), 1.0]), (12, [float("inf"), 1.0]), (None, [5.0, 5.0]),
            (15, []), (18, [1.0]), (1, [-0.01, 0.01]), (2, [2.0, 1.0]), (2, [2.0, 1.0]), (21, [1.0, 2.0]), (21, [0.5, 9.0]), (21, [0.5, 9.0])]
    assert found(spark, rows, k=3) == brute([(i, v if v is None else v + [0.0] * (2 - len(v))) for i, v in rows], [0, 15, 18, 21], 3)
    assert found(spark, rows[:1]) == [] and found(spark, rows[:0]) == []


def test_scores_beyond_doubles(spark):
    rows = [(i, [f32(2.0**21 + 64 * i), f32(2.0**22 + 64 * i + 1)]) for i in range(9)]
    assert found(spark, rows) == brute(rows, [0, 3, 6], 5)
    large, four = (cover_tree.build(np.array([1]), np.array([[n, n]])) for n in (2**62, 4))
    assert cover_tree.products(large, 0, 1, four, 0, 1).tolist() == [[2**63 - 1]]


def test_a_tree_covers_its_members():
    rng = np.random.default_rng(0)
    points = rng.integers(-60, 60, size=(700, 5))
    points[100:300] = points[100]
    tree = cover_tree.build(np.arange(700), points, leaf=20, fan_out=4)
    assert sorted(tree.ids.tolist()) == list(range(700))
    for n, own in enumerate(tree.children):
        inside = tree.points[tree.lo[n] : tree.hi[n]]
        away = np.sqrt(((inside - tree.centre[n]) ** 2).sum(axis=1))
        assert away.max() <= tree.radius[n] + 1e-9
        if own:
            runs = sorted((tree.lo[c], tree.hi[c]) for c in own)
            assert [runs[0][0], *(hi for _, hi in runs)] == [*(lo for lo, _ in runs), tree.hi[n]] and len(own) > 1


def test_pruning_leaves_products_out():
    rng = np.random.default_rng(1)
    centres = rng.integers(-2000, 2000, size=(20, 8))
    points = centres[rng.integers(0, 20, 6000)] + rng.integers(-20, 20, size=(6000, 8))
    ids = np.arange(6000)
    queries, data = cover_tree.build(ids[::20], points[::20], leaf=16), cover_tree.build(ids, points, leaf=64)
    best, multiplied = cover_tree.top_k(queries, data, 10)
    assert multiplied < 0.3 * 300 * 6000
    scores = points[::20] @ points.T
    for row, q in enumerate(queries.ids):
        own = sorted((-s, i) for i, s in enumerate(scores[q // 20]) if i != q)[:10]
        assert list(zip(best.scores[row], best.ids[row])) == [(-s, i) for s, i in own]
