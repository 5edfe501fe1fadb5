"""Exact top-k search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from duelspark.llm import topk

VECTORS = "vec_id bigint, embedding array<float>, label int"


def brute(rows, is_query, k, scale=256.0):
    vectors = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            vectors.setdefault(i, set()).add(tuple(float(np.floor(np.float64(np.float32(x)) * scale)) for x in v))
    product = lambda a, b: sum(int(x) * int(y) for x, y in zip(a, b))
    out = {}
    for q in vectors:
        if is_query(q):
            scores = [(-max(product(a, b) for a in vectors[q] for b in vectors[d]), d) for d in vectors if d != q]
            for rank, (s, d) in enumerate(sorted(scores)[:k], 1):
                out[q, rank] = d, max(-topk.LARGEST, min(topk.LARGEST, -s))
    return out


def search(spark, rows, every, k, **settings):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).withColumn("v", F.lit("clash")).withColumn("block", F.lit(1))
    found = topk.top_k(df, F.col("vec_id") % every == 0, k, **settings).collect()
    return {(r.query_id, r.rank): (r.vec_id, r.score) for r in found}


@pytest.mark.parametrize("kind", ["spread", "clusters", "copies"])
def test_against_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(topk, "BLOCK_VALUES", 64 * 8)
    rng = np.random.default_rng(3)
    points = rng.normal(size=(400, 8))
    if kind == "clusters":
        points = rng.normal(size=(10, 8))[rng.integers(0, 10, 400)] * 3 + 0.05 * points
    if kind == "copies":
        points[100:300] = points[0]
    rows = [(n, [float(x) for x in p]) for n, p in enumerate(points)]
    assert search(spark, rows, 7, 5) == brute(rows, lambda i: i % 7 == 0, 5)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [1.0, 2.0]), (5, [1.0, 2.0]),
        (10, [0.5]), (6, []), (7, [0.1, 0.2, 0.3]), (None, [1.0, 1.0]), (20, [-1.0, -1.0]), (8, [1.0, 2.0]), (0, [3.0, 0.0]),
    ]
    assert search(spark, rows, 10, 3) == brute(rows, lambda i: i % 10 == 0, 3)
    assert search(spark, rows[:1], 10, 3) == {}
    assert search(spark, [(1, [1.0])], 10, 3) == {}
    assert search(spark, [(1, None)], 1, 3) == {}


@pytest.mark.parametrize("values", [1 << 17, 64 * 2])
def test_repeated_ids_take_one_place(spark, monkeypatch, values):
    monkeypatch.setattr(topk, "BLOCK_VALUES", values)
    rows = [(0, [1.0, 0.0])] + [(1, [100.0 + n, 1.0]) for n in range(90)] + [(n, [float(n), 0.0]) for n in range(2, 90)]
    assert search(spark, rows, 1000, 4) == brute(rows, lambda i: i == 0, 4)
    again = rows + [(0, [0.5, float(n)]) for n in range(90)]
    assert search(spark, again, 1000, 4) == brute(again, lambda i: i == 0, 4)


def test_large_numbers_stop_at_the_limit(spark):
    rows = [(0, [3e30, 1.0]), (1, [3e30, 1.0]), (2, [-3e30, 1.0]), (3, [1e9, 7.0]), (4, [123456.789, 1.0])]
    assert search(spark, rows, 1, 4) == brute(rows, lambda i: True, 4)


def test_trees_cover_and_separate():
    points = np.random.default_rng(1).normal(size=(300, 3))
    tree = topk.Tree(topk.grow(np.arange(300), points))
    assert sorted(tree.ids.tolist()) == list(range(300)) and np.allclose(tree.points, points[tree.ids])
    for node in range(len(tree.low)):
        part = tree.points[tree.low[node] : tree.high[node]]
        away = np.linalg.norm(part - tree.points[tree.center[node]], axis=1)
        assert away.max() <= tree.radius[node] + 1e-9
        children = np.arange(tree.first[node], tree.past[node])
        if len(children):
            assert tree.low[children[0]] == tree.low[node] and tree.high[children[-1]] == tree.high[node]
            assert (tree.radius[children] <= tree.radius[node] / 2 + 1e-9).all()
            centers = tree.points[tree.center[children]]
            apart = np.linalg.norm(centers[:, None] - centers[None], axis=2) + 1e9 * np.eye(len(children))
            assert apart.min() > tree.radius[node] / 2


def test_walk_prunes_clustered_data():
    rng = np.random.default_rng(2)
    points = np.repeat(rng.normal(size=(20, 6)) * 2560, 50, axis=0) + rng.integers(-20, 20, size=(1000, 6))
    data = topk.Tree(topk.grow(np.arange(1000), np.floor(points)))
    queries = topk.Tree(topk.grow(np.arange(0, 1000, 10), np.floor(points[::10])))
    seen = []
    walk = topk.Walk.__new__(topk.Walk)
    take = topk.Walk.take
    walk.take = lambda low, high, rows: (seen.append((high - low) * len(rows)), take(walk, low, high, rows))
    walk.__init__(queries, data, 5, np.full(100, -np.inf))
    assert sum(seen) < 0.5 * 100 * 1000
    for n, q in enumerate(queries.ids):
        scores = np.delete(np.floor(points) @ np.floor(points[q]), q).astype(np.int64)
        assert walk.best[n][0].tolist() == sorted(scores.tolist(), reverse=True)[:5]


def test_blocks_of_far_cells_are_not_sent(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_VALUES", 64)
    sent, walked = [], topk._walked
    monkeypatch.setattr(topk, "_walked", lambda pairs, *rest: sent.append(pairs.count()) or walked(pairs, *rest))
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(30, 4)) * 40
    rows = [(n, [float(x) for x in centers[n % 30] + 0.01 * rng.normal(size=4)]) for n in range(3000)]
    assert search(spark, rows, 10, 5) == brute(rows, lambda i: i % 10 == 0, 5)
    # At least 3000 / 64 blocks, and two groups of queries in each of three clusters.
    assert sum(sent) < 0.3 * (3000 // 64) * 6, sent


def test_digits_sort_like_their_numbers():
    rng = np.random.default_rng(8)
    numbers = [int(a) * 10 ** int(b) + int(c) for a, b, c in zip(rng.integers(-9, 9, 200), rng.integers(0, 40, 200), rng.integers(-9, 9, 200))]
    assert all(topk.joined(topk.digits(x, 4)) == x for x in numbers)
    assert sorted(numbers) == [topk.joined(d) for d in sorted(topk.digits(x, 4) for x in numbers)]
