"""Vector codes against plain rounds over all distances."""

import hashlib
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from duelspark.llm import vector_codes

VECTORS = "vec_id bigint, embedding array<float>, label int"


def plain(rows, parts=4, entries=256, rounds=4, scale=1024.0):
    """The contract in unbounded whole numbers: rows (vec_id, code, error, label_error, sha)."""
    good = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    whole = [(i, [int(np.floor(np.float64(np.float32(x)) * scale)) for x in v], label) for i, v, label in good]
    width = -(-max((len(v) for _, v, _ in whole), default=0) // parts)
    whole = [(i, v + [0] * (parts * width - len(v)), label) for i, v, label in whole]
    first = sorted(whole, key=lambda r: (r[0] is None, r[0], r[1]))[:entries]
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    place = lambda x, book: min((away(x, c), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p, book in enumerate(books):
            members = {}
            for _, v, _ in whole:
                members.setdefault(place(cut(v, p), book)[1], []).append(cut(v, p))
            books[p] = [[sum(c) // len(members[e]) for c in zip(*members[e])] if e in members else book[e] for e in range(len(book))]
    found = [[place(cut(v, p), books[p]) for p in range(parts)] for _, v, _ in whole]
    errors = [sum(min(d, vector_codes.LARGEST) for d, _ in f) for f in found]
    of = {}
    for (_, _, label), e in zip(whole, errors):
        of[label] = of.get(label, 0) + e
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    most = lambda e: min(e, vector_codes.LARGEST)
    return sorted(
        ((i, "".join(f"{e:02x}" for _, e in f), most(e), most(of[label]), sha) for (i, _, label), f, e in zip(whole, found, errors)),
        key=repr,
    )


def coded(spark, rows, **settings):
    df = spark.createDataFrame(rows, VECTORS).withColumn("code", F.lit("clash")).withColumn("at", F.lit(1)).withColumn("v", F.lit(2))
    return sorted((tuple(r) for r in vector_codes.compress(df, **settings).collect()), key=repr)


@pytest.mark.parametrize("kind", ["spread", "clusters", "copies", "grid"])
def test_against_plain_rounds(spark, monkeypatch, kind):
    monkeypatch.setattr(vector_codes, "BLOCK_VALUES", 64)
    rng = np.random.default_rng(4)
    points = rng.normal(size=(400, 8)) * 0.2
    if kind == "clusters":
        points = rng.normal(size=(12, 8))[rng.integers(0, 12, 400)] + points * 0.01
    if kind == "copies":
        points[50:300] = points[7]
    if kind == "grid":
        points = rng.integers(-2, 3, size=(400, 8)) / 1024  # many ties
    rows = [(int(n), [float(x) for x in p], int(n % 3) if n % 5 else None) for n, p in enumerate(points)]
    rng.shuffle(rows)
    rows = [(int(n), [float(x) for x in v], None if l is None else int(l)) for n, v, l in rows]
    assert coded(spark, rows, entries=32) == plain(rows, entries=32)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (3, [0.5, -0.5, 0.25, 1.0, 2.0], 1), (1, None, 1), (2, [1.0, None], 1), (4, [nan, 1.0], 2), (5, [inf], 2), (6, [], None),
        (7, [0.1], None), (7, [0.1], None), (7, [-0.1, 3.0], 4), (None, [1.0, 1.0, 1.0, 1.0], 4), (-9, [-0.0001] * 5, 1),
    ]
    assert coded(spark, rows, entries=3) == plain(rows, entries=3)
    assert coded(spark, rows) == plain(rows)
    assert coded(spark, rows[1:3]) == [] and coded(spark, []) == []
    assert [r[:4] for r in coded(spark, [(1, [], 5), (2, [], None)])] == [(1, "00000000", 0, 0), (2, "00000000", 0, 0)]


def test_numbers_beyond_double_precision(spark):
    rows = [(n, [3e30 * (n % 3), -2.5e30 * (n % 4), 1e12 + n * 1e6, 1e-3 * n], n % 2) for n in range(40)]
    assert coded(spark, rows, entries=4) == plain(rows, entries=4)
    middle = [(n, [1e5 * (n % 7), 2e5, -3e5 * (n % 2), float(n)], 1) for n in range(60)]
    assert coded(spark, middle, entries=5) == plain(middle, entries=5)


@pytest.mark.parametrize("bits,dims", [(1, 5), (2, 3), (4, 2), (5, 1)])
def test_hilbert_keys_walk_to_neighbours(bits, dims):
    grid = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = vector_codes.hilbert_keys(grid, bits)
    assert len(set(keys)) == len(grid)
    walk = grid[sorted(range(len(grid)), key=keys.__getitem__)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_shortlists_hold_every_nearest_entry():
    rng = np.random.default_rng(6)
    saved = 0
    for _ in range(200):
        book = rng.integers(-50, 50, size=(30, 3)).astype(float)
        points = rng.integers(-50, 50, size=3) + rng.integers(-9, 9, size=(20, 3)).astype(float)
        picked = vector_codes.shortlist(points.min(axis=0), points.max(axis=0), book)
        at, away = vector_codes.nearest(points, book[picked])
        every = ((points[:, None] - book[None]) ** 2).sum(axis=2)
        assert (picked[at] == every.argmin(axis=1)).all() and (away == every.min(axis=1)).all()
        saved += len(book) - len(picked)
    assert saved > 200 * 10
