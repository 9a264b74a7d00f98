import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from blotterflow.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """rows: (vec_id, vector, label). The result as a sorted list."""
    good = []
    for i, v, label in rows:
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.append((i, [max(-hn.LIMIT, min(hn.LIMIT, math.floor(256 * float(np.float32(x))))) for x in v], label))
    out = []
    last = lambda i: (i is None, i or 0)
    for n, (i, v, label) in enumerate(good):
        if i is None or i % 50:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, other) for m, (j, w, other) in enumerate(good) if m != n]
        scored.sort(key=lambda s: (-s[0], last(s[1])))
        for ps, p, _ in [s for s in scored if s[2] == label][:5]:
            near = [s for s in scored if s[2] != label and 50 * ps <= 100 * s[0] <= 95 * ps][:3]
            out += [(i, p, k + 1, s[1], ps, s[0]) for k, s in enumerate(near)]
    return sorted(out, key=str)


def run(spark, rows, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema)
    got = hn.hard_negatives(df, F.col("vec_id") % 50 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, got.collect()), key=str)


def vectors(seed, n, dims, hot=0.33, size=0.3):
    pick = random.Random(seed)
    centers = [[pick.gauss(0, size) for _ in range(dims)] for _ in range(4)]
    rows = []
    for i in range(n):
        label = 1 if pick.random() < hot else pick.randrange(4)
        base = centers[pick.randrange(4)]
        rows.append((i, [float(np.float32(x + pick.gauss(0, size / 2))) for x in base], label))
    return rows


@pytest.mark.parametrize("seed,dims", [(1, 8), (2, 64)])
def test_as_brute_force(spark, monkeypatch, seed, dims):
    monkeypatch.setattr(hn, "PAGE_ROWS", 37)
    monkeypatch.setattr(hn, "BLOCK_ROWS", 3)
    rows = vectors(seed, 400, dims)
    want = brute(rows)
    assert want and run(spark, rows) == want


def test_ties_and_repeated_rows(spark):
    rows = [(i, [float(i % 3), 1.0], i % 2) for i in range(120)]
    rows += [(50, [2.0, 1.0], 0)] * 2 + [(7, [1.0, 1.0], 1), (None, [2.0, 1.0], 0), (None, [1.0, 0.5], 1)]
    want = brute(rows)
    assert want and run(spark, rows) == want


def test_odd_rows(spark):
    rows = vectors(3, 120, 4)
    rows += [(200, None, 1), (250, [1.0, 2.0, None, 0.0], 1), (300, [float("nan")] * 4, 1), (350, [float("inf")] * 4, 0)]
    rows += [(400, [1.0, 2.0, 0.5, 0.0], None), (450, [], 1), (500, [0.5, 0.25], 1), (550, [0.1] * 9, 2), (600, [1e30, 0.0], 1)]
    assert run(spark, rows) == brute(rows)


def test_empty_and_extra_columns(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0], 1), (2, [2.0], 2)]) == []
    rows = [(*r, "x", 5, 6) for r in vectors(5, 150, 4)]
    got = run(spark, rows, SCHEMA + ", rank string, row int, anchor_id int")
    assert got == brute([r[:3] for r in rows])


@pytest.mark.parametrize("size,dims", [(100, 64), (1 << 12, 64), (1 << 26, 5), (1 << 26, 3000)])
def test_packed_products_are_exact(size, dims):
    pick = np.random.default_rng(size + dims)
    a = pick.integers(-size, size + 1, (7, dims)).astype(np.int32)
    c = pick.integers(-size, size + 1, (50, dims)).astype(np.int32)
    packing = hn.fields(int(c.min()), int(c.max()), int(np.abs(a.astype(np.int64)).sum(axis=1).max()))
    assert (packing.scores(a, packing.pack(c), 50) == a.astype(np.int64) @ c.astype(np.int64).T).all()
    assert packing.count > 1 or 32 < packing.width <= 64


def test_bounds_of_negatives():
    for p in (*range(-3, 300), 10**17 + 3):
        best = hn.Nearest(np.array([[p] * hn.POSITIVES]))
        for s in (*range(-3, 300), p // 2, p * 95 // 100, p * 95 // 100 + 1):
            assert (best.low[0, 0] <= s <= best.high[0, 0]) == (50 * p <= 100 * s <= 95 * p)
