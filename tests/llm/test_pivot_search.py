"""Operator 9 against all inner products."""

from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import functions as F

from ordermill.llm import pivot_search
from ordermill.llm.pivot_search import best_of_block, distances, top_inner_products

SCHEMA = "vec_id long, embedding array<float>, score string, part int"


def brute(rows, k):
    usable = {
        (i, tuple(math.floor(1024 * float(np.float32(x))) for x in v))
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) and abs(x) < 1e5 for x in v)
    }
    out = []
    for q in sorted({i for i, _ in usable if i % 10 == 0}):
        best = {}
        for j, v in usable:
            for i, w in usable:
                if i == q and j != q and len(v) == len(w):
                    s = sum(a * b for a, b in zip(v, w, strict=True))
                    best[j] = max(best.get(j, s), s)
        top = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
        out += [(q, n, j, s) for n, (j, s) in enumerate(top, 1)]
    return out


def got(spark, rows, k):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    out = top_inner_products(df, F.col("vec_id") % 10 == 0, k=k, n_pivots=4)
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in out.collect())


def corpus():
    rnd = random.Random(4)
    centres = [[rnd.gauss(0, 1) for _ in range(8)] for _ in range(4)]
    rows = [(i, [x + rnd.gauss(0, 0.2) for x in rnd.choice(centres)]) for i in range(150)]
    rows += [(i, rows[20][1]) for i in range(200, 230)]
    rows += [(300, None), (301, []), (302, [1.0, None]), (303, [float("nan")] * 8), (304, [float("inf")] * 8), (305, [1e30] * 8)]
    return rows + [(310, [0.5, 0.5]), (311, [1.0, -1.0]), (None, rows[0][1]), rows[10], rows[11], (10, rows[12][1])]


def test_equals_all_products(spark, monkeypatch):
    rows = corpus()
    assert got(spark, rows, 5) == brute(rows, 5)
    monkeypatch.setattr(pivot_search, "BLOCK_CANDIDATES", 40)
    monkeypatch.setattr(pivot_search, "BLOCK_QUERIES", 5)
    assert got(spark, rows, 500) == brute(rows, 500)


def test_empty_table_and_lone_query(spark):
    assert got(spark, [], 5) == []
    assert got(spark, [(10, [1.0, 2.0])], 5) == []


def test_bounds_stop_early():
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 300, (20, 16))
    vectors = np.floor(centres[rng.integers(0, 20, 4000)] + rng.normal(0, 20, (4000, 16))).astype(np.int64)
    points = vectors.astype(float)
    most = float((points**2).sum(1).max())
    extra = np.sqrt(most - (points**2).sum(1))
    table = distances(points, extra, points[:20], extra[:20])
    q = vectors[5]
    best, seen = best_of_block(
        np.arange(4000), vectors, table, 5, q, distances(q[None].astype(float), np.zeros(1), points[:20], extra[:20])[0],
        most, 10,
    )
    scores = vectors @ q
    scores[5] = -(10**12)
    assert best == [(int(scores[i]), int(i)) for i in np.lexsort((np.arange(4000), -scores))[:10]]
    assert seen < 4000


def test_large_components_are_exact(spark):
    rnd = random.Random(8)
    rows = [(i, [float(rnd.randrange(-(2**9), 2**9)) for _ in range(8)]) for i in range(60)]
    rows += [(61, [300_000.0] * 8), (70, [float(2**18)] + [0.0] * 7), (72, [0.0] * 7 + [float(2**30)])]
    want = []
    for q, v in rows:
        if q % 10 == 0:
            products = [(-sum(int(a * 1024) * int(b * 1024) for a, b in zip(v, w)), i) for i, w in rows if i != q]
            want += [(q, n, i, -s) for n, (s, i) in enumerate(sorted(products)[:5], 1)]
    assert {i for _, _, i, _ in want} >= {61, 72}
    assert got(spark, rows, 5) == sorted(want)


def test_products_beyond_64_bits_do_not_wrap():
    vectors = np.array([[2**28 - 1] * 256, [1] * 256, [-(2**28)] * 256], np.int64)
    best, _ = best_of_block(np.arange(3), vectors, np.zeros((3, 1)), 9, vectors[0], np.zeros(1), 1e30, 3)
    exact = sum(c * c for c in vectors[0].tolist())
    assert exact > 2**63 and best[0] == (exact, 0) and [i for _, i in best] == [0, 1, 2]
