"""Exact search against all products."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayfare.llm import topk


def plain(rows, k=5):
    fine = [(i, [math.floor(256.0 * float(np.float32(x))) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    found = []
    for at, (qid, q) in enumerate(fine):
        if qid % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), i) for j, (i, v) in enumerate(fine)
                            if j != at and len(v) == len(q))
            found += [(qid, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(found)


@pytest.mark.parametrize("seed, n, dim, block", [(1, 900, 16, 1024), (2, 400, 3, 3), (3, 4, 8, 10)])
def test_against_all_products(spark, seed, n, dim, block):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=dim).round(2 if seed == 2 else 6).tolist()) for i in range(n)]
    rows += [(2000 + i, rows[1][1]) for i in range(30)]  # ties
    rows += [(3000, None), (3050, []), (3100, [None] * dim), (3150, [math.nan] * dim), (3200, [math.inf] * dim),
             (None, rows[0][1]), (3250, [0.0] * dim), (3300, [0.5]), (3301, [0.25]), (3350, [1e6] * dim),
             rows[0], (4001, rows[2][1]), (4001, rows[2][1])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, score string, rank int")
    got = topk.top_k(df.repartition(5), F.col("vec_id") % 50 == 0, block_queries=block)
    assert sorted(map(tuple, got.collect())) == plain(rows)


@pytest.mark.parametrize("block", [1, 2, 1024])
def test_repeated_ids_with_unlike_vectors(spark, block):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=6).round(3).tolist()) for i in [0] * 4 + [50] * 3 + [100, 150, 200, 7, 8, 8, 9]]
    rows += [rows[0], rows[5], rows[12]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.top_k(df.repartition(3), F.col("vec_id") % 50 == 0, block_queries=block)
    assert sorted(map(tuple, got.collect())) == plain(rows)


def test_bounds_spare_products():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 32)) * 300
    vectors = np.floor(centres[rng.integers(0, 40, 6000)] + rng.normal(size=(6000, 32)) * 10)
    pivots = topk.Pivots(topk.choose_pivots(vectors[:1000], topk.PIVOTS), (vectors**2).sum(1).max() * (1 + 1e-9))
    best = topk.Best(20, 5)
    evaluated = topk.search_rows(best, np.arange(20), np.arange(20), vectors[:20], pivots, np.arange(6000),
                                 np.arange(6000), vectors,
                                 pivots.of_stored(vectors))
    assert evaluated < 20 * 6000 / 4
    for q in range(20):
        scores = vectors @ vectors[q]
        scores[q] = -np.inf
        want = np.lexsort((np.arange(6000), -scores))[:5]
        assert best.ids[q].tolist() == want.tolist()


def test_empty_table(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(none, F.col("vec_id") % 50 == 0).collect() == []
