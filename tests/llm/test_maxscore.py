"""Exact top-k search against a plain version."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from poolspark.llm import maxscore

ROWS = "vec_id long, embedding array<double>, score string, query long"


def plain(rows, k=5, every=50):
    own = [(i, [math.floor(256 * x) for x in v]) for i, v, *_ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v in own:
        if i is not None and i % every == 0:
            found = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), j is None, j or 0) for j, w in own if j != i)[:k]
            out += [(i, r, None if null else j, -s) for r, (s, null, j) in enumerate(found, 1)]
    return sorted(out, key=repr)


def top(spark, rows, **options):
    df = spark.createDataFrame(rows, ROWS).repartition(3) if rows else spark.createDataFrame([], ROWS)
    got = maxscore.top(df, **options)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def random_rows(n, width, seed, zeros=0.0):
    rng = random.Random(seed)
    return [(i, [0.0 if rng.random() < zeros else rng.gauss(0, 0.2) for _ in range(width)], "x", 1) for i in range(n)]


@pytest.mark.parametrize("zeros", [0.0, 0.95])
def test_search_matches_the_plain_version(spark, zeros):
    rows = random_rows(400, 24, 3, zeros)
    assert top(spark, rows) == plain(rows)


def test_ties_and_copies(spark):
    rng = random.Random(4)
    rows = [(i, [float(rng.choice([-1, 0, 1])) for _ in range(3)], "x", 1) for i in range(300)]
    rows += [(1000 + i, [1.0, 1.0, 1.0], "x", 1) for i in range(200)]
    assert top(spark, rows) == plain(rows)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -1.0], "x", 1), (50, None, "x", 1), (100, [], None, None), (150, [nan], "x", 1), (200, [1.0, None], "x", 1), (1, [inf, 1.0], "x", 1), (2, [0.5], "x", 1), (3, [0.5, 0.25, 7.0], "x", 1)]
    rows += [(None, [0.5], "x", 1), (None, [1.0, 2.0], "x", 1), (0, [1.0, -1.0], "x", 1), (0, [0.0, 3.0], "x", 1), (250, [-0.001, 0.001], "x", 1), (4, [0.5], "x", 1), (4, [0.5], "x", 1)]
    assert top(spark, rows) == plain(rows)


def test_few_rows(spark):
    assert top(spark, []) == []
    assert top(spark, [(0, [1.0], "x", 1)]) == []
    rows = [(0, [1.0], "x", 1), (1, [-1.0], "x", 1)]
    assert top(spark, rows) == plain(rows) == [(0, 1, 1, -65536)]


def test_large_components_are_bounded(spark):
    rows = [(0, [1e300, 1.0], "x", 1), (1, [1e300, 1.0], "x", 1)]
    assert top(spark, rows) == [(0, 1, 1, maxscore.LARGEST**2 + 256**2)]


def test_blocks_and_chunks_change_nothing(spark, monkeypatch):
    rows = random_rows(500, 16, 8)
    own = maxscore.whole(spark.createDataFrame(rows, ROWS))
    got = maxscore.search(own.where(F.col("vec_id") % 10 == 0), own, 5, block=7)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(rows, every=10)


@pytest.mark.parametrize("n", [4, 5, 6, 7, 60])
def test_first_thresholds_are_reached(n):
    v, ids = np.random.default_rng(n).integers(-9, 9, (n, 4)), np.arange(n) // 2 * 2
    for i, floor in enumerate(maxscore._bounds(ids, v, 5)):
        others = sorted((v[ids != ids[i]] @ v[i]).tolist(), reverse=True)
        assert floor == (others[4] if len(others) >= 5 else maxscore.Best.LOW)


def test_terms_are_left_out_and_vectors_not_scored():
    rng = np.random.default_rng(1)
    v = np.floor(rng.standard_normal((2000, 32)) * 40 * (0.8 ** np.arange(32))).astype(np.int64)
    ids, known = np.arange(2000), np.ones(2000, bool)
    q = v[:40]
    floors = maxscore._bounds(ids[:40], q, 5)
    best, met, held = maxscore.Best(40, 5, floors), [], maxscore.Postings.traverse

    def traverse(self, t, weight, total):
        met.append(t)
        held(self, t, weight, total)

    maxscore.Postings.traverse = traverse
    try:
        scored = sum(maxscore.search_chunk(maxscore.Postings(v[a : a + 500]), ids[a : a + 500], known[a : a + 500], q, ids[:40], best) for a in range(0, 2000, 500))
    finally:
        maxscore.Postings.traverse = held
    score = q @ v.T
    score[np.arange(40), np.arange(40)] = maxscore.Best.LOW
    assert (best.scores == -np.sort(-score, axis=1)[:, :5]).all()
    assert (floors <= best.scores[:, -1]).all()
    assert len(met) < 0.8 * 40 * 32 * 4 and scored < 0.05 * 40 * 2000
