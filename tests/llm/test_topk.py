"""Exact top-k search against brute force."""

import math

import numpy as np
from pyspark.sql import functions as F

from shoplens.llm import topk as T

SCHEMA = "vec_id long, embedding array<float>, label int, score string, v string"


def brute(rows, k=5, every=50):
    known = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        w = [math.floor(256 * float(np.float32(x))) for x in v]
        known[i] = min(known.get(i, w), w)
    out = []
    for q, a in known.items():
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in known.items() if c != q)
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scored[:k])]
    return sorted(out)


def got(spark, rows, **how):
    df = spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, T.top_k(df, F.col("vec_id") % 50 == 0, **how).collect()))


def vectors(n, d, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, d))
    m = centres[rng.integers(0, 8, n)] + rng.normal(scale=0.2, size=(n, d))
    return [(int(i), [float(x) for x in row.astype(np.float32)]) for i, row in enumerate(m)]


def test_matches_brute_force_with_edge_rows(spark):
    rows = vectors(600, 12, 1)
    same = rows[3][1]
    rows += [(1000 + i, same) for i in range(9)] + [(3000, same), (2000, None), (2001, [1.0, None] * 6), (2002, [float("nan")] * 12),
             (2003, [float("inf")] * 12), (None, same), (50, rows[50][1]), (7, [0.0] * 12), (2050, []), (2004, [2.0, -1.5]),
             (-50, [0.1] * 12)]
    assert got(spark, rows) == brute(rows)


def test_blocks_of_queries_and_few_pivots(spark):
    rows = vectors(700, 6, 2)
    assert got(spark, rows, query_block=4, pivots=2) == brute(rows) == got(spark, rows, pivots=1)


def test_all_equal_and_fewer_than_k(spark):
    rows = [(i, [0.5, 0.25]) for i in range(0, 150, 10)]
    assert got(spark, rows) == brute(rows)
    assert got(spark, rows[:3]) == brute(rows[:3]) and got(spark, [(0, [1.0])]) == [] == got(spark, [])


def test_long_vectors_are_scored_exactly(spark):
    rows = vectors(300, 4, 4)
    # lengths far beyond 2^26, which differ in their last bits only, beside ordinary ones
    rows += [(1000 + i, [3e5, 3e5 + 0.03125 * (i % 7), 0.00390625 * i, 1.0]) for i in range(60)]
    rows += [(2000, [-3e5, 1.0, 2.0, 3e5]), (2001, [0.0] * 4), (2050, [2e6, 2e6, -2e6, 1e6])]
    want = brute(rows)
    assert max(s for *_, s in want) > 1 << 53
    assert got(spark, rows) == want == got(spark, rows, query_block=3, pivots=3)


def test_far_candidates_are_not_scored():
    rng = np.random.default_rng(3)
    c = np.floor(256 * (np.repeat(rng.normal(size=(16, 8)) * 9, 64, axis=0) + rng.normal(size=(1024, 8)) * 0.05))
    pivots = T.choose_pivots(c[::7])
    best = T.Best(16, 5)
    far = T.distances(c, pivots)
    q = np.arange(0, 1024, 64)
    done = T.search_step(best, q, c[q], far[q], np.arange(1024), c, far)
    score = c[q] @ c.T
    score[np.arange(16), q] = -np.inf
    assert (best.score == -np.sort(-score, axis=1)[:, :5]).all() and done < 0.6 * score.size
