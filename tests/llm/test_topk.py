import math
import random
from fractions import Fraction

import pytest

from fileledger.llm import topk


def brute(rows, every=50, k=5):
    vecs = [(i, [math.floor(256 * Fraction(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, a in {i: a for i, a in vecs if i % every == 0}.items():
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in vecs if i != q)[:k]
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)}
    return out


@pytest.mark.parametrize("dims,n", [(64, 400), (7, 150), (1, 60)])
def test_against_brute_force(spark, dims, n):
    rng = random.Random(dims)
    rows = [(i, [rng.uniform(-1, 1) * rng.choice([0.2, 1]) for _ in range(dims)]) for i in range(n)]
    rows += [(n + i, rows[3][1]) for i in range(30)]  # ties
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    for options in ({}, {"query_rows": 3, "shard_rows": 40}):
        got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.exact_top_k(df, **options).collect()}
        assert got == brute(rows)


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.5]), (50, [0.25, None]), (100, None), (150, [float("nan"), 1.0]), (200, [float("inf"), 1.0]), (None, [1.0, 1.0]), (7, [2.0]), (8, []), (9, [0.5, 0.5, 9.0]), (300, [0.5, 0.5]), (-50, [1.0, 0.0])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, block string, score int")
    got = topk.exact_top_k(df)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert {r.query_id for r in got.collect()} == {0, 300, -50}
    pad = [(i, v + [0.0] * (3 - len(v))) for i, v in rows if v is not None and i is not None and all(x is not None and math.isfinite(x) for x in v)]
    assert {tuple(r) for r in got.collect()} == brute(pad)
    assert topk.exact_top_k(df.limit(0)).count() == 0


def test_large_components_stay_exact(spark):
    rows = [(i, [4_000.0 * (i + 1), -1.0 * i]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {tuple(r) for r in topk.exact_top_k(df).collect()} == brute(rows)


def clipped(rows):
    return {(q, r, i, min(max(s, topk.LONG_MIN), topk.LONG_MAX)) for q, r, i, s in brute(rows)}


@pytest.mark.parametrize("sizes", [[1e9], [1, 1e9], [1, 1e6, 1e12], [1e-3, 1, 1e17, 1e30], [1e300, 1, 1e-300], [1e308]])
def test_values_of_any_size_are_ranked_exactly(spark, sizes):
    rng = random.Random(len(sizes))
    rows = [(i, [rng.uniform(-1, 1) * rng.choice(sizes) for _ in range(5)]) for i in range(160)]
    rows += [(200 + i, rows[i % 3][1]) for i in range(8)] + [(300, rows[7][1]), (400, [0.0] * 5), (350, [sizes[-1]] + [0.0] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for options in ({}, {"query_rows": 2, "shard_rows": 30}):
        assert {tuple(r) for r in topk.exact_top_k(df, **options).collect()} == clipped(rows)


def test_wide_vectors(spark):
    rng = random.Random(9)
    for dims, size in ((4096, 3_000.0), (4096, 1.0)):
        rows = [(i, [rng.uniform(-1, 1) * size for _ in range(dims)]) for i in range(60)] + [(60, [size] * dims), (100, [size] * (dims - 1))]
        got = {tuple(r) for r in topk.exact_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
        assert got == brute([(i, v + [0.0] * (dims - len(v))) for i, v in rows])


def test_short_candidates_are_passed_over_and_nothing_is_lost(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) * math.exp(rng.gauss(0, 1.5)) for _ in range(6)]) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {tuple(r) for r in topk.exact_top_k(df, query_rows=4, shard_rows=20).collect()} == brute(rows)
