import hashlib
import math
import random
from fractions import Fraction

import pytest

from fileledger.llm import centroids as C


def brute(rows, k, rounds, dims):
    kept = [(i, [math.floor(256 * Fraction(x)) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centers = [v for _, v in order[:k]]

    def best(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centers))

    for _ in range(rounds):
        members = [[] for _ in centers]
        for _, v in kept:
            members[best(v)[1]].append(v)
        centers = [[sum(c) // len(m) for c in zip(*m)] if m else old for m, old in zip(members, centers)]
    found = [(i, *best(v)[::-1]) for i, v in kept]
    clip = lambda s: min(s, 2**63 - 1)
    whole = clip(sum(d for _, _, d in found))
    return sorted((i is None, i or 0, n, clip(d), clip(sum(x for _, m, x in found if m == n)), whole, hashlib.sha256(",".join(map(str, centers[n])).encode()).hexdigest()) for i, n, d in found)


def got(df, **options):
    out = C.centroid_clusters(df, **options)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((r.vec_id is None, r.vec_id or 0, *tuple(r)[1:]) for r in out.collect())


@pytest.mark.parametrize("k,rounds,dims,size", [(40, 5, 64, 0.3), (3, 2, 2, 1.0), (5, 0, 3, 100.0), (4, 3, 2, 1e7), (200, 1, 2, 1.0)])
def test_against_brute_force(spark, k, rounds, dims, size):
    rng = random.Random(k)
    rows = [(i, [rng.uniform(-size, size) for _ in range(dims)]) for i in range(150)] + [(200 + i, [size / 2] * dims) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert got(df, k=k, rounds=rounds, dims=dims) == brute(rows, k, rounds, dims)


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.5]), (1, [0.25, None]), (2, None), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [-float("inf"), 1.0]), (None, [1.0, 1.0]), (7, [2.0]), (8, []), (9, [0.5, 0.5, 9.0]), (10, [-0.5, -0.001]), (10, [-0.5, -0.001]), (10, [0.0, -0.0])]
    df = spark.createDataFrame([(i, v, 1, "x", "y") for i, v in rows], "vec_id long, embedding array<double>, cluster int, v string, c string")
    for k in (1, 2, 40):
        assert got(df, k=k, dims=2, rounds=3) == brute(rows, k, 3, 2)
    assert got(df.limit(0)) == [] and got(df, dims=5) == []
    with pytest.raises(ValueError, match="too large"):
        C.centroid_clusters(spark.createDataFrame([(1, [1e300, 0.0])], "vec_id long, embedding array<double>"), dims=2)
