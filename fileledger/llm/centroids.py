"""Clustering around centroids in whole numbers, by DataFrame expressions.

Vectors become arrays of integers once. A round is one aggregation: every vector's squared distance to each centroid of
a literal array comes from ``zip_with`` and ``aggregate``, ``array_min`` of ``(distance, number)`` structs chooses the
cluster, and sums of the component columns, combined in each task first, give the new centroids. Only ``k`` rows of
sums reach the driver in a round, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

#: Components of at most this size leave squared distances of 64 of them, and sums of 2**36 rows, within a long.
LONG_LIMIT = 1 << 27
#: Components up to this size are worked on as decimals of 38 digits.
DECIMAL_LIMIT = 10**17
_LONG_MAX = (1 << 63) - 1


def whole_vectors(vectors: DataFrame, dims: int) -> DataFrame:
    """``vec_id, v``: the vectors that have ``dims`` components, none null or non-finite, each component ``x`` as ``floor(256 * x)`` in a double (whole, as 256 is a power of two)."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where((F.size("x") == dims) & F.coalesce(finite, F.lit(False)))
    # the floor of a double as a double: rint, less one where it rounded up
    floor = lambda c: F.rint(c) - F.when(F.rint(c) > c, 1.0).otherwise(0.0)
    return rows.select("vec_id", F.transform("x", lambda c: floor(c * 256)).alias("v"))


def literal_centroids(centroids: list[list[int]], number: str) -> Column:
    """The centroids as one literal array of ``(v, cluster)``."""
    suffix = "L" if number == "bigint" else "BD"
    cast = "" if number == "bigint" else f"cast(array({{}}) as array<{number}>)"
    arrays = [", ".join(f"{c}{suffix}" for c in v) for v in centroids]
    arrays = [cast.format(a) if cast else f"array({a})" for a in arrays]
    return F.expr("array(" + ", ".join(f"named_struct('v', {a}, 'cluster', {k})" for k, a in enumerate(arrays)) + ")")


def nearest(v: Column, centroids: list[list[int]], number: str) -> Column:
    """``(distance, cluster)`` of the nearest centroid by squared distance, ties to the smaller number."""

    def distance(c: Column) -> Column:
        squares = F.zip_with(v, c["v"], lambda a, b: ((a - b) * (a - b)).cast(number))
        return F.aggregate(squares, F.lit(0).cast(number), lambda total, s: (total + s).cast(number))

    return F.array_min(F.transform(literal_centroids(centroids, number), lambda c: F.struct(distance(c).alias("distance"), c["cluster"].alias("cluster"))))


def first_centroids(kept: DataFrame, k: int, salt: str) -> list[list[int]]:
    """The ``k`` vectors with the smallest sha256 of ``salt:vec_id``; vectors without an id come last, ties by their components."""
    order = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.select("v", order.alias("h")).orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()
    return [[int(c) for c in r.v] for r in rows]


def centroid_clusters(vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, salt: str = "2") -> DataFrame:
    """``vectors (vec_id, embedding, ...)`` to ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``.

    Only vectors with exactly ``dims`` components, none of them null or non-finite, take part; each row counts, repeated
    ones too, and a null vec_id is a row like any other, but starts a centroid only where fewer than ``k`` rows have an
    id. With fewer vectors than ``k`` there are as many centroids as vectors. Other columns are ignored; an empty table,
    or one without such vectors, gives an empty result.

    All arithmetic is exact: in longs, or in decimals of 38 digits where a scaled component passes ``LONG_LIMIT``; past
    ``DECIMAL_LIMIT`` a ``ValueError`` says so. A sum that is no long (only with such components) is given as the largest long.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "centroids")
    kept = whole_vectors(vectors, dims)
    # few large files would leave cores idle for rounds of pure arithmetic
    cores = spark.sparkContext.defaultParallelism
    few = vectors.select(F.spark_partition_id().alias("p")).distinct().count() < cores  # reads no column
    kept = scratch.save(kept.repartition(cores) if few else kept, "doubles")
    size = kept.agg(F.max(F.array_max(F.transform("v", lambda c: F.abs(c))))).first()[0] or 0.0
    if size > DECIMAL_LIMIT:
        raise ValueError(f"components of up to {size / 256:g} are too large for exact distances; scale the vectors down")
    number = "bigint" if size <= LONG_LIMIT and dims <= 64 else "decimal(38,0)"
    exact = scratch.save(kept.select("vec_id", F.col("v").cast(f"array<{number}>").alias("v")), "whole")
    scratch.drop(kept)

    centroids = first_centroids(exact, k, salt)
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not centroids:
        return spark.createDataFrame([], schema)
    for _ in range(rounds):
        chosen = exact.select(nearest(F.col("v"), centroids, number)["cluster"].alias("cluster"), "v")
        sums = chosen.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *(F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(dims)))
        for row in sums.collect():  # at most k rows
            centroids[row.cluster] = [int(row[f"s{i}"]) // row.n for i in range(dims)]

    assigned = scratch.save(exact.select("vec_id", nearest(F.col("v"), centroids, number).alias("best")).select("vec_id", "best.cluster", "best.distance"), "assigned")
    scratch.drop(exact)
    inertia = {r.cluster: int(r.s) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    fits = lambda n: min(n, _LONG_MAX)
    facts = [(c, fits(s), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c, s in inertia.items()]
    facts = spark.createDataFrame(facts, "c int, cluster_inertia long, centroid_sha256 string")  # k rows
    distance = F.least(F.col("distance"), F.lit(_LONG_MAX).cast(number)).cast("long")
    out = assigned.join(F.broadcast(facts), F.col("cluster") == F.col("c"))
    return out.select("vec_id", "cluster", distance.alias("distance"), "cluster_inertia", F.lit(fits(sum(inertia.values()))).cast("long").alias("inertia"), "centroid_sha256")
