"""Exact inner-product top-k by columnar branch and bound.

Candidates are dealt to shards by falling length, queries to blocks; a block meets a shard in one task, in which the shard
lies in vertical layout (one row of memory per dimension). A first batch of candidates is scored whole and sets each
query's bar, its k-th best score so far. For the others, partial scores are accumulated dimension block by dimension
block; after each, a candidate leaves if its partial score plus the most that the remaining dimensions can add (the
product of both remaining norms) is below the bar, and the survivors are compacted.

The shard of the longest candidates comes first and gives bars. Blocks are then dealt anew by the length that a candidate
needs to reach the bar, and a block meets a shard only if the shard's longest candidate has that length.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

#: Most classes of lengths, of shards and of blocks, whose bounds the driver holds.
BANDS = 512
LONG_MIN, LONG_MAX = -(1 << 63), (1 << 63) - 1


def narrow_limit(width: int) -> int:
    """Components up to this have inner products below 2**62."""
    return 1 << ((62 - max(1, width - 1).bit_length()) // 2)


def matrix(lists: pd.Series, width: int) -> np.ndarray:
    """Lists as rows of a matrix of doubles; shorter ones end in zeros."""
    out = np.zeros((len(lists), width))
    for i, x in enumerate(lists):
        out[i, : len(x)] = x
    return out


def _tails(m: np.ndarray, cuts: list[int]) -> np.ndarray:
    """For each vector (column) the norm of what follows each cut."""
    sq = m.astype(np.float64) ** 2
    return np.array([np.sqrt(sq[c:].sum(axis=0)) for c in cuts]).reshape(len(cuts), m.shape[1])


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The places of the k highest scores, ties to smaller ids."""
    if len(scores) > 4 * k:
        bar = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= bar)
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def search(qids: np.ndarray, queries: np.ndarray, ids: np.ndarray, columns: np.ndarray, k: int, bars: np.ndarray | None = None, step: int = 16, batch: int = 4096) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each query (row) the ids and scores of its k best candidates (columns), its own id left out; with ``bars`` only those that reach the query's bar.

    Components are whole numbers up to :func:`narrow_limit`.
    """
    width = queries.shape[1]
    exact = np.float64 if int(np.abs(queries).max(initial=0)) * int(np.abs(columns).max(initial=0)) * width < 1 << 53 else np.int64
    q, c = queries.astype(exact), columns.astype(exact)
    cuts = list(range(step, width, step))
    q_tail, c_tail = _tails(queries.T, cuts), _tails(columns, cuts)
    order = np.argsort(-np.sqrt((columns.astype(np.float64) ** 2).sum(axis=0)), kind="stable")  # long vectors first: high bars early
    out_ids = [np.empty(0, np.int64)] * len(qids)
    out_scores = [np.empty(0, exact)] * len(qids)
    for at in range(0, len(ids), batch):
        piece = order[at : at + batch]
        columns_here, ids_here = c[:, piece], ids[piece]
        first = q[:, :step] @ columns_here[:step]
        for i in range(len(qids)):
            alive = np.flatnonzero(ids_here != qids[i])
            part = first[i, alive]
            bar = out_scores[i][-1] if len(out_scores[i]) >= k else None
            if bars is not None and not np.isnan(bars[i]):
                bar = bars[i] if bar is None else max(bar, bars[i])
            if bar is None and len(alive):
                lead = alive[: 8 * k]
                some = np.sort(q[i] @ columns_here[:, lead])
                if len(some) >= k:
                    bar = some[-k]
            for j, cut in enumerate(cuts):
                if bar is not None:
                    rest = q_tail[j, i] * c_tail[j, piece[alive]]
                    stays = part + rest + 1e-9 * (np.abs(part) + rest) + 1e-6 >= bar
                    alive, part = alive[stays], part[stays]
                if not len(alive):
                    break
                part = part + q[i, cut : cut + step] @ columns_here[cut : cut + step, alive]
            if len(alive):
                every, values = np.concatenate((out_ids[i], ids_here[alive])), np.concatenate((out_scores[i], part))
                keep = best_of(values, every, k)
                out_ids[i], out_scores[i] = every[keep], values[keep]
    return out_ids, out_scores


def whole_numbers(vector: np.ndarray, scale: float) -> list[int]:
    """``floor(scale * x)`` of each component, of any size."""
    with np.errstate(over="ignore"):
        return [int(y) if math.isfinite(y) else math.floor(Fraction(x) * Fraction(scale)) for x, y in zip(vector.tolist(), np.floor(scale * vector).tolist(), strict=True)]


def search_wide(qid: int, query: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int, scale: float) -> list[tuple[int, int]]:
    """The k best ``(id, score)`` of one query among candidates of any size (unscaled rows), its own id left out.

    Scores in doubles, each vector made small by a power of two, have known errors; who may be among the k best by them
    is scored in whole numbers.
    """
    ids, rows = ids[ids != qid], rows[ids != qid]
    if not len(ids):
        return []
    small = lambda m: np.frexp(np.abs(m).max(axis=-1, initial=0))[1]
    floors = np.where(np.abs(rows) < 2.0**43, np.floor(scale * np.clip(rows, -(2.0**43), 2.0**43)) / scale, rows)
    own = np.where(np.abs(query) < 2.0**43, np.floor(scale * np.clip(query, -(2.0**43), 2.0**43)) / scale, query)
    powers = small(floors)
    about = np.ldexp(floors, -powers[:, None]) @ np.ldexp(own, -small(own))
    shift = powers - powers.max()
    about, error = np.ldexp(about, shift), np.ldexp(np.full(len(ids), len(query) ** 2 * 2.0**-51), shift) + 1e-290
    bar = np.sort(about - error)[-k] if len(ids) > k else -np.inf
    exact = whole_numbers(query, scale)
    found = [(sum(a * b for a, b in zip(exact, whole_numbers(rows[i], scale), strict=True)), int(ids[i])) for i in np.flatnonzero(about + error >= bar)]
    return [(i, s) for s, i in sorted(found, key=lambda x: (-x[0], x[1]))[:k]]


def beyond(score: int) -> str | None:
    """For a score that is no long, a text that orders such scores of one sign."""
    if LONG_MIN <= score <= LONG_MAX:
        return None
    digits = str(abs(score))
    text = f"{len(digits):05d}{digits}"
    return text if score > 0 else text.translate(str.maketrans("0123456789", "9876543210"))


def meet(left: pd.DataFrame, right: pd.DataFrame, k: int, width: int, scale: float) -> pd.DataFrame:
    """The k best candidates ``right (vec_id, x)`` of each query ``left (vec_id, x, bar)``."""
    qids, ids = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
    queries, rows = matrix(left["x"], width), matrix(right["x"], width)
    bars, limit = left["bar"].to_numpy(np.float64), narrow_limit(width)
    with np.errstate(over="ignore"):
        whole_q, whole_c = np.floor(scale * queries), np.floor(scale * rows)
    wide_q, wide_c = (np.abs(whole_q) > limit).any(axis=1), (np.abs(whole_c) > limit).any(axis=1)
    found: list[tuple[int, int, int, str | None]] = []
    tame = np.flatnonzero(~wide_q)
    if len(tame) and not wide_c.all():
        got, scores = search(qids[tame], whole_q[tame].astype(np.int64), ids[~wide_c], np.ascontiguousarray(whole_c[~wide_c].astype(np.int64).T), k, bars[tame])
        found += [(int(q), int(i), int(s), None) for q, g, ss in zip(qids[tame], got, scores, strict=True) for i, s in zip(g.tolist(), ss.tolist(), strict=True)]
    for at in range(len(qids)):
        for mask in ([wide_c, ~wide_c] if wide_q[at] else [wide_c]):
            if mask.any():
                found += [(int(qids[at]), i, min(max(s, LONG_MIN), LONG_MAX), beyond(s)) for i, s in search_wide(int(qids[at]), queries[at], ids[mask], rows[mask], k, scale)]
    return pd.DataFrame(found, columns=["query_id", "vec_id", "score", "beyond"]).astype({"query_id": "int64", "vec_id": "int64", "score": "int64", "beyond": "object"})


def dealt(df: DataFrame, value: str, rows: int, name: str, falling: bool) -> tuple[DataFrame, list[tuple[float, int, int]]]:
    """The rows dealt to groups of about ``rows`` rows of like ``value``: adds ``name`` and ``class``.

    For each class, in the order of values, the driver gets its outermost value (the largest if values fall, else the
    smallest), its first group and the one after its last. Classes, at most ``BANDS``, are cut at quantiles; a class of
    many equal values becomes several groups.
    """
    total = df.count()
    parts = max(1, min(BANDS, -(-total // rows)))
    cuts = df.select(F.percentile_approx(value, [i / parts for i in range(1, parts)], 10_000).alias("p")).first()["p"] if parts > 1 and total else []
    cuts = F.array(*map(F.lit, sorted(set(cuts or [])))).cast("array<double>")
    before = F.size(F.filter(cuts, (lambda c: c > F.col(value)) if falling else (lambda c: c <= F.col(value))))
    banded = df.withColumn("class", before)
    sizes = banded.groupBy("class").agg(F.count(F.lit(1)).alias("n"), (F.max if falling else F.min)(value).alias("edge")).orderBy("class").collect()
    classes, groups = [], 0
    for r in sizes:
        classes.append((r["edge"], groups, groups + -(-r["n"] // rows)))
        groups = classes[-1][2]
    place = {r["class"]: i for i, r in enumerate(sizes)}
    banded = banded.withColumn("class", by_class([place.get(b, 0) for b in range(max(place, default=0) + 1)]))
    start, many = by_class([lo for _, lo, _ in classes]), by_class([hi - lo for _, lo, hi in classes])
    return banded.withColumn(name, (start + F.pmod(F.xxhash64("vec_id", F.lit(1), "x"), many)).cast("int")), classes


def by_class(numbers: list[int]) -> Column:
    """The number of the row's class."""
    return F.get(F.array(*map(F.lit, numbers)).cast("array<int>"), F.col("class"))


def exact_top_k(vectors: DataFrame, every: int = 50, k: int = 5, scale: float = 256.0, query_rows: int = 2048, shard_rows: int = 8192) -> DataFrame:
    """``vectors (vec_id, embedding, ...)`` to ``query_id, rank, vec_id, score``.

    Components become ``floor(scale * x)``; queries are the rows whose vec_id is divisible by ``every``, candidates all
    rows but those with the query's own vec_id; the score is the integer inner product. Each query gets its ``k``
    highest scores (all, if there are fewer), ties to the smaller vec_id, ranks from 1.

    Vectors that are null, or hold null or non-finite components, and rows with a null vec_id take no part. Of
    vectors with different lengths the shorter ones count as ending in zeros; an empty vector scores 0 with all.
    Repeated rows are candidates each; a repeated query is one query. Components may have any size: scores are whole
    numbers without rounding, ranked by their true value; one that is no long is given as the nearest long. Other
    columns are ignored.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    kind = "array<float>" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"
    base = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("x")).where("vec_id is not null and x is not null")
    finite = F.forall("x", lambda v: v.isNotNull() & (F.abs(v) < F.lit(float("inf"))))  # NaN is above infinity
    length = F.sqrt(F.aggregate("x", F.lit(0.0), lambda t, v: t + F.pow(F.abs(scale * v.cast("double")) + 1, F.lit(2.0))))  # no less than that of the floors
    base = scratch.save(base.where(finite).withColumn("norm", length), "vectors")
    is_query = F.col("vec_id") % every == 0
    size = base.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("w")).first()
    width = max(1, size["w"] or 1)
    shard_rows = min(shard_rows, max(256, -(-size["n"] // 32)))  # small tables, too, are dealt over many tasks
    candidates, shards = dealt(base, "norm", shard_rows, "shard", falling=True)
    candidates = scratch.save(candidates, "candidates")
    queries = base.where(is_query).dropDuplicates(["vec_id"])
    found = "query_id long, vec_id long, score long, beyond string"

    def scan(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return meet(left, right, k, width, scale)

    blocks = max(1, -(-size["n"] // every // query_rows))
    start = queries.select(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), "vec_id", "x", F.lit(None).cast("double").alias("bar"))
    longest = candidates.where("shard = 0").select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "vec_id", "x")
    lead = scratch.save(start.groupBy("block").cogroup(longest.groupBy("block")).applyInPandas(scan, found), "lead")
    bars = lead.groupBy(F.col("query_id").alias("vec_id")).agg(F.when(F.count(F.lit(1)) >= k, F.min("score").cast("double")).alias("bar"))
    need = F.when((F.col("bar") > 0) & (F.col("norm") > 0) & (F.col("norm") < F.lit(float("inf"))), F.col("bar") / F.col("norm") * (1 - 1e-9)).otherwise(F.lit(-1.0))
    waiting = scratch.save(queries.join(bars, "vec_id", "left").withColumn("need", need), "queries")
    waiting, needs = dealt(waiting, "need", query_rows, "block", falling=False)
    # a block meets the shards whose longest candidate is as long as its least demanding query needs; shards fall, needs rise
    reached = [max((end for top, _, end in shards if top >= edge), default=0) for edge, _, _ in needs]
    asking = [max((hi for n, (_, _, hi) in zip(reached, needs, strict=True) if n > first), default=0) for _, first, _ in shards]
    left = waiting.withColumn("upto", by_class(reached)).where("upto > 1")
    left = left.select("block", F.explode(F.sequence(F.lit(1), F.col("upto") - 1)).alias("shard"), "vec_id", "x", "bar")
    right = candidates.where("shard > 0").withColumn("upto", by_class(asking)).where("upto > 0")
    right = right.select(F.explode(F.sequence(F.lit(0), F.col("upto") - 1)).alias("block"), "shard", "vec_id", "x")
    near = left.groupBy("block", "shard").cogroup(right.groupBy("block", "shard")).applyInPandas(scan, found).unionByName(lead)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("beyond"), "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
