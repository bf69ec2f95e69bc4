"""Runs of failures by segmented scans, against a loop over each pass."""

import random

import pytest
from pyspark.sql import functions as F

from fileledger.operators import outcomes as O


def rows_of(seed, sizes):
    rng = random.Random(seed)
    out = []
    for p, n in enumerate(sizes):
        bad = 0.95 if p % 2 else 0.5
        out += [(p if p != 3 else None, s * 3, rng.random() > bad, rng.choice(["timeout", "connection reset", "no such file", None]) if rng.random() < 0.97 else None, rng.random() < 0.3, rng.choice(["checksum_mismatch", "verified", None])) for s in range(n)]
    rng.shuffle(out)
    return out


def looped(rows, hit, resets):
    """Streak of each row, row after row."""
    out, run, last = {}, 0, object()
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        run = 0 if r[0] != last or resets(r) else run
        last = r[0]
        run += bool(hit(r))
        out[r[0], r[1]] = run
    return out


@pytest.mark.parametrize("parts,batch,sizes", [(1, 10_000, [40, 40]), (7, 10_000, [300, 500, 1, 30]), (16, 5, [200, 700, 0, 90, 3]), (5, 1, [60])])
def test_against_a_loop(spark, parts, batch, sizes):
    rows = rows_of(parts, sizes)
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        df = spark.createDataFrame(rows, "pass_id int, seq long, success boolean, error string, decode_failure boolean, result string")
        conn = lambda r: not r[2] and r[3] in ("timeout", "connection reset")
        got = {(r.pass_id, r.seq): r.streak for r in O.conn_streaks(df).collect()}
        want = looped(rows, conn, lambda r: not conn(r))
        assert got == want
        stops = {p: min(s for q, s in want if q == p and want[q, s] >= 4) for p in {q for q, _ in want} if any(want[k] >= 4 for k in want if k[0] == p)}
        assert {r.pass_id: r.seq for r in O.conn_streak_abort_point(df, 4).collect()} == stops
        decoded = looped(rows, lambda r: r[4] and not r[2], lambda r: r[2])
        first = {}
        for r in sorted(rows, key=lambda r: r[1]):
            if decoded[r[0], r[1]] >= 3 and r[4]:
                first.setdefault(r[0], (r[1], decoded[r[0], r[1]]))
        assert {r.pass_id: (r.seq, r.streak) for r in O.decode_halt_point(df, 3).collect()} == first
        counted = looped(rows, lambda r: r[5] == "checksum_mismatch", lambda r: False)
        assert {r.pass_id: (r.seq, r.mismatches) for r in O.mismatch_abort_point(df, 5).collect()} == {p: min((s, 5) for q, s in counted if q == p and counted[q, s] == 5) for p, _ in counted if 5 in [counted[k] for k in counted if k[0] == p]}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_one_pass_spreads_over_all_tasks(spark):
    n = 40_000
    df = spark.range(n).select(F.lit(1).alias("pass_id"), F.col("id").alias("seq"), (F.col("id") % 7 == 0).alias("success"), F.lit("timeout").alias("error"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        local = df.withColumn("hit", F.lit(True)).withColumn("resets", F.lit(False)).repartitionByRange(8, "pass_id", "seq")
        sizes = sorted(r["count"] for r in local.groupBy(F.spark_partition_id()).count().collect())
        assert len(sizes) == 8 and sizes[-1] < 2 * sizes[4]
        assert O.conn_streaks(df).agg(F.max("streak")).first()[0] == 6
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_no_rows(spark):
    df = spark.createDataFrame([], "pass_id int, seq long, success boolean, error string")
    assert O.conn_streaks(df).collect() == [] and O.conn_streak_abort_point(df).collect() == []
