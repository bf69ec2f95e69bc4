"""What one task of a join sorts doesn't grow with the table, whatever the number of shuffle partitions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fileledger.operators import codec as K
from fileledger.operators import prefix
from fileledger.sources import signals_store

from .test_task_memory import stages

SHARE = 1000


@pytest.fixture
def shares(spark, monkeypatch):
    """Small shares, and joins as on large tables."""
    monkeypatch.setattr(prefix, "TASK_ROWS", SHARE)
    monkeypatch.setattr(prefix, "FEW_ROWS", 0, raising=False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def most_rows(spark, since: int) -> int:
    """The most shuffled rows that a task read in the stages from ``since`` on."""
    store, most = spark.sparkContext._jsc.sc().statusStore(), 0
    for stage in range(since, stages(spark)):
        try:
            tasks = store.taskList(stage, 0, 10_000)
        except Exception:  # a stage that was skipped
            continue
        metrics = [tasks.apply(i).taskMetrics() for i in range(tasks.size())]
        most = max([most, *(m.get().shuffleReadMetrics().recordsRead() for m in metrics if m.isDefined())])
    return most


@pytest.mark.parametrize("what", ["compression_report", "stored_signal_meta", "decode"])
def test_no_task_reads_more_than_its_share(spark, shares, tmp_path, what):
    rng = np.random.default_rng(3)
    given = [(s, i, float(v)) for s in range(100) for i, v in enumerate(rng.normal(size=600) if s % 2 else 0.25 * (np.arange(600) % 300))]
    path = f"file://{tmp_path}/signals"
    spark.createDataFrame(given, "signal_id long, idx long, value double").write.parquet(path)
    signals, since = spark.read.parquet(path), stages(spark)
    codes, meta, levels = K.encode_signals(signals)
    if what == "compression_report":
        got = {r.encoding: (r.signals, r.bytes_in) for r in K.compression_report(meta).collect()}
        assert got == {e: (50, 50 * 600 * 8) for e in ("affine_codes", "indexed")}
    elif what == "stored_signal_meta":
        signals_store.write_signal_meta(meta, f"file://{tmp_path}/meta")
        back = signals_store.read_signal_meta(spark, f"file://{tmp_path}/meta", "signal_id bigint, encoding string, n_samples bigint").collect()
        assert sorted((r.signal_id, r.encoding, r.n_samples) for r in back) == [(s, "indexed" if s % 2 else "affine_codes", 600) for s in range(100)]
    else:
        assert sorted(map(tuple, K.decode(codes, meta, levels).collect())) == given
    assert 0 < most_rows(spark, since) < 7 * SHARE


def test_long_signals_and_common_values(spark, shares):
    """A level with many shares of samples, a signal with many shares of levels, and one that no code keeps."""
    nan = float("nan")
    given = {1: [0.5] * 5000, 2: [v**0.5 for v in range(4000)], 3: [0.0, -0.0, 1.0] * 1000, 4: [nan, None, 1.0] * 1500, 5: [2.0]}
    s = spark.createDataFrame([(k, i, v) for k, vs in given.items() for i, v in enumerate(vs)], "signal_id long, idx long, value double")
    codes, meta, levels = K.encode_signals(s)
    assert {r.signal_id: (r.exact, r.n_samples) for r in meta.collect()} == {k: (k != 3, len(vs)) for k, vs in given.items()}
    back = sorted((r.signal_id, r.idx, repr(r.value)) for r in K.decode(codes, meta, levels).collect())
    assert back == [(k, i, repr(v)) for k, vs in given.items() if k != 3 for i, v in enumerate(vs)]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_rows_of_a_common_key_are_many_tasks(spark, shares, how):
    rows = spark.range(20_000).select(F.when(F.col("id") < 15_000, 7).otherwise(F.col("id") % 50).alias("k"), "id")
    side = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
    heavy = rows.groupBy("k").agg(F.count("*").alias("weight")).where(F.col("weight") > SHARE)
    got = prefix.joined(rows, 20_000, side, heavy, "k", spread="id", how=how)
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 5 * SHARE
    assert sorted(map(str, got.collect())) == sorted(map(str, rows.join(side, "k", how).collect()))


def test_tasks_that_deal_hold_no_rows(spark):
    rows = spark.range(1000)
    got = [prefix.dealt(rows, n * prefix.TASK_ROWS, "id").rdd.getNumPartitions() for n in (150, 300, 800, 1000)]
    assert got == [150, 200, 200, 250]
