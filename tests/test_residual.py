"""Predicted blocks of codes: exact, small, and the same however rows are dealt."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fileledger.operators import codec as K
from fileledger.operators import residual as R
from fileledger.sources import signals_store

INT64 = st.integers(-(2**63), 2**63 - 1)


@given(st.lists(st.one_of(st.integers(-40, 40), st.integers(-(2**23), 2**23), INT64), min_size=1, max_size=60))
@settings(max_examples=400, deadline=None)
def test_any_block_comes_back(codes):
    x = np.array(codes, np.int64)
    got = R.pack(x)
    assert R.unpack(len(x), *got).tolist() == codes
    m = len(x) - got.predictor
    assert len(got.payload) == -(-(got.bits - m * got.rice) // 8) + -(-m * got.rice // 8)


@given(st.lists(INT64, max_size=30))
def test_folding(values):
    x = np.array(values, np.int64)
    assert R.unfold(R.fold(x)).tolist() == values
    assert R.fold(np.array([0, -1, 1, -2, 2], np.int64)).tolist() == [0, 1, 2, 3, 4]


def test_polynomials_take_their_order_and_no_low_bits():
    t = np.arange(500, dtype=np.int64)
    for order, x in enumerate((0 * t + 7, 3 * t + 1, t * t - 5, t**3 - t, 2 * t**4 + t)):
        got = R.pack(x)
        assert got.predictor <= order + 1 and R.unpack(len(x), *got).tolist() == x.tolist()
    assert R.pack(3 * t + 1).predictor == 2 and R.pack(3 * t + 1).bits == 498
    assert R.pack(np.array([5], np.int64)).predictor == 0


def test_parameter_is_the_cheapest():
    rng = np.random.default_rng(1)
    for scale in (1, 10, 5000):
        z = R.fold(rng.normal(0, scale, 300).astype(np.int64))
        k, bits = R.rice_parameter(z)
        costs = [sum((int(v) >> j) + 1 + j for v in z) for j in range(30)]
        assert bits == min(costs) and k == costs.index(min(costs))


def adc(n, seed):
    """A smooth 16-bit signal with noise of about one step."""
    rng = np.random.default_rng(seed)
    t = np.arange(n)
    return np.rint(9000 * np.sin(t / 310) + 4000 * np.sin(t / 77 + 1) + rng.normal(0, 0.8, n)).astype(np.int64)


def test_smooth_signals_shrink_eight_times(spark):
    frames = [spark.createDataFrame([(f"s{i}", int(j), float(v) * 0.25 - 3) for j, v in enumerate(adc(9000, i))], "signal_id string, idx long, value double") for i in range(3)]
    signals = frames[0].unionByName(frames[1]).unionByName(frames[2])
    codes, meta, levels = K.encode_signals(signals)
    blocks = R.residual_blocks(codes)
    report = R.residual_report(meta, blocks).collect()
    assert {r.encoding for r in report} == {"affine_codes"} and report[0].signals == 3 and report[0].bytes_in == 3 * 9000 * 8
    assert report[0].times > 8 and report[0].times > 2 * K.compression_report(meta).first().times
    back = K.decode(R.residual_codes(blocks), meta, levels)
    assert K.roundtrip_report(signals, back).where("exact").count() == 3


@pytest.mark.parametrize("block,batch", [(4096, 10_000), (64, 7), (1, 100)])
def test_table_comes_back(spark, tmp_path, block, batch):
    rows = [("a", i, int(v)) for i, v in enumerate(adc(300, 1))] + [("b", 5 * i * i - 40, i % 3) for i in range(60)] + [("c", 7, -(2**62)), ("c", 7, 2**62), ("c", 9, 0)] + [(None, 1, 4), (None, 2, 5)]
    df = spark.createDataFrame(rows + [("d", None, 3), ("d", 4, None)], "signal_id string, idx long, code long").withColumn("block", F.lit("x")).withColumn("n", F.lit(1))
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        signals_store.write_residuals(df, str(tmp_path / "r"), block)
        got = [tuple(r) for r in signals_store.read_residuals(spark, str(tmp_path / "r")).collect()]
        blocks = spark.read.parquet(str(tmp_path / "r"))
        assert blocks.groupBy("signal_id", "block").count().where("count > 1").count() == 0
        assert R.residual_codes(R.residual_blocks(df.limit(0))).collect() == []
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    key = lambda r: (str(r[0]), r[1], r[2])
    assert sorted(got, key=key) == sorted(rows, key=key)


def test_a_long_signal_is_many_blocks_in_many_tasks(spark):
    codes = spark.range(40_000).select(F.lit("one").alias("signal_id"), F.col("id").alias("idx"), (F.col("id") % 11).alias("code"))
    spark.conf.set("spark.sql.adaptive.enabled", False)  # which joins small partitions
    try:
        sizes = R.residual_blocks(codes, 1000).groupBy(F.spark_partition_id().alias("p")).agg(F.sum("n").alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", True)
    assert len(sizes) > 1 and sum(r.n for r in sizes) == 40_000
