"""Signals of more levels than codes of 24 bits can tell apart are fitted like all others."""

import numpy as np
from pyspark.sql import functions as F

from fileledger.operators import codec as K


def test_a_grid_of_more_levels_than_24_bits(spark):
    n = (1 << 24) + 1
    at = spark.range(n).select(F.lit(1).cast("long").alias("signal_id"), (F.col("id") * 0.25 - 3).alias("level"))
    off = spark.createDataFrame([(2, v) for v in (0.0, 1.0, 2.5)], at.schema)
    fit = {r.signal_id: tuple(r)[1:] for r in K.fit_grid(at.unionByName(off)).collect()}
    assert fit == {1: (n, -3.0, 0.25, True), 2: (3, 0.0, None, False)}


def test_codes_know_no_limit_of_levels(spark, monkeypatch):
    monkeypatch.setattr(K, "MAX_FIT_LEVELS", 50)
    values = np.random.default_rng(1).normal(size=60).tolist()
    s = spark.createDataFrame([(1, i, v) for i, v in enumerate(values)], "signal_id long, idx long, value double")
    codes, meta, levels = K.encode_signals(s)
    assert [(r.encoding, r.exact, r.n_levels) for r in meta.collect()] == [("indexed", True, 60)]
    assert [r.value for r in K.decode(codes, meta, levels).sort("idx").collect()] == values
