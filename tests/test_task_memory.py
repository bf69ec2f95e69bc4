"""Memory of one task: a step that chains many sorts in a task holds the buffers of all of them, however few the rows are."""

import numpy as np
import pytest

from fileledger.operators import codec as K
from fileledger.operators.prefix import TASK_ROWS, dealt
from fileledger.plans.queries import QUERIES


def peak_mb(spark, since: int) -> float:
    """The most execution memory of a task in the stages from ``since`` on."""
    store = spark.sparkContext._jsc.sc().statusStore()
    most = 0
    for stage in range(since, stages(spark)):
        try:
            tasks = store.taskList(stage, 0, 10_000)
        except Exception:  # a stage that was skipped
            continue
        for i in range(tasks.size()):
            metrics = tasks.apply(i).taskMetrics()
            if metrics.isDefined():
                most = max(most, metrics.get().peakExecutionMemory())
    return most / 1e6


def stages(spark) -> int:
    """Runs a job to see which number its stage has."""
    spark.sparkContext.parallelize([1], 1).count()
    return int(spark.sparkContext._jsc.sc().dagScheduler().nextStageId())


@pytest.mark.parametrize("name", ["fit_grid", "choose_encoding", "compression_report", "stored_signal_meta", "decode", "roundtrip_report"])
def test_no_task_holds_a_whole_chain(spark, sf, name):
    since = stages(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # joins as on large tables
    try:
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert 0 < peak_mb(spark, since) < 700


def test_partitions_of_a_given_number_stay(spark):
    rows = spark.range(8 * TASK_ROWS).withColumn("key", K.F.col("id") % 1000)
    assert dealt(rows, 8 * TASK_ROWS, "key").rdd.getNumPartitions() == 8
    assert dealt(rows, 3, "key").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_codes_of_levels_are_codes_of_samples(spark):
    """A level's samples have one code, and -0.0, NaN and null keep their own fate."""
    given = {1: [0.5, 1.0, 0.5, 2.0] * 5, 2: [0.0, -0.0, 1.0], 3: [float("nan"), 1.0, None, float("nan")], 4: [None, None], 5: np.sqrt(np.arange(50.0)).tolist()}
    s = spark.createDataFrame([(k, i, v) for k, vs in given.items() for i, v in enumerate(vs)], "signal_id long, idx long, value double")
    codes, meta, levels = K.encode_signals(s)
    exact = {r.signal_id: r.exact for r in meta.collect()}
    assert exact == {1: True, 2: False, 3: True, 4: True, 5: True}
    back = {(r.signal_id, r.idx): r.value for r in K.decode(codes, meta, levels).collect()}
    want = {(k, i): v for k, vs in given.items() for i, v in enumerate(vs) if k != 2}
    assert {k: repr(v) for k, v in back.items()} == {k: repr(v) for k, v in want.items()}


def test_an_audit_reads_its_signals_once(spark):
    given = spark.createDataFrame([(k, i, i * 0.5) for k in range(3) for i in range(40)], "signal_id long, idx long, value double")
    seen = spark.sparkContext.accumulator(0)

    def counted(frames):
        for frame in frames:
            seen.add(len(frame))
            yield frame

    rows, _ = K.audit_codec(given.mapInPandas(counted, given.schema), given.select("signal_id").distinct())
    assert [r.passed for r in rows.collect()] == [True] * 3
    assert seen.value == 120
