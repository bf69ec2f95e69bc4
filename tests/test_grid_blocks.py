"""Grids of signals whose levels are many ranges' and many blocks'."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fileledger.operators import codec as K
from fileledger.operators.prefix import ranged


def levels_of(spark, signals):
    rows = [(s, float(v)) for s, values in signals.items() for v in values]
    return spark.createDataFrame(rows, "signal_id long, level double").repartition(5)


def plain_fit(values):
    """Offset, step and whether on a grid, of finite levels in order, one after the other."""
    v = np.sort(np.array(values, dtype=float))
    if len(v) == 1:
        return 1.0, True
    gaps = np.diff(v)
    share = gaps / gaps.min()
    if np.abs(share - np.rint(share)).max() > K.GRID_TOLERANCE:
        return None, False
    k = np.rint((v - v[0]) / gaps.min())
    return float((k * (v - v[0])).sum() / (k * k).sum()), True


@pytest.mark.parametrize("block", [2, 7, 100, 1 << 16])
def test_borders_of_blocks_and_ranges_change_nothing(spark, monkeypatch, block):
    monkeypatch.setattr(K, "BLOCK_LEVELS", block)
    rng = np.random.default_rng(block)
    signals = {1: 0.1 + 0.003 * np.arange(700), 2: [5.0], 3: np.unique(rng.normal(size=400)), 4: np.unique(rng.integers(0, 5000, 300)) * 0.25, 5: [0.0, 2.0]}
    for at in range(6, 12):  # one level off the grid, at and beside borders of blocks
        signals[at] = np.r_[np.arange(at + 1.0), at + 0.5, np.arange(at + 1.0, 30)]
    fit = {r.signal_id: r for r in K.fit_grid(levels_of(spark, signals)).collect()}
    assert set(fit) == set(signals)
    for s, values in signals.items():
        step, on_grid = plain_fit(values)
        assert fit[s].n_levels == len(values) and fit[s].grid_offset == min(values) and fit[s].on_grid == on_grid
        assert (fit[s].step is None) == (step is None) and (step is None or abs(fit[s].step - step) <= 1e-12 * step)
    again = {r.signal_id: r for r in K.fit_grid(levels_of(spark, signals).repartition(3)).collect()}
    assert again == fit  # to the last bit, however rows are dealt


def test_numbers_of_levels(spark):
    rng = np.random.default_rng(5)
    signals = {s: np.unique(rng.normal(size=n)) for s, n in ((1, 900), (2, 1), (3, 40))}
    got = K.number_levels(levels_of(spark, signals)).collect()
    assert {(r.signal_id, r.level, r.level_idx) for r in got} == {(s, v, i) for s, vs in signals.items() for i, v in enumerate(vs)}
    assert {r.signal_id for r in K.number_levels(levels_of(spark, signals), 40).collect()} == {2, 3}
    assert K.number_levels(levels_of(spark, signals).limit(0)).count() == 0


def test_a_signal_of_too_many_levels_is_on_no_grid_and_not_sorted(spark, monkeypatch):
    monkeypatch.setattr(K, "MAX_FIT_LEVELS", 50)
    seen, real = [], K.ranged
    monkeypatch.setattr(K, "ranged", lambda df, *by: seen.append(df.count()) or real(df, *by))
    fit = {r.signal_id: r for r in K.fit_grid(levels_of(spark, {1: np.arange(51.0), 2: np.arange(50.0)})).collect()}
    assert (fit[1].n_levels, fit[1].on_grid, fit[1].step) == (51, False, None) and fit[2].on_grid and seen == [50]


def test_odd_levels(spark):
    odd = {1: [float("nan"), 1.0], 2: [float("inf"), 1.0], 3: [float("-inf")], 4: [0.0, 1.0]}
    fit = {r.signal_id: r.on_grid for r in K.fit_grid(levels_of(spark, odd).unionByName(spark.createDataFrame([(5, None)], "signal_id long, level double"))).collect()}
    assert fit == {1: False, 2: False, 3: False, 4: True, 5: False}
    assert K.fit_grid(levels_of(spark, odd).limit(0)).count() == 0


def test_one_signal_is_no_single_task(spark):
    df = spark.range(400_000).select(F.lit(1).cast("long").alias("signal_id"), F.hash("id").cast("double").alias("level")).distinct()
    sizes = [r["count"] for r in ranged(df, "signal_id", "level").groupBy("__part").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2 * sum(sizes) / 4
