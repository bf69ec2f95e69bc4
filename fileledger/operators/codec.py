"""Float signals as small integer codes, without loss where the report says exact.

``signals (signal_id, idx, value double)`` is long; levels, fits and codes are tables too. A signal's distinct values are
its levels. Each signal takes the first encoding that fits: ``affine_codes`` (a uniform grid), ``indexed`` (the
number of its level) or ``fixed_point`` (scaled to 24 bits, with loss).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import publish, remove, saved
from . import prefix
from .prefix import dealt, joined, ranged

#: How far from a whole number of steps a gap between levels may be.
GRID_TOLERANCE = 1e-4
MAX_BITS = 24
FULL = 2**23 - 1
#: For callers who want no grid of more levels than this: :func:`fit_grid` then leaves such signals out. Unset, as here and in all queries, every signal is fitted.
MAX_FIT_LEVELS: int | None = None
#: Levels of a signal that are looked at together.
BLOCK_LEVELS = 1 << 16
#: Property names that say that samples are scaled on reading, and the highest rate of the stored format.
SCALE_PREFIX = "NI_Scale"
SCALE_NAMES = ["NI_Scaling_Status", "NI_Number_Of_Scales"]
HIGHEST_RATE = 655_350


def bits_equal(a: Column, b: Column) -> Column:
    """Equal bit for bit, but for the payloads of NaN: the shortest decimal forms are equal, which parts -0.0 from 0.0."""
    return a.cast("string").eqNullSafe(b.cast("string"))


def _levels(signals: DataFrame) -> DataFrame:
    """The levels with their samples, and whether -0.0 is among these; samples are dealt first, so that no task holds the levels of more than its share."""
    samples = dealt(signals.select("signal_id", "value", F.xxhash64("value").alias("__hash")), signals.count(), "signal_id", "__hash")
    minus = F.bool_or(F.coalesce(F.col("value").cast("string") == "-0.0", F.lit(False)))
    return samples.groupBy("signal_id", "__hash", F.col("value").alias("level")).agg(F.count(F.lit(1)).alias("samples"), minus.alias("minus_zero")).drop("__hash")


def _heavy(counts: DataFrame, *keys: str, weight: str) -> DataFrame:
    """What :func:`joined` must know of keys with more rows than a task should sort."""
    return counts.where(F.col(weight) > prefix.TASK_ROWS).select(*keys, F.col(weight).alias("weight"))


def signal_levels(signals: DataFrame) -> DataFrame:
    """``signal_id, level, samples``: the distinct values of each signal; -0.0 and 0.0 are one level."""
    return _levels(signals).drop("minus_zero")


def number_levels(levels: DataFrame, most: int | None = None) -> DataFrame:
    """``signal_id, level, level_idx``: levels numbered from 0 in order, of all signals, or of those with no more than ``most`` of them.

    With ``most``, levels are counted before anything is sorted. Sorted ranges of all levels are numbered in their own tasks, and the counts of
    a signal's earlier ranges are added, so that the levels of one signal are no single task's.
    """
    levels = levels.select("signal_id", "level")
    if most is not None:
        many = levels.groupBy("signal_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)  # at most one for so many levels
        levels = levels.join(F.broadcast(many.select("signal_id")), "signal_id", "left_anti")
    rows = ranged(levels, "signal_id", "level")
    parts = rows.groupBy("signal_id", "__part").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy("signal_id").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("signal_id", "__part", (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first")).alias("__shift"))
    rows = dealt(rows, rows.count(), "signal_id", "__part")
    return rows.join(parts, ["signal_id", "__part"]).select("signal_id", "level", (F.col("__at") + F.col("__shift")).cast("long").alias("level_idx"))


def fit_grid(levels: DataFrame, places: DataFrame | None = None) -> DataFrame:
    """``signal_id, n_levels, grid_offset, step, on_grid`` from the levels.

    The step is the least gap; every gap must be a whole number of steps up to the tolerance; then the step is refined
    by least squares over all levels, summed in level order in blocks of :data:`BLOCK_LEVELS` and over these, so that the last bit
    doesn't depend on partitions and a signal is many tasks' work. A single level has step 1. Levels that are null, NaN or
    infinite aren't on a grid, not even single ones. ``places`` are the levels numbered before, if they are. The numbered levels are
    sorted twice, each time in steps of their own: for the least gaps, and for all that needs these.
    """
    if places is None:
        levels = saved(levels, "levels")
        places = saved(number_levels(levels, MAX_FIT_LEVELS), "places")
    per = levels.groupBy("signal_id").agg(F.count(F.lit(1)).alias("n_levels"), F.max("level").alias("top"), F.min("level").alias("grid_offset"))
    finite = (F.col("top") < F.lit(float("inf"))) & (F.col("grid_offset") > F.lit(float("-inf")))
    per = saved(per.withColumn("finite", F.coalesce(finite, F.lit(False))), "spans")
    placed = dealt(places.withColumn("block", F.floor(F.col("level_idx") / BLOCK_LEVELS)), places.count(), "signal_id", "block")
    in_block = Window.partitionBy("signal_id", "block").orderBy("level_idx")
    gap = F.col("level") - F.lag("level").over(in_block)
    ends = placed.select("signal_id", "block", "level", gap.alias("gap")).groupBy("signal_id", "block").agg(F.min("level").alias("low"), F.max("level").alias("high"), F.min("gap").alias("least"))
    ends = saved(ends.join(per.where(F.col("finite") & (F.col("n_levels") > 1)).select("signal_id", "grid_offset"), "signal_id"), "ends")
    by_block = Window.partitionBy("signal_id").orderBy("block")  # one row for BLOCK_LEVELS levels of a signal
    ends = ends.withColumn("border", F.col("low") - F.lag("high").over(by_block))
    steps = saved(ends.select("signal_id", "block", "grid_offset", "border", F.min(F.least("least", "border")).over(Window.partitionBy("signal_id")).alias("least_gap")), "steps")
    so_far = Window.unboundedPreceding, Window.currentRow
    whole = lambda g: F.abs(g / F.col("least_gap") - F.rint(g / F.col("least_gap")))
    k = F.rint((F.col("level") - F.col("grid_offset")) / F.col("least_gap"))
    of_step = placed.join(steps, ["signal_id", "block"])
    sums = of_step.select("signal_id", "block", "level_idx", "least_gap", whole(F.col("border")).alias("at_border"), whole(gap).alias("inside"), F.sum(k * (F.col("level") - F.col("grid_offset"))).over(in_block.rowsBetween(*so_far)).alias("num"), F.sum(k * k).over(in_block.rowsBetween(*so_far)).alias("den"))
    blocks = saved(sums.groupBy("signal_id", "block").agg(F.max_by("num", "level_idx").alias("num"), F.max_by("den", "level_idx").alias("den"), F.max(F.greatest("at_border", "inside")).alias("worst"), F.first("least_gap").alias("least_gap")), "sums")
    joined = blocks.select("signal_id", "block", "worst", "least_gap", F.sum("num").over(by_block.rowsBetween(*so_far)).alias("num"), F.sum("den").over(by_block.rowsBetween(*so_far)).alias("den"))
    off = joined.groupBy("signal_id").agg(F.first("least_gap").alias("least_gap"), F.max("worst").alias("worst"), (F.max_by("num", "block") / F.max_by("den", "block")).alias("refined"))
    fit = per.join(off, "signal_id", "left")
    fit = fit.withColumn("on_grid", F.coalesce(F.col("finite") & ((F.col("n_levels") == 1) | ((F.col("least_gap") > 0) & (F.col("worst") <= GRID_TOLERANCE))), F.lit(False)))
    return fit.select("signal_id", "n_levels", "grid_offset", F.when(F.col("on_grid"), F.when(F.col("n_levels") == 1, F.lit(1.0)).otherwise(F.col("refined"))).alias("step"), "on_grid")


def affine_codes(signals: DataFrame, fit: DataFrame) -> DataFrame:
    """``signal_id, idx, value, code`` of the signals on a grid, rounded half to even."""
    grid = fit.where("on_grid").select("signal_id", "grid_offset", "step")
    return signals.join(grid, "signal_id").select("signal_id", "idx", "value", F.rint((F.col("value") - F.col("grid_offset")) / F.col("step")).cast("long").alias("code"), "grid_offset", "step")


def level_index(levels: DataFrame) -> DataFrame:
    """``signal_id, level, level_idx``: levels numbered from 0 in order."""
    return number_levels(levels)


def indexed_codes(signals: DataFrame, index: DataFrame) -> DataFrame:
    """``signal_id, idx, value, code``: each sample's level number."""
    at = index.select(F.col("signal_id").alias("__s"), F.col("level").alias("__level"), "level_idx")
    return signals.join(at, (F.col("signal_id") == F.col("__s")) & F.col("value").eqNullSafe(F.col("__level"))).select("signal_id", "idx", "value", F.col("level_idx").alias("code"))


def fixed_point_codes(signals: DataFrame) -> DataFrame:
    """``signal_id, idx, value, code, scale``: samples scaled to 24 bits by the largest magnitude, 1 for a signal of zeros."""
    scale = signals.groupBy("signal_id").agg(F.max(F.abs("value")).alias("m")).select("signal_id", F.when(F.col("m") == 0, F.lit(1.0)).otherwise(F.col("m")).alias("scale"))
    return signals.join(scale, "signal_id").select("signal_id", "idx", "value", F.rint(F.col("value") / F.col("scale") * F.lit(float(FULL))).cast("long").alias("code"), "scale")


def bits_for_codes(low: Column, high: Column) -> Column:
    """The least width of a signed integer, 2 at least, that holds all from ``low`` to ``high``; 2 for null."""
    up = F.when(high > 0, F.length(F.bin(high)) + 1)
    down = F.when(low < 0, F.length(F.bin(-low - 1)) + 1)
    return F.greatest(F.lit(2), F.coalesce(up, F.lit(2)), F.coalesce(down, F.lit(2))).cast("int")


def encoding_stats(levels: DataFrame, fit: DataFrame) -> DataFrame:
    """For each signal: its level count, the width of affine codes and whether they are exact, the width of level numbers, the scale of fixed-point codes.

    All of it follows from the levels, so the samples aren't read; ``minus_zero`` says that a level of zero has samples of
    -0.0, which no code keeps.
    """
    grid = fit.select("signal_id", "n_levels", "grid_offset", "step", "on_grid")
    code = F.rint((F.col("level") - F.col("grid_offset")) / F.col("step"))
    of = joined(levels, levels.count(), grid, _heavy(grid, "signal_id", weight="n_levels"), "signal_id", spread="level")
    coded = of.withColumn("code", F.when(F.col("on_grid"), code).cast("long"))
    same = bits_equal(F.col("grid_offset") + F.col("code") * F.col("step"), F.col("level")) & ~F.col("minus_zero")
    largest = F.max(F.abs("level"))
    sums = coded.groupBy("signal_id").agg(bits_for_codes(F.min("code"), F.max("code")).alias("affine_bits"), F.bool_and(same).alias("affine_exact"), F.when(largest == 0, F.lit(1.0)).otherwise(largest).alias("largest"), F.sum("samples").alias("n_samples"))
    return fit.join(sums, "signal_id").withColumn("index_bits", bits_for_codes(F.lit(0), F.col("n_levels") - 1))


def choose_encoding(stats: DataFrame, exact: bool = True) -> DataFrame:
    """Adds ``encoding``, ``code_bits`` and the stored ``bits_per_sample`` (16 or 24)."""
    affine = F.coalesce(F.col("on_grid") & (F.col("affine_bits") <= MAX_BITS) & (F.col("affine_exact") if exact else F.lit(True)), F.lit(False))
    encoding = F.when(affine, "affine_codes").when(F.col("index_bits") <= MAX_BITS, "indexed").otherwise("fixed_point")
    out = stats.withColumn("encoding", encoding)
    out = out.withColumn("code_bits", F.when(F.col("encoding") == "affine_codes", F.col("affine_bits")).when(F.col("encoding") == "indexed", F.col("index_bits")).otherwise(F.lit(MAX_BITS)))
    return out.withColumn("bits_per_sample", F.when(F.col("code_bits") <= 16, 16).otherwise(24))


def _value(level: Column) -> Column:
    """A sample from its code, as its signal's encoding says."""
    return (
        F.when(F.col("encoding") == "affine_codes", F.col("grid_offset") + F.col("code") * F.col("step"))
        .when(F.col("encoding") == "indexed", level)
        .otherwise(F.col("code").cast("double") / (F.pow(F.lit(2.0), F.col("bits_per_sample") - 1) - 1) * F.col("scale"))
    )


def encode_signals(signals: DataFrame, exact: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(codes, meta, levels)`` of all signals. Levels, encodings and codes are written once, since each is used several times.
    A code depends on its sample's level only, so levels get codes, and samples meet these in one join.

    ``codes (signal_id, idx, code)``; ``meta`` has encoding, bits_per_sample, grid_offset, step, scale, n_levels, n_samples,
    and, from decoding every code that was written, ``exact`` and ``max_abs_error``; ``levels (signal_id, level_idx, level)``
    of the indexed signals. With ``exact``, a signal that doesn't decode bit for bit has no codes and no levels, only its
    row in ``meta``. Empty signals have no rows anywhere; see :func:`route` for them.
    """
    levels = saved(_levels(signals), "levels")
    places = saved(number_levels(levels), "places")
    fit = saved(fit_grid(levels, places), "fit")
    chosen = choose_encoding(encoding_stats(levels, fit), exact)
    affine, fixed = F.col("encoding") == "affine_codes", F.col("encoding") == "fixed_point"
    chosen = saved(chosen.select("signal_id", "encoding", "bits_per_sample", F.when(affine, F.col("grid_offset")).alias("grid_offset"), F.when(affine, F.col("step")).alias("step"), F.when(fixed, F.col("largest")).alias("scale"), "n_levels", "n_samples"), "encodings")
    large = _heavy(chosen, "signal_id", weight="n_levels")
    index = saved(joined(places, places.count(), chosen.where("encoding = 'indexed'").select("signal_id"), large, "signal_id", spread="level_idx"), "index")
    of = chosen.where("encoding <> 'indexed'").select("signal_id", "encoding", "grid_offset", "step", "scale", "bits_per_sample")
    of = joined(levels.select("signal_id", "level"), levels.count(), of, large, "signal_id", spread="level")
    computed = F.when(affine, F.rint((F.col("level") - F.col("grid_offset")) / F.col("step"))).otherwise(F.rint(F.col("level") / F.col("scale") * F.lit(float(FULL))))
    plain = of.withColumn("code", computed.cast("long")).select("signal_id", "level", "code", _value(F.lit(None).cast("double")).alias("back"))
    at = saved(plain.unionByName(index.select("signal_id", "level", F.col("level_idx").alias("code"), F.col("level").alias("back"))), "level_codes")
    at, common = (df.withColumn("hash", F.xxhash64("level")) for df in (at, levels.where(F.col("samples") > prefix.TASK_ROWS)))
    common = common.groupBy("signal_id", "hash").agg(F.sum("samples").alias("weight"))  # each once, even if hashes are equal
    both = joined(signals.select("signal_id", "idx", "value", F.xxhash64("value").alias("hash")), signals.count(), at, common, "signal_id", "hash", spread="idx")
    both = both.where(F.when(F.col("value").isNull(), F.col("level").isNull()).otherwise(F.col("value") == F.col("level")))
    coded = saved(both.select("signal_id", "idx", "code", "value", "back"), "codes")
    same = bits_equal(F.col("value"), F.col("back"))
    error = F.max(F.when(same, F.lit(0.0)).otherwise(F.abs(F.col("value") - F.col("back"))))
    report = coded.groupBy("signal_id").agg(F.count(F.lit(1)).alias("n_decoded"), F.bool_and(same).alias("same"), error.alias("max_abs_error"))
    meta = saved(chosen.join(report, "signal_id").withColumn("exact", F.col("same") & (F.col("n_decoded") == F.col("n_samples"))).drop("same", "n_decoded"), "meta")
    codes, index = coded.select("signal_id", "idx", "code"), index.select("signal_id", "level_idx", "level")
    if exact and meta.where("not exact").limit(1).count():
        good = meta.where("exact").select("signal_id")
        codes = joined(codes, coded.count(), good, _heavy(meta, "signal_id", weight="n_samples"), "signal_id", spread="idx")
        index = joined(index, index.count(), good, large, "signal_id", spread="level_idx")
    return codes, meta, index


def decode(codes: DataFrame, meta: DataFrame, levels: DataFrame) -> DataFrame:
    """``signal_id, idx, value`` from codes, as each signal's encoding says; only indexed codes meet the levels."""
    n = codes.count()
    long = _heavy(meta, "signal_id", weight="n_samples")
    how = meta.select("signal_id", "encoding", "grid_offset", "step", "scale", "bits_per_sample")
    m = joined(codes.select("signal_id", "idx", "code"), n, how, long, "signal_id", spread="idx")
    plain = m.where("encoding <> 'indexed'").select("signal_id", "idx", _value(F.lit(None).cast("double")).alias("value"))
    within = codes.join(F.broadcast(long.select("signal_id")), "signal_id", "left_semi").groupBy("signal_id", "code").agg(F.count(F.lit(1)).alias("n"))  # a common code's signal is long
    at = levels.select("signal_id", F.col("level_idx").alias("code"), "level")
    indexed = joined(m.where("encoding = 'indexed'"), n, at, _heavy(within, "signal_id", "code", weight="n"), "signal_id", "code", spread="idx", how="left")
    return plain.unionByName(indexed.select("signal_id", "idx", F.col("level").alias("value")))


def roundtrip_report(signals: DataFrame, decoded: DataFrame) -> DataFrame:
    """``signal_id, n_samples, n_decoded, max_abs_error, exact`` of decoded signals; exact is bit for bit, with no sample lost or added."""
    n = signals.count()
    a = dealt(signals.select("signal_id", "idx", F.col("value").alias("a"), F.lit(True).alias("in_a")), n, "signal_id", "idx")
    both = a.join(dealt(decoded.select("signal_id", "idx", F.col("value").alias("b"), F.lit(True).alias("in_b")), n, "signal_id", "idx"), ["signal_id", "idx"], "full")
    paired = F.col("in_a").isNotNull() & F.col("in_b").isNotNull()
    out = both.groupBy("signal_id").agg(F.count("in_a").alias("n_samples"), F.count("in_b").alias("n_decoded"), F.max(F.abs(F.col("a") - F.col("b"))).alias("worst"), F.bool_and(paired & bits_equal(F.col("a"), F.col("b"))).alias("exact"))
    return out.select("signal_id", "n_samples", "n_decoded", F.when(F.col("n_samples") == F.col("n_decoded"), F.coalesce("worst", F.lit(0.0))).otherwise(F.lit(float("inf"))).alias("max_abs_error"), "exact")


def compression_report(meta: DataFrame) -> DataFrame:
    """``encoding, signals, bytes_in, bytes_out, times``: float64 bytes against stored codes and level tables."""
    out = F.col("n_samples") * F.col("bits_per_sample") / 8 + F.when(F.col("encoding") == "indexed", F.col("n_levels") * 8).otherwise(0)
    sums = meta.groupBy("encoding").agg(F.count(F.lit(1)).alias("signals"), F.sum(F.col("n_samples") * 8).alias("bytes_in"), F.sum(out.cast("long")).alias("bytes_out"))
    return sums.withColumn("times", F.when(F.col("bytes_out") > 0, F.col("bytes_in") / F.col("bytes_out")))


def signal_xxh64(signals: DataFrame) -> DataFrame:
    """``signal_id, data_xxh64, n_samples``: xxh64 of the samples' little-endian float64 bytes in index order.

    The hash depends on order, so a signal's samples pass one task; they are sorted by Spark, which spills, and hashed
    in a stream, with nothing but the hash's state in memory.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        last, h, n, started = None, None, 0, False
        rows: list[tuple] = []
        for frame in frames:
            if not len(frame):
                continue
            ids = frame["signal_id"].to_numpy()
            values = frame["value"].to_numpy("<f8")
            cuts = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if not started or ids[lo] != last:
                    if started:
                        rows.append((last, h.hexdigest(), n))
                    last, h, n, started = ids[lo], xxhash.xxh64(), 0, True
                h.update(values[lo:hi].tobytes())
                n += hi - lo
            if rows:
                yield pd.DataFrame(rows, columns=["signal_id", "data_xxh64", "n_samples"])
                rows = []
        if started:
            yield pd.DataFrame([(last, h.hexdigest(), n)], columns=["signal_id", "data_xxh64", "n_samples"])

    kind = signals.schema["signal_id"].dataType.simpleString()
    rows = dealt(signals.select("signal_id", "idx", "value"), signals.count(), "signal_id").sortWithinPartitions("signal_id", "idx")
    return rows.select("signal_id", "value").mapInPandas(run, f"signal_id {kind}, data_xxh64 string, n_samples long")


def signal_meta(meta: DataFrame, hashes: DataFrame, timing: DataFrame) -> DataFrame:
    """The encodings with hashes and timing; the rate is the inverse increment, rounded half to even.

    ``timing (signal_id, wf_increment, wf_start_time)``.
    """
    rate = F.rint(1 / F.when(F.col("wf_increment") > 0, F.col("wf_increment"))).cast("int")
    return meta.join(hashes.select("signal_id", "data_xxh64"), "signal_id").join(timing, "signal_id", "left").withColumn("sample_rate_hz", rate)


def rebuild_signals(codes: DataFrame, meta: DataFrame, levels: DataFrame, expected: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Decoded signals whose hash is as expected, and one ``signal_id, ok, error`` row for each expected signal.

    ``expected (signal_id, data_xxh64)``. The decoded samples are written once, hashed as they are read again, and nothing
    of a signal with another hash comes out.
    """
    staged = saved(decode(codes, meta, levels), "rebuilt")
    result = saved(_against(staged, expected), "result")
    return staged.join(result.where("ok").select("signal_id"), "signal_id", "left_semi"), result


def _against(signals: DataFrame, expected: DataFrame) -> DataFrame:
    """``signal_id, ok, error`` of expected hashes against those of signals."""
    got = signal_xxh64(signals).select("signal_id", F.col("data_xxh64").alias("got"))
    judged = expected.select("signal_id", "data_xxh64").join(got, "signal_id", "left")
    error = F.when(F.col("got").isNull(), "no samples").when(~F.col("got").eqNullSafe(F.col("data_xxh64")), F.concat(F.lit("data hash "), F.col("got"), F.lit(" is not as expected")))
    return judged.select("signal_id", error.isNull().alias("ok"), error.alias("error"))


def publish_rebuilt(codes: DataFrame, meta: DataFrame, levels: DataFrame, expected: DataFrame, path: str) -> DataFrame:
    """Rebuild signals into ``path``, a new folder of Parquet files: one ``signal_id, ok, error`` row for each expected signal.

    The good signals are written beside ``path``, read again and hashed again; the folder gets its name only if all of
    them still are as expected, and is removed otherwise.
    """
    good, result = rebuild_signals(codes, meta, levels, expected)
    spark, stage = codes.sparkSession, f"{path}.part"
    good.write.mode("overwrite").parquet(stage)
    again = _against(spark.read.schema(good.schema).parquet(stage), expected.join(result.where("ok").select("signal_id"), "signal_id", "left_semi"))
    bad = saved(again.where("not ok").select("signal_id"), "reread")
    if bad.limit(1).count():
        remove(spark, stage)
        return result.join(bad.withColumn("__bad", F.lit(True)), "signal_id", "left").select("signal_id", F.lit(False).alias("ok"), F.coalesce("error", F.when(F.col("__bad"), "reads back differently").otherwise("not published with others")).alias("error"))
    publish(spark, stage, path)
    return result


def channel_shape(channels: DataFrame) -> DataFrame:
    """``file_path, n_groups, n_channels, single``: a file can be encoded if it has one channel in one group."""
    out = channels.groupBy("file_path").agg(F.count_distinct("group_name").alias("n_groups"), F.count(F.lit(1)).alias("n_channels"))
    return out.withColumn("single", (F.col("n_groups") == 1) & (F.col("n_channels") == 1))


def codec_eligibility(ledger: DataFrame, channels: DataFrame, enabled: bool = True, least_bytes: int = 10 << 20, extension: str = ".tdms", highest_rate: int = HIGHEST_RATE) -> DataFrame:
    """``file_path, eligible, decline_reason`` of records, by the first reason that holds.

    ``channels (file_path, group_name, channel_name, properties map<string, struct<t, dt, v>>)``.
    """
    shape = channel_shape(channels)
    one = channels.join(shape.where("single").select("file_path"), "file_path", "left_semi").select("file_path", "properties")
    joined = ledger.select("file_path", "file_extension", "file_size_bytes").join(shape, "file_path", "left").join(one, "file_path", "left")
    prop = lambda name: F.try_element_at("properties", F.lit(name))["v"]
    step = prop("wf_increment").try_cast("double")
    rate = F.rint(1 / F.when(step > 0, step))
    scaled = F.exists(F.map_keys("properties"), lambda k: k.startswith(SCALE_PREFIX) | k.isin(SCALE_NAMES))
    reason = (
        F.when(F.lit(not enabled), "switched_off")
        .when(F.lower("file_extension") != extension, "extension")
        .when(F.col("file_size_bytes") < least_bytes, "too_small")
        .when(F.col("n_channels").isNull(), "unreadable")
        .when(F.col("n_groups") != 1, "groups")
        .when(F.col("n_channels") != 1, "channels")
        .when(scaled, "scaling_properties")
        .when(prop("wf_increment").isNull() | prop("wf_start_time").isNull(), "no_timing")
        .when(~F.coalesce(step > 0, F.lit(False)), "increment")
        .when(~rate.between(1, highest_rate), "sample_rate")
    )
    return joined.select("file_path", reason.isNull().alias("eligible"), reason.alias("decline_reason"))


def route(eligibility: DataFrame, reports: DataFrame) -> DataFrame:
    """``file_path, route, reason``: encoded, or plain because declined, fallback_empty (no samples) or not exact.

    ``reports (file_path, exact)``, a round-trip report by file; a file without one has no samples.
    """
    joined = eligibility.join(reports.select("file_path", "exact"), "file_path", "left")
    reason = F.when(~F.col("eligible"), F.concat(F.lit("declined: "), F.col("decline_reason"))).when(F.col("exact").isNull(), "fallback_empty").when(~F.col("exact"), "not_exact")
    return joined.select("file_path", F.when(reason.isNull(), "encoded").otherwise("plain").alias("route"), reason.alias("reason"))


def audit_codec(signals: DataFrame, sample: DataFrame, properties: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Encode, decode and rebuild the sampled signals: ``signal_id, passed, reason``, and totals in one row.

    ``sample (signal_id)``; ``properties (signal_id, before, after)`` maps that must be equal, if given.
    """
    mine = saved(signals.join(sample.select("signal_id"), "signal_id", "left_semi"), "sampled")
    back = saved(decode(*encode_signals(mine)), "decoded")
    report = saved(roundtrip_report(mine, back), "report")
    rebuilt = saved(_against(back, signal_xxh64(mine)), "rebuilt")
    out = sample.select("signal_id").join(report, "signal_id", "left").join(rebuilt, "signal_id", "left")
    same = F.lit(True)
    if properties is not None:
        out = out.join(properties, "signal_id", "left")
        same = F.array_sort(F.map_entries("before")).eqNullSafe(F.array_sort(F.map_entries("after")))
    reason = F.when(F.col("n_samples").isNull(), "skipped: no samples").when(~F.col("exact"), "not exact").when(~F.col("ok"), F.col("error")).when(~same, "properties differ")
    rows = out.select("signal_id", reason.isNull().alias("passed"), reason.alias("reason"))
    totals = rows.agg(F.count_if("passed").alias("passed"), F.count_if(F.col("reason").startswith("skipped")).alias("skipped"), F.count_if(~F.col("passed") & ~F.coalesce(F.col("reason").startswith("skipped"), F.lit(False))).alias("failed"))
    return rows, totals
