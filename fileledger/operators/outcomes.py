"""Results of attempted copies: applied to the ledger, and runs of failures in them."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from ..functions.text import is_conn_error
from ..sources.scratch import saved
from .scan import stamp


def resolve_outcomes(outcomes: DataFrame) -> DataFrame:
    """One row per try with ``result`` (verified, failed or checksum_mismatch) and ``message``.

    ``outcomes`` has success, error, sent_checksum, remote_checksum and remote_error of each try.
    """
    result = (
        F.when(~F.col("success"), "failed")
        .when(F.col("remote_error").isNotNull(), "failed")
        .when(F.col("remote_checksum").eqNullSafe(F.col("sent_checksum")), "verified")
        .otherwise("checksum_mismatch")
    )
    message = (
        F.when(~F.col("success"), F.col("error"))
        .when(F.col("remote_error").isNotNull(), F.concat(F.lit("the copy could not be read back: "), F.col("remote_error")))
        .when(result == "checksum_mismatch", F.concat(F.lit("the copy differs: hash of what was sent "), F.coalesce("sent_checksum", F.lit("none")), F.lit(", of what is there "), F.coalesce("remote_checksum", F.lit("none"))))
    )
    return outcomes.withColumn("result", result).withColumn("message", message)


def _folded(outcomes: DataFrame, extra: list[Column]) -> DataFrame:
    """One row per file: number of tries and mismatches, what the last successful copy sent, the last result and the last error."""
    order = F.col("attempt")
    return outcomes.groupBy("file_path").agg(
        F.count(F.lit(1)).cast("int").alias("__tries"),
        F.count_if(F.col("result") == "checksum_mismatch").cast("int").alias("__mismatches"),
        F.max_by(F.struct("result", "remote_checksum"), order).alias("__last"),
        F.max_by("sent_checksum", F.when(F.col("success") & F.col("sent_checksum").isNotNull(), order)).alias("__sent"),
        F.max_by("message", F.when(F.col("message").isNotNull(), order)).alias("__error"),
        *extra,
    )


def apply_outcomes(ledger: DataFrame, outcomes: DataFrame, now: datetime | str) -> DataFrame:
    """The ledger after plain copies, ``outcomes`` one row per try.

    Each try counts in ``transfer_attempts`` and each mismatch in ``failed_checksum_count``; ``local_checksum`` becomes the
    hash of the bytes sent; an earlier ``last_error`` stays after a success.
    """
    joined = ledger.join(_folded(resolve_outcomes(outcomes), []), "file_path", "left")
    hit, last = F.col("__tries").isNotNull(), F.col("__last.result")
    verified = last == "verified"
    put = {
        "local_checksum": F.coalesce("__sent", "local_checksum"),
        "remote_checksum": F.when(verified, F.col("__last.remote_checksum")).otherwise(F.col("remote_checksum")),
        "compressed": F.when(verified, F.lit(False)).otherwise(F.col("compressed")),
        "transfer_status": last,
        "transfer_attempts": F.col("transfer_attempts") + F.col("__tries"),
        "last_transfer_time": stamp(now),
        "failed_checksum_count": F.col("failed_checksum_count") + F.col("__mismatches"),
        "last_error": F.coalesce("__error", "last_error"),
        "last_error_time": F.when(F.col("__error").isNotNull(), stamp(now)).otherwise(F.col("last_error_time")),
        "last_verified_remote": F.when(verified, stamp(now)).otherwise(F.col("last_verified_remote")),
    }
    return joined.select(*(F.when(hit, put[n]).otherwise(F.col(n)).alias(n) if n in put else F.col(n) for n in ledger.columns))


def apply_encoded_outcomes(ledger: DataFrame, outcomes: DataFrame, now: datetime | str) -> DataFrame:
    """The ledger after encoded copies: success records the whole hash chain, every failure is ``failed``.

    ``outcomes`` has success, error, rebuilt_checksum, data_checksum, compressed_checksum, sidecar_checksum and
    compressed_bytes of each try; mismatches don't count as such here.
    """
    chain = ["data_checksum", "compressed_checksum", "sidecar_checksum", "compressed_bytes", "rebuilt_checksum"]
    folded = outcomes.groupBy("file_path").agg(
        F.count(F.lit(1)).cast("int").alias("__tries"),
        F.max_by(F.struct("success", *chain), "attempt").alias("__last"),
        F.max_by("error", F.when(~F.col("success"), F.col("attempt"))).alias("__error"),
    )
    joined = ledger.join(folded, "file_path", "left")
    hit, ok = F.col("__tries").isNotNull(), F.col("__last.success")
    put = {n: F.when(ok, F.col(f"__last.{n}")).otherwise(F.col(n)) for n in chain[:4]} | {
        "remote_checksum": F.when(ok, F.col("__last.rebuilt_checksum")).otherwise(F.col("remote_checksum")),
        "compressed": F.when(ok, F.lit(True)).otherwise(F.col("compressed")),
        "transfer_status": F.when(ok, "verified").otherwise("failed"),
        "transfer_attempts": F.col("transfer_attempts") + F.col("__tries"),
        "last_transfer_time": stamp(now),
        "last_error": F.coalesce("__error", "last_error"),
        "last_error_time": F.when(F.col("__error").isNotNull(), stamp(now)).otherwise(F.col("last_error_time")),
        "last_verified_remote": F.when(ok, stamp(now)).otherwise(F.col("last_verified_remote")),
    }
    return joined.select(*(F.when(hit, put[n]).otherwise(F.col(n)).alias(n) if n in put else F.col(n) for n in ledger.columns))


def reroute_index_siblings(ledger: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """The ledger in which the index files of rebuilt files go to the compressed tree, verified ones becoming pending."""
    names = rebuilt.select(F.concat("file_path", F.lit("_index")).alias("__index")).distinct()
    joined = ledger.join(names, F.col("file_path") == F.col("__index"), "left")
    moves = F.col("__index").isNotNull() & (F.col("remote_tree") != "compressed")
    put = {"remote_tree": F.lit("compressed"), "transfer_status": F.when(F.col("transfer_status") == "verified", "pending").otherwise(F.col("transfer_status"))}
    return joined.select(*(F.when(moves, put[n]).otherwise(F.col(n)).alias(n) if n in put else F.col(n) for n in ledger.columns))


def current_errors(ledger: DataFrame) -> DataFrame:
    """The ledger with ``current_error``: the last error, if the status still is failed or checksum_mismatch."""
    return ledger.withColumn("current_error", F.when(F.col("transfer_status").isin("failed", "checksum_mismatch"), F.col("last_error")))


# --- runs of failures, by pass ------------------------------------------------------------------------------------


def _first(df: DataFrame, reached: Column, what: Column, name: str) -> DataFrame:
    return df.where(reached).groupBy("pass_id").agg(F.min("seq").alias("seq"), F.min_by(what, "seq").alias(name))


def _local_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted rows: hits since the last reset in this task, ``run``, and whether there was none yet, ``open``, by pass; and the task's number."""
    number = TaskContext.get().partitionId()
    before, run, still_open = None, 0, True  # of the last row
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        passes = batch.column("pass_id").dictionary_encode(null_encoding="encode").indices.to_numpy()
        hits, resets = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("hit", "resets"))
        starts = np.concatenate(([before is None or not before.equals(batch.column("pass_id")[0])], passes[1:] != passes[:-1]))
        total = np.concatenate(([0], np.cumsum(hits)))
        since = np.maximum.accumulate(np.where(starts | resets, np.arange(n), -1))
        runs = total[1:] - np.where(since >= 0, total[since], -run)
        first = np.maximum.accumulate(np.where(starts, np.arange(n), -1))
        last_reset = np.maximum.accumulate(np.where(resets, np.arange(n), -1))
        opened = np.where(first >= 0, last_reset < first, (last_reset < 0) & still_open)
        before, run, still_open = batch.column("pass_id")[n - 1], int(runs[-1]), bool(opened[-1])
        more = [pa.array(runs, pa.int64()), pa.array(opened), pa.array(np.full(n, number), pa.int64())]
        yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "run", "open", "part"])


def _streaks(outcomes: DataFrame, hit: Column, resets: Column) -> DataFrame:
    """Adds ``hit`` and ``streak``: hits since the last reset, by pass in order of ``seq``.

    A segmented scan: rows are dealt by ranges of ``(pass_id, seq)``, so that one pass spreads over all tasks. Each task finds the
    runs inside its range; what it hands to the next one is a summary of each of its passes (the run at its end, and whether it
    holds no reset), and the summaries, one for each task and pass, are joined in order. Written once, since ranges are sampled.
    """
    parts = int(outcomes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = outcomes.withColumn("hit", F.coalesce(hit, F.lit(False))).withColumn("resets", F.coalesce(resets, F.lit(False)))
    dealt = rows.repartitionByRange(parts, "pass_id", "seq").sortWithinPartitions("pass_id", "seq")
    local = saved(dealt.mapInArrow(_local_runs, StructType([*rows.schema, StructField("run", LongType()), StructField("open", BooleanType()), StructField("part", LongType())])), "runs")
    ends = local.groupBy("pass_id", "part").agg(F.max_by(F.struct("run", "open"), "seq").alias("end")).select("pass_id", "part", "end.*")
    w = Window.partitionBy("pass_id").orderBy("part")
    island = F.sum((~F.col("open")).cast("int")).over(w)
    carried = ends.withColumn("island", island)
    carried = carried.withColumn("upto", F.sum("run").over(Window.partitionBy("pass_id", "island").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)))
    carried = carried.select(F.col("pass_id").alias("__pass"), F.col("part").alias("__part"), F.coalesce(F.lag("upto").over(w), F.lit(0)).alias("__carried"))
    joined = local.join(carried, F.col("pass_id").eqNullSafe(F.col("__pass")) & (F.col("part") == F.col("__part")))
    streak = F.col("run") + F.when(F.col("open"), F.col("__carried")).otherwise(0)
    return joined.select(*outcomes.columns, F.col("hit").cast("int").alias("hit"), streak.alias("streak"))


def mismatch_abort_point(outcomes: DataFrame, n: int = 5) -> DataFrame:
    """``pass_id, seq, mismatches``: where a pass reaches its n-th mismatch; passes that don't are absent.

    ``outcomes (pass_id, seq, result)``; a pass is ordered by ``seq``.
    """
    df = _streaks(outcomes, F.col("result") == "checksum_mismatch", F.lit(False))
    return _first(df, F.col("streak") >= n, F.col("streak"), "mismatches")


def conn_streaks(outcomes: DataFrame) -> DataFrame:
    """Adds ``streak``: connection failures without any other result between. ``outcomes (pass_id, seq, success, error)``."""
    hit = ~F.col("success") & is_conn_error(F.col("error"))
    return _streaks(outcomes, hit, ~hit)


def conn_streak_abort_point(outcomes: DataFrame, n: int = 12) -> DataFrame:
    """``pass_id, seq, streak``: where a pass reaches n connection failures in a row."""
    df = conn_streaks(outcomes)
    return _first(df, F.col("streak") >= n, F.col("streak"), "streak")


def decode_halt_point(outcomes: DataFrame, n: int = 5) -> DataFrame:
    """``pass_id, seq, streak``: where a pass reaches n decode failures with no success between.

    ``outcomes (pass_id, seq, success, decode_failure)``; other failures neither count nor clear.
    """
    df = _streaks(outcomes, F.col("decode_failure") & ~F.col("success"), F.col("success"))
    return _first(df, (F.col("streak") >= n) & F.col("decode_failure"), F.col("streak"), "streak")


def cancelled(outcomes: DataFrame, mismatches: int = 5, streak: int = 12) -> DataFrame:
    """The outcomes with ``cancelled``: they come after their pass's first abort point, whose own row still counts."""
    stops = mismatch_abort_point(outcomes, mismatches).select("pass_id", "seq").unionByName(conn_streak_abort_point(outcomes, streak).select("pass_id", "seq"))
    first = stops.groupBy("pass_id").agg(F.min("seq").alias("stop"))
    return outcomes.join(first, "pass_id", "left").withColumn("cancelled", F.coalesce(F.col("seq") > F.col("stop"), F.lit(False))).drop("stop")


def retry_plan(outcomes: DataFrame) -> DataFrame:
    """The files to try a second time: first tries that raised, or failed by the connection."""
    again = (F.col("attempt") == 1) & ~F.col("success") & (F.col("raised") | is_conn_error(F.col("error")))
    return outcomes.where(again).select("file_path", F.lit(2).alias("attempt"))


def final_outcomes(outcomes: DataFrame) -> DataFrame:
    """The last try of each file."""
    w = Window.partitionBy("file_path").orderBy(F.desc("attempt"))
    return outcomes.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def numbered(df: DataFrame, *order: str) -> DataFrame:
    """Adds ``seq``, from 0 in the given order. Numbers come from sorted partitions and their counts, so no task sees all rows.

    The dealt rows are written once, since bounds of ranges are sampled and would be others when they are dealt again.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    rows = saved(rows.withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id() % (1 << 33)), "numbered")
    counts = {r["__part"]: r["c"] for r in rows.groupBy("__part").agg(F.count(F.lit(1)).alias("c")).collect()}
    total, offsets = 0, {}
    for part in sorted(counts):  # one number for each partition
        offsets[part] = total
        total += counts[part]
    start = F.create_map(*(F.lit(x) for item in offsets.items() for x in item)) if offsets else F.lit(None).cast("map<int, long>")
    return rows.withColumn("seq", (F.try_element_at(start, F.col("__part")) + F.col("__at")).cast("long")).drop("__part", "__at")


def spread_sample(df: DataFrame, n: int, least_bytes: int = 0) -> DataFrame:
    """Every k-th of the rows of at least ``least_bytes``, by path, k = max(1, rows // n), and the first n of these."""
    rows = df.where(F.col("file_size_bytes") >= least_bytes)
    total = rows.count()
    if not total:
        return df.limit(0)
    step = max(1, total // n)
    return numbered(rows, "file_path").where((F.col("seq") % step == 0) & (F.col("seq") < step * n)).drop("seq")
