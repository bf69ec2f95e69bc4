"""The ledger: look-ups, upserts, deletes, counts and state."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import ACTIONABLE, STATE, STATUSES, domain
from .prefix import running_sum
from .scan import stamp


def get_file(ledger: DataFrame, path: str) -> DataFrame:
    """The record of one path: no row or one."""
    return ledger.where(F.col("file_path") == path)


def get_files(ledger: DataFrame, keys: DataFrame) -> DataFrame:
    """The records of the paths in ``keys``."""
    return ledger.join(keys.select("file_path"), "file_path", "left_semi")


def latest(changes: DataFrame, order: str = "seq") -> DataFrame:
    """One row per path, that with the highest ``order``; without such a column the rows are taken as unique."""
    if order not in changes.columns:
        return changes
    rank = F.row_number().over(Window.partitionBy("file_path").orderBy(F.desc(order)))
    return changes.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def upsert(ledger: DataFrame, changes: DataFrame, order: str = "seq") -> DataFrame:
    """The ledger with the rows of ``changes`` in place of, or beside, its own; of a repeated path the last change holds."""
    changes = latest(changes, order).select(*ledger.columns)
    return ledger.join(changes.select("file_path"), "file_path", "left_anti").select(*ledger.columns).unionByName(changes)


def delete_files(ledger: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The ledger without the paths in ``keys``, and those paths that it had."""
    keys = keys.select("file_path").distinct()
    return ledger.join(keys, "file_path", "left_anti"), keys.join(ledger, "file_path", "left_semi")


def by_status(ledger: DataFrame, status: str) -> DataFrame:
    return ledger.where(F.col("transfer_status") == status)


def pending_transfers(ledger: DataFrame) -> DataFrame:
    """Records to be sent, or sent again."""
    return ledger.where(F.col("transfer_status").isin(ACTIONABLE))


def unverified(ledger: DataFrame, older_than: datetime | str | None = None) -> DataFrame:
    """Records never verified at the target, or last before ``older_than``."""
    never = F.col("last_verified_remote").isNull()
    return ledger.where(never if older_than is None else never | (F.col("last_verified_remote") < stamp(older_than)))


def stalest(ledger: DataFrame, byte_budget: int) -> DataFrame:
    """The records to verify next within a budget: never verified ones, then those longest ago, by path, until their bytes reach it.

    The record that passes the budget is the last one taken, so that each call goes on, whatever a file's size. Unknown sizes
    count as 0. Repeated over time, every record has its turn. Sums come from sorted ranges, so no task sees all records.
    """
    summed = running_sum(ledger, F.col("file_size_bytes"), F.asc_nulls_first("last_verified_remote"), "file_path")
    return summed.where(F.col("before") < byte_budget).drop("seq", "before")


def count_tracked(ledger: DataFrame) -> DataFrame:
    return ledger.agg(F.count(F.lit(1)).alias("files"))


def count_by_status(ledger: DataFrame) -> DataFrame:
    """A row for each status, with 0 where there is no record."""
    counts = ledger.groupBy("transfer_status").agg(F.count(F.lit(1)).alias("c"))
    return domain(ledger.sparkSession, STATUSES, "transfer_status").join(counts, "transfer_status", "left").select("transfer_status", F.coalesce("c", F.lit(0)).alias("files"))


def ledger_totals(ledger: DataFrame) -> DataFrame:
    """Files and bytes tracked; unknown sizes count as 0."""
    return ledger.agg(F.count(F.lit(1)).alias("total_files_tracked"), F.coalesce(F.sum("file_size_bytes"), F.lit(0)).alias("total_bytes_tracked"))


def recent(ledger: DataFrame, now: datetime | str, hours: float = 6) -> DataFrame:
    """Records of files modified in the last hours."""
    now = datetime.fromisoformat(now) if isinstance(now, str) else now
    return ledger.where(F.col("file_mtime") > stamp(now - timedelta(hours=hours)))


def recent_stats(ledger: DataFrame, now: datetime | str, hours: float = 6) -> DataFrame:
    """A row for each status: recent files, zero-filled."""
    return count_by_status(recent(ledger, now, hours))


def read_state(state: DataFrame | None, spark=None) -> DataFrame:
    """The state's one row, or its default."""
    spark = spark or state.sparkSession
    default = spark.range(1).select(*(F.lit(0 if f.dataType.typeName() == "long" else None).cast(f.dataType).alias(f.name) for f in STATE))
    if state is None:
        return default
    first = state.select(*STATE.fieldNames()).limit(1)
    return first.unionByName(default.join(first.select(F.lit(1)).limit(1), F.lit(True), "left_anti"))


def update_state(state: DataFrame, ledger: DataFrame, **fields: datetime | str | None) -> DataFrame:
    """The state with some times set and the totals recounted; names that it doesn't have are ignored."""
    totals = ledger_totals(ledger)
    kept = [F.lit(None if fields[n] is None else str(fields[n])).cast("timestamp_ntz").alias(n) if n in fields else F.col(n) for n in STATE.fieldNames()[:3]]
    return state.select(*kept).join(F.broadcast(totals), how="cross")  # one row by one row


def advance_cursor(state: DataFrame, ledger: DataFrame, start: datetime, mode: str = "settled", settle_minutes: float = 0) -> DataFrame:
    """Set the scan cursor after a pass that began at ``start``.

    ``settled`` steps back by the settle window, so that a file skipped as too recent is seen by the next pass;
    ``start`` takes the start itself, which loses such files until a full scan.
    """
    if mode not in ("settled", "start"):
        raise ValueError(mode)
    return update_state(state, ledger, last_scan_time=start - timedelta(minutes=max(0, settle_minutes)) if mode == "settled" else start)
