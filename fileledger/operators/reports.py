"""Reports of passes, verifications and the ledger, one row each."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import megabytes, per_second
from ..schema import ACTIONABLE
from .ledger import count_by_status, ledger_totals, recent
from .scan import scan_stats


def top_n_with_overflow(df: DataFrame, n: int, name: str = "name", order: str = "file_path") -> DataFrame:
    """One row: the first n names in order, and how many more there are. Only n rows meet in one task."""
    head = df.select(F.struct(F.col(order).alias("o"), F.col(name).alias("v")).alias("s")).orderBy("s").limit(n)
    names = head.agg(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["v"]).alias("names"))
    total = df.agg(F.count(F.lit(1)).alias("total"))
    return names.join(F.broadcast(total), how="cross").select("names", "total", F.greatest(F.col("total") - n, F.lit(0)).alias("more"))  # one row by one row


def recent_summary(ledger: DataFrame, now: datetime | str, hours: int = 6, n: int = 5) -> DataFrame:
    """One row with ``summary``: empty without recent files, else what is verified, or how many have issues and the first names."""
    rows = recent(ledger, now, hours)
    issue = F.col("transfer_status").isin(ACTIONABLE)
    counts = rows.agg(F.count(F.lit(1)).alias("t"), F.count_if(F.col("transfer_status") == "verified").alias("v"), F.count_if(issue).alias("p"))
    names = top_n_with_overflow(rows.where(issue), n, "file_name")
    head = F.format_string(f"In {hours} hours %d files were modified", F.col("t"))
    listed = F.array_join(F.transform("names", lambda x: F.concat(F.lit("\n* "), x)), "")
    more = F.when(F.col("more") > 0, F.format_string("\n(%d others)", F.col("more"))).otherwise("")
    text = F.when(F.col("t") == 0, "").when(F.col("p") > 0, F.concat(head, F.format_string("; to look at: %d", F.col("p")), listed, more)).otherwise(F.concat(head, F.format_string("; verified: %d", F.col("v"))))
    return counts.join(F.broadcast(names), how="cross").select(text.alias("summary"))  # one row by one row


def sync_stats(scan: DataFrame, plan: DataFrame, outcomes: DataFrame, requeued: DataFrame | None = None) -> DataFrame:
    """The counters of a pass in one row.

    ``outcomes`` holds the final try of each file with ``result`` and ``bytes_transferred``. Files held back by the settle
    window are counted apart for the scan and for re-queued files.
    """
    p = plan.agg(F.count(F.lit(1)).alias("files_checked"), F.count_if("needs_transfer").alias("files_planned"), F.count_if(F.col("reason") == "already_there").alias("files_already_there"))
    o = outcomes.agg(
        F.count_if(F.col("result") == "verified").alias("files_transferred"),
        F.count_if(F.col("result") != "verified").alias("files_failed"),
        F.count_if(F.col("result") == "checksum_mismatch").alias("files_mismatched"),
        F.coalesce(F.sum(F.when(F.col("result") == "verified", F.col("bytes_transferred"))), F.lit(0)).alias("bytes_transferred"),
        F.coalesce(F.sum("duration_seconds"), F.lit(0.0)).alias("copy_seconds"),
    )
    out = scan_stats(scan).join(F.broadcast(p), how="cross").join(F.broadcast(o), how="cross")  # one row each
    if requeued is not None:
        r = requeued.agg(F.count_if(~F.col("held")).alias("files_requeued"), F.count_if("held").alias("requeue_skipped_recent"))
        out = out.join(F.broadcast(r), how="cross")
    return out


def severity(bad: Column, otherwise_bad: str) -> Column:
    return F.when(bad, otherwise_bad).otherwise("success")


def sync_summary(stats: DataFrame, seconds: float) -> DataFrame:
    """Transferred, failed, MB, seconds, MB/s, severity and a text of a pass."""
    mb = megabytes(F.col("bytes_transferred"))
    speed = per_second(mb, F.lit(float(seconds)))
    text = F.format_string("%d transferred, %d failed, %.1f MB in %.0fs", F.col("files_transferred"), F.col("files_failed"), mb, F.lit(float(seconds)))
    return stats.select("files_transferred", "files_failed", mb.alias("mb"), F.lit(float(seconds)).alias("seconds"), speed.alias("mb_per_second"), severity(F.col("files_failed") > 0, "warning").alias("severity"), text.alias("summary"))


def verify_summary(verdicts: DataFrame, n: int = 10) -> DataFrame:
    """Checked, ok, mismatches (local ones too), errors, missing, severity and the first names of remote mismatches."""
    of = lambda *names: F.count_if(F.col("verdict").isin(*names))
    counts = verdicts.agg(F.count(F.lit(1)).alias("files_checked"), of("ok").alias("files_ok"), of("local_changed", "remote_mismatch").alias("mismatches"), of("remote_error").alias("errors"), of("local_missing").alias("missing"))
    names = top_n_with_overflow(verdicts.where(F.col("verdict") == "remote_mismatch"), n, "file_name")
    out = counts.join(F.broadcast(names.select("names", "more")), how="cross")  # one row by one row
    return out.withColumn("severity", severity((F.col("mismatches") > 0) | (F.col("errors") > 0), "error"))


def status_report(ledger: DataFrame, state: DataFrame) -> DataFrame:
    """Totals, counts by status as a map, and the state's times, in one row."""
    counts = count_by_status(ledger).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("transfer_status", "files")))).alias("status_counts"))
    cursors = state.select("last_scan_time", "last_full_verify_time")
    return ledger_totals(ledger).join(F.broadcast(counts), how="cross").join(F.broadcast(cursors), how="cross")  # one row each
