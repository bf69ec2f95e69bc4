"""Scans of an inventory: what to look at, and why the rest is skipped."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.paths import base_name, extension, first_segment, normalise
from ..functions.text import filename_timestamp


def stamp(at: datetime | str) -> Column:
    """A literal timestamp without zone."""
    return F.lit(str(at)).cast("timestamp_ntz")


def file_info(df: DataFrame) -> DataFrame:
    """Adds name, extension and the time in the name to rows with ``file_path``; backslashes become slashes."""
    df = df.withColumn("file_path", normalise(F.col("file_path")))
    name = base_name(F.col("file_path"))
    return df.withColumn("file_name", name).withColumn("file_extension", extension(name)).withColumn("filename_timestamp", filename_timestamp(name))


def filter_extension(df: DataFrame, extensions: list[str] | None) -> DataFrame:
    """Rows with one of the extensions, whatever the case; all for None."""
    return df if extensions is None else df.where(_has_extension(extensions))


def _has_extension(extensions: list[str]) -> Column:
    return F.lower("file_extension").isin([e.lower() for e in extensions])


def prune_ignored(df: DataFrame, ignore: DataFrame) -> DataFrame:
    """Without the files below an ignored top-level folder; names are compared exactly and nested namesakes stay.

    ``ignore (name)`` is a person's list, and Spark broadcasts it by its size.
    """
    return df.join(ignore.select(F.col("name").alias("__name")).distinct(), first_segment(F.col("file_path")) == F.col("__name"), "left_anti")


def skip_root_files(df: DataFrame) -> DataFrame:
    """Without the files that lie in the root itself."""
    return df.where(F.instr(normalise(F.col("file_path")), "/") > 0)


def filter_settled(df: DataFrame, now: datetime | str, minutes: float) -> DataFrame:
    """Rows last changed ``minutes`` before ``now`` or earlier; a negative number counts as 0."""
    return df.where(F.col("file_mtime") <= _cutoff(now, minutes))


def filter_since(df: DataFrame, since: datetime | str) -> DataFrame:
    """Rows changed after ``since``."""
    return df.where(F.col("file_mtime") > stamp(since))


def _cutoff(now: datetime | str, minutes: float) -> Column:
    now = datetime.fromisoformat(now) if isinstance(now, str) else now
    return stamp(now - timedelta(minutes=max(0, minutes)))


def scan_all(inventory: DataFrame, now: datetime | str, settle_minutes: float = 0, extensions: list[str] | None = None, ignore: DataFrame | None = None, skip_root: bool = False) -> DataFrame:
    """The inventory with ``skip_reason``: extension, recent, or null. Ignored and root files are left out."""
    return _scan(inventory, now, None, settle_minutes, extensions, ignore, skip_root)


def scan_since(inventory: DataFrame, since: datetime | str | None, now: datetime | str, settle_minutes: float = 0, extensions: list[str] | None = None, ignore: DataFrame | None = None, skip_root: bool = False) -> DataFrame:
    """As :func:`scan_all`, with ``not_modified`` for what didn't change after ``since``; the first reason of the three holds."""
    return _scan(inventory, now, since, settle_minutes, extensions, ignore, skip_root)


def _scan(inventory, now, since, settle_minutes, extensions, ignore, skip_root) -> DataFrame:
    df = inventory if ignore is None else prune_ignored(inventory, ignore)
    df = skip_root_files(df) if skip_root else df
    reason = F.when(~_has_extension(extensions), "extension") if extensions is not None else F.when(F.lit(False), "extension")
    if since is not None:
        reason = reason.when(F.col("file_mtime") <= stamp(since), "not_modified")
    return df.withColumn("skip_reason", reason.when(F.col("file_mtime") > _cutoff(now, settle_minutes), "recent"))


def selected(scan: DataFrame) -> DataFrame:
    """The rows to look at, without the reason."""
    return scan.where(F.col("skip_reason").isNull()).drop("skip_reason")


def scan_stats(scan: DataFrame) -> DataFrame:
    """One row: files to look at, and skipped ones by reason."""
    of = lambda reason: F.count_if(F.col("skip_reason") == reason)
    return scan.agg(F.count_if(F.col("skip_reason").isNull()).alias("files_scanned"), of("extension").alias("skipped_extension"), of("not_modified").alias("skipped_not_modified"), of("recent").alias("skipped_recent"))


def count_files(scan: DataFrame) -> DataFrame:
    """One row with the number of files to look at."""
    return scan.agg(F.count_if(F.col("skip_reason").isNull()).alias("files"))


def audit_names(names: DataFrame, inventory: DataFrame | None = None) -> DataFrame:
    """``name, problem`` for list entries that are paths, or, given an inventory, no top-level folder of it."""
    bad = names.select("name", F.col("name").rlike(r"[/\\]").alias("is_path"))
    paths = bad.where("is_path").select("name", F.lit("is a path").alias("problem"))
    if inventory is None:
        return paths
    tops = inventory.select(first_segment(F.col("file_path")).alias("top")).where("top is not null").distinct()
    absent = bad.where("not is_path").join(tops, F.col("name") == F.col("top"), "left_anti")
    return paths.unionByName(absent.select("name", F.lit("not in the archive").alias("problem")))
