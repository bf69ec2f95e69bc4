"""Directory listings as inventories."""

from __future__ import annotations

import os
from collections.abc import Iterator
from datetime import UTC, datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scan import file_info
from .scratch import saved

_ROWS = "path string, is_dir boolean, file_size_bytes bigint, mtime double, ctime double"


def list_files(spark: SparkSession, root: str, ignore: list[str] | None = None, batch: int = 64) -> DataFrame:
    """The inventory of a folder that every executor mounts: empty and hidden files too, links to folders not followed.

    Each round lists all folders of one depth in parallel, so a deep or wide branch doesn't hold up one task; ignored
    top-level folders are never opened. Folders that can't be read are left out, and files that go meanwhile.
    ``root`` itself must exist. Each depth is written once, so that all of it is of one time and a lost executor
    doesn't list again.
    """
    if not os.path.isdir(root):
        raise FileNotFoundError(root)
    root = root.rstrip("/") or "/"
    skip = set(ignore or [])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for folder in frame["path"]:
                try:
                    entries = list(os.scandir(folder))
                except OSError:
                    continue
                for e in entries:
                    try:
                        if e.is_dir(follow_symlinks=False):
                            if folder != root or e.name not in skip:
                                rows.append((e.path, True, 0, 0.0, 0.0))
                        elif e.is_file():
                            s = e.stat()
                            rows.append((e.path, False, s.st_size, s.st_mtime, s.st_ctime))
                    except OSError:
                        continue
            yield pd.DataFrame(rows, columns=["path", "is_dir", "file_size_bytes", "mtime", "ctime"])

    folders = spark.createDataFrame([(root,)], "path string")
    files: DataFrame | None = None
    while True:
        found = folders.repartition(max(1, min(1000, folders.count() // batch))).mapInPandas(run, _ROWS)
        found = saved(found, "listing")
        here = found.where(~F.col("is_dir")).drop("is_dir")
        files = here if files is None else files.unionByName(here)
        folders = found.where("is_dir").select("path")
        if folders.limit(1).count() == 0:
            break
    return as_inventory(files, root)


def as_inventory(files: DataFrame, root: str) -> DataFrame:
    """Listed files ``(path, file_size_bytes, mtime, ctime)``, times in seconds, as inventory rows with paths below ``root``."""
    root = root.removeprefix("file://").rstrip("/")
    as_time = lambda c: F.expr(f"timestamp_micros(cast(round({c} * 1000000) as bigint))").cast("timestamp_ntz")
    listed = files.withColumn("file_path", F.substr("path", F.lit(len(root) + 2), F.length("path")))
    listed = listed.withColumn("file_mtime", as_time("mtime")).withColumn("file_ctime", as_time("ctime"))
    return file_info(listed).select("file_path", "file_name", "file_extension", "file_size_bytes", "file_mtime", "file_ctime", "filename_timestamp")


def read_content(spark: SparkSession, root: str, glob: str | None = None, modified_after: datetime | None = None) -> DataFrame:
    """``path, modificationTime, length, content`` of files below ``root``; sizes and times are pushed to the listing.

    Spark leaves out empty files and names that begin with ``_`` or ``.``, and can't hold 2 GB in a row:
    use :func:`list_files` and :func:`~fileledger.functions.hashing.hash_files` for those.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after.astimezone(UTC).strftime("%Y-%m-%dT%H:%M:%S"))
    return reader.load(root)


def read_ignore_list(spark: SparkSession, file: str | None = None, names: str | None = None) -> DataFrame:
    """``name`` rows from a text file (one a line; blank lines and ``#`` comments left out) or, without one, a comma list."""
    if file:
        return spark.read.text(file).select(F.trim("value").alias("name")).where("name <> '' and not startswith(name, '#')").distinct()
    given = spark.range(1).select(F.explode(F.split(F.lit(names or ""), ",")).alias("name"))
    return given.select(F.trim("name").alias("name")).where("name <> ''").distinct()
