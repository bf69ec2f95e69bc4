"""A ledger of buckets: a change rewrites the buckets that it touches, and a manifest names the files of each version.

Paths are dealt to a fixed number of buckets by hash. ``manifests/m<version>.json`` says, for each bucket, which folder
below ``data`` holds it, and its files, bytes and files by status, so totals need no record. Manifests are
created, never written over: of two writers that start from one version the second is refused. A manifest
ends with a mark; one without it, of a writer that stopped, counts for nothing but keeps its number.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import STATUSES, with_defaults
from .scratch import place, remove

BUCKETS = 64
_MARK = "whole"


class Conflict(RuntimeError):
    """Another writer has committed since the version that a change started from."""


def _numbers(spark: SparkSession, path: str) -> list[int]:
    fs, p = place(spark, f"{path}/manifests")
    if not fs.exists(p):
        return []
    names = (re.fullmatch(r"m(\d+)\.json", f.getPath().getName()) for f in fs.listStatus(p))
    return sorted(int(m[1]) for m in names if m)


def _manifest(spark: SparkSession, path: str, version: int) -> dict | None:
    """A version's manifest; None if it isn't there or not whole."""
    fs, p = place(spark, f"{path}/manifests/m{version:08d}.json")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        found = json.loads(text)
    except ValueError:
        return None
    return found if found.get(_MARK) else None


def current(spark: SparkSession, path: str) -> int | None:
    """The highest whole version; None if there is none."""
    return next((v for v in reversed(_numbers(spark, path)) if _manifest(spark, path, v)), None)


def _bucket(count: int):
    return F.pmod(F.xxhash64("file_path"), F.lit(count)).cast("int")


def _read(spark: SparkSession, path: str, manifest: dict, buckets: set[int] | None = None) -> DataFrame:
    places = [f"{path}/data/{b['at']}" for k, b in manifest["buckets"].items() if buckets is None or int(k) in buckets]
    empty = with_defaults(spark.createDataFrame([], "file_path string"))
    return with_defaults(spark.read.schema(empty.schema).parquet(*places)) if places else empty


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The records of a version, of the current one by default."""
    version = current(spark, path) if version is None else version
    manifest = None if version is None else _manifest(spark, path, version)
    if version is not None and manifest is None:
        raise FileNotFoundError(f"{path}: no version {version}")
    return _read(spark, path, manifest or {"buckets": {}})


def _commit(spark: SparkSession, path: str, version: int, manifest: dict) -> None:
    """Create a version's manifest; the file system lets only one writer do so."""
    fs, p = place(spark, f"{path}/manifests/m{version:08d}.json")
    try:
        out = fs.create(p, False)
    except Exception as e:
        if fs.exists(p):
            raise Conflict(f"{path}: version {version} is another writer's") from e
        raise
    try:
        out.write(bytearray(json.dumps(manifest | {_MARK: True}).encode()))
    finally:
        out.close()


def write_changes(spark: SparkSession, path: str, changes: DataFrame, base: int | None = None, gone: DataFrame | None = None, buckets: int = BUCKETS) -> int:
    """A new version with the records of ``changes`` put in place of those with their paths, and without the paths of ``gone``.

    Only the buckets of these paths are read and written. ``base`` is the version that the change was made from (the current one by
    default); if it isn't current any more, :class:`Conflict` is raised and nothing is left. Gives the version. Of
    several records of a path in ``changes`` the greatest by all columns stays.
    """
    now = current(spark, path)
    base = now if base is None else base
    if base != now:
        raise Conflict(f"{path}: the change starts from version {base}, the current one is {now}")
    numbers = _numbers(spark, path)
    version = (numbers[-1] if numbers else -1) + 1
    manifest = _manifest(spark, path, base) if base is not None else {"count": buckets, "buckets": {}}
    count = manifest["count"]
    new = with_defaults(changes)
    new = new.groupBy("file_path").agg(F.max(F.struct(*new.columns)).alias("r")).select("r.*")
    paths = new.select("file_path") if gone is None else new.select("file_path").unionByName(gone.select("file_path"))
    touched = {r["b"] for r in paths.select(_bucket(count).alias("b")).distinct().collect()}  # at most ``count`` rows
    folder = uuid.uuid4().hex
    if touched:
        old = _read(spark, path, manifest, touched)
        if gone is not None:
            old = old.join(gone.select("file_path"), "file_path", "left_anti")
        rows = old.join(new.select("file_path"), "file_path", "left_anti").unionByName(new).withColumn("bucket", _bucket(count))
        rows.repartition("bucket").write.partitionBy("bucket").parquet(f"{path}/data/{folder}")
    try:
        entries = {k: b for k, b in manifest["buckets"].items() if int(k) not in touched}
        if touched:
            written = spark.read.schema(rows.schema).parquet(f"{path}/data/{folder}")
            by_status = [F.count_if(F.col("transfer_status") == s).alias(f"s_{s}") for s in STATUSES]
            for r in written.groupBy("bucket").agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("file_size_bytes"), F.lit(0)).alias("bytes"), *by_status).collect():
                entries[str(r.bucket)] = {"at": f"{folder}/bucket={r.bucket}", "files": r.files, "bytes": r.bytes, "status": {s: r[f"s_{s}"] for s in STATUSES}}
        _commit(spark, path, version, {"count": count, "buckets": entries})
    except BaseException:
        remove(spark, f"{path}/data/{folder}")
        raise
    return version


def totals(spark: SparkSession, path: str, version: int | None = None) -> dict:
    """``files``, ``bytes`` and ``status`` (files by status, zeros too) of a version, from its manifest alone."""
    version = current(spark, path) if version is None else version
    found = [] if version is None else list(_manifest(spark, path, version)["buckets"].values())
    return {"files": sum(b["files"] for b in found), "bytes": sum(b["bytes"] for b in found), "status": {s: sum(b["status"][s] for b in found) for s in STATUSES}}


def check_totals(spark: SparkSession, path: str) -> bool:
    """Whether the manifest's totals are those of a recount of all records."""
    records = read(spark, path)
    counts = {r["transfer_status"]: r["count"] for r in records.groupBy("transfer_status").count().collect()}
    row = records.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("file_size_bytes"), F.lit(0)).alias("bytes")).first()
    return totals(spark, path) == {"files": row.files, "bytes": row.bytes, "status": {s: counts.get(s, 0) for s in STATUSES}}


def expire(spark: SparkSession, path: str, keep: int = 3) -> int:
    """Delete all versions but the last ``keep`` whole ones, and the data that none of these names: how many versions went.

    Not to be run while a writer is at work, whose data no manifest names yet. The highest number stays, so none is given twice.
    """
    numbers = _numbers(spark, path)
    whole = [v for v in numbers if _manifest(spark, path, v)]
    kept = whole[-keep:]
    used = {b["at"] for v in kept for b in _manifest(spark, path, v)["buckets"].values()}
    going = [v for v in numbers if v not in kept and v != numbers[-1]]
    for v in going:
        remove(spark, f"{path}/manifests/m{v:08d}.json")
    fs, data = place(spark, f"{path}/data")
    for folder in fs.listStatus(data) if fs.exists(data) else []:
        name = folder.getPath().getName()
        inside = [f"{name}/{b.getPath().getName()}" for b in fs.listStatus(folder.getPath()) if b.isDirectory()]
        if not used & set(inside):
            remove(spark, f"{path}/data/{name}")
        else:
            for at in set(inside) - used:
                remove(spark, f"{path}/data/{at}")
    return len(going)
