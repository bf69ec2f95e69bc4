"""Bulk copies between folders that every executor mounts."""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import CHUNK, file_xxh64
from ..operators.prefix import running_sum
from .scratch import saved

_SCHEMA = "file_path string, attempt int, success boolean, bytes_transferred bigint, duration_seconds double, error string, raised boolean, sent_checksum string, remote_checksum string, remote_error string"


def copy_one(source: str, target: str, chunk: int = CHUNK) -> tuple[int, str]:
    """Copy a file in chunks, hash exactly the bytes written, and rename it into place at the end."""
    import xxhash

    os.makedirs(os.path.dirname(target), exist_ok=True)
    part = f"{target}.{uuid.uuid4().hex}.part"
    h, n = xxhash.xxh64(), 0
    try:
        with open(source, "rb") as src, open(part, "wb") as dst:
            while data := src.read(chunk):
                dst.write(data)
                h.update(data)
                n += len(data)
            dst.flush()
            os.fsync(dst.fileno())
        os.replace(part, target)
    except BaseException:
        if os.path.exists(part):
            os.remove(part)
        raise
    return n, h.hexdigest()


def copy_files(plan: DataFrame, source: str, target: str, parallelism: int = 8, attempt: int = 1, chunk: int = CHUNK) -> DataFrame:
    """Copy the paths of ``plan`` and read each copy's hash back: one outcome row per file.

    ``plan`` has ``file_path`` and may have ``target_file``, a path below ``target``, and ``task``, from 0 below ``parallelism``. A task that runs twice writes the
    same file again. The result must be saved before it is used twice, since every evaluation copies.
    """
    named = plan if "target_file" in plan.columns else plan.withColumn("target_file", plan["file_path"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for path, to in zip(frame["file_path"], frame["target_file"], strict=True):
                began = time.monotonic()
                n, sent, there, error, remote_error = 0, None, None, None, None
                try:
                    n, sent = copy_one(os.path.join(source, path), os.path.join(target, to), chunk)
                    try:
                        there = file_xxh64(os.path.join(target, to), chunk)
                    except OSError as e:
                        remote_error = f"{type(e).__name__}: {e.strerror}"
                except OSError as e:
                    error = f"{type(e).__name__}: {e.strerror}"
                rows.append((path, attempt, error is None, n, time.monotonic() - began, error, error is not None, sent, there, remote_error))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _SCHEMA.split(", ")])

    dealt = named.repartitionById(parallelism, "task") if "task" in named.columns else named.repartition(parallelism)
    return dealt.select("file_path", "target_file").mapInPandas(run, _SCHEMA)


def move_files(moves: DataFrame, root_of: str = "") -> DataFrame:
    """Rename ``artifact`` to ``moved_to``, creating folders: ``artifact, moved_to, error``. A file moved before is no error."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for old, new in zip(frame["artifact"], frame["moved_to"], strict=True):
                error = None
                try:
                    if os.path.exists(root_of + old) or not os.path.exists(root_of + new):
                        os.makedirs(os.path.dirname(root_of + new), exist_ok=True)
                        os.replace(root_of + old, root_of + new)
                except OSError as e:
                    error = f"{type(e).__name__}: {e.strerror}"
                rows.append((old, new, error))
            yield pd.DataFrame(rows, columns=["artifact", "moved_to", "error"])

    return moves.select("artifact", "moved_to").mapInPandas(run, "artifact string, moved_to string, error string")


def remove_files(copies: DataFrame) -> DataFrame:
    """Delete the files ``copy``: the rows with ``removed`` and ``error``. A file that isn't there any more counts as removed."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            removed, errors = [], []
            for path in frame["copy"]:
                error = None
                try:
                    os.remove(path)
                except FileNotFoundError:
                    pass
                except OSError as e:
                    error = f"{type(e).__name__}: {e.strerror}"
                removed.append(error is None)
                errors.append(error)
            yield frame.assign(removed=removed, error=errors)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in copies.schema)
    return copies.mapInPandas(run, f"{fields}, removed boolean, error string")


def free_space(spark: SparkSession, folders: list[str]) -> DataFrame:
    """``target, free_bytes`` of mounted folders, asked in a task; of a folder that isn't there yet, its nearest parent's."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for folder in frame["target"]:
                at = folder
                while not os.path.isdir(at):
                    at = os.path.dirname(at) or "/"
                s = os.statvfs(at)
                rows.append((folder, s.f_bavail * s.f_frsize))
            yield pd.DataFrame(rows, columns=["target", "free_bytes"])

    return spark.createDataFrame([(f,) for f in folders], "target string").mapInPandas(run, "target string, free_bytes bigint")


#: What a file costs besides its bytes, as bytes; the least and the most bytes of a range.
FILE_COST, LEAST_RANGE, MOST_RANGE = 1 << 16, 8 << 20, 1 << 30

_PIECE = "file_path string, target_file string, part string, task int, start bigint, length bigint, copied bigint, seconds double, hash string, error string"


def range_size(total_bytes: int, parallelism: int) -> int:
    """Bytes of a range, so that a task has eight or so; between 8 MiB and 1 GiB."""
    return max(LEAST_RANGE, min(MOST_RANGE, total_bytes // (8 * parallelism)))


def file_ranges(plan: DataFrame, range_bytes: int) -> DataFrame:
    """Each file of ``plan (file_path, target_file, file_size_bytes)`` as ranges ``start, length`` and whether it is the ``last``; unknown sizes and empty files as one."""
    size = F.greatest(F.coalesce("file_size_bytes", F.lit(0)), F.lit(1))
    starts = F.sequence(F.lit(0).cast("long"), size - 1, F.lit(range_bytes).cast("long"))
    cut = plan.select("file_path", "target_file", "file_size_bytes", F.explode(starts).alias("start"))
    left = F.greatest(F.coalesce("file_size_bytes", F.lit(0)) - F.col("start"), F.lit(0))
    return cut.select("file_path", "target_file", "start", F.least(left, F.lit(range_bytes)).cast("long").alias("length"), (left <= range_bytes).alias("last"))


def deal_ranges(ranges: DataFrame, parallelism: int) -> DataFrame:
    """Adds ``task``, from 0 below ``parallelism``: longest ranges first, cut where the running sum of bytes passes a share.

    No task has more than its share and one range. A range counts :data:`FILE_COST` more than its bytes, so that empty files are dealt too.
    """
    cost = F.col("length") + F.lit(FILE_COST)
    summed = running_sum(ranges, cost, F.desc("length"), "file_path", "start")
    total = summed.agg(F.sum(cost)).first()[0] or 1
    return summed.withColumn("task", F.expr(f"cast(before * cast({parallelism} as decimal(10, 0)) div {total} as int)")).drop("seq", "before")


def copy_range(source: str, part: str, start: int, length: int, last: bool, chunk: int = CHUNK) -> tuple[int, str]:
    """Copy one range of a file to its place in a part file, which needn't be there: bytes and their hash. The last range goes to the file's end."""
    import xxhash

    os.makedirs(os.path.dirname(part), exist_ok=True)
    h, n = xxhash.xxh64(), 0
    to = os.open(part, os.O_WRONLY | os.O_CREAT, 0o644)
    try:
        with open(source, "rb") as src:
            src.seek(start)
            while data := src.read(chunk if last else min(chunk, length - n)):
                at = 0
                while at < len(data):
                    at += os.pwrite(to, data[at:], start + n + at)
                h.update(data)
                n += len(data)
        if not last and n < length:
            raise OSError(0, "the source became shorter while it was copied")
        os.fsync(to)
    finally:
        os.close(to)
    return n, h.hexdigest()


def finish_ranges(source: str, target: str, part: str, ranges: list[tuple[int, int, str]], chunk: int = CHUNK) -> tuple[str, str | None, str | None]:
    """Give a part file its name and read it back in order: hash of what was sent, hash of what is there, and why that couldn't be read.

    If every range reads back as it was sent, what was sent has the hash of what is there; if not, it is the source's.
    """
    import xxhash

    if os.path.exists(part) or not os.path.exists(target):  # else an earlier try of this task gave the name
        os.replace(part, target)
    whole, same = xxhash.xxh64(), True
    try:
        with open(target, "rb") as f:
            for _, n, sent in sorted(ranges):
                h = xxhash.xxh64()
                while n and (data := f.read(min(chunk, n))):
                    h.update(data)
                    whole.update(data)
                    n -= len(data)
                same &= h.hexdigest() == sent
            while data := f.read(chunk):  # more than was sent
                whole.update(data)
                same = False
    except OSError as e:
        return file_xxh64(source, chunk), None, f"{type(e).__name__}: {e.strerror}"
    there = whole.hexdigest()
    return there if same else file_xxh64(source, chunk), there, None


def copy_ranged(plan: DataFrame, source: str, target: str, parallelism: int = 8, attempt: int = 1, range_bytes: int | None = None, chunk: int = CHUNK) -> DataFrame:
    """:func:`copy_files` with tasks of equal bytes: large files are copied in ranges by several tasks.

    ``plan`` has ``file_size_bytes``. The ranges of a file go to one part file, which gets its name when all are there; a file of
    which a range fails leaves none. Hashes depend on order, so each copy is read back by one task. Ranges are copied when this is called.
    """
    named = plan if "target_file" in plan.columns else plan.withColumn("target_file", plan["file_path"])
    named = named.select("file_path", "target_file", "file_size_bytes")
    if range_bytes is None:
        range_bytes = range_size(named.agg(F.sum("file_size_bytes")).first()[0] or 0, parallelism)
    tag = uuid.uuid4().hex
    dealt = deal_ranges(file_ranges(named, range_bytes), parallelism)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for path, to, start, length, last, task in zip(frame["file_path"], frame["target_file"], frame["start"], frame["length"], frame["last"], frame["task"], strict=True):
                began, n, hashed, error = time.monotonic(), 0, None, None
                part = f"{os.path.join(target, to)}.{tag}.part"
                try:
                    n, hashed = copy_range(os.path.join(source, path), part, start, length, last, chunk)
                except OSError as e:
                    error = f"{type(e).__name__}: {e.strerror}"
                rows.append((path, to, part, task, start, length, n, time.monotonic() - began, hashed, error))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _PIECE.split(", ")])

    def end(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for path, to, part, pieces, seconds, error in zip(frame["file_path"], frame["target_file"], frame["part"], frame["pieces"], frame["seconds"], frame["error"], strict=True):
                began, sent, there, remote_error = time.monotonic(), None, None, None
                try:
                    if error is None:
                        ranges = [(p["start"], p["copied"], p["hash"]) for p in pieces]
                        sent, there, remote_error = finish_ranges(os.path.join(source, path), os.path.join(target, to), part, ranges, chunk)
                    elif os.path.exists(part):
                        os.remove(part)
                except OSError as e:
                    error = f"{type(e).__name__}: {e.strerror}"
                n = sum(p["copied"] for p in pieces) if error is None else 0
                rows.append((path, attempt, error is None, n, seconds + time.monotonic() - began, error, error is not None, sent, there, remote_error))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _SCHEMA.split(", ")])

    done = saved(dealt.repartitionById(parallelism, "task").mapInPandas(run, _PIECE), "ranges")
    files = done.groupBy("file_path", "target_file", "part").agg(
        F.collect_set(F.struct("start", "copied", "hash")).alias("pieces"), F.sum("seconds").alias("seconds"), F.min("error").alias("error"), F.min("task").alias("task")
    )  # at most a file's ranges
    return files.repartitionById(parallelism, "task").mapInPandas(end, _SCHEMA)
