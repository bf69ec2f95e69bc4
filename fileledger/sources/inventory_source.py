"""A folder as a data source: its files as a table, and their changes as a stream with offsets of time."""

from __future__ import annotations

import os
import time
import zlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from .listing import as_inventory

_SCHEMA = "path string, file_size_bytes bigint, mtime double, ctime double"
_NAMES = ["path", "file_size_bytes", "mtime", "ctime"]
_ARROW = pa.schema([("path", pa.string()), ("file_size_bytes", pa.int64()), ("mtime", pa.float64()), ("ctime", pa.float64())])
_BATCH = 10_000


class Share(InputPartition):
    """A share of folders: share ``k`` of ``n`` takes the entries whose name's hash leaves ``k``; deep, with all below these."""

    def __init__(self, folders: list[str], deep: bool, k: int, n: int, after: int | None, until: int | None):
        super().__init__((folders, deep, k, n, after, until))
        self.folders, self.deep, self.k, self.n, self.after, self.until = folders, deep, k, n, after, until


def _entries(folder: str) -> Iterator[os.DirEntry]:
    """What stands in a folder; nothing if it can't be read or has gone."""
    try:
        with os.scandir(folder) as found:
            yield from found
    except OSError:
        return


def plan_shares(root: str, skip: set[str], tasks: int, after: int | None, until: int | None) -> list[Share]:
    """Deal a tree to about ``tasks`` shares or more.

    Folders are opened from the top, level by level, until ``tasks`` of them are known; each one opened is read by name only.
    Those opened are listed without what is below, the others with it. All are dealt in ``tasks / 8`` groups, and each
    group by the hash of names to 8 shares, so that one large folder isn't one task.
    """
    opened, known = [], deque([root])
    while known and len(known) < tasks:
        folder = known.popleft()
        opened.append(folder)
        for e in _entries(folder):
            if e.is_dir(follow_symlinks=False) and (folder != root or e.name not in skip):
                known.append(e.path)
                if len(known) >= tasks * 64:  # a folder of so many others is read by its shares
                    break
        else:
            continue
        opened.pop()
        known = deque(f for f in known if os.path.dirname(f) != folder)
        known.append(folder)
        break
    groups, n = max(1, tasks // 8), min(8, tasks)
    shares = []
    for folders, deep in ((opened, False), (list(known), True)):
        for g in range(min(groups, len(folders))):
            shares += [Share(folders[g::groups], deep, k, n, after, until) for k in range(n)]
    return shares


def read_share(share: Share, root: str, skip: set[str]) -> Iterator[pa.RecordBatch]:
    """The files of a share that changed after ``after`` and not after ``until``, both in microseconds; a change of names counts too."""
    rows: list[tuple] = []
    for top in share.folders:
        below = [top]
        while below:
            folder = below.pop()
            for e in _entries(folder):
                if folder == top and share.n > 1 and zlib.crc32(os.fsencode(e.name)) % share.n != share.k:
                    continue
                try:
                    if e.is_dir(follow_symlinks=False):
                        if share.deep and (folder != root or e.name not in skip):
                            below.append(e.path)
                    elif e.is_file():
                        s = e.stat()
                        changed = max(s.st_mtime_ns, s.st_ctime_ns) // 1000
                        if (share.after is None or changed > share.after) and (share.until is None or changed <= share.until):
                            rows.append((e.path, s.st_size, s.st_mtime, s.st_ctime))
                except OSError:
                    continue
                if len(rows) >= _BATCH:
                    yield _batch(rows)
                    rows = []
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)


class _Tree:
    """What both readers know of the options."""

    def __init__(self, options: dict):
        self.root = options.get("path", "").removeprefix("file://").rstrip("/") or "/"
        self.skip = set(filter(None, options.get("ignore", "").split("\n")))
        self.tasks = max(1, int(options.get("tasks", "64")))
        self.settle = float(options.get("settleseconds", options.get("settleSeconds", "0")))

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        return read_share(partition, self.root, self.skip)


class InventoryReader(_Tree, DataSourceReader):
    def partitions(self) -> list[Share]:
        if not os.path.isdir(self.root):
            raise FileNotFoundError(self.root)
        return plan_shares(self.root, self.skip, self.tasks, None, None)


class InventoryStreamReader(_Tree, DataSourceStreamReader):
    """An offset is a time in microseconds; a batch holds the files whose last change lies between two of them."""

    def initialOffset(self) -> dict:
        return {"micros": -1}

    def latestOffset(self) -> dict:
        return {"micros": int((time.time() - self.settle) * 1_000_000)}

    def partitions(self, start: dict, end: dict) -> list[Share]:
        if end["micros"] <= start["micros"]:  # the clock was set back
            return []
        return plan_shares(self.root, self.skip, self.tasks, start["micros"], end["micros"])

    def commit(self, end: dict) -> None:
        pass


class InventorySource(DataSource):
    """Format ``inventory``: ``path, file_size_bytes, mtime, ctime`` of the files below the option ``path``, which every executor mounts.

    Options: ``ignore``, names of top-level folders, one a line; ``tasks``; ``settleSeconds``, how long a streamed file must
    have stayed as it is. Folders that can't be read are left out, and files that go meanwhile; an empty folder has no rows.
    """

    @classmethod
    def name(cls) -> str:
        return "inventory"

    def schema(self) -> str:
        return _SCHEMA

    def reader(self, schema) -> InventoryReader:
        return InventoryReader(self.options)

    def streamReader(self, schema) -> InventoryStreamReader:
        return InventoryStreamReader(self.options)


def _options(ignore: list[str] | None, tasks: int, settle_minutes: float = 0) -> dict[str, str]:
    return {"ignore": "\n".join(ignore or []), "tasks": str(tasks), "settleSeconds": str(60 * max(0.0, settle_minutes))}


def read_inventory(spark: SparkSession, root: str, ignore: list[str] | None = None, tasks: int = 64) -> DataFrame:
    """The inventory of a folder, listed when the frame is evaluated; :func:`~fileledger.sources.listing.list_files` deals very uneven trees better."""
    spark.dataSource.register(InventorySource)
    return as_inventory(spark.read.format("inventory").options(**_options(ignore, tasks)).load(root), root)


def stream_inventory(spark: SparkSession, root: str, ignore: list[str] | None = None, settle_minutes: float = 0, tasks: int = 64) -> DataFrame:
    """A stream of inventory rows: first all files, then those that changed, each once it has stayed as it is for the settle window.

    A file that changes again before its batch is read comes in a later batch, so no change is lost; a batch that is
    run again may lack it. The clocks of the file server and the driver may differ by the settle window.
    """
    spark.dataSource.register(InventorySource)
    return as_inventory(spark.readStream.format("inventory").options(**_options(ignore, tasks, settle_minutes)).load(root), root)
