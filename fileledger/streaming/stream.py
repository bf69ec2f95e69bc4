"""Micro-batch forms: a ledger from a stream of changes, rows held until they settle, periodic passes."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.ledger import latest
from ..operators.scan import stamp
from ..sources.scratch import place, remove


def fold_events(state: DataFrame | None, events: DataFrame) -> DataFrame:
    """``file_path, file_size_bytes, seq, changes, duplicates`` after some events ``(file_path, file_size_bytes, seq)``.

    An event of the size before it is a duplicate, any other one a change; the first event of a path is a change.
    Events of one batch are taken in order of ``seq``; those not after a path's last one were seen before, and are left out.
    """
    if state is not None:
        last = state.select("file_path", F.col("file_size_bytes").alias("old_size"), F.col("seq").alias("old_seq"), "changes", "duplicates")
        joined = events.join(last, "file_path", "left").where("old_seq is null or seq > old_seq")
    else:
        joined = events.withColumn("old_size", F.lit(None).cast("long")).withColumn("changes", F.lit(0).cast("long")).withColumn("duplicates", F.lit(0).cast("long"))
    before = F.lag("file_size_bytes").over(Window.partitionBy("file_path").orderBy("seq"))
    first = F.row_number().over(Window.partitionBy("file_path").orderBy("seq")) == 1
    same = F.coalesce(F.when(first, F.col("old_size")).otherwise(before) == F.col("file_size_bytes"), F.lit(False))
    marked = joined.withColumn("same", same)
    new = marked.groupBy("file_path").agg(F.max_by("file_size_bytes", "seq").alias("file_size_bytes"), F.max("seq").alias("seq"), (F.coalesce(F.max("changes"), F.lit(0)) + F.count_if(~F.col("same"))).alias("changes"), (F.coalesce(F.max("duplicates"), F.lit(0)) + F.count_if("same")).alias("duplicates"))
    if state is None:
        return new
    return state.join(new.select("file_path"), "file_path", "left_anti").select(*new.columns).unionByName(new)


_LEDGER = "file_path string, file_size_bytes bigint, seq bigint, changes bigint, duplicates bigint"


def _versions(spark: SparkSession, path: str) -> dict[int, list[int]]:
    """The batches in which each bucket was written, in order."""
    fs, at = place(spark, f"{path}/batch=*/bucket=*")
    found: dict[int, list[int]] = {}
    for f in fs.globStatus(at) or []:
        folder = f.getPath()
        found.setdefault(int(folder.getName().split("=")[1]), []).append(int(folder.getParent().getName().split("=")[1]))
    return {bucket: sorted(batches) for bucket, batches in found.items()}


def _latest(spark: SparkSession, path: str, below: int | None, buckets: set[int] | None = None) -> DataFrame | None:
    """The last rows of buckets, of batches before ``below``."""
    last = {b: max((n for n in batches if below is None or n < below), default=None) for b, batches in _versions(spark, path).items() if buckets is None or b in buckets}
    paths = [f"{path}/batch={n:08d}/bucket={b}" for b, n in last.items() if n is not None]
    return spark.read.schema(_LEDGER).parquet(*paths) if paths else None


def stream_ledger(events: DataFrame, path: str, checkpoint: str, buckets: int = 64, keep: int = 3) -> StreamingQuery:
    """Keep a ledger of a stream of change events under ``path``; :func:`read_stream_ledger` gives the latest.

    Paths are dealt to ``buckets`` by hash. A micro-batch rewrites only the buckets that its events touch, and the last
    ``keep`` versions of a bucket stay. A batch that is run again starts from the versions before it and writes the same again.
    """

    def fold(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        bucket = F.pmod(F.xxhash64("file_path"), F.lit(buckets)).cast("int")
        batch.persist()
        try:
            touched = {r["b"] for r in batch.select(bucket.alias("b")).distinct().collect()}  # at most ``buckets`` rows
            state = _latest(spark, path, batch_id, touched) if touched else None
            new = fold_events(state, batch).withColumn("bucket", bucket)
            if not touched:
                return
            new.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/batch={batch_id:08d}")
        finally:
            batch.unpersist()
        found = _versions(spark, path)
        kept = set()
        for b, batches in found.items():
            old = [n for n in batches if n <= batch_id][:-keep]
            kept |= set(batches) - set(old)
            for n in old:
                remove(spark, f"{path}/batch={n:08d}/bucket={b}")
        for n in {n for batches in found.values() for n in batches} - kept:  # no bucket's version is left in it
            remove(spark, f"{path}/batch={n:08d}")

    return events.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_stream_ledger(spark: SparkSession, path: str, batch_id: int | None = None) -> DataFrame:
    """The ledger after a batch, one of the last few; after the last one by default."""
    found = _latest(spark, path, None if batch_id is None else batch_id + 1)
    return spark.createDataFrame([], _LEDGER) if found is None else found


def split_settled(held: DataFrame | None, rows: DataFrame, now: datetime, minutes: float) -> tuple[DataFrame, DataFrame]:
    """Of carried-over and new rows those that have settled, and those to hold on: the latest row of each path counts."""
    every = rows if held is None else held.unionByName(rows)
    every = latest(every, "file_mtime")
    ready = F.col("file_mtime") <= stamp(now - timedelta(minutes=max(0, minutes)))
    return every.where(ready), every.where(~ready)


def settle_stream(rows: DataFrame, path: str, checkpoint: str, clock: Callable[[int], datetime], minutes: float) -> StreamingQuery:
    """Delay the rows of a stream until ``minutes`` have passed since their ``file_mtime``.

    Nothing is dropped: rows too young are carried to the next batch. Batch n puts its settled rows into
    ``path/settled/batch=n`` and what it holds into ``path/held/batch=n``, of which the last two stay; ``clock(n)`` is the
    time at batch n.
    """

    def one(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        held = spark.read.parquet(f"{path}/held/batch={batch_id - 1:08d}") if batch_id else None
        ready, wait = split_settled(held, batch, clock(batch_id), minutes)
        ready.write.mode("overwrite").parquet(f"{path}/settled/batch={batch_id:08d}")
        wait.write.mode("overwrite").parquet(f"{path}/held/batch={batch_id:08d}")
        if batch_id > 1:  # this batch, run again, still needs the one before
            remove(spark, f"{path}/held/batch={batch_id - 2:08d}")

    return rows.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def start_stream(snapshots: DataFrame, run: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = "10 minutes") -> StreamingQuery:
    """Run a pass for each batch of new listing snapshots, every so often, or once over what is there if ``every`` is None.

    ``snapshots`` is a stream of listings appended as files; a changed file shows up as a new row, since the file source
    gives no path twice.
    """
    writer = snapshots.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
