"""Places and running sums in an order, without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import saved

#: About the rows that a task sorts at once.
TASK_ROWS = 1 << 19
#: A side of so few rows is broadcast by :func:`joined`.
FEW_ROWS = 1 << 17


def dealt(df: DataFrame, rows: int, *keys: str | Column) -> DataFrame:
    """The rows, ``rows`` in number, dealt by keys to tasks of about :data:`TASK_ROWS`, so that what one task sorts doesn't grow with the table.

    Partitions of a given number stay as many, where Spark would join them to as few as there are cores. Up to 4 times as many rows a task are taken
    to stay within ``spark.shuffle.sort.bypassMergeThreshold``: above it the tasks that deal hold all rows that they read.
    """
    context = df.sparkSession.sparkContext
    most = int(context.getConf().get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    parts = max(min(-(-rows // TASK_ROWS), most), -(-rows // (4 * TASK_ROWS)))
    return df.repartition(max(context.defaultParallelism, parts), *keys)


def joined(rows: DataFrame, n: int, side: DataFrame, heavy: DataFrame, *keys: str, spread: str, how: str = "inner") -> DataFrame:
    """``rows``, ``n`` in number, with those of ``side`` that have their keys; a task sorts no more of them when the tables grow.

    Both are dealt by the keys. ``heavy`` has the keys of more than :data:`TASK_ROWS` rows with ``weight``, the number of these rows; it has at most
    ``n`` / :data:`TASK_ROWS` of them and is broadcast. The rows of such a key are parted by the hash of the column ``spread``, and what ``side`` has of it goes to each part.
    """
    keys_of = [*keys]
    if side.count() <= FEW_ROWS:
        return rows.join(F.broadcast(side), keys_of, how)
    heavy = F.broadcast(heavy.select(*keys, F.ceil(F.col("weight") / TASK_ROWS).alias("__shares")))
    share = F.coalesce(F.pmod(F.xxhash64(spread), F.col("__shares")), F.lit(0).cast("long"))
    rows = rows.join(heavy, keys_of, "left").withColumn("__share", share).drop("__shares")
    shares = F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("__shares"), F.lit(1).cast("long")) - 1)
    side = side.join(heavy, keys_of, "left").withColumn("__share", F.explode(shares)).drop("__shares")
    return dealt(rows, n, *keys, "__share").join(dealt(side, n, *keys, "__share"), [*keys, "__share"], how).drop("__share")


def _ranges(df: DataFrame, parts: int, *order: str | Column) -> DataFrame:
    rows = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return saved(rows.withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id() % (1 << 33)), "ranged")


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ranged(df: DataFrame, *order: str | Column) -> DataFrame:
    """The rows, which are counted first, dealt to ranges of an order, of about :data:`TASK_ROWS` at most, and written once, with ``__part``, the range, and ``__at``, the place in it.

    Bounds of ranges are sampled and would be others when the rows are dealt again.
    """
    return _ranges(df, max(_parts(df), -(-df.count() // TASK_ROWS)), *order)


def running_sum(df: DataFrame, value: Column, *order: str | Column) -> DataFrame:
    """Adds ``seq``, from 0 in an order that must be total, and ``before``, the whole-number sum of ``value`` over the rows before it.

    A null value counts as 0. Each range is summed in its own task; one count and one sum for each range reach the driver.
    """
    rows = _ranges(df.withColumn("__value", F.coalesce(value.cast("long"), F.lit(0))), _parts(df), *order)
    counts = {r["__part"]: (r["c"], r["s"]) for r in rows.groupBy("__part").agg(F.count(F.lit(1)).alias("c"), F.sum("__value").alias("s")).collect()}
    places, sums, n, total = {}, {}, 0, 0
    for part in sorted(counts):
        places[part], sums[part] = n, total
        n, total = n + counts[part][0], total + counts[part][1]
    of = lambda m: F.try_element_at(F.create_map(*(F.lit(x).cast("long") for item in m.items() for x in item)), F.col("__part").cast("long")) if m else F.lit(None).cast("long")
    here = Window.partitionBy("__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = rows.withColumn("seq", of(places) + F.col("__at")).withColumn("before", of(sums) + F.sum("__value").over(here) - F.col("__value"))
    return summed.drop("__part", "__at", "__value")
