"""The ledger on disk: versioned Parquet snapshots, replicas, JSON export, old documents."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import LEDGER_FIELDS, STATE, with_defaults
from .scratch import place

#: An empty file that a whole snapshot ends with.
_WHOLE = "_WHOLE"


def current_version(spark: SparkSession, path: str) -> int | None:
    """The highest version that is whole; None if there is no ledger yet."""
    fs, p = place(spark, path)
    if not fs.exists(p):
        return None
    names = (re.fullmatch(r"v(\d+)", f.getPath().getName()) for f in fs.listStatus(p))
    for version in sorted((int(m[1]) for m in names if m), reverse=True):
        if fs.exists(place(spark, f"{path}/v{version:08d}/{_WHOLE}")[1]):
            return version
    return None


def write_ledger(df: DataFrame, path: str, version: int | None = None) -> int:
    """Write a snapshot in a folder of its own, and then the empty file that makes it whole.

    Making that file is one step, so readers see the snapshot before or this one, whenever the writer stops; what a
    stopped writer left is written over. Gives the version, one above the current one by default.
    """
    spark = df.sparkSession
    if version is None:
        now = current_version(spark, path)
        version = 0 if now is None else now + 1
    at = f"{path}/v{version:08d}"
    fs, whole = place(spark, f"{at}/{_WHOLE}")
    fs.delete(whole, False)
    with_defaults(df).write.mode("overwrite").parquet(at)
    fs.create(whole, True).close()
    return version


def read_ledger(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The current snapshot, or the given one, with defaults for columns that it lacks."""
    version = current_version(spark, path) if version is None else version
    if version is None:
        return with_defaults(spark.createDataFrame([], "file_path string"))
    return with_defaults(spark.read.parquet(f"{path}/v{version:08d}"))


def replicate_ledger(df: DataFrame, target: str, version: int | None = None) -> int:
    """The same snapshot in a second place."""
    return write_ledger(df, target, version)


def export_ledger_json(df: DataFrame, path: str) -> None:
    """One JSON document a line and record, with nulls written out."""
    df.write.option("ignoreNullFields", "false").json(path)


def read_json_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Records from exported lines; unknown keys go, missing ones take their defaults."""
    return with_defaults(spark.read.schema(_text_schema()).json(path))


def read_document_store(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Ledger and state of an old store: one JSON object with the tables ``files`` and ``state``, each from id to document."""
    state = ", ".join(f"{f.name}: {'bigint' if f.dataType.typeName() == 'long' else 'string'}" for f in STATE)
    fields = ", ".join(f"{n}: {'string' if t.startswith('timestamp') else t}" for n, t, _ in LEDGER_FIELDS)
    raw = spark.read.schema(f"files map<string, struct<{fields}>>, state map<string, struct<{state}>>").option("multiLine", "true").json(path)
    files = raw.select(F.explode("files").alias("id", "r")).select("r.*")
    states = raw.select(F.explode("state").alias("id", "r")).select("r.*")
    return with_defaults(files), states.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in STATE))


def _text_schema() -> str:
    return ", ".join(f"{n} {'string' if t.startswith('timestamp') else t}" for n, t, _ in LEDGER_FIELDS)
