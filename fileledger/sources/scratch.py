"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: The folder of this process below each root, by application.
_OWN: dict[tuple[str, str], str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in a folder of this process in ``spark.checkpoint.dir``, deleted when the process ends; where that is unset, in a temporary folder, in local mode only."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", root)
    key = (spark.sparkContext.applicationId, root)
    if key not in _OWN:
        own = f"{root}/fileledger-{uuid.uuid4().hex}"
        fs, p = place(spark, own)
        fs.mkdirs(p)
        fs.deleteOnExit(p)  # only of what is there
        _OWN[key] = own
    return f"{_OWN[key]}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """The frame, written once and read again: what is used several times isn't computed anew, and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def place(spark: SparkSession, path: str):
    """The file system of a path, and the path, as Spark's JVM has them."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any file system that Spark knows, if it is there."""
    fs, p = place(spark, path)
    fs.delete(p, True)


def publish(spark: SparkSession, stage: str, path: str) -> None:
    """Give a finished folder its name, which must be new."""
    fs, p = place(spark, path)
    if fs.exists(p) or not fs.rename(place(spark, stage)[1], p):
        raise FileExistsError(path)
