"""Encoded signals on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import residual


def write_codes(codes: DataFrame, meta: DataFrame, path: str) -> None:
    """Codes partitioned by their stored width and sorted by signal and index; 16 bits as short, 24 as int."""
    wide = codes.join(meta.select("signal_id", "bits_per_sample"), "signal_id")
    for bits, kind in ((16, "smallint"), (24, "int")):
        part = wide.where(F.col("bits_per_sample") == bits).select("signal_id", "idx", F.col("code").cast(kind).alias("code"))
        part.sort("signal_id", "idx").write.mode("overwrite").parquet(f"{path}/bits_per_sample={bits}")


def read_codes(spark: SparkSession, path: str) -> DataFrame:
    """``signal_id, idx, code`` of both widths, codes as long."""
    parts = [spark.read.parquet(f"{path}/bits_per_sample={bits}").select("signal_id", "idx", F.col("code").cast("long").alias("code")) for bits in (16, 24)]
    return parts[0].unionByName(parts[1])


def write_residuals(codes: DataFrame, path: str, block: int = residual.BLOCK) -> None:
    """Codes as predicted blocks, sorted by signal and block; payloads are as good as random, so pages aren't compressed again."""
    residual.residual_blocks(codes, block).write.mode("overwrite").option("compression", "none").parquet(path)


def read_residuals(spark: SparkSession, path: str) -> DataFrame:
    """``signal_id, idx, code`` of stored blocks."""
    return residual.residual_codes(spark.read.parquet(path))


def write_signal_meta(meta: DataFrame, path: str) -> None:
    """One JSON document a signal, with nulls written out."""
    meta.select("signal_id", F.to_json(F.struct(*meta.columns), {"ignoreNullFields": "false"}).alias("meta")).write.mode("overwrite").parquet(path)


def read_signal_meta(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The documents as columns of ``schema`` (DDL)."""
    return spark.read.parquet(path).select(F.from_json("meta", schema).alias("m")).select("m.*")
