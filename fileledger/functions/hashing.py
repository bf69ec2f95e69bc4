"""64-bit content hashes (xxh64, seed 0, 16 hexadecimal digits)."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.classic.column import Column as ClassicColumn
from pyspark.sql.types import StringType

from .paths import normalise

CHUNK = 8 << 20


@F.pandas_udf(StringType())
def _xxh64(content: pd.Series) -> pd.Series:
    import xxhash

    return content.map(lambda b: None if b is None else xxhash.xxh64_hexdigest(b))


def content_xxh64(content: Column) -> Column:
    """The hash of a binary column; of strings as UTF-8; null for null.

    Spark's own xxh64 with seed 0, inside generated code; SQL's ``xxhash64`` has another seed. A Connect session can't reach that
    expression and hashes Arrow batches in Python.
    """
    data = content.cast("binary")
    if not isinstance(data, ClassicColumn):
        return _xxh64(data)
    jvm = SparkContext._active_spark_context._jvm
    utils = jvm.org.apache.spark.sql.classic.ExpressionUtils
    children = jvm.PythonUtils.toSeq([utils.expression(data._jc)])
    number = ClassicColumn(utils.column(jvm.org.apache.spark.sql.catalyst.expressions.XxHash64(children, 0)))
    return F.when(data.isNotNull(), F.lpad(F.lower(F.hex(number)), 16, "0"))


def file_xxh64(path: str, chunk: int = CHUNK) -> str:
    """One file's hash in constant memory."""
    import xxhash

    h = xxhash.xxh64()
    with open(path, "rb") as f:
        while data := f.read(chunk):
            h.update(data)
    return h.hexdigest()


def hash_files(df: DataFrame, root: str, chunk: int = CHUNK) -> DataFrame:
    """``df (file_path, ...)`` to ``file_path, hash, error``: files below a root that every executor mounts.

    A file that can't be read has an error and no hash; memory is one chunk.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for path in frame["file_path"]:
                try:
                    rows.append((path, file_xxh64(os.path.join(root, path), chunk), None))
                except OSError as e:
                    rows.append((path, None, f"{type(e).__name__}: {e.strerror}"))
            yield pd.DataFrame(rows, columns=["file_path", "hash", "error"])

    return df.select("file_path").mapInPandas(run, "file_path string, hash string, error string")


def target_hash(df: DataFrame, root: str, chunk: int = CHUNK) -> DataFrame:
    """``df (file_path, ...)`` to ``file_path, hash, error`` of the copies below the target's root; a copy that isn't there has an error."""
    return hash_files(df.select(normalise(F.col("file_path")).alias("file_path")), root, chunk)


def compare_hash(expected: Column, found: Column, error: Column) -> Column:
    """``struct(ok, message)`` of a check: the error first, then a missing hash, then the two hashes."""
    same = expected.eqNullSafe(found)
    message = (
        F.when(error.isNotNull(), F.concat(F.lit("could not read: "), error))
        .when(expected.isNull(), F.lit("no expected hash"))
        .when(found.isNull(), F.lit("no hash found"))
        .when(same, F.concat(F.lit("match: "), found))
        .otherwise(F.concat(F.lit("mismatch: expected="), expected, F.lit(" found="), found))
    )
    return F.struct((error.isNull() & expected.isNotNull() & same).alias("ok"), message.alias("message"))
