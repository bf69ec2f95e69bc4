"""Schemas and closed domains of the ledger, its state, outcomes and signals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType

#: Column, type, default as SQL. The order is the ledger's column order.
LEDGER_FIELDS = [
    ("file_path", "string", None),
    ("file_name", "string", None),
    ("file_extension", "string", None),
    ("file_size_bytes", "bigint", None),
    ("file_mtime", "timestamp_ntz", None),
    ("file_ctime", "timestamp_ntz", None),
    ("filename_timestamp", "timestamp_ntz", None),
    ("tdms_start_time", "timestamp_ntz", None),
    ("tdms_end_time", "timestamp_ntz", None),
    ("local_checksum", "string", None),
    ("remote_checksum", "string", None),
    ("checksum_algorithm", "string", "'xxh64'"),
    ("remote_tree", "string", "'uncompressed'"),
    ("compressed", "boolean", "false"),
    ("data_checksum", "string", None),
    ("compressed_checksum", "string", None),
    ("sidecar_checksum", "string", None),
    ("compressed_bytes", "bigint", None),
    ("transfer_status", "string", "'pending'"),
    ("transfer_attempts", "int", "0"),
    ("last_transfer_time", "timestamp_ntz", None),
    ("failed_checksum_count", "int", "0"),
    ("last_error", "string", None),
    ("last_error_time", "timestamp_ntz", None),
    ("first_seen", "timestamp_ntz", None),
    ("last_verified_local", "timestamp_ntz", None),
    ("last_verified_remote", "timestamp_ntz", None),
    ("data_quality", "string", "'unknown'"),
    ("data_quality_notes", "string", None),
]
_TYPES = {"string": StringType, "bigint": LongType, "int": IntegerType, "boolean": BooleanType, "double": DoubleType, "timestamp_ntz": TimestampNTZType}


def _struct(fields: list[tuple[str, str]]) -> StructType:
    """A schema from names and types, built without a session."""
    return StructType([StructField(name, _TYPES[kind]()) for name, kind in fields])


def _listed(text: str) -> StructType:
    return _struct([tuple(x.split()) for x in text.split(", ")])


LEDGER = _struct([(n, t) for n, t, _ in LEDGER_FIELDS])
STATE = _listed("last_scan_time timestamp_ntz, last_full_verify_time timestamp_ntz, last_db_sync_time timestamp_ntz, total_files_tracked bigint, total_bytes_tracked bigint")
INVENTORY = _listed("file_path string, file_name string, file_extension string, file_size_bytes bigint, file_mtime timestamp_ntz, file_ctime timestamp_ntz, filename_timestamp timestamp_ntz")
OUTCOMES = _listed("file_path string, attempt int, success boolean, bytes_transferred bigint, duration_seconds double, error string, raised boolean, sent_checksum string, remote_checksum string, remote_error string")

STATUSES = ["pending", "transferring", "transferred", "verified", "failed", "checksum_mismatch"]
QUALITIES = ["unknown", "good", "suspect", "bad"]
#: Statuses from which a file is sent again.
ACTIONABLE = ["pending", "failed", "checksum_mismatch"]


def with_defaults(df: DataFrame) -> DataFrame:
    """The ledger's columns, cast and in order: missing ones and nulls take their defaults, unknown ones go."""
    have = {c.lower(): c for c in df.columns}

    def column(name: str, kind: str, default: str | None) -> Column:
        value = F.col(f"`{have[name]}`").cast(kind) if name in have else F.lit(None).cast(kind)
        return (F.coalesce(value, F.expr(default).cast(kind)) if default else value).alias(name)

    return df.select(*(column(*field) for field in LEDGER_FIELDS))


def domain(spark: SparkSession, values: list[str], name: str) -> DataFrame:
    """A closed domain as rows, for zero-filled counts."""
    return spark.range(1).select(F.explode(F.array(*map(F.lit, values))).alias(name))
