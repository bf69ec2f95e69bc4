"""Inventories, ledgers, outcomes and signals derived from the driver's tables, for Spark and as SQL from the same expressions."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..schema import with_defaults

NOW, SINCE, SETTLE = "2024-01-01 12:00:00", "2024-01-01 04:00:00", 30
ROOT, PACKED = "/data/main", "/data/packed"

_PATH = "(CASE WHEN doc_id % 17 = 0 THEN '' ELSE source || '/' || lang || '/' END) || 'doc_' || doc_id || (CASE doc_id % 4 WHEN 0 THEN '.tdms' WHEN 1 THEN '.tdms_index' WHEN 2 THEN '.txt' ELSE '.TDMS' END)"
_STEM = "(CASE WHEN doc_id % 17 = 0 THEN '' ELSE source || '/' || lang || '/' END) || 'doc_' || doc_id"
_EXT = "CASE doc_id % 4 WHEN 0 THEN '.tdms' WHEN 1 THEN '.tdms_index' WHEN 2 THEN '.txt' ELSE '.TDMS' END"

#: Table to source table, filter, and columns. ``@TS(x)`` is a literal time, ``@MINUTES(x)`` an interval.
FRAMES: dict[str, tuple[str, str, dict[str, str]]] = {
    "inv": ("documents", "true", {
        "file_path": _PATH, "file_name": f"'doc_' || doc_id || ({_EXT})", "file_extension": _EXT, "file_size_bytes": "n_chars",
        "file_mtime": "@TS(2024-01-01 00:00:00) + @MINUTES(doc_id)", "file_ctime": "@TS(2024-01-01 00:00:00)", "hash": "md5(text)", "doc_id": "doc_id",
    }),
    "target": ("documents", "doc_id % 7 <> 0", {"file_path": _PATH, "hash": "CASE WHEN doc_id % 11 = 0 THEN 'tampered' ELSE md5(text) END", "file_size_bytes": "n_chars + doc_id % 2"}),
    "ledger0": ("documents", "doc_id % 5 <> 0", {
        "file_path": _PATH, "file_name": f"'doc_' || doc_id || ({_EXT})", "file_extension": _EXT, "file_size_bytes": "n_chars + (CASE WHEN doc_id % 13 = 0 THEN 1 ELSE 0 END)",
        "file_mtime": "@TS(2024-01-01 00:00:00) + @MINUTES(doc_id)", "local_checksum": "CASE WHEN doc_id % 19 <> 0 THEN md5(text) END",
        "remote_checksum": "CASE WHEN doc_id % 3 = 0 OR doc_id % 9 = 0 THEN md5(text) END", "remote_tree": "CASE WHEN doc_id % 8 = 1 THEN 'compressed' ELSE 'uncompressed' END", "compressed": "doc_id % 9 = 0",
        "compressed_checksum": "CASE WHEN doc_id % 9 = 0 THEN 'c' || md5(text) END", "sidecar_checksum": "CASE WHEN doc_id % 18 = 0 THEN 's' || md5(text) END", "data_checksum": "CASE WHEN doc_id % 9 = 0 THEN 'd' || md5(text) END",
        "compressed_bytes": "CASE WHEN doc_id % 9 = 0 THEN n_chars - 1 END",
        "transfer_status": "CASE doc_id % 6 WHEN 0 THEN 'pending' WHEN 1 THEN 'transferring' WHEN 2 THEN 'verified' WHEN 3 THEN 'failed' WHEN 4 THEN 'checksum_mismatch' ELSE 'verified' END",
        "transfer_attempts": "CAST(doc_id % 3 AS INT)", "failed_checksum_count": "CAST(doc_id % 2 AS INT)", "last_error": "CASE WHEN doc_id % 10 = 1 THEN 'old error' END",
        "last_verified_remote": "CASE WHEN doc_id % 4 <> 0 THEN @TS(2023-12-31 00:00:00) + @MINUTES(doc_id) END",
    }),
    "local0": ("documents", "doc_id % 37 <> 0", {"file_path": _PATH, "hash": "CASE WHEN doc_id % 41 = 0 THEN 'rewritten' ELSE md5(text) END"}),
    "art_main": ("documents", "doc_id % 7 <> 0", {"artifact": f"'{ROOT}/' || {_PATH}", "hash": "CASE WHEN doc_id % 11 = 0 THEN 'tampered' ELSE md5(text) END", "error": "CASE WHEN doc_id % 23 = 0 THEN 'I/O error' END"}),
    "art_tree": ("documents", "doc_id % 7 <> 0", {"artifact": f"'{PACKED}/' || {_PATH}", "hash": "CASE WHEN doc_id % 11 = 0 THEN 'tampered' ELSE md5(text) END", "error": "CASE WHEN doc_id % 23 = 0 THEN 'I/O error' END"}),
    "art_flac": ("documents", "doc_id % 12 <> 0", {"artifact": f"'{PACKED}/' || {_STEM} || '.flac'", "hash": "CASE WHEN doc_id % 29 = 0 THEN 'tampered' ELSE 'c' || md5(text) END", "error": "CAST(NULL AS VARCHAR(9))"}),
    "art_json": ("documents", "doc_id % 31 <> 0", {"artifact": f"'{PACKED}/' || {_STEM} || '.json'", "hash": "'s' || md5(text)", "error": "CAST(NULL AS VARCHAR(9))"}),
    "tries": ("documents", "doc_id % 3 <> 1", {
        "file_path": _PATH, "attempt": "CAST(1 AS INT)", "success": "doc_id % 5 <> 2", "bytes_transferred": "n_chars", "duration_seconds": "CAST(doc_id % 9 AS DOUBLE)",
        "error": "CASE WHEN doc_id % 5 = 2 THEN (CASE doc_id % 3 WHEN 0 THEN 'Connection reset by peer' ELSE 'disk full' END) END", "raised": "doc_id % 15 = 2",
        "sent_checksum": "CASE WHEN doc_id % 5 <> 2 THEN md5(text) END", "remote_checksum": "CASE WHEN doc_id % 5 <> 2 THEN (CASE WHEN doc_id % 8 = 0 THEN 'tampered' ELSE md5(text) END) END", "remote_error": "CASE WHEN doc_id % 5 <> 2 AND doc_id % 14 = 5 THEN 'timed out' END",
    }),
    "tries2": ("documents", "doc_id % 3 <> 1 AND doc_id % 15 = 2", {
        "file_path": _PATH, "attempt": "CAST(2 AS INT)", "success": "doc_id % 2 = 0", "bytes_transferred": "n_chars", "duration_seconds": "CAST(doc_id % 4 AS DOUBLE)",
        "error": "CASE WHEN doc_id % 2 = 1 THEN 'socket closed' END", "raised": "false", "sent_checksum": "CASE WHEN doc_id % 2 = 0 THEN md5(text) END", "remote_checksum": "CASE WHEN doc_id % 2 = 0 THEN md5(text) END", "remote_error": "CAST(NULL AS VARCHAR(9))",
    }),
    "encoded_tries": ("documents", "doc_id % 9 = 0 OR doc_id % 4 = 0", {
        "file_path": _PATH, "attempt": "CAST(1 AS INT)", "success": "doc_id % 6 <> 0", "error": "CASE WHEN doc_id % 6 = 0 THEN 'wire hash differs' END", "rebuilt_checksum": "'r' || md5(text)", "data_checksum": "'d' || md5(text)",
        "compressed_checksum": "'c' || md5(text)", "sidecar_checksum": "'s' || md5(text)", "compressed_bytes": "n_chars - 2",
    }),
    "found_links": ("documents", "doc_id % 9 = 0 AND doc_id % 20 <> 0", {
        "file_path": _PATH, "file_hash": "md5(text)", "samples_hash": "CASE WHEN doc_id % 12 = 0 THEN 'x' ELSE 'd' || md5(text) END", "encoded_hash": "'c' || md5(text)", "sidecar_hash": "CASE WHEN doc_id % 18 = 0 THEN 's' || md5(text) END", "rebuilt_hash": "md5(text)",
    }),
    "ev": ("events", "true", {
        "pass_id": "user_id", "event_id": "event_id", "ts": "ts", "success": "event_type NOT IN ('error', 'view')", "error": "CASE event_type WHEN 'error' THEN 'Connection reset by peer' WHEN 'view' THEN 'disk full' END",
        "result": "CASE WHEN event_type IN ('error', 'view') THEN 'failed' WHEN event_id % 3 = 0 THEN 'checksum_mismatch' ELSE 'verified' END", "decode_failure": "event_type = 'error'", "bytes_transferred": "CAST(event_id % 1000 AS BIGINT)", "value": "value",
    }),
}

_MACRO = re.compile(r"@(TS|MINUTES)\(([^()]*)\)")


def _spark(e: str) -> str:
    return _MACRO.sub(lambda m: f"timestamp_ntz'{m[2]}'" if m[1] == "TS" else f"make_dt_interval(0, 0, cast({m[2]} as int), 0)", e).replace("VARCHAR(9)", "STRING")


def _duck(e: str) -> str:
    return _MACRO.sub(lambda m: f"TIMESTAMP '{m[2]}'" if m[1] == "TS" else f"to_minutes(CAST({m[2]} AS BIGINT))", e)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of FRAMES from the tables of a folder; ``ledger`` with all its fields, ``inventory`` with the listing's."""
    if name == "ledger":
        return with_defaults(frame(spark, sf_dir, "ledger0"))
    if name == "artifacts":
        a, b, c, d = (frame(spark, sf_dir, f"art_{x}") for x in ("main", "tree", "flac", "json"))
        return a.unionByName(b).unionByName(c).unionByName(d)
    source, where, columns = FRAMES[name]
    return table(spark, sf_dir, source).where(_spark(where)).selectExpr(*(f"{_spark(e)} AS {c}" for c, e in columns.items()))


def with_sql(*names: str) -> str:
    """The frames as common table expressions for DuckDB, to stand before a SELECT."""
    parts = []
    for name in names:
        if name == "ledger":
            parts.append(f"ledger AS ({_select('ledger0')})")
        elif name == "artifacts":
            parts.append("artifacts AS (" + " UNION ALL ".join(_select(f"art_{x}") for x in ("main", "tree", "flac", "json")) + ")")
        else:
            parts.append(f"{name} AS ({_select(name)})")
    return "WITH " + ", ".join(parts) + " "


def _select(name: str) -> str:
    source, where, columns = FRAMES[name]
    return "SELECT " + ", ".join(f"{_duck(e)} AS {c}" for c, e in columns.items()) + f" FROM {source} WHERE {_duck(where)}"
