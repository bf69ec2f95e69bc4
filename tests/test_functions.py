from datetime import datetime

import pytest
import xxhash
from pyspark.sql import functions as F

from fileledger.functions import hashing, paths, text


def values(spark, rows, expr, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r.y for r in df.select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()]


NAMES = {
    "2025-01-15_data.tdms": datetime(2025, 1, 15), "experiment_2025-01-15T14-30-00.tdms": datetime(2025, 1, 15, 14, 30), "data_20250115.tdms": datetime(2025, 1, 15), "experiment_20250115_143000.tdms": datetime(2025, 1, 15, 14, 30),
    "data.tdms": None, "data_99999999.tdms": None, "2025-13-40_20250115.x": datetime(2025, 1, 15), "20250115_250000": None, "a_2025-01-15T14:30-00_x": None, "2025-01-15T24:00:00": None, "0000-01-01": None, "2025-01-15_10-20-30.tdms": datetime(2025, 1, 15), "2025-01-15T10-20-60_20240102.x": datetime(2024, 1, 2), "2025-01-15T10-20.x": datetime(2025, 1, 15), "x20250115_1234.x": datetime(2025, 1, 15), "2025-02-29_20250301_000000": datetime(2025, 3, 1), "": None, None: None,
}


def test_filename_timestamp(spark):
    assert values(spark, list(NAMES), text.filename_timestamp) == list(NAMES.values())


def test_extension(spark):
    names = ["a.tdms", "a.tar.GZ", ".env", "a.", "..x", "...", "x", ".a.b", "n\nl.t", None]
    assert values(spark, names, paths.extension) == [".tdms", ".GZ", "", "", ".x", "", "", ".b", ".t", None]


def test_paths(spark):
    got = values(spark, ["a/b", "a\\b\\c", "c", None], paths.first_segment)
    assert got == ["a", "a", None, None]
    assert values(spark, ["a\\b.tdms", "x.y/b", ".e", "q.a.b"], lambda c: paths.with_suffix(c, ".flac")) == ["a/b.flac", "x.y/b.flac", ".e.flac", "q.a.flac"]
    assert values(spark, ["Run48\\T\\x"], lambda c: paths.target_path(c, F.lit("compressed"), "/u", "/c")) == ["/c/Run48/T/x"]
    assert values(spark, ["Run48\\T\\x"], lambda c: paths.target_path(c, F.lit("uncompressed"), "/u", "/c")) == ["/u/Run48/T/x"]
    assert values(spark, [".tdms_index", ".TDMS_INDEX", ".tdms", ".csv", None], lambda c: paths.desired_tree(c, True)) == ["compressed", "compressed"] + ["uncompressed"] * 3
    assert values(spark, ["Run48\\x", "Run45/x", "Run48"], lambda c: paths.priority_rank(c, ["Run48"])) == [0, 1, 0]
    assert values(spark, ["Run48"], lambda c: paths.priority_rank(c, [])) == [0]
    assert values(spark, ["r/a.tdms"], lambda c: paths.quarantine_path(F.lit("/u"), c, F.lit("2024-05-06 07:08:09").cast("timestamp_ntz"))) == ["/u/_mismatched/r/a.tdms.20240506T070809"]


def test_conn_errors(spark):
    assert values(spark, ["SSH banner", "Connection RESET", "disk full", "", None, "Broken pipe", "EOF"], text.is_conn_error) == [True, True, False, False, False, True, True]


def test_content_hash(spark):
    given = [b"", b"hello", b"x" * 100_000, None]
    assert values(spark, given, hashing.content_xxh64, "binary") == ["ef46db3751d8e999", *(xxhash.xxh64_hexdigest(b) for b in given[1:3]), None]


def test_files_hash(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"X" * (10 << 20))
    (tmp_path / "e").write_bytes(b"")
    df = spark.createDataFrame([("a",), ("e",), ("gone",)], "file_path string")
    got = {r.file_path: r for r in hashing.hash_files(df, str(tmp_path), chunk=1 << 16).collect()}
    assert got["a"]["hash"] == xxhash.xxh64_hexdigest(b"X" * (10 << 20)) and got["e"]["hash"] == "ef46db3751d8e999"
    assert got["gone"]["hash"] is None and "FileNotFound" in got["gone"].error


def test_properties(spark):
    df = spark.sql("SELECT map('inc', '2e-05', 'start', '2026-05-28T15:56:21.123456', 'n', '5000', 'name', 'x', 'flag', 'true', 'odd', '?') AS v, map('inc', 'float64', 'start', 'timestamp', 'n', 'int32', 'name', 'string', 'flag', 'boolean', 'odd', 'array') AS k")
    row = df.select(text.tag_props(F.col("v"), F.col("k")).alias("p")).select("p", text.props_from_json(text.props_to_json(F.col("p"))).alias("q"))
    r = row.select("*", text.props_equal(F.col("p"), F.col("q")).alias("same"), text.untag_props(F.col("q"), "inc", "double").alias("inc"), text.untag_props(F.col("q"), "start", "timestamp_ntz").alias("start"), text.untag_props(F.col("q"), "n", "int").alias("n"), text.untag_props(F.col("q"), "flag", "boolean").alias("flag"), text.untag_props(F.col("q"), "none", "int").alias("none"), text.untag_props(F.col("q"), "name", "int").alias("bad")).first()
    assert r.same and r.inc == 2e-5 and r.start == datetime(2026, 5, 28, 15, 56, 21, 123456) and r.n == 5000 and r.flag is True and r.none is None and r.bad is None
    assert {k: v.t for k, v in r.p.items()} == {"inc": "np", "start": "dt64", "n": "np", "name": "py", "flag": "py", "odd": "str"}


@pytest.mark.parametrize("a,b,error,ok", [("x", "x", None, True), ("x", "y", None, False), (None, "y", None, False), ("x", None, None, False), ("x", "x", "io", False), (None, None, None, False)])
def test_compare(spark, a, b, error, ok):
    lit = lambda v: F.lit(v).cast("string")
    got = spark.range(1).select(hashing.compare_hash(lit(a), lit(b), lit(error)).alias("c")).first().c
    assert got.ok is ok and got.message


def test_relative(spark):
    df = spark.createDataFrame([("/r/a/b",), ("/other",)], "path string")
    assert [r.file_path for r in paths.relative_path(df, "/r/").collect()] == ["a/b", None]


def test_content_hash_is_xxh64_with_seed_0_without_python(spark):
    import xxhash

    rows = [b"", b"a", None, *(bytes((i * 7 + j) % 256 for j in range(i)) for i in (3, 4, 7, 8, 9, 31, 32, 33, 63, 64, 100, 5000))]
    from fileledger.functions.hashing import content_xxh64

    df = spark.createDataFrame([(r,) for r in rows], "b binary").select("b", content_xxh64(F.col("b")).alias("h"))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    assert [r.h for r in df.collect()] == [None if b is None else xxhash.xxh64_hexdigest(b) for b in rows]
    assert df.sparkSession.sql("select 'é' as s").select(content_xxh64(F.col("s")).alias("h")).first().h == xxhash.xxh64_hexdigest("é".encode())
