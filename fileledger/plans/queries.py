"""Every operator as a query over the driver's tables, with SQL for the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hashing, paths, text
from ..operators import changes as C
from ..operators import codec as K
from ..operators import ledger as L
from ..operators import outcomes as O
from ..operators import reports as R
from ..operators import residual as RC
from ..operators import scan as S
from ..operators import verify as V
from ..operators.prefix import dealt
from ..schema import STATUSES
from ..sources import bucket_store, copying, inventory_source, ledger_store, listing, signals_store
from ..sources.scratch import saved, scratch_path
from ..streaming import stream
from . import passes as P
from .frames import NOW, PACKED, ROOT, SETTLE, SINCE, frame, table
from .frames import with_sql as W

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

EXTS = [".tdms", ".tdms_index"]
IGNORE, PRIORITY = ["src3", "src7"], ["src1", "src4"]
_NOW, _SINCE = f"TIMESTAMP '{NOW}'", f"TIMESTAMP '{SINCE}'"
_CUT = f"({_NOW} - INTERVAL {SETTLE} MINUTE)"
_TOP = "CASE WHEN instr(file_path, '/') > 0 THEN split_part(file_path, '/', 1) END"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _names(spark: SparkSession, names: list[str]) -> DataFrame:
    return spark.createDataFrame([(n,) for n in names], "name string")


# --- A: sources and sinks ------------------------------------------------------------------------------------------


@query(W("inv") + "SELECT file_path, file_name, file_extension FROM inv")
def file_info(spark, d):
    return S.file_info(frame(spark, d, "inv").select(F.translate("file_path", "/", "\\").alias("file_path"))).select("file_path", "file_name", "file_extension")


@query(W("inv") + f"SELECT '{ROOT}/' || file_path AS path, file_path FROM inv")
def relative_path(spark, d):
    return paths.relative_path(frame(spark, d, "inv").select(F.concat(F.lit(ROOT + "/"), "file_path").alias("path")), ROOT)


_TRACKED = "file_path, file_size_bytes, transfer_status, local_checksum, compressed, transfer_attempts"


@query(W("ledger") + f"SELECT {_TRACKED}, 'xxh64' AS checksum_algorithm, 'unknown' AS data_quality FROM ledger")
def ledger_snapshot(spark, d):
    at = scratch_path(spark, "ledger")
    ledger_store.write_ledger(frame(spark, d, "ledger0"), at)
    return ledger_store.read_ledger(spark, at).select(*_TRACKED.split(", "), "checksum_algorithm", "data_quality")


@query(W("ledger") + f"SELECT {_TRACKED} FROM ledger")
def ledger_json_export(spark, d):
    at = scratch_path(spark, "export")
    ledger_store.export_ledger_json(frame(spark, d, "ledger"), at)
    return ledger_store.read_json_ledger(spark, at).select(*_TRACKED.split(", "))


@query(W("ledger") + f"SELECT {_TRACKED} FROM ledger")
def ledger_replica(spark, d):
    at = scratch_path(spark, "replica")
    ledger_store.replicate_ledger(frame(spark, d, "ledger"), at, 3)
    return ledger_store.read_ledger(spark, at).select(*_TRACKED.split(", "))


@query("SELECT CAST(l_suppkey AS BIGINT) AS signal_id, count(*) AS samples, CAST(sum(CAST(rint_code AS BIGINT)) AS BIGINT) AS code_sum FROM (SELECT l_suppkey, round_even((l_discount - min(l_discount) OVER (PARTITION BY l_suppkey)) * 100, 0) AS rint_code FROM lineitem) GROUP BY l_suppkey")
def stored_codes(spark, d):
    codes, meta, _ = K.encode_signals(_discounts(spark, d))
    at = scratch_path(spark, "codes")
    signals_store.write_codes(codes, meta, at)
    return signals_store.read_codes(spark, at).groupBy("signal_id").agg(F.count(F.lit(1)).alias("samples"), F.sum("code").alias("code_sum"))


@query("SELECT DISTINCT trim(source) AS name FROM documents WHERE doc_id % 3 <> 0")
def read_ignore_list(spark, d):
    at = scratch_path(spark, "ignore")
    lines = table(spark, d, "documents").select(F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("# "), "source")).otherwise(F.concat(F.lit("  "), "source")).alias("value"))
    lines.unionByName(spark.createDataFrame([("",), ("# a comment",)], "value string")).write.text(at)
    return listing.read_ignore_list(spark, at)


#: About the most bytes of a source in one file of the archive, and the most documents.
FILE_BYTES, FILE_ROWS = 1 << 26, 10_000


def _as_files(spark, d) -> tuple[str, str]:
    """The documents' texts as files of an archive on the shared folder: its root and a folder beside it.

    A source is dealt over as many tasks as the whole table fills files, so that none is one task's or one file's.
    """
    at = scratch_path(spark, "archive")
    if "://" in at and not at.startswith("file://"):
        raise ValueError("these operators need a folder that every executor mounts")
    docs = table(spark, d, "documents")
    total = docs.agg(F.sum(F.octet_length("text") + F.lit(1).cast("long"))).first()[0] or 0
    parts = max(4, total // FILE_BYTES + 1)
    salted = docs.select("source", F.col("text").alias("value"), F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)).alias("salt"))
    salted.repartition(parts, "source", "salt").drop("salt").write.option("maxRecordsPerFile", FILE_ROWS).partitionBy("source").text(at)
    root = at.removeprefix("file://")
    return root, root + "-copy"


_FILE_BYTES = "SELECT 'source=' || source AS top, CAST(sum(strlen(text) + 1) AS BIGINT) AS bytes FROM documents GROUP BY source"


@query(_FILE_BYTES)
def list_files(spark, d):
    """Listed by folder level; hidden checksum files and markers are left out here."""
    root, _ = _as_files(spark, d)
    files = S.filter_extension(listing.list_files(spark, root), [".txt"])
    return files.groupBy(paths.first_segment(F.col("file_path")).alias("top")).agg(F.sum("file_size_bytes").alias("bytes"))


@query("SELECT 'source=' || source AS top, CAST(sum(strlen(text) + 1) AS BIGINT) AS bytes FROM documents GROUP BY source")
def read_content(spark, d):
    root, _ = _as_files(spark, d)
    files = listing.read_content(spark, "file://" + root, "*.txt").select(F.regexp_extract("path", "/(source=[^/]*)/", 1).alias("top"), F.length("content").alias("n"))
    return files.groupBy("top").agg(F.sum("n").alias("bytes"))


@query("SELECT top, bytes, true AS verified FROM (" + _FILE_BYTES + ")")
def copy_files(spark, d):
    """Copy, hash while copying, read back: every hash is that of the source file."""
    root, to = _as_files(spark, d)
    files = S.filter_extension(listing.list_files(spark, root), [".txt"]).select("file_path")
    files.write.parquet("file://" + root + "-plan")
    plan = spark.read.parquet("file://" + root + "-plan")
    copying.copy_files(plan, root, to).write.parquet("file://" + root + "-tries")
    tries = spark.read.parquet("file://" + root + "-tries").join(hashing.hash_files(plan, root), "file_path")
    ok = F.col("success") & (F.col("sent_checksum") == F.col("remote_checksum")) & (F.col("sent_checksum") == F.col("hash"))
    return tries.groupBy(paths.first_segment(F.col("file_path")).alias("top")).agg(F.sum("bytes_transferred").alias("bytes"), F.bool_and(ok).alias("verified"))


@query("SELECT top, bytes, true AS verified FROM (" + _FILE_BYTES + ")")
def copy_ranged(spark, d):
    """The same archive copied in ranges: more than one for each large file, and every hash is that of the source file."""
    root, to = _as_files(spark, d)
    plan = saved(S.filter_extension(listing.list_files(spark, root), [".txt"]).select("file_path", "file_size_bytes"), "plan")
    largest = plan.agg(F.max("file_size_bytes")).first()[0] or 0
    tries = saved(copying.copy_ranged(plan, root, to, range_bytes=max(1, largest // 5)), "tries").join(hashing.hash_files(plan, root), "file_path")
    ok = F.col("success") & (F.col("sent_checksum") == F.col("remote_checksum")) & (F.col("sent_checksum") == F.col("hash"))
    return tries.groupBy(paths.first_segment(F.col("file_path")).alias("top")).agg(F.sum("bytes_transferred").alias("bytes"), F.bool_and(ok).alias("verified"))


_RANGES = W("inv") + f""", r AS (SELECT file_path, unnest(range(0, greatest(file_size_bytes, 1), 1000)) AS start, file_size_bytes FROM inv),
p AS (SELECT file_path, start, least(file_size_bytes - start, 1000) AS length FROM r),
s AS (SELECT *, sum(length + {copying.FILE_COST}) OVER (ORDER BY length DESC, file_path, start) - length - {copying.FILE_COST} AS before, sum(length + {copying.FILE_COST}) OVER () AS total FROM p)
SELECT file_path, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length, CAST(before * 16 // total AS INTEGER) AS task FROM s"""


@query(_RANGES)
def deal_ranges(spark, d):
    plan = frame(spark, d, "inv").select("file_path", F.col("file_path").alias("target_file"), "file_size_bytes")
    return copying.deal_ranges(copying.file_ranges(plan, 1000), 16).select("file_path", "start", "length", "task")


def _damaged(spark, root: str, top: str) -> None:
    """One byte more at the end of each text below one top-level folder."""

    def run(frames):
        for frame in frames:
            for path in frame["file_path"]:
                with open(f"{root}/{path}", "ab") as f:
                    f.write(b"!")
            yield frame

    files = listing.list_files(spark, root).where(F.col("file_path").startswith(f"{top}/") & F.lower("file_extension").isin(".txt")).select("file_path")
    files.mapInPandas(run, "file_path string").write.format("noop").mode("overwrite").save()


def _first_top(spark, d) -> str:
    return "source=" + (table(spark, d, "documents").agg(F.min("source")).first()[0] or "")


@query("SELECT top, bytes, top <> (SELECT 'source=' || min(source) FROM documents) AS there FROM (" + _FILE_BYTES + ")")
def target_hash(spark, d):
    """Of the copies of all folders but one; those that aren't there have an error."""
    root, to = _as_files(spark, d)
    files = S.filter_extension(listing.list_files(spark, root), [".txt"]).select("file_path", "file_size_bytes")
    files = saved(files, "files")
    saved(copying.copy_files(files.where(~F.col("file_path").startswith(_first_top(spark, d) + "/")), root, to), "tries")
    here = hashing.hash_files(files, root).select("file_path", F.col("hash").alias("expected"))
    joined = hashing.target_hash(files, to).join(here, "file_path").join(files, "file_path")
    there = F.col("error").isNull() & (F.col("hash") == F.col("expected"))
    return joined.groupBy(paths.first_segment(F.col("file_path")).alias("top")).agg(F.sum("file_size_bytes").alias("bytes"), F.bool_and(there).alias("there"))


def _pass_config(spark, d) -> P.PassConfig:
    """An archive of the documents' texts, and empty folders for its copy and its ledger."""
    root, to = _as_files(spark, d)
    return P.PassConfig(root, to, f"file://{root}-ledger", f"file://{root}-work", extensions=[".txt"], least_free_gb=0)


def _by_top(df: DataFrame, *keys) -> DataFrame:
    return df.groupBy(paths.first_segment(F.col("file_path")).alias("top"), *keys).agg(F.sum("file_size_bytes").alias("bytes"))


def _later() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None) + timedelta(minutes=1)


@query("SELECT top, 'verified' AS transfer_status, CAST(1 AS INTEGER) AS transfer_attempts, bytes FROM (" + _FILE_BYTES + ")")
def run_pass(spark, d):
    """The ledger after a first pass."""
    config = _pass_config(spark, d)
    return _by_top(P.run_pass(spark, config, _later()).ledger, "transfer_status", "transfer_attempts")


@query("SELECT top, top = (SELECT 'source=' || min(source) FROM documents) AS needs_transfer, CASE WHEN top = (SELECT 'source=' || min(source) FROM documents) THEN 'different_there' ELSE 'not_actionable' END AS reason, bytes FROM (" + _FILE_BYTES + ")")
def run_pass_full(spark, d):
    """After a first pass, damage to one folder of the copy and a verification, a full pass plans that folder and no other."""
    config, now = _pass_config(spark, d), _later()
    P.run_pass(spark, config, now)
    _damaged(spark, config.target, _first_top(spark, d))
    P.run_verification(spark, config, now + timedelta(minutes=1), quarantine=False)
    return _by_top(P.run_pass(spark, config, now + timedelta(minutes=2), full=True).plan, "needs_transfer", "reason")


@query("SELECT top, true AS needs_transfer, 'absent' AS reason, bytes, CAST(0 AS BIGINT) AS recorded FROM (" + _FILE_BYTES + ")")
def dry_run(spark, d):
    """The whole plan, and no ledger."""
    config = _pass_config(spark, d)
    plan = P.run_pass(spark, config, _later(), dry_run=True).plan
    recorded = ledger_store.read_ledger(spark, config.ledger_path).count()
    return _by_top(plan, "needs_transfer", "reason").withColumn("recorded", F.lit(recorded))


@query("SELECT top, CASE WHEN top = (SELECT 'source=' || min(source) FROM documents) THEN 'remote_mismatch' ELSE 'ok' END AS verdict, bytes FROM (" + _FILE_BYTES + ")")
def run_verification(spark, d):
    """One folder of the copy is damaged."""
    config, now = _pass_config(spark, d), _later()
    P.run_pass(spark, config, now)
    _damaged(spark, config.target, _first_top(spark, d))
    verdicts, _ = P.run_verification(spark, config, now + timedelta(minutes=1))
    sizes = ledger_store.read_ledger(spark, config.ledger_path).select("file_path", "file_size_bytes")
    return _by_top(verdicts.select("file_path", "verdict").join(sizes, "file_path"), "verdict")


@query("SELECT name, 'is a path' AS problem FROM (SELECT DISTINCT source || CASE WHEN doc_id % 2 = 0 THEN '/' || lang ELSE '' END AS name FROM documents) WHERE contains(name, '/')")
def priority_audit(spark, d):
    """Names of a priority list that hold separators; without an inventory nothing else is wrong with a name."""
    names = table(spark, d, "documents").select(F.concat("source", F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("/"), "lang")).otherwise("")).alias("name")).distinct()
    return S.audit_names(names)


# --- B: filters and functions ---------------------------------------------------------------------------------------


@query(W("inv") + "SELECT file_path FROM inv WHERE lower(file_extension) = '.tdms'")
def filter_extension(spark, d):
    return S.filter_extension(frame(spark, d, "inv"), [".TDMS"]).select("file_path")


@query(W("inv") + f"SELECT file_path FROM inv WHERE coalesce({_TOP}, '') NOT IN ('src3', 'src7')")
def prune_ignored(spark, d):
    return S.prune_ignored(frame(spark, d, "inv"), _names(spark, IGNORE)).select("file_path")


@query(W("inv") + "SELECT file_path FROM inv WHERE contains(file_path, '/')")
def skip_root_files(spark, d):
    return S.skip_root_files(frame(spark, d, "inv")).select("file_path")


@query(W("inv") + f"SELECT file_path FROM inv WHERE file_mtime <= {_CUT}")
def filter_settled(spark, d):
    return S.filter_settled(frame(spark, d, "inv"), NOW, SETTLE).select("file_path")


@query(W("inv") + f"SELECT file_path FROM inv WHERE file_mtime > {_SINCE}")
def filter_since(spark, d):
    return S.filter_since(frame(spark, d, "inv"), SINCE).select("file_path")


_KEPT = f"FROM inv WHERE coalesce({_TOP}, '') NOT IN ('src3', 'src7') AND contains(file_path, '/')"
_FULL = f"SELECT file_path, CASE WHEN lower(file_extension) NOT IN ('.tdms', '.tdms_index') THEN 'extension' WHEN file_mtime > {_CUT} THEN 'recent' END AS skip_reason {_KEPT}"
_INCR = f"SELECT file_path, CASE WHEN lower(file_extension) NOT IN ('.tdms', '.tdms_index') THEN 'extension' WHEN file_mtime <= {_SINCE} THEN 'not_modified' WHEN file_mtime > {_CUT} THEN 'recent' END AS skip_reason, file_size_bytes {_KEPT}"


def _scan(spark, d):
    return S.scan_since(frame(spark, d, "inv"), SINCE, NOW, SETTLE, EXTS, _names(spark, IGNORE), True)


@query(W("inv") + _FULL)
def scan_full(spark, d):
    return S.scan_all(frame(spark, d, "inv"), NOW, SETTLE, EXTS, _names(spark, IGNORE), True).select("file_path", "skip_reason")


@query(W("inv") + f"SELECT file_path, skip_reason FROM ({_INCR})")
def scan_since(spark, d):
    return _scan(spark, d).select("file_path", "skip_reason")


@query(W("inv") + f"SELECT count(*) FILTER (skip_reason IS NULL) AS files_scanned, count(*) FILTER (skip_reason = 'extension') AS skipped_extension, count(*) FILTER (skip_reason = 'not_modified') AS skipped_not_modified, count(*) FILTER (skip_reason = 'recent') AS skipped_recent FROM ({_INCR})")
def scan_stats(spark, d):
    return S.scan_stats(_scan(spark, d))


@query(W("inv") + f"SELECT count(*) FILTER (skip_reason IS NULL) AS files FROM ({_INCR})")
def count_files(spark, d):
    return S.count_files(_scan(spark, d))


_NAME = "(CASE o_orderkey % 9 WHEN 0 THEN 'run_' || {d1} || 'T10-20-30.tdms' WHEN 1 THEN {d1} || '_x.tdms' WHEN 2 THEN 'd' || {d2} || '_235959.tdms' WHEN 3 THEN {d2} || '.tdms' WHEN 4 THEN {d2} || '_250000.tdms' WHEN 5 THEN '2025-13-40_' || {d2} || '.x' WHEN 6 THEN {d1} || '_10-20-30.tdms' WHEN 7 THEN {d1} || 'T10:20-30_' || {d2} || '_000001' ELSE o_orderpriority END)"
_DUCK_NAME = _NAME.format(d1="strftime(o_orderdate, '%Y-%m-%d')", d2="strftime(o_orderdate, '%Y%m%d')")


@query(f"""SELECT o_orderkey, CASE o_orderkey % 9 WHEN 0 THEN CAST(o_orderdate AS DATE) + INTERVAL 37230 SECOND WHEN 2 THEN CAST(o_orderdate AS DATE) + INTERVAL 86399 SECOND WHEN 7 THEN CAST(o_orderdate AS DATE) + INTERVAL 1 SECOND
WHEN 1 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) WHEN 3 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) WHEN 5 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) WHEN 6 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS filename_timestamp
FROM (SELECT o_orderkey, o_orderdate, {_DUCK_NAME} AS name FROM orders)""")
def filename_timestamp(spark, d):
    name = F.expr(_NAME.format(d1="date_format(o_orderdate, 'yyyy-MM-dd')", d2="date_format(o_orderdate, 'yyyyMMdd')"))
    return table(spark, d, "orders").select("o_orderkey", text.filename_timestamp(name).alias("filename_timestamp"))


@query()
def content_xxh64(spark, d):
    """Compared with the hash library in the tests."""
    return table(spark, d, "documents").select("doc_id", hashing.content_xxh64(F.col("text")).alias("xxh64"))


_HASHES = "SELECT l.file_path, local_checksum AS expected, t.hash AS found, CASE WHEN length(l.file_path) % 9 = 0 THEN 'timed out' END AS err FROM ledger l LEFT JOIN target t ON l.file_path = t.file_path"


@query(W("ledger", "target") + f"SELECT file_path, coalesce(err IS NULL AND expected IS NOT NULL AND expected = found, false) AS ok, CASE WHEN err IS NOT NULL THEN 'could not read: ' || err WHEN expected IS NULL THEN 'no expected hash' WHEN found IS NULL THEN 'no hash found' WHEN expected = found THEN 'match: ' || found ELSE 'mismatch: expected=' || expected || ' found=' || found END AS message FROM ({_HASHES})")
def compare_hash(spark, d):
    j = frame(spark, d, "ledger").join(frame(spark, d, "target").select("file_path", "hash"), "file_path", "left")
    error = F.when(F.length("file_path") % 9 == 0, "timed out")
    return j.select("file_path", hashing.compare_hash(F.col("local_checksum"), F.col("hash"), error).alias("c")).select("file_path", "c.*")


@query(W("inv") + f"SELECT file_path, tree, CASE WHEN tree = 'compressed' THEN '{PACKED}/' ELSE '{ROOT}/' END || file_path AS place, '{ROOT}/' || file_path AS fallback FROM (SELECT file_path, CASE WHEN file_extension = '.tdms_index' THEN 'compressed' ELSE 'uncompressed' END AS tree FROM inv)")
def target_paths(spark, d):
    df = frame(spark, d, "inv").withColumn("tree", paths.desired_tree(F.col("file_extension"), True))
    return df.select("file_path", "tree", paths.target_path(F.translate("file_path", "/", "\\"), F.col("tree"), ROOT, PACKED).alias("place"), paths.target_path(F.col("file_path"), F.col("tree"), ROOT).alias("fallback"))


@query(W("inv") + r"SELECT file_path, regexp_replace(file_path, '\.[^.]+$', '.flac') AS encoded_path, regexp_replace(file_path, '\.[^.]+$', '.json') AS sidecar_path FROM inv")
def artifact_paths(spark, d):
    return paths.artifact_paths(frame(spark, d, "inv")).select("file_path", "encoded_path", "sidecar_path")


@query(W("inv") + "SELECT file_path, CASE WHEN split_part(file_path, '/', 1) IN ('src1', 'src4') THEN 0 ELSE 1 END AS rank FROM inv")
def priority_rank(spark, d):
    return frame(spark, d, "inv").select("file_path", paths.priority_rank(F.col("file_path"), PRIORITY).alias("rank"))


@query(W("ev") + "SELECT event_id, coalesce(contains(lower(error), 'reset'), false) AS conn FROM ev")
def is_conn_error(spark, d):
    return frame(spark, d, "ev").select("event_id", text.is_conn_error(F.col("error")).alias("conn"))


@query("SELECT l_orderkey, l_linenumber, l_extendedprice, CASE WHEN l_linenumber - 2 > 0 THEN l_extendedprice / 1048576.0 / (l_linenumber - 2) ELSE 0.0 END AS mb_per_second, CASE WHEN l_quantity > 0 THEN l_extendedprice / l_quantity END AS times FROM lineitem")
def throughput(spark, d):
    x = F.col("l_extendedprice").cast("double")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", text.per_second(text.megabytes(x), F.col("l_linenumber") - 2).alias("mb_per_second"), text.ratio(x, F.col("l_quantity").cast("double")).alias("times"))


@query("SELECT p_partkey, CAST(p_size AS BIGINT) AS size, p_name AS name, CAST(p_retailprice AS DOUBLE) AS price, true AS same FROM part")
def typed_properties(spark, d):
    cols = {"size": ("p_size", "int32"), "name": ("p_name", "string"), "price": ("p_retailprice", "float64"), "seen": ("p_brand", "timestamp")}
    values = F.create_map(*(x for k, (c, _) in cols.items() for x in (F.lit(k), F.col(c).cast("string"))))
    kinds = F.create_map(*(x for k, (_, t) in cols.items() for x in (F.lit(k), F.lit(t))))
    tagged = table(spark, d, "part").select("p_partkey", text.tag_props(values, kinds).alias("props"))
    back = tagged.withColumn("again", text.props_from_json(text.props_to_json(F.col("props"))))
    p = F.col("again")
    return back.select("p_partkey", text.untag_props(p, "size", "bigint").alias("size"), text.untag_props(p, "name", "string").alias("name"), text.untag_props(p, "price", "double").alias("price"), text.props_equal(F.col("props"), p).alias("same"))


@query("SELECT s_nationkey AS target, CAST(b AS BIGINT) AS planned_bytes, CAST((s_nationkey * CAST(42949672960 AS BIGINT)) AS BIGINT) AS free_bytes, (s_nationkey * 40 < 100 OR b > s_nationkey * CAST(42949672960 AS BIGINT)) AS refused, CASE WHEN s_nationkey * 40 < 100 THEN 'below_floor' WHEN b > s_nationkey * CAST(42949672960 AS BIGINT) THEN 'does_not_fit' END AS reason FROM (SELECT s_nationkey, sum(s_suppkey * 50000000) AS b FROM supplier GROUP BY s_nationkey)")
def capacity_check(spark, d):
    plan = table(spark, d, "supplier").select(F.col("s_nationkey").alias("target"), (F.col("s_suppkey").cast("long") * 50_000_000).alias("file_size_bytes"))
    free = plan.select("target").distinct().select("target", (F.col("target").cast("long") * 40 * 1024**3).alias("free_bytes"))
    return C.capacity_check(plan, free)


# --- C: joins and ledger maintenance --------------------------------------------------------------------------------


@query(W("ledger", "target") + f"SELECT {_TRACKED} FROM ledger WHERE file_path IN (SELECT file_path FROM target)")
def get_files(spark, d):
    return L.get_files(frame(spark, d, "ledger"), frame(spark, d, "target")).select(*_TRACKED.split(", "))


_CHANGES = "SELECT file_path, file_size_bytes + k AS file_size_bytes, k AS seq FROM inv, (SELECT unnest([1, 2]) AS k) WHERE doc_id % 4 = 0"


@query(W("ledger", "inv") + "SELECT file_path, file_size_bytes FROM ledger WHERE file_path NOT IN (SELECT file_path FROM inv WHERE doc_id % 4 = 0) UNION ALL SELECT file_path, file_size_bytes + 2 FROM inv WHERE doc_id % 4 = 0")
def upsert(spark, d):
    changed = frame(spark, d, "inv").where("doc_id % 4 = 0").select("file_path", "file_size_bytes", F.explode(F.array(F.lit(1), F.lit(2))).alias("seq")).withColumn("file_size_bytes", F.col("file_size_bytes") + F.col("seq"))
    return L.upsert(frame(spark, d, "ledger").select("file_path", "file_size_bytes"), changed)


@query(W("ledger", "inv") + "SELECT file_path, false AS deleted FROM ledger WHERE file_path NOT IN (SELECT file_path FROM inv WHERE doc_id % 3 = 0) UNION ALL SELECT file_path, true FROM ledger WHERE file_path IN (SELECT file_path FROM inv WHERE doc_id % 3 = 0)")
def delete_files(spark, d):
    rest, gone = L.delete_files(frame(spark, d, "ledger"), frame(spark, d, "inv").where("doc_id % 3 = 0"))
    return rest.select("file_path", F.lit(False).alias("deleted")).unionByName(gone.select("file_path", F.lit(True).alias("deleted")))


_CHANGE = "SELECT i.file_path, i.doc_id, i.hash, i.file_size_bytes, l.file_size_bytes AS old_size, l.local_checksum AS old_hash, l.transfer_status, CASE WHEN l.file_path IS NULL THEN 'new' WHEN l.local_checksum IS NULL THEN 'unhashed' WHEN i.file_size_bytes <> l.file_size_bytes THEN 'changed' ELSE 'unchanged' END AS change FROM inv i LEFT JOIN ledger l ON i.file_path = l.file_path"


def _changes(spark, d, detect="size"):
    return C.detect_changes(frame(spark, d, "inv").withColumn("filename_timestamp", F.lit(None).cast("timestamp_ntz")), frame(spark, d, "ledger"), detect)


@query(W("inv", "ledger") + f"SELECT file_path, change FROM ({_CHANGE})")
def detect_changes(spark, d):
    return _changes(spark, d).select("file_path", "change")


@query(W("inv", "ledger") + "SELECT i.file_path, CASE WHEN l.file_path IS NULL THEN 'new' WHEN l.local_checksum IS NULL THEN 'unhashed' WHEN i.file_size_bytes <> l.file_size_bytes OR i.file_mtime <> l.file_mtime THEN 'changed' ELSE 'unchanged' END AS change FROM inv i LEFT JOIN ledger l ON i.file_path = l.file_path")
def detect_changes_by_time(spark, d):
    return _changes(spark, d, "size_mtime").select("file_path", "change")


@query(W("inv", "ledger") + f"SELECT file_path, file_size_bytes, 'pending' AS transfer_status, hash AS local_checksum, {_NOW} AS first_seen, 'xxh64' AS checksum_algorithm, CASE WHEN doc_id % 4 = 1 THEN 'compressed' ELSE 'uncompressed' END AS remote_tree FROM ({_CHANGE}) WHERE change = 'new'")
def new_records(spark, d):
    return C.new_records(_changes(spark, d), NOW, True).select("file_path", "file_size_bytes", "transfer_status", "local_checksum", "first_seen", "checksum_algorithm", "remote_tree")


_APPLIED = f"SELECT file_path, file_size_bytes, CASE WHEN change = 'unchanged' THEN old_hash ELSE hash END AS local_checksum, CASE WHEN change = 'unchanged' THEN transfer_status ELSE 'pending' END AS transfer_status FROM ({_CHANGE})"


@query(W("inv", "ledger") + _APPLIED)
def apply_changes(spark, d):
    return C.apply_changes(frame(spark, d, "ledger"), _changes(spark, d), NOW).select("file_path", "file_size_bytes", "local_checksum", "transfer_status")


_WANTED = "SELECT l.*, CASE WHEN lower(l.file_extension) = '.tdms_index' AND s.f IS NOT NULL THEN 'compressed' WHEN lower(l.file_extension) = '.tdms_index' AND {on} THEN 'compressed' ELSE 'uncompressed' END AS desired FROM ledger l LEFT JOIN (SELECT DISTINCT file_path || '_index' AS f FROM ledger WHERE compressed) s ON l.file_path = s.f"


@query(W("ledger") + f"SELECT file_path, CASE WHEN transfer_status <> 'verified' THEN desired ELSE remote_tree END AS remote_tree, transfer_status <> 'verified' AND desired <> remote_tree AND remote_checksum IS NOT NULL AS superseded FROM ({_WANTED.format(on='true')})")
def reroute(spark, d):
    moved, old = C.reroute(frame(spark, d, "ledger"), True)
    return moved.join(old.select("file_path", F.lit(True).alias("s")), "file_path", "left").select("file_path", "remote_tree", F.coalesce("s", F.lit(False)).alias("superseded"))


@query(W("ledger") + f"SELECT file_path, desired AS desired_tree FROM ({_WANTED.format(on='false')})")
def desired_tree_for_record(spark, d):
    return C.desired_tree_for_record(frame(spark, d, "ledger"), False).select("file_path", "desired_tree")


_PLAN = "SELECT l.file_path, l.transfer_status, l.file_size_bytes, CASE WHEN transfer_status NOT IN ('pending', 'failed', 'checksum_mismatch') THEN 'not_actionable' WHEN t.hash = l.local_checksum THEN 'already_there' WHEN t.file_path IS NOT NULL THEN 'different_there' ELSE 'absent' END AS reason FROM ledger l LEFT JOIN target t ON l.file_path = t.file_path"


def _plan(spark, d):
    return C.plan_transfers(frame(spark, d, "ledger"), frame(spark, d, "target"))


@query(W("ledger", "target") + f"SELECT file_path, reason, reason IN ('absent', 'different_there') AS needs_transfer FROM ({_PLAN})")
def plan_transfers(spark, d):
    return _plan(spark, d).select("file_path", "reason", "needs_transfer")


@query(W("ledger", "target") + f"SELECT file_path, CASE WHEN reason = 'already_there' THEN 'verified' ELSE transfer_status END AS transfer_status FROM ({_PLAN})")
def settle_matches(spark, d):
    return C.settle_matches(frame(spark, d, "ledger"), _plan(spark, d), NOW).select("file_path", "transfer_status")


@query(W("ledger", "target") + "SELECT l.file_path, t.file_path IS NOT NULL AS exists_there, t.file_size_bytes AS target_size FROM ledger l LEFT JOIN target t ON l.file_path = t.file_path")
def target_state(spark, d):
    return C.target_state(frame(spark, d, "ledger"), frame(spark, d, "target"))


@query(W("inv", "ledger") + f"SELECT file_path, file_mtime > {_CUT} AS held FROM inv WHERE file_path IN (SELECT file_path FROM ledger WHERE transfer_status IN ('pending', 'failed', 'checksum_mismatch')) AND file_path NOT IN (SELECT file_path FROM ({_INCR}) WHERE skip_reason IS NULL) AND coalesce({_TOP}, '') NOT IN ('src3', 'src7')")
def requeue(spark, d):
    return C.requeue(frame(spark, d, "ledger"), frame(spark, d, "inv"), S.selected(_scan(spark, d)), NOW, _names(spark, IGNORE), SETTLE).select("file_path", "held")


@query(W("inv", "ledger") + "SELECT file_path, file_size_bytes, 'pending' AS transfer_status, 0 AS transfer_attempts FROM inv WHERE doc_id % 10 = 0 AND file_path NOT IN (SELECT file_path FROM ledger)")
def stub_failed_checks(spark, d):
    return C.stub_failed_checks(frame(spark, d, "inv").where("doc_id % 10 = 0"), frame(spark, d, "ledger"), NOW).select("file_path", "file_size_bytes", "transfer_status", "transfer_attempts")


@query(W("ledger") + f"SELECT {_TRACKED} FROM ledger WHERE transfer_status = 'failed'")
def by_status(spark, d):
    return L.by_status(frame(spark, d, "ledger"), "failed").select(*_TRACKED.split(", "))


@query(W("ledger") + f"SELECT {_TRACKED} FROM ledger WHERE transfer_status IN ('pending', 'failed', 'checksum_mismatch')")
def pending_transfers(spark, d):
    return L.pending_transfers(frame(spark, d, "ledger")).select(*_TRACKED.split(", "))


@query(W("ledger") + "SELECT file_path, last_verified_remote FROM ledger WHERE last_verified_remote IS NULL OR last_verified_remote < TIMESTAMP '2023-12-31 06:00:00'")
def unverified(spark, d):
    return L.unverified(frame(spark, d, "ledger"), "2023-12-31 06:00:00").select("file_path", "last_verified_remote")


@query(W("ledger") + "SELECT file_path, last_verified_remote, file_size_bytes FROM (SELECT *, sum(file_size_bytes) OVER (ORDER BY last_verified_remote NULLS FIRST, file_path) - file_size_bytes AS before FROM ledger) WHERE before < (SELECT CAST(sum(file_size_bytes) AS BIGINT) // 3 FROM ledger)")
def stalest(spark, d):
    """The records to verify next, a third of all bytes."""
    records = frame(spark, d, "ledger")
    budget = (records.agg(F.sum("file_size_bytes")).first()[0] or 0) // 3
    return L.stalest(records, budget).select("file_path", "last_verified_remote", "file_size_bytes")


_TRY = "SELECT *, CASE WHEN NOT success OR remote_error IS NOT NULL THEN 'failed' WHEN remote_checksum = sent_checksum THEN 'verified' ELSE 'checksum_mismatch' END AS result, CASE WHEN NOT success THEN error WHEN remote_error IS NOT NULL THEN 'the copy could not be read back: ' || remote_error WHEN remote_checksum <> sent_checksum THEN 'the copy differs: hash of what was sent ' || sent_checksum || ', of what is there ' || remote_checksum END AS message FROM (SELECT * FROM tries UNION ALL SELECT * FROM tries2)"


def _tries(spark, d):
    return frame(spark, d, "tries").unionByName(frame(spark, d, "tries2"))


@query(W("tries", "tries2") + f"SELECT file_path, attempt, result, message FROM ({_TRY})")
def resolve_outcomes(spark, d):
    return O.resolve_outcomes(_tries(spark, d)).select("file_path", "attempt", "result", "message")


@query(W("ledger", "tries", "tries2") + f""", t AS ({_TRY}), f AS (SELECT file_path, count(*) AS n, count(*) FILTER (result = 'checksum_mismatch') AS m, arg_max(result, attempt) AS result, arg_max(remote_checksum, attempt) FILTER (remote_checksum IS NOT NULL) AS rc, arg_max(sent_checksum, attempt) FILTER (success AND sent_checksum IS NOT NULL) AS sent, arg_max(message, attempt) FILTER (message IS NOT NULL) AS message FROM t GROUP BY file_path)
SELECT l.file_path, coalesce(f.sent, l.local_checksum) AS local_checksum, CASE WHEN f.result = 'verified' THEN f.rc ELSE l.remote_checksum END AS remote_checksum, coalesce(f.result, l.transfer_status) AS transfer_status, CAST(l.transfer_attempts + coalesce(f.n, 0) AS INTEGER) AS transfer_attempts, CAST(l.failed_checksum_count + coalesce(f.m, 0) AS INTEGER) AS failed_checksum_count, coalesce(f.message, l.last_error) AS last_error, CASE WHEN f.result = 'verified' THEN false ELSE l.compressed END AS compressed FROM ledger l LEFT JOIN f ON l.file_path = f.file_path""")
def apply_outcomes(spark, d):
    return O.apply_outcomes(frame(spark, d, "ledger"), _tries(spark, d), NOW).select("file_path", "local_checksum", "remote_checksum", "transfer_status", "transfer_attempts", "failed_checksum_count", "last_error", "compressed")


@query(W("ledger", "encoded_tries") + "SELECT l.file_path, CASE WHEN e.file_path IS NULL THEN l.transfer_status WHEN e.success THEN 'verified' ELSE 'failed' END AS transfer_status, CASE WHEN e.success THEN e.compressed_bytes ELSE l.compressed_bytes END AS compressed_bytes, CASE WHEN e.success THEN e.rebuilt_checksum ELSE l.remote_checksum END AS remote_checksum, coalesce(CASE WHEN NOT e.success THEN e.error END, l.last_error) AS last_error, coalesce(e.success, false) OR l.compressed AS compressed FROM ledger l LEFT JOIN encoded_tries e ON l.file_path = e.file_path")
def apply_encoded_outcomes(spark, d):
    return O.apply_encoded_outcomes(frame(spark, d, "ledger"), frame(spark, d, "encoded_tries"), NOW).select("file_path", "transfer_status", "compressed_bytes", "remote_checksum", "last_error", "compressed")


_SIBLINGS = "SELECT DISTINCT regexp_replace(file_path, '_index$', '') AS file_path FROM inv WHERE doc_id % 4 = 1 AND doc_id % 3 = 0"


@query(W("ledger", "inv") + f"SELECT l.file_path, CASE WHEN s.file_path IS NOT NULL THEN 'compressed' ELSE remote_tree END AS remote_tree, CASE WHEN s.file_path IS NOT NULL AND remote_tree <> 'compressed' AND transfer_status = 'verified' THEN 'pending' ELSE transfer_status END AS transfer_status FROM ledger l LEFT JOIN ({_SIBLINGS}) s ON l.file_path = s.file_path || '_index'")
def reroute_index_siblings(spark, d):
    rebuilt = frame(spark, d, "inv").where("doc_id % 4 = 1 AND doc_id % 3 = 0").select(F.regexp_replace("file_path", "_index$", "").alias("file_path"))
    return O.reroute_index_siblings(frame(spark, d, "ledger"), rebuilt).select("file_path", "remote_tree", "transfer_status")


@query(W("ledger") + "SELECT file_path, CASE WHEN transfer_status IN ('failed', 'checksum_mismatch') THEN last_error END AS current_error FROM ledger")
def current_errors(spark, d):
    return O.current_errors(frame(spark, d, "ledger")).select("file_path", "current_error")


_VERIFY = f"""k AS (SELECT l.*, lo.hash AS now_local, CASE WHEN lo.file_path IS NULL THEN 'local_missing' WHEN l.local_checksum IS NULL OR lo.hash <> l.local_checksum THEN 'local_changed' END AS st FROM ledger l LEFT JOIN local0 lo ON l.file_path = lo.file_path),
chk AS (
SELECT file_path, 1 AS o, CASE WHEN compressed THEN 'rebuilt' ELSE 'file' END AS label, CASE WHEN remote_tree = 'compressed' THEN '{PACKED}/' ELSE '{ROOT}/' END || file_path AS artifact, CASE WHEN compressed THEN remote_checksum ELSE now_local END AS expected, CASE WHEN compressed OR remote_tree <> 'compressed' THEN '{ROOT}' ELSE '{PACKED}' END AS check_root, file_path AS rel FROM k WHERE st IS NULL
UNION ALL SELECT file_path, 2, 'encoded', '{PACKED}/' || regexp_replace(file_path, '\\.[^.]+$', '.flac'), compressed_checksum, '{PACKED}', regexp_replace(file_path, '\\.[^.]+$', '.flac') FROM k WHERE st IS NULL AND compressed AND compressed_checksum IS NOT NULL
UNION ALL SELECT file_path, 3, 'sidecar', '{PACKED}/' || regexp_replace(file_path, '\\.[^.]+$', '.json'), sidecar_checksum, '{PACKED}', regexp_replace(file_path, '\\.[^.]+$', '.json') FROM k WHERE st IS NULL AND compressed AND sidecar_checksum IS NOT NULL),
seen AS (SELECT c.*, a.hash AS found, CASE WHEN a.artifact IS NULL OR a.error IS NOT NULL THEN 'remote_error' WHEN c.expected IS NULL OR a.hash <> c.expected THEN 'remote_mismatch' END AS bad FROM chk c LEFT JOIN artifacts a ON c.artifact = a.artifact),
firsts AS (SELECT *, row_number() OVER (PARTITION BY file_path ORDER BY o) AS rn FROM seen WHERE bad IS NOT NULL),
verdicts AS (SELECT k.file_path, k.file_name, k.now_local, coalesce(k.st, f.bad, 'ok') AS verdict, f.label, f.artifact, f.check_root, f.rel FROM k LEFT JOIN firsts f ON k.file_path = f.file_path AND f.rn = 1)"""
_VW = W("ledger", "local0", "artifacts").rstrip() + ", " + _VERIFY + " "


def _verdicts(spark, d):
    return V.verify_ledger(frame(spark, d, "ledger"), frame(spark, d, "local0"), frame(spark, d, "artifacts"), ROOT, PACKED)


@query(_VW + "SELECT file_path, verdict, label, artifact FROM verdicts")
def verify_ledger(spark, d):
    return _verdicts(spark, d).select("file_path", "verdict", "label", "artifact")


@query(_VW + f"SELECT l.file_path, CASE WHEN v.verdict = 'local_changed' THEN v.now_local ELSE l.local_checksum END AS local_checksum, CASE WHEN v.verdict IN ('local_changed', 'remote_mismatch') THEN 'pending' ELSE l.transfer_status END AS transfer_status, CAST(l.failed_checksum_count + CASE WHEN v.verdict = 'remote_mismatch' THEN 1 ELSE 0 END AS INTEGER) AS failed_checksum_count, CASE WHEN v.verdict = 'ok' THEN {_NOW} ELSE l.last_verified_remote END AS last_verified_remote FROM ledger l JOIN verdicts v ON l.file_path = v.file_path")
def apply_verdicts(spark, d):
    return V.apply_verdicts(frame(spark, d, "ledger"), _verdicts(spark, d), NOW).select("file_path", "local_checksum", "transfer_status", "failed_checksum_count", "last_verified_remote")


@query(_VW + "SELECT artifact, check_root || '/_mismatched/' || rel || '.20240101T120000' AS moved_to FROM verdicts WHERE verdict = 'remote_mismatch'")
def quarantine_plan(spark, d):
    return V.quarantine_plan(_verdicts(spark, d), NOW)


@query("WITH n AS (SELECT 'src' || CAST(n_nationkey AS VARCHAR) AS name FROM nation UNION ALL SELECT 'a/' || n_name FROM nation WHERE n_nationkey < 3), tops AS (SELECT DISTINCT source AS top FROM documents WHERE doc_id % 17 <> 0) SELECT name, 'is a path' AS problem FROM n WHERE contains(name, '/') UNION ALL SELECT name, 'not in the archive' FROM n WHERE NOT contains(name, '/') AND name NOT IN (SELECT top FROM tops)")
def audit_names(spark, d):
    n = table(spark, d, "nation")
    names = n.select(F.concat(F.lit("src"), "n_nationkey").alias("name")).unionByName(n.where("n_nationkey < 3").select(F.concat(F.lit("a/"), "n_name").alias("name")))
    return S.audit_names(names, frame(spark, d, "inv"))


@query("SELECT p_partkey, p_size % 2 = 0 AS same FROM part")
def properties_equal(spark, d):
    p = table(spark, d, "part")
    a = F.create_map(F.lit("brand"), F.struct(F.lit("py").alias("t"), F.lit("string").alias("dt"), F.col("p_brand").alias("v")))
    b = F.create_map(F.lit("brand"), F.struct(F.lit("py").alias("t"), F.lit("string").alias("dt"), F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).otherwise("x").alias("v")))
    return p.select("p_partkey", text.props_equal(a, b).alias("same"))


_SHAPE = "SELECT file_path, CASE WHEN doc_id % 30 = 0 THEN 2 ELSE 1 END AS g, CASE WHEN doc_id % 30 = 0 OR doc_id % 25 = 0 THEN 2 ELSE 1 END AS c"


def _channels(spark, d):
    one = lambda name, value: (F.lit(name), F.struct(F.lit("np").alias("t"), F.lit("float64").alias("dt"), value.alias("v")))
    inv = frame(spark, d, "inv").where("doc_id % 35 <> 0")
    step = F.when(F.col("doc_id") % 28 == 0, "0.0").when(F.col("doc_id") % 32 == 0, "1e-7").otherwise("2e-05")
    props = F.create_map(*one("wf_increment", step), *one("wf_start_time", F.when(F.col("doc_id") % 44 != 0, "2024-01-01T00:00:00")), *one("unit", F.lit("V")))
    scaled = F.map_concat(props, F.create_map(*one("NI_Scale[0]", F.lit("1"))))
    n = F.when((F.col("doc_id") % 30 == 0) | (F.col("doc_id") % 25 == 0), 2).otherwise(1)
    return inv.select("file_path", F.explode(F.sequence(F.lit(1), n)).alias("k"), F.when(F.col("doc_id") % 52 == 0, scaled).otherwise(props).alias("properties"), (F.col("doc_id") % 30 == 0).alias("two")).select("file_path", F.when(F.col("two"), F.concat(F.lit("g"), "k")).otherwise("g").alias("group_name"), F.concat(F.lit("c"), "k").alias("channel_name"), "properties")


@query(W("inv") + f"SELECT file_path, CAST(g AS BIGINT) AS n_groups, CAST(c AS BIGINT) AS n_channels, g = 1 AND c = 1 AS single FROM ({_SHAPE} FROM inv WHERE doc_id % 35 <> 0)")
def channel_shape(spark, d):
    return K.channel_shape(_channels(spark, d))


@query(W("inv", "ledger") + "SELECT l.file_path, r IS NULL AS eligible, r AS decline_reason FROM (SELECT l.file_path, CASE WHEN lower(l.file_extension) <> '.tdms' THEN 'extension' WHEN l.file_size_bytes < 500 THEN 'too_small' WHEN doc_id % 35 = 0 THEN 'unreadable' WHEN doc_id % 30 = 0 THEN 'groups' WHEN doc_id % 25 = 0 THEN 'channels' WHEN doc_id % 52 = 0 THEN 'scaling_properties' WHEN doc_id % 44 = 0 THEN 'no_timing' WHEN doc_id % 28 = 0 THEN 'increment' WHEN doc_id % 32 = 0 THEN 'sample_rate' END AS r FROM ledger l JOIN inv i ON l.file_path = i.file_path) l")
def codec_eligibility(spark, d):
    return K.codec_eligibility(frame(spark, d, "ledger"), _channels(spark, d), least_bytes=500)


# --- D: aggregations -------------------------------------------------------------------------------------------------

_DOMAIN = "(VALUES " + ", ".join(f"('{s}')" for s in STATUSES) + ") AS dom(transfer_status)"


@query(W("ledger") + "SELECT count(*) AS files FROM ledger")
def count_tracked(spark, d):
    return L.count_tracked(frame(spark, d, "ledger"))


@query(W("ledger") + f"SELECT dom.transfer_status, count(l.file_path) AS files FROM {_DOMAIN} LEFT JOIN ledger l ON l.transfer_status = dom.transfer_status GROUP BY dom.transfer_status")
def count_by_status(spark, d):
    return L.count_by_status(frame(spark, d, "ledger"))


@query(W("ledger") + "SELECT count(*) AS total_files_tracked, CAST(sum(file_size_bytes) AS BIGINT) AS total_bytes_tracked FROM ledger")
def ledger_totals(spark, d):
    return L.ledger_totals(frame(spark, d, "ledger"))


_RECENT = f"file_mtime > {_NOW} - INTERVAL 6 HOUR"


@query(W("ledger") + f"SELECT dom.transfer_status, count(l.file_path) AS files FROM {_DOMAIN} LEFT JOIN ledger l ON l.transfer_status = dom.transfer_status AND {_RECENT} GROUP BY dom.transfer_status")
def recent_stats(spark, d):
    return L.recent_stats(frame(spark, d, "ledger"), NOW)


_ISSUES = "transfer_status IN ('pending', 'failed', 'checksum_mismatch')"


@query(W("ledger") + f""", r AS (SELECT * FROM ledger WHERE {_RECENT}), n AS (SELECT file_name, row_number() OVER (ORDER BY file_path, file_name) AS k FROM r WHERE {_ISSUES}),
c AS (SELECT count(*) AS t, count(*) FILTER (transfer_status = 'verified') AS v, count(*) FILTER ({_ISSUES}) AS p FROM r)
SELECT CASE WHEN t = 0 THEN '' WHEN p > 0 THEN 'In 6 hours ' || t || ' files were modified; to look at: ' || p || (SELECT string_agg(chr(10) || '* ' || file_name, '' ORDER BY k) FROM n WHERE k <= 5) || CASE WHEN p > 5 THEN chr(10) || '(' || (p - 5) || ' others)' ELSE '' END ELSE 'In 6 hours ' || t || ' files were modified; verified: ' || v END AS summary FROM c""")
def recent_summary(spark, d):
    return R.recent_summary(frame(spark, d, "ledger"), NOW)


@query(W("inv") + "SELECT (SELECT string_agg(file_name, ',' ORDER BY file_path) FROM (SELECT file_name, file_path FROM inv ORDER BY file_path LIMIT 10)) AS names, count(*) AS total, greatest(count(*) - 10, 0) AS more FROM inv")
def top_n_with_overflow(spark, d):
    return R.top_n_with_overflow(frame(spark, d, "inv"), 10, "file_name").withColumn("names", F.array_join("names", ","))


_LAST = f", t AS ({_TRY}), fin AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY file_path ORDER BY attempt DESC) = 1), scan AS ({_INCR}), plan AS ({_PLAN}) "
_STATS = """SELECT (SELECT count(*) FROM scan WHERE skip_reason IS NULL) AS files_scanned, (SELECT count(*) FROM scan WHERE skip_reason = 'extension') AS skipped_extension, (SELECT count(*) FROM scan WHERE skip_reason = 'not_modified') AS skipped_not_modified, (SELECT count(*) FROM scan WHERE skip_reason = 'recent') AS skipped_recent,
(SELECT count(*) FROM plan) AS files_checked, (SELECT count(*) FROM plan WHERE reason IN ('absent', 'different_there')) AS files_planned, (SELECT count(*) FROM plan WHERE reason = 'already_there') AS files_already_there,
count(*) FILTER (result = 'verified') AS files_transferred, count(*) FILTER (result <> 'verified') AS files_failed, count(*) FILTER (result = 'checksum_mismatch') AS files_mismatched, CAST(coalesce(sum(bytes_transferred) FILTER (result = 'verified'), 0) AS BIGINT) AS bytes_transferred, coalesce(sum(duration_seconds), 0.0) AS copy_seconds FROM fin"""


def _stats(spark, d):
    return R.sync_stats(_scan(spark, d), _plan(spark, d), O.resolve_outcomes(O.final_outcomes(_tries(spark, d))))


@query(W("inv", "ledger", "target", "tries", "tries2") + _LAST + _STATS)
def sync_stats(spark, d):
    return _stats(spark, d)


@query(W("inv", "ledger", "target", "tries", "tries2") + _LAST + f"SELECT files_transferred, files_failed, bytes_transferred / 1048576.0 AS mb, 50.0::DOUBLE AS seconds, bytes_transferred / 1048576.0 / 50.0 AS mb_per_second, CASE WHEN files_failed > 0 THEN 'warning' ELSE 'success' END AS severity FROM ({_STATS})")
def sync_summary(spark, d):
    return R.sync_summary(_stats(spark, d), 50.0).drop("summary")


@query(_VW + "SELECT count(*) AS files_checked, count(*) FILTER (verdict = 'ok') AS files_ok, count(*) FILTER (verdict IN ('local_changed', 'remote_mismatch')) AS mismatches, count(*) FILTER (verdict = 'remote_error') AS errors, count(*) FILTER (verdict = 'local_missing') AS missing, (SELECT string_agg(file_name, ',' ORDER BY file_path) FROM (SELECT * FROM verdicts WHERE verdict = 'remote_mismatch' ORDER BY file_path LIMIT 10)) AS names, greatest(count(*) FILTER (verdict = 'remote_mismatch') - 10, 0) AS more, CASE WHEN count(*) FILTER (verdict IN ('local_changed', 'remote_mismatch', 'remote_error')) > 0 THEN 'error' ELSE 'success' END AS severity FROM verdicts")
def verify_summary(spark, d):
    return R.verify_summary(_verdicts(spark, d)).withColumn("names", F.array_join("names", ","))


@query(W("ledger") + f"SELECT count(*) AS total_files_tracked, CAST(sum(file_size_bytes) AS BIGINT) AS total_bytes_tracked, (SELECT string_agg(s || '=' || n, ',' ORDER BY s) FROM (SELECT dom.transfer_status AS s, count(l.file_path) AS n FROM {_DOMAIN} LEFT JOIN ledger l ON l.transfer_status = dom.transfer_status GROUP BY 1)) AS counts, {_CUT} AS last_scan_time FROM ledger")
def status_report(spark, d):
    ledger = frame(spark, d, "ledger")
    state = L.advance_cursor(L.read_state(None, spark), ledger, datetime.fromisoformat(NOW), "settled", SETTLE)
    out = R.status_report(ledger, state)
    return out.select("total_files_tracked", "total_bytes_tracked", F.array_join(F.transform(F.map_entries("status_counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("counts"), "last_scan_time")


# --- E: runs, order, samples ------------------------------------------------------------------------------------------


def _ordered(spark, d):
    from pyspark.sql import Window

    return frame(spark, d, "ev").withColumn("seq", F.row_number().over(Window.partitionBy("pass_id").orderBy("ts", "event_id")))


_SEQ = "e AS (SELECT *, CAST(row_number() OVER (PARTITION BY pass_id ORDER BY ts, event_id) AS INTEGER) AS seq FROM ev)"
_EW = W("ev").rstrip() + ", " + _SEQ + " "


@query(W("ledger", "target") + f"SELECT file_path, CASE WHEN split_part(file_path, '/', 1) IN ('src1', 'src4') THEN 0 ELSE 1 END AS rank, reason FROM ({_PLAN})")
def order_plan(spark, d):
    return C.order_plan(_plan(spark, d), PRIORITY).select("file_path", "rank", "reason")


_MISMATCH = "SELECT pass_id, min(seq) AS seq, min_by(run, seq) AS mismatches FROM (SELECT *, count(*) FILTER (result = 'checksum_mismatch') OVER (PARTITION BY pass_id ORDER BY seq) AS run FROM e) WHERE run >= 5 GROUP BY pass_id"


@query(_EW + _MISMATCH)
def mismatch_abort_point(spark, d):
    return O.mismatch_abort_point(_ordered(spark, d))


_STREAK = "SELECT *, CASE WHEN hit THEN 1 ELSE 0 END AS h, sum(CASE WHEN hit THEN 0 ELSE 1 END) OVER (PARTITION BY pass_id ORDER BY seq) AS island FROM (SELECT *, NOT success AND coalesce(contains(lower(error), 'reset'), false) AS hit FROM e)"
_CONN = f"SELECT pass_id, min(seq) AS seq, CAST(min_by(streak, seq) AS BIGINT) AS streak FROM (SELECT *, sum(h) OVER (PARTITION BY pass_id, island ORDER BY seq) AS streak FROM ({_STREAK})) WHERE streak >= 3 GROUP BY pass_id"


@query(_EW + _CONN)
def conn_streak_abort_point(spark, d):
    return O.conn_streak_abort_point(_ordered(spark, d), 3)


@query(_EW + "SELECT pass_id, min(seq) AS seq, CAST(min_by(streak, seq) AS BIGINT) AS streak FROM (SELECT *, sum(CASE WHEN decode_failure THEN 1 ELSE 0 END) OVER (PARTITION BY pass_id, island ORDER BY seq) AS streak FROM (SELECT *, sum(CASE WHEN success THEN 1 ELSE 0 END) OVER (PARTITION BY pass_id ORDER BY seq) AS island FROM e)) WHERE streak >= 3 AND decode_failure GROUP BY pass_id")
def decode_halt_point(spark, d):
    return O.decode_halt_point(_ordered(spark, d), 3)


@query(_EW + f", stop AS (SELECT pass_id, min(seq) AS stop FROM ((SELECT pass_id, seq FROM ({_MISMATCH})) UNION ALL (SELECT pass_id, seq FROM ({_CONN}))) GROUP BY pass_id) SELECT event_id, coalesce(seq > stop, false) AS cancelled FROM e LEFT JOIN stop ON e.pass_id = stop.pass_id")
def cancelled(spark, d):
    return O.cancelled(_ordered(spark, d), 5, 3).select("event_id", "cancelled")


@query(W("tries", "tries2") + "SELECT file_path, 2 AS attempt FROM (SELECT * FROM tries UNION ALL SELECT * FROM tries2) WHERE attempt = 1 AND NOT success AND (raised OR contains(lower(error), 'reset'))")
def retry_plan(spark, d):
    return O.retry_plan(_tries(spark, d))


@query(W("inv") + ", big AS (SELECT *, row_number() OVER (ORDER BY file_path) - 1 AS rk, count(*) OVER () AS n FROM inv WHERE file_size_bytes >= 300) SELECT file_path, file_size_bytes FROM big WHERE rk % greatest(1, n // 25) = 0 AND rk < greatest(1, n // 25) * 25")
def spread_sample(spark, d):
    return O.spread_sample(frame(spark, d, "inv"), 25, 300).select("file_path", "file_size_bytes")


# --- F: signals -------------------------------------------------------------------------------------------------------


def _values(spark, d):
    """Event values by user."""
    from pyspark.sql import Window

    events = table(spark, d, "events").select("user_id", "ts", "event_id", "value")
    return dealt(events, events.count(), "user_id").select(F.col("user_id").cast("long").alias("signal_id"), (F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1).cast("long").alias("idx"), "value")


def _by_supplier(spark, d, column):
    from pyspark.sql import Window

    by = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_extendedprice", "l_shipdate"]
    order = Window.partitionBy("l_suppkey").orderBy(*by)
    items = table(spark, d, "lineitem").select("l_suppkey", *by, *({column} - {*by}))
    return dealt(items, items.count(), "l_suppkey").select(F.col("l_suppkey").cast("long").alias("signal_id"), (F.row_number().over(order) - 1).cast("long").alias("idx"), F.col(column).cast("double").alias("value"))


def _discounts(spark, d):
    return _by_supplier(spark, d, "l_discount")


_SIG = "s AS (SELECT CAST(user_id AS BIGINT) AS signal_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS idx, value FROM events)"
_DISC = "s AS (SELECT CAST(l_suppkey AS BIGINT) AS signal_id, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount, l_extendedprice, l_shipdate) - 1 AS idx, CAST(l_discount AS DOUBLE) AS value FROM lineitem)"
_FIT = """lv AS (SELECT signal_id, value AS level, count(*) AS samples FROM s GROUP BY ALL),
g AS (SELECT *, level - lag(level) OVER w AS gap FROM lv WINDOW w AS (PARTITION BY signal_id ORDER BY level)),
a AS (SELECT signal_id, count(*) AS n_levels, min(level) AS grid_offset, min(gap) AS lg FROM g GROUP BY signal_id),
b AS (SELECT a.signal_id, max(abs(gap / lg - round_even(gap / lg, 0))) AS worst FROM a JOIN g ON a.signal_id = g.signal_id WHERE gap IS NOT NULL GROUP BY a.signal_id),
f0 AS (SELECT a.*, n_levels = 1 OR coalesce(lg > 0 AND worst <= 1e-4, false) AS on_grid FROM a LEFT JOIN b ON a.signal_id = b.signal_id),
r AS (SELECT f0.signal_id, level, sum(round_even((level - grid_offset) / lg, 0) * (level - grid_offset)) OVER w AS num, sum(round_even((level - grid_offset) / lg, 0) * round_even((level - grid_offset) / lg, 0)) OVER w AS den FROM f0 JOIN lv ON f0.signal_id = lv.signal_id WHERE on_grid AND n_levels > 1 WINDOW w AS (PARTITION BY f0.signal_id ORDER BY level)),
fit AS (SELECT f0.signal_id, n_levels, grid_offset, CASE WHEN n_levels = 1 THEN 1.0 WHEN on_grid THEN num / den END AS step, on_grid FROM f0 LEFT JOIN (SELECT signal_id, max_by(num, level) AS num, max_by(den, level) AS den FROM r GROUP BY signal_id) z ON f0.signal_id = z.signal_id),
code AS (SELECT s.signal_id, idx, value, grid_offset, step, CAST(round_even((value - grid_offset) / step, 0) AS BIGINT) AS code FROM s JOIN fit ON s.signal_id = fit.signal_id WHERE on_grid)"""


@query("WITH " + _SIG + " SELECT signal_id, value AS level, count(*) AS samples FROM s GROUP BY ALL")
def signal_levels(spark, d):
    return K.signal_levels(_values(spark, d))


def _rounded(fit):
    return fit.select("signal_id", "n_levels", "grid_offset", F.round("step", 9).alias("step"), "on_grid")


_MIXED = _SIG.replace("s AS (", "s1 AS (", 1) + ", " + _DISC.replace("s AS (", "s2 AS (", 1) + ", s AS (SELECT signal_id, idx, value FROM s1 UNION ALL SELECT -1 - signal_id, idx, value FROM s2)"
#: Which encoding each signal gets, from its levels: a grid that gives back every level, else level numbers.
_CHOSEN = """x AS (SELECT lv.signal_id, sum(samples) AS n_samples, bool_and(level = grid_offset + CAST(round_even((level - grid_offset) / step, 0) AS BIGINT) * step) AS ex,
 min(CAST(round_even((level - grid_offset) / step, 0) AS BIGINT)) AS lo, max(CAST(round_even((level - grid_offset) / step, 0) AS BIGINT)) AS hi FROM lv JOIN fit ON lv.signal_id = fit.signal_id AND on_grid GROUP BY lv.signal_id),
y AS (SELECT fit.signal_id, n_levels, greatest(2, CASE WHEN hi > 0 THEN length(bin(hi)) + 1 ELSE 2 END, CASE WHEN lo < 0 THEN length(bin(-lo - 1)) + 1 ELSE 2 END) AS affine_bits, CASE WHEN n_levels > 1 THEN greatest(2, length(bin(n_levels - 1)) + 1) ELSE 2 END AS index_bits, coalesce(on_grid AND ex, false) AS fits FROM fit LEFT JOIN x ON fit.signal_id = x.signal_id),
chosen AS (SELECT y.signal_id, n_levels, n_samples, CASE WHEN fits AND affine_bits <= 24 THEN 'affine_codes' WHEN index_bits <= 24 THEN 'indexed' ELSE 'fixed_point' END AS encoding,
 CAST(CASE WHEN (CASE WHEN fits AND affine_bits <= 24 THEN affine_bits WHEN index_bits <= 24 THEN index_bits ELSE 24 END) <= 16 THEN 16 ELSE 24 END AS INTEGER) AS bits_per_sample FROM y JOIN (SELECT signal_id, CAST(sum(samples) AS BIGINT) AS n_samples FROM lv GROUP BY signal_id) n ON y.signal_id = n.signal_id)"""


def _mixed(spark, d):
    """Event values, which lie on no grid, and discounts, which do; written once, since they are read several times."""
    return saved(_values(spark, d).unionByName(_discounts(spark, d).withColumn("signal_id", -1 - F.col("signal_id"))), "signals")


@query("WITH " + _SIG + ", " + _FIT + " SELECT signal_id, n_levels, grid_offset, round(step, 9) AS step, on_grid FROM fit")
def fit_grid(spark, d):
    return _rounded(K.fit_grid(K.signal_levels(_values(spark, d))))


@query("WITH " + _DISC + ", " + _FIT + " SELECT signal_id, n_levels, grid_offset, round(step, 9) AS step, on_grid FROM fit")
def fit_grid_discounts(spark, d):
    return _rounded(K.fit_grid(K.signal_levels(_discounts(spark, d))))


@query("WITH " + _DISC + ", " + _FIT + " SELECT signal_id, idx, code FROM code")
def affine_codes(spark, d):
    s = _discounts(spark, d)
    return K.affine_codes(s, K.fit_grid(K.signal_levels(s))).select("signal_id", "idx", "code")


@query("WITH " + _SIG + " SELECT signal_id, idx, CAST(dense_rank() OVER (PARTITION BY signal_id ORDER BY value) - 1 AS BIGINT) AS code FROM s")
def indexed_codes(spark, d):
    s = _values(spark, d)
    return K.indexed_codes(s, K.level_index(K.signal_levels(s))).select("signal_id", "idx", "code")


@query("WITH " + _SIG + ", m AS (SELECT signal_id, CASE WHEN max(abs(value)) = 0 THEN 1.0 ELSE max(abs(value)) END AS scale FROM s GROUP BY signal_id) SELECT s.signal_id, idx, CAST(round_even(value / scale * 8388607.0, 0) AS BIGINT) AS code, scale FROM s JOIN m ON s.signal_id = m.signal_id")
def fixed_point_codes(spark, d):
    return K.fixed_point_codes(_values(spark, d)).select("signal_id", "idx", "code", "scale")


@query("WITH " + _DISC + ", " + _FIT + ", mm AS (SELECT signal_id, min(code) AS lo, max(code) AS hi FROM code GROUP BY signal_id) SELECT signal_id, CAST(greatest(2, CASE WHEN hi > 0 THEN length(bin(hi)) + 1 ELSE 2 END, CASE WHEN lo < 0 THEN length(bin(-lo - 1)) + 1 ELSE 2 END) AS INTEGER) AS bits FROM mm")
def bits_for_codes(spark, d):
    s = _discounts(spark, d)
    return K.affine_codes(s, K.fit_grid(K.signal_levels(s))).groupBy("signal_id").agg(K.bits_for_codes(F.min("code"), F.max("code")).alias("bits"))


@query("WITH " + _MIXED + ", " + _FIT + ", " + _CHOSEN + " SELECT signal_id, encoding, bits_per_sample, n_levels, n_samples FROM chosen")
def choose_encoding(spark, d):
    _, meta, _ = K.encode_signals(_mixed(spark, d))
    return meta.select("signal_id", "encoding", "bits_per_sample", "n_levels", "n_samples")


@query("WITH " + _MIXED + ", " + _FIT + ", " + _CHOSEN + " SELECT signal_id, encoding, bits_per_sample, n_samples FROM chosen")
def stored_signal_meta(spark, d):
    _, meta, _ = K.encode_signals(_mixed(spark, d))
    at = scratch_path(spark, "meta")
    signals_store.write_signal_meta(meta, at)
    schema = "signal_id bigint, encoding string, bits_per_sample int, grid_offset double, step double, scale double, n_levels bigint, n_samples bigint"
    return signals_store.read_signal_meta(spark, at, schema).select("signal_id", "encoding", "bits_per_sample", "n_samples")


@query("WITH " + _MIXED + " SELECT signal_id, idx, value FROM s")
def decode(spark, d):
    return K.decode(*K.encode_signals(_mixed(spark, d)))


@query("WITH " + _MIXED + ", b AS (SELECT signal_id, idx, CASE WHEN signal_id % 3 = 1 AND idx % 5 = 2 THEN value + 0.5 ELSE value END AS back FROM s WHERE signal_id % 3 <> 2 OR idx % 7 <> 3) SELECT s.signal_id, count(*) AS n_samples, count(b.idx) AS n_decoded, CASE WHEN count(*) = count(b.idx) THEN max(abs(value - back)) ELSE 'inf'::DOUBLE END AS max_abs_error, bool_and(b.idx IS NOT NULL AND value = back) AS exact FROM s LEFT JOIN b ON s.signal_id = b.signal_id AND s.idx = b.idx GROUP BY s.signal_id")
def roundtrip_report(spark, d):
    """Some decoded signals lack samples, and in some, samples are moved."""
    s = _mixed(spark, d)
    back = K.decode(*K.encode_signals(s)).where("signal_id % 3 <> 2 or idx % 7 <> 3")
    back = back.withColumn("value", F.when(F.expr("signal_id % 3 = 1 and idx % 5 = 2"), F.col("value") + 0.5).otherwise(F.col("value")))
    return K.roundtrip_report(s, back)


#: Level numbers in blocks of 256; the differences of order 0 to 4 within a block; the order with the least sum of magnitudes from the fifth sample on;
#: its differences folded; and the Rice parameter with the fewest bits.
_RESIDUAL = """c AS (SELECT signal_id, idx // 256 AS block, idx, CAST(dense_rank() OVER (PARTITION BY signal_id ORDER BY value) - 1 AS BIGINT) AS code FROM s),
d0 AS (SELECT *, row_number() OVER w - 1 AS pos, count(*) OVER (PARTITION BY signal_id, block) AS n, code AS r0, code - lag(code) OVER w AS r1 FROM c WINDOW w AS (PARTITION BY signal_id, block ORDER BY idx)),
d2 AS (SELECT *, r1 - lag(r1) OVER w AS r2 FROM d0 WINDOW w AS (PARTITION BY signal_id, block ORDER BY idx)),
d3 AS (SELECT *, r2 - lag(r2) OVER w AS r3 FROM d2 WINDOW w AS (PARTITION BY signal_id, block ORDER BY idx)),
d4 AS (SELECT *, r3 - lag(r3) OVER w AS r4 FROM d3 WINDOW w AS (PARTITION BY signal_id, block ORDER BY idx)),
r AS (SELECT signal_id, block, n, pos, unnest([{'p': 0, 'r': r0}, {'p': 1, 'r': r1}, {'p': 2, 'r': r2}, {'p': 3, 'r': r3}, {'p': 4, 'r': r4}]) AS x FROM d4),
sums AS (SELECT signal_id, block, x.p AS p, coalesce(sum(abs(x.r)) FILTER (WHERE pos >= 4), 0) AS total FROM r GROUP BY signal_id, block, x.p),
best AS (SELECT signal_id, block, arg_min(p, (total, p)) AS p FROM sums GROUP BY signal_id, block),
z AS (SELECT r.signal_id, r.block, r.n, best.p, CASE WHEN r.x.r < 0 THEN -2 * r.x.r - 1 ELSE 2 * r.x.r END AS z FROM r JOIN best ON r.signal_id = best.signal_id AND r.block = best.block AND r.x.p = best.p WHERE r.pos >= best.p),
cost AS (SELECT signal_id, block, n, p, k, count(*) * (k + 1) + sum(z >> k) AS bits FROM z, (SELECT unnest(range(26)) AS k) GROUP BY signal_id, block, n, p, k),
packed AS (SELECT signal_id, block, n, p, min({'b': bits, 'k': k}) AS m FROM cost GROUP BY signal_id, block, n, p)"""


def _level_numbers(spark, d):
    s = _values(spark, d)
    return K.indexed_codes(s, K.level_index(K.signal_levels(s))).select("signal_id", "idx", "code")


@query("WITH " + _SIG + ", " + _RESIDUAL + " SELECT signal_id, block, CAST(n AS INTEGER) AS n, CAST(p AS INTEGER) AS predictor, CAST(m.k AS INTEGER) AS rice, CAST(m.b AS BIGINT) AS bits FROM packed")
def residual_blocks(spark, d):
    return RC.residual_blocks(_level_numbers(spark, d), 256).select("signal_id", "block", "n", "predictor", "rice", "bits")


@query("WITH " + _SIG + " SELECT signal_id, idx, CAST(dense_rank() OVER (PARTITION BY signal_id ORDER BY value) - 1 AS BIGINT) AS code FROM s")
def stored_residuals(spark, d):
    """Level numbers written as predicted blocks and read again."""
    at = scratch_path(spark, "residuals")
    signals_store.write_residuals(_level_numbers(spark, d), at, 256)
    return signals_store.read_residuals(spark, at)


@query("WITH " + _SIG + ", " + _RESIDUAL + ", o AS (SELECT signal_id, sum(24 + 8 * p + CAST(ceil((m.b - (n - p) * m.k) / 8) AS BIGINT) + CAST(ceil((n - p) * m.k / 8) AS BIGINT)) AS bytes, sum(n) AS n_samples FROM packed GROUP BY signal_id), l AS (SELECT signal_id, count(DISTINCT value) AS n_levels FROM s GROUP BY signal_id) SELECT 'indexed' AS encoding, count(*) AS signals, CAST(sum(n_samples * 8) AS BIGINT) AS bytes_in, CAST(sum(bytes + 8 * n_levels) AS BIGINT) AS bytes_out, sum(n_samples * 8) / sum(bytes + 8 * n_levels) AS times FROM o JOIN l ON o.signal_id = l.signal_id")
def residual_report(spark, d):
    """Level numbers as predicted blocks, with their level tables."""
    levels = K.signal_levels(_values(spark, d))
    meta = levels.groupBy("signal_id").agg(F.count(F.lit(1)).alias("n_levels"), F.sum("samples").alias("n_samples"), F.lit("indexed").alias("encoding"))
    return RC.residual_report(meta, RC.residual_blocks(_level_numbers(spark, d), 256))


@query("WITH " + _MIXED + ", " + _FIT + ", " + _CHOSEN + ", o AS (SELECT *, CAST(n_samples * bits_per_sample / 8 + CASE WHEN encoding = 'indexed' THEN n_levels * 8 ELSE 0 END AS BIGINT) AS bytes FROM chosen) SELECT encoding, count(*) AS signals, CAST(sum(n_samples * 8) AS BIGINT) AS bytes_in, CAST(sum(bytes) AS BIGINT) AS bytes_out, sum(n_samples * 8) / sum(bytes) AS times FROM o GROUP BY encoding")
def compression_report(spark, d):
    return K.compression_report(K.encode_signals(_mixed(spark, d))[1])


@query()
def signal_xxh64(spark, d):
    """Compared with the hash library in the tests."""
    return K.signal_xxh64(_values(spark, d))


@query("WITH " + _DISC + ", " + _FIT + ", " + _CHOSEN + " SELECT signal_id, encoding, n_samples, CAST(round_even(1 / (1e-5 * (1 + signal_id % 3)), 0) AS INTEGER) AS sample_rate_hz FROM chosen")
def signal_meta(spark, d):
    s = _discounts(spark, d)
    timing = s.select("signal_id").distinct().select("signal_id", (F.lit(1e-5) * (1 + F.col("signal_id") % 3)).alias("wf_increment"), F.lit("2024-01-01").cast("timestamp_ntz").alias("wf_start_time"))
    return K.signal_meta(K.encode_signals(s)[1], K.signal_xxh64(s), timing).select("signal_id", "encoding", "n_samples", "sample_rate_hz")


@query("WITH " + _DISC + " SELECT signal_id, signal_id % 4 <> 0 AS ok FROM s GROUP BY signal_id")
def rebuild_signals(spark, d):
    """Every fourth signal is expected with another hash, and is refused."""
    s = _discounts(spark, d)
    expected = K.signal_xxh64(s).select("signal_id", F.when(F.col("signal_id") % 4 == 0, "0" * 16).otherwise(F.col("data_xxh64")).alias("data_xxh64"))
    return K.rebuild_signals(*K.encode_signals(s), expected)[1].select("signal_id", "ok")


@query(W("inv", "ledger") + "SELECT file_path, CASE WHEN lower(file_extension) = '.tdms' AND NOT compressed AND transfer_attempts = 0 THEN 'encoded' ELSE 'plain' END AS route, CASE WHEN lower(file_extension) <> '.tdms' THEN 'declined: extension' WHEN transfer_attempts = 1 THEN 'fallback_empty' WHEN compressed OR transfer_attempts = 2 THEN 'not_exact' END AS reason FROM ledger")
def route(spark, d):
    ledger = frame(spark, d, "ledger")
    wrong = F.lower("file_extension") != ".tdms"
    eligible = ledger.select("file_path", (~wrong).alias("eligible"), F.when(wrong, "extension").alias("decline_reason"))
    reports = ledger.where("transfer_attempts <> 1").select("file_path", (~F.col("compressed") & (F.col("transfer_attempts") == 0)).alias("exact"))
    return K.route(eligible, reports)


@query("WITH " + _DISC + " SELECT signal_id, true AS passed FROM s GROUP BY signal_id")
def audit_codec(spark, d):
    s = _discounts(spark, d)
    sample = table(spark, d, "lineitem").select(F.col("l_suppkey").cast("long").alias("signal_id")).distinct()
    return K.audit_codec(s, sample)[0].select("signal_id", "passed")


@query(W("ledger", "found_links") + ", c AS (SELECT l.*, f.file_hash, f.samples_hash, f.encoded_hash, f.sidecar_hash, f.rebuilt_hash FROM ledger l LEFT JOIN found_links f ON l.file_path = f.file_path WHERE l.compressed) SELECT file_path, CAST(5 AS BIGINT) AS links, CASE WHEN local_checksum IS DISTINCT FROM file_hash THEN 'file' WHEN data_checksum IS DISTINCT FROM samples_hash THEN 'samples' WHEN compressed_checksum IS DISTINCT FROM encoded_hash THEN 'encoded' WHEN sidecar_checksum IS DISTINCT FROM sidecar_hash THEN 'sidecar' WHEN remote_checksum IS DISTINCT FROM rebuilt_hash THEN 'rebuilt' ELSE 'intact' END AS first_broken FROM c")
def hash_chain(spark, d):
    return V.hash_chain(V.chain_links(frame(spark, d, "ledger"), frame(spark, d, "found_links")))


# --- G: state and streams ---------------------------------------------------------------------------------------------


@query(W("ledger") + f"SELECT {_CUT} AS last_scan_time, CAST(NULL AS TIMESTAMP) AS last_full_verify_time, count(*) AS total_files_tracked, CAST(sum(file_size_bytes) AS BIGINT) AS total_bytes_tracked FROM ledger")
def advance_cursor(spark, d):
    return L.advance_cursor(L.read_state(None, spark), frame(spark, d, "ledger"), datetime.fromisoformat(NOW), "settled", SETTLE).drop("last_db_sync_time")


def _event_files(spark, d):
    """Events as change events of one file per user: the size is the event type's length."""
    return table(spark, d, "events").select(F.concat(F.lit("f"), "user_id").alias("file_path"), F.length("event_type").cast("long").alias("file_size_bytes"), F.col("event_id").cast("long").alias("seq"))


def _as_stream(spark, df, name):
    at = scratch_path(spark, name)
    df.write.parquet(at + "/in")
    return spark.readStream.schema(df.schema).parquet(at + "/in"), at


@query("SELECT file_path, max_by(size, seq) AS file_size_bytes, max(seq) AS seq, count(*) FILTER (prev IS NULL OR prev <> size) AS changes, count(*) FILTER (prev = size) AS duplicates FROM (SELECT *, lag(size) OVER (PARTITION BY file_path ORDER BY seq) AS prev FROM (SELECT 'f' || user_id AS file_path, CAST(length(event_type) AS BIGINT) AS size, CAST(event_id AS BIGINT) AS seq FROM events)) GROUP BY file_path")
def stream_ledger(spark, d):
    """Two batches of events, in order of time, make the same ledger as all at once."""
    df = _event_files(spark, d)
    cut = df.agg(F.percentile_approx("seq", 0.5)).first()[0] or 0
    at = scratch_path(spark, "stream")
    for i, part in enumerate((df.where(F.col("seq") <= cut), df.where(F.col("seq") > cut))):
        part.write.parquet(f"{at}/in/part={i}")
        events = spark.readStream.schema(df.schema).option("recursiveFileLookup", "true").parquet(f"{at}/in")
        stream.stream_ledger(events, f"{at}/ledger", f"{at}/checkpoint").awaitTermination()
    return stream.read_stream_ledger(spark, f"{at}/ledger", 1)


@query(W("inv") + f"SELECT file_path, file_mtime <= {_CUT} AS settled FROM inv")
def settle_stream(spark, d):
    df = frame(spark, d, "inv").select("file_path", "file_size_bytes", "file_mtime")
    rows, at = _as_stream(spark, df, "settle")
    now = datetime.fromisoformat(NOW)
    stream.settle_stream(rows, at, at + "/checkpoint", lambda n: now, SETTLE).awaitTermination()
    settled = spark.read.schema(df.schema).option("recursiveFileLookup", "true").parquet(f"{at}/settled").withColumn("settled", F.lit(True))
    held = spark.read.schema(df.schema).option("recursiveFileLookup", "true").parquet(f"{at}/held").withColumn("settled", F.lit(False))
    return settled.unionByName(held).select("file_path", "settled")


@query(W("inv", "ledger") + f"SELECT coalesce(l.file_path, i.file_path) AS file_path, CASE WHEN i.change IS NULL OR i.change = 'unchanged' THEN l.file_size_bytes ELSE i.file_size_bytes END AS file_size_bytes, CASE WHEN i.change IS NULL OR i.change = 'unchanged' THEN l.transfer_status ELSE 'pending' END AS transfer_status FROM ledger l FULL JOIN ({_CHANGE}) i ON l.file_path = i.file_path")
def periodic_passes(spark, d):
    """Two rounds of the loop over listing snapshots: part of the files, then all of them; each round's changes go into the next version of the ledger."""
    inventory, at, now = frame(spark, d, "inv"), scratch_path(spark, "loop"), datetime.fromisoformat(NOW)
    ledger_store.write_ledger(frame(spark, d, "ledger"), f"{at}/ledger", 0)

    def run(batch, n):
        records = ledger_store.read_ledger(spark, f"{at}/ledger", n)
        found = C.detect_changes(batch, records)
        ledger_store.write_ledger(C.apply_changes(records, found, now), f"{at}/ledger", n + 1)

    for i, part in enumerate((inventory.where("file_size_bytes % 3 = 0"), inventory)):
        part.write.parquet(f"{at}/in/part={i}")
        snapshots = spark.readStream.schema(inventory.schema).option("recursiveFileLookup", "true").parquet(f"{at}/in")
        stream.start_stream(snapshots, run, f"{at}/checkpoint", None).awaitTermination()
    return ledger_store.read_ledger(spark, f"{at}/ledger").select("file_path", "file_size_bytes", "transfer_status")


@query(_FILE_BYTES)
def read_inventory(spark, d):
    """The archive by the data source in place of the listing by level."""
    root, _ = _as_files(spark, d)
    files = S.filter_extension(inventory_source.read_inventory(spark, root), [".txt"])
    return files.groupBy(paths.first_segment(F.col("file_path")).alias("top")).agg(F.sum("file_size_bytes").alias("bytes"))


@query("SELECT top, CAST(0 AS BIGINT) AS batch, 'verified' AS transfer_status, bytes FROM (" + _FILE_BYTES + ") UNION ALL SELECT top, CAST(1 AS BIGINT), 'pending', bytes FROM (" + _FILE_BYTES + ") WHERE top = (SELECT 'source=' || min(source) FROM documents)")
def streamed_passes(spark, d):
    """Passes fed by the stream of changes of an archive: all files, then one damaged folder, which alone is looked at again; without room for it at the target its records stay pending."""
    config, found = _pass_config(spark, d), []

    def run(batch, n):
        limited = replace(config, least_free_gb=0 if n == 0 else 1e9)
        result = P.run_pass(spark, limited, _later(), inventory=batch)
        rows = result.ledger if n == 0 else result.plan.select("file_path", F.col("file_size_bytes") - 1, "transfer_status").toDF("file_path", "file_size_bytes", "transfer_status")
        found.append(saved(_by_top(rows, F.lit(n).cast("long").alias("batch"), "transfer_status"), "streamed"))

    for n in range(2):
        if n:
            _damaged(spark, config.source, _first_top(spark, d))
        rows = inventory_source.stream_inventory(spark, config.source)
        stream.start_stream(rows, run, f"{config.ledger_path}-checkpoint", None).awaitTermination()
    return found[0].unionByName(found[1])


def _retried(spark, d):
    """A bucketed ledger, and a second version in which failed records are verified and those of one source are gone."""
    records, at = frame(spark, d, "ledger"), scratch_path(spark, "buckets")
    bucket_store.write_changes(spark, at, records)
    failed = records.where("transfer_status = 'failed'").withColumn("transfer_status", F.lit("verified"))
    bucket_store.write_changes(spark, at, failed, 0, records.where("file_path like 'src1/%' and transfer_status <> 'failed'").select("file_path"))
    return at


_RETRIED = W("ledger") + ", l AS (SELECT file_path, file_size_bytes, CASE WHEN transfer_status = 'failed' THEN 'verified' ELSE transfer_status END AS transfer_status FROM ledger WHERE file_path NOT LIKE 'src1/%' OR transfer_status = 'failed')"


@query(_RETRIED + " SELECT file_path, file_size_bytes, transfer_status FROM l")
def bucketed_ledger(spark, d):
    return bucket_store.read(spark, _retried(spark, d)).select("file_path", "file_size_bytes", "transfer_status")


@query(_RETRIED + " SELECT s AS transfer_status, count(l.file_path) AS files, CAST((SELECT sum(file_size_bytes) FROM l) AS BIGINT) AS all_bytes FROM (SELECT unnest([" + ", ".join(f"'{s}'" for s in STATUSES) + "]) AS s) LEFT JOIN l ON s = transfer_status GROUP BY s")
def incremental_totals(spark, d):
    """Files by status and all bytes, from the sums of buckets that the manifest keeps."""
    found = bucket_store.totals(spark, _retried(spark, d))
    return spark.createDataFrame([(s, n, found["bytes"]) for s, n in found["status"].items()], "transfer_status string, files long, all_bytes long")
