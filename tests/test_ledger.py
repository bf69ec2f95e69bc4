from datetime import datetime

from fileledger.operators import changes as C
from fileledger.operators import ledger as L
from fileledger.operators import outcomes as O
from fileledger.operators import reports as R
from fileledger.operators import scan as S
from fileledger.operators import verify as V
from fileledger.schema import with_defaults

NOW = datetime(2024, 1, 2, 12)


def ledger(spark, rows, columns="file_path string, transfer_status string, file_size_bytes bigint"):
    return with_defaults(spark.createDataFrame(rows, columns))


def tree(spark, paths):
    return S.file_info(spark.createDataFrame([(p, 1, datetime(2024, 1, 1)) for p in paths], "file_path string, file_size_bytes bigint, file_mtime timestamp_ntz"))


RUNS = ["Run45/TDMS/a.tdms", "Run45/nested/deep/b.tdms", "Run46/TDMS/c.tdms", "Run12/TDMS/old1.tdms", "Run12/TDMS/old2.tdms", "00 - with spaces/x.tdms", "loose.xlsx"]


def names(spark, *n):
    return spark.createDataFrame([(x,) for x in n], "name string")


def test_ignore_and_root(spark):
    inv = tree(spark, RUNS)
    count = lambda **o: S.selected(S.scan_all(inv, NOW, **o)).count()
    assert count() == 7 and count(ignore=names(spark, "Run12")) == 5 and count(ignore=names(spark, "Run12", "00 - with spaces")) == 4
    assert count(ignore=names(spark, "TDMS")) == 7 and count(skip_root=True) == 6 and count(extensions=[".TDMS"]) == 6


def test_scan_boundaries_and_first_reason(spark):
    rows = [("d/a.txt", datetime(2024, 1, 2, 12)), ("d/b.tdms", datetime(2024, 1, 2, 11)), ("d/c.tdms", datetime(2024, 1, 2, 11, 0, 1)), ("d/e.tdms", datetime(2024, 1, 1)), ("d/f.tdms", datetime(2024, 1, 3))]
    inv = S.file_info(spark.createDataFrame(rows, "file_path string, file_mtime timestamp_ntz"))
    got = {r.file_path: r.skip_reason for r in S.scan_since(inv, datetime(2024, 1, 1), NOW, 60, [".tdms"]).collect()}
    assert got == {"d/a.txt": "extension", "d/b.tdms": None, "d/c.tdms": "recent", "d/e.tdms": "not_modified", "d/f.tdms": "recent"}
    assert {r.file_path for r in S.selected(S.scan_all(inv, NOW, -5)).collect()} == {"d/a.txt", "d/b.tdms", "d/c.tdms", "d/e.tdms"}


def test_status_sets(spark):
    led = ledger(spark, [("a", "pending", 1), ("b", "failed", 1), ("c", "checksum_mismatch", 1), ("d", "verified", 1), ("e", "transferred", 1)])
    assert L.pending_transfers(led).count() == 3 and L.by_status(led, "verified").count() == 1
    assert dict(L.count_by_status(led).collect()) == {"pending": 1, "failed": 1, "checksum_mismatch": 1, "verified": 1, "transferred": 1, "transferring": 0}
    assert set(dict(L.count_by_status(led.limit(0)).collect()).values()) == {0}


def test_upsert_delete_totals(spark):
    led = ledger(spark, [("a", "pending", 100), ("b", "pending", 200), ("c", "pending", None)])
    up = L.upsert(led, with_defaults(spark.createDataFrame([("a", 2000)], "file_path string, file_size_bytes bigint")))
    assert up.count() == 3 and L.get_file(up, "a").first().file_size_bytes == 2000
    assert tuple(L.ledger_totals(led).first()) == (3, 300) and tuple(L.ledger_totals(led.limit(0)).first()) == (0, 0)
    rest, gone = L.delete_files(led, spark.createDataFrame([("a",), ("zz",)], "file_path string"))
    assert rest.count() == 2 and [r.file_path for r in gone.collect()] == ["a"]


def test_state(spark):
    led = ledger(spark, [("a", "pending", 100)])
    state = L.read_state(None, spark)
    assert state.first().last_scan_time is None and L.read_state(state.limit(0)).count() == 1
    assert L.advance_cursor(state, led, NOW, "settled", 30).first().last_scan_time == datetime(2024, 1, 2, 11, 30)
    assert L.advance_cursor(state, led, NOW, "start", 30).first().last_scan_time == NOW
    out = L.update_state(state, led, last_full_verify_time=NOW, nonsense=1).first()
    assert out.last_full_verify_time == NOW and out.total_bytes_tracked == 100


def test_changes(spark):
    led = ledger(spark, [("a", "verified", 1, "h"), ("b", "verified", 2, "h"), ("c", "pending", 1, None), ("e", "verified", 1, "")], "file_path string, transfer_status string, file_size_bytes bigint, local_checksum string")
    found = C.detect_changes(tree(spark, ["a", "b", "c", "d", "e"]), led)
    assert {r.file_path: r.change for r in found.collect()} == {"a": "unchanged", "b": "changed", "c": "unhashed", "d": "new", "e": "unhashed"}
    assert {r.file_path for r in C.to_hash(found).collect()} == {"b", "c", "d", "e"}
    assert C.detect_changes(tree(spark, ["a"]), led.limit(0)).first().change == "new"


def test_outcomes_and_sticky_error(spark):
    led = ledger(spark, [("a", "failed", 1, "old", True), ("b", "pending", 1, None, False), ("c", "pending", 1, None, False)], "file_path string, transfer_status string, file_size_bytes bigint, last_error string, compressed boolean")
    rows = [("a", 1, True, None, "s1", "s1", None), ("b", 1, False, "reset", None, None, None), ("b", 2, True, None, "s2", "other", None), ("c", 1, True, None, "s3", None, "timed out")]
    tries = spark.createDataFrame(rows, "file_path string, attempt int, success boolean, error string, sent_checksum string, remote_checksum string, remote_error string")
    got = {r.file_path: r for r in O.current_errors(O.apply_outcomes(led, tries, NOW)).collect()}
    assert got["a"].transfer_status == "verified" and got["a"].last_error == "old" and got["a"].current_error is None and got["a"].compressed is False
    assert got["b"].transfer_status == "checksum_mismatch" and got["b"].transfer_attempts == 2 and got["b"].failed_checksum_count == 1 and got["b"].local_checksum == "s2"
    assert got["c"].transfer_status == "failed" and "timed out" in got["c"].current_error


def test_streaks(spark):
    text = "FFSFFFSF"
    df = spark.createDataFrame([(1, i, c == "S", "reset" if c == "F" else None) for i, c in enumerate(text)] + [(2, 0, False, "disk full"), (2, 1, False, "reset")], "pass_id int, seq int, success boolean, error string")
    got = [r.streak for r in O.conn_streaks(df).where("pass_id = 1").orderBy("seq").collect()]
    assert got == [1, 2, 0, 1, 2, 3, 0, 1]
    assert [tuple(r) for r in O.conn_streak_abort_point(df, 3).collect()] == [(1, 5, 3)]


def test_decode_halt(spark):
    rows = [(1, i, s == "S", s == "D") for i, s in enumerate("DDxDSDxDxD")]
    df = spark.createDataFrame(rows, "pass_id int, seq int, success boolean, decode_failure boolean")
    assert [tuple(r) for r in O.decode_halt_point(df, 3).orderBy("seq").collect()] == [(1, 3, 3)]


def test_spread_sample(spark):
    df = spark.createDataFrame([(f"f{i:04d}", i) for i in range(1003)], "file_path string, file_size_bytes bigint").repartition(5)
    got = sorted(r.file_path for r in O.spread_sample(df, 10, 100).collect())
    files = [f"f{i:04d}" for i in range(100, 1003)]
    assert got == files[:: len(files) // 10][:10]
    assert O.spread_sample(df, 10, 10_000).count() == 0 and O.spread_sample(df.limit(3), 10).count() == 3


def test_first_bad_check_decides(spark):
    columns = "file_path string, file_name string, local_checksum string, remote_checksum string, compressed_checksum string, sidecar_checksum string, compressed boolean, remote_tree string"
    led = ledger(spark, [("a.tdms", "a.tdms", "l", "r", "c", "s", True, "uncompressed"), ("b.tdms", "b.tdms", "l", None, None, None, False, "compressed"), ("m", "m", "l", None, None, None, False, None), ("d", "d", "old", None, None, None, False, None)], columns)
    local = spark.createDataFrame([("a.tdms", "l"), ("b.tdms", "l"), ("d", "new")], "file_path string, hash string")
    target = spark.createDataFrame([("/u/a.tdms", "r", None), ("/c/a.flac", "bad", None), ("/c/a.json", None, "io"), ("/c/b.tdms", "l", None)], "artifact string, hash string, error string")
    v = V.verify_ledger(led, local, target, "/u", "/c")
    got = {r.file_path: (r.verdict, r.label) for r in v.collect()}
    assert got == {"a.tdms": ("remote_mismatch", "encoded"), "b.tdms": ("ok", None), "m": ("local_missing", None), "d": ("local_changed", None)}
    after = {r.file_path: r for r in V.apply_verdicts(led, v, NOW).collect()}
    assert after["d"].local_checksum == "new" and after["a.tdms"].failed_checksum_count == 1 and after["b.tdms"].last_verified_remote == NOW and after["b.tdms"].transfer_status == "pending"
    assert [tuple(r) for r in V.quarantine_plan(v, NOW).collect()] == [("/c/a.flac", "/c/_mismatched/a.flac.20240102T120000")]
    s = R.verify_summary(v).first()
    assert (s.files_checked, s.files_ok, s.mismatches, s.missing, s.severity, s.names) == (4, 1, 2, 1, "error", ["a.tdms"])


def test_recent_summary(spark):
    led = ledger(spark, [(f"f{i}", "failed" if i < 7 else "verified", f"f{i}", NOW) for i in range(9)], "file_path string, transfer_status string, file_name string, file_mtime timestamp_ntz")
    assert R.recent_summary(led, NOW).first().summary == "In 6 hours 9 files were modified; to look at: 7" + "".join(f"\n* f{i}" for i in range(5)) + "\n(2 others)"
    assert R.recent_summary(led.where("transfer_status = 'verified'"), NOW).first().summary == "In 6 hours 2 files were modified; verified: 2"
    assert R.recent_summary(led.limit(0), NOW).first().summary == ""


def test_capacity_and_audit(spark):
    plan = spark.createDataFrame([("a", 1 << 40), ("b", 1)], "target string, file_size_bytes bigint")
    free = spark.createDataFrame([("a", 200 << 30), ("b", 50 << 30), ("c", 200 << 30)], "target string, free_bytes bigint")
    assert {r.target: r.reason for r in C.capacity_check(plan, free).collect()} == {"a": "does_not_fit", "b": "below_floor", "c": None}
    assert {tuple(r) for r in S.audit_names(names(spark, "Run12", "a/b", "c\\d", "none"), tree(spark, RUNS)).collect()} == {("a/b", "is a path"), ("c\\d", "is a path"), ("none", "not in the archive")}
