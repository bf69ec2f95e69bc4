"""Passes over real folders, stores and streams."""

import json
import os
import subprocess
import sys
import time
from datetime import datetime, timedelta

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fileledger.plans.passes import PassConfig, PassResult, remove_superseded, run_pass, run_verification
from fileledger.schema import with_defaults
from fileledger.sources import copying, encoded, ledger_store, listing, signals_store
from fileledger.streaming import stream


def put(root, path, data, at):
    os.makedirs(os.path.dirname(f"{root}/{path}"), exist_ok=True)
    with open(f"{root}/{path}", "wb") as f:
        f.write(data)
    os.utime(f"{root}/{path}", (at.timestamp(), at.timestamp()))


@pytest.fixture
def config(tmp_path):
    for x in ("src", "dst", "led", "work"):
        os.makedirs(tmp_path / x)
    return PassConfig(str(tmp_path / "src"), str(tmp_path / "dst"), str(tmp_path / "led"), str(tmp_path / "work"), extensions=[".tdms"], ignore=["skip"], settle_minutes=10, parallelism=2, replica=str(tmp_path / "rep"), least_free_gb=0)


def test_listing(spark, tmp_path):
    t = datetime(2024, 1, 1)
    for p in ("a/x.tdms", "a/b/c/.hidden", "a/_u", "e", "skip/y"):
        put(tmp_path, p, b"12" if p != "e" else b"", t)
    os.makedirs(tmp_path / "empty")
    got = {r.file_path: r.file_size_bytes for r in listing.list_files(spark, str(tmp_path), ["skip"]).collect()}
    assert got == {"a/x.tdms": 2, "a/b/c/.hidden": 2, "a/_u": 2, "e": 0}
    with pytest.raises(FileNotFoundError):
        listing.list_files(spark, str(tmp_path / "none"))
    assert {r.length for r in listing.read_content(spark, str(tmp_path), "*.tdms").collect()} == {2}


def test_ignore_lists(spark, tmp_path):
    (tmp_path / "l").write_text("# c\n\n one name \ntwo\n")
    read = lambda **kw: sorted(r.name for r in listing.read_ignore_list(spark, **kw).collect())
    assert read(file=str(tmp_path / "l"), names="x") == ["one name", "two"] and read(names="a, b ,c d") == ["a", "b", "c d"] and read() == [] and read(names="") == []


def test_two_passes_and_a_verification(spark, config):
    now = datetime(2024, 5, 1, 12)
    put(config.source, "run/a.tdms", b"aaaa", now - timedelta(hours=1))
    put(config.source, "run/late.tdms", b"ll", now - timedelta(minutes=1))
    put(config.source, "skip/b.tdms", b"b", now - timedelta(hours=1))
    put(config.source, "run/c.txt", b"c", now - timedelta(hours=1))
    dry = run_pass(spark, config, now, dry_run=True)
    assert dry.plan.count() == 1 and ledger_store.current_version(spark, config.ledger_path) is None
    first = run_pass(spark, config, now)
    assert [r.file_path for r in first.plan.collect()] == ["run/a.tdms"]
    assert open(f"{config.target}/run/a.tdms", "rb").read() == b"aaaa"
    s = first.stats.first()
    assert (s.files_scanned, s.skipped_recent, s.skipped_extension, s.files_transferred, s.bytes_transferred) == (1, 1, 1, 1, 4)
    # the file skipped as too recent is found by the next pass
    second = run_pass(spark, config, now + timedelta(minutes=15))
    assert {r.file_path for r in second.plan.where("needs_transfer").collect()} == {"run/late.tdms"}
    led = {r.file_path: r for r in ledger_store.read_ledger(spark, config.ledger_path).collect()}
    assert {p: r.transfer_status for p, r in led.items()} == {"run/a.tdms": "verified", "run/late.tdms": "verified"}
    assert ledger_store.read_ledger(spark, config.replica).count() == 2
    # a rewrite of equal size is seen by a verification, a damaged copy is moved aside and sent again
    put(config.source, "run/a.tdms", b"AAAA", now - timedelta(hours=1))
    with open(f"{config.target}/run/late.tdms", "wb") as f:
        f.write(b"xx")
    verdicts, summary = run_verification(spark, config, now + timedelta(minutes=20))
    assert {r.file_path: r.verdict for r in verdicts.collect()} == {"run/a.tdms": "local_changed", "run/late.tdms": "remote_mismatch"}
    assert summary.first().mismatches == 2 and os.listdir(f"{config.target}/_mismatched/run") == ["late.tdms.20240501T122000"]
    third = run_pass(spark, config, now + timedelta(minutes=30))
    assert {r.file_path for r in third.plan.where("needs_transfer").collect()} == {"run/a.tdms", "run/late.tdms"}
    assert open(f"{config.target}/run/a.tdms", "rb").read() == b"AAAA" and open(f"{config.target}/run/late.tdms", "rb").read() == b"ll"
    assert third.state.first().last_full_verify_time == now + timedelta(minutes=20)
    again = run_pass(spark, config, now + timedelta(hours=2), full=True)
    assert again.plan.count() == 2 and again.plan.where("needs_transfer").count() == 0


def many(config, n, at):
    for i in range(n):
        put(config.source, f"run/f{i:03}.tdms", b"x%d" % i, at)


def status_counts(spark, config):
    return {r.transfer_status: r["count"] for r in ledger_store.read_ledger(spark, config.ledger_path).groupBy("transfer_status").count().collect()}


def test_a_pass_stops_at_the_fifth_mismatch(spark, config, monkeypatch):
    now = datetime(2024, 5, 1, 12)
    many(config, 60, now - timedelta(hours=1))
    real = copying.copy_files

    def damaged(plan, source, target, parallelism=8, attempt=1):
        out = real(plan, source, target, parallelism, attempt)
        return out.withColumn("remote_checksum", F.when(F.substring("file_path", -6, 1).isin("1", "5"), "0" * 16).otherwise(F.col("remote_checksum")))

    monkeypatch.setattr(copying, "copy_files", damaged)
    got = run_pass(spark, config, now)
    assert got.stopped.startswith("5 copies differ")
    # waves of 16 and 32 files: the fifth mismatch is in the second
    assert status_counts(spark, config) == {"verified": 38, "checksum_mismatch": 10, "pending": 12}
    monkeypatch.setattr(copying, "copy_files", real)
    again = run_pass(spark, config, now + timedelta(hours=1))
    assert again.stopped is None and status_counts(spark, config) == {"verified": 60}


def test_a_server_that_refuses_is_asked_for_one_wave(spark, config, monkeypatch):
    now = datetime(2024, 5, 1, 12)
    many(config, 60, now - timedelta(hours=1))
    real = copying.copy_files
    asked = []

    def refusing(plan, source, target, parallelism=8, attempt=1):
        asked.append(attempt)
        out = real(plan, source, target, parallelism, attempt)
        return out.withColumn("success", F.lit(False)).withColumn("raised", F.lit(True)).withColumn("error", F.lit("Connection reset by peer"))

    monkeypatch.setattr(copying, "copy_files", refusing)
    got = run_pass(spark, config, now)
    assert got.stopped.startswith("12 failures") and got.outcomes.count() == 16 and asked.count(2) == 0
    assert status_counts(spark, config) == {"failed": 16, "pending": 44}


def test_single_failures_are_tried_again(spark, config, monkeypatch):
    now = datetime(2024, 5, 1, 12)
    many(config, 30, now - timedelta(hours=1))
    real = copying.copy_files

    def shaky(plan, source, target, parallelism=8, attempt=1):
        out = real(plan, source, target, parallelism, attempt)
        fails = F.substring("file_path", -6, 1).isin("3", "4") & F.lit(attempt == 1)
        return out.withColumn("success", ~fails & F.col("success")).withColumn("error", F.when(fails, "timed out").otherwise(F.col("error")))

    monkeypatch.setattr(copying, "copy_files", shaky)
    got = run_pass(spark, config, now)
    assert got.stopped is None and status_counts(spark, config) == {"verified": 30} and got.outcomes.where("attempt = 2").count() == 6


def test_a_plan_without_room_is_refused(spark, config):
    now = datetime(2024, 5, 1, 12)
    many(config, 3, now - timedelta(hours=1))
    config.least_free_gb = 1e9
    got = run_pass(spark, config, now)
    r = got.refused.first()
    assert r.reason == "below_floor" and r.planned_bytes == 6 and got.plan.count() == 3
    assert ledger_store.current_version(spark, config.ledger_path) is None and os.listdir(config.target) == []


def test_encoded_route(spark, config, tmp_path, monkeypatch):
    now = datetime(2024, 5, 1, 12)
    values = {"run/grid.tdms": [0.5 + 0.25 * (i * 7 % 40) for i in range(900)], "run/levels.tdms": [((i * 31) % 50) ** 0.5 for i in range(300)], "run/minus.tdms": [0.0, -0.0, 1.0]}
    for name in [*values, "run/none.tdms", "run/grid.tdms_index"]:
        put(config.source, name, b"container of " + name.encode(), now - timedelta(hours=1))
    timing = {"wf_increment": ("np", "float64", "2e-05"), "wf_start_time": ("dt64", None, "2024-01-01")}
    spark.createDataFrame([(f, "g", "c", timing) for f in values], "file_path string, group_name string, channel_name string, properties map<string, struct<t: string, dt: string, v: string>>").write.parquet(str(tmp_path / "ch"))
    spark.createDataFrame([(f, i, x) for f, xs in values.items() for i, x in enumerate(xs)], "file_path string, idx long, value double").write.parquet(str(tmp_path / "sig"))
    config.extensions, config.compression, config.compressed_target = [".tdms", ".tdms_index"], True, str(tmp_path / "packed")
    config.signals, config.channels, config.encode_least_bytes = str(tmp_path / "sig"), str(tmp_path / "ch"), 1
    got = run_pass(spark, config, now)
    led = {r.file_path: r for r in got.ledger.collect()}
    assert {p: (r.transfer_status, r.compressed) for p, r in led.items()} == {"run/grid.tdms": ("verified", True), "run/levels.tdms": ("verified", True), "run/minus.tdms": ("verified", False), "run/none.tdms": ("verified", False), "run/grid.tdms_index": ("verified", False)}
    for name in ("run/grid.tdms", "run/levels.tdms"):
        data = np.array(values[name], "<f8").tobytes()
        assert open(f"{config.target}/{name}", "rb").read() == data
        assert led[name].data_checksum == led[name].remote_checksum == xxhash.xxh64_hexdigest(data) and 0 < led[name].compressed_bytes < len(data) + 300
    assert open(f"{config.target}/run/minus.tdms", "rb").read() == b"container of run/minus.tdms"
    assert got.outcomes.count() == 3 and got.encoded.count() == 2
    verdicts, _ = run_verification(spark, config, now + timedelta(minutes=5))
    assert {r.verdict for r in verdicts.collect()} == {"ok"}
    # a damaged encoded file is found, and the file is sent in codes again
    with open(f"{config.compressed_target}/run/levels.flac", "ab") as f:
        f.write(b"x")
    verdicts, _ = run_verification(spark, config, now + timedelta(minutes=6))
    assert {r.file_path: r.label for r in verdicts.where("verdict = 'remote_mismatch'").collect()} == {"run/levels.tdms": "encoded"}
    again = run_pass(spark, config, now + timedelta(minutes=7))
    assert [r.file_path for r in again.encoded.collect()] == ["run/levels.tdms"] and status_counts(spark, config) == {"verified": 5}
    # rebuilding that fails leaves nothing at the target
    os.remove(f"{config.target}/run/grid.tdms")
    how = json.load(open(f"{config.compressed_target}/run/grid.json"))
    (tmp_path / "bad.json").write_text(json.dumps(how | {"data_xxh64": "0" * 16}))
    with pytest.raises(ValueError):
        encoded.rebuild_file(f"{config.compressed_target}/run/grid.flac", str(tmp_path / "bad.json"), f"{config.target}/run/grid.tdms")
    assert sorted(os.listdir(f"{config.target}/run")) == ["levels.tdms", "minus.tdms", "none.tdms"]


def test_rebuilding_that_keeps_failing_halts_the_encoded_route(spark, config, tmp_path, monkeypatch):
    now = datetime(2024, 5, 1, 12)
    many(config, 30, now - timedelta(hours=1))
    names = [f"run/f{i:03}.tdms" for i in range(30)]
    timing = {"wf_increment": ("np", "float64", "2e-05"), "wf_start_time": ("dt64", None, "2024-01-01")}
    spark.createDataFrame([(f, "g", "c", timing) for f in names], "file_path string, group_name string, channel_name string, properties map<string, struct<t: string, dt: string, v: string>>").write.parquet(str(tmp_path / "ch"))
    spark.createDataFrame([(f, i, float(i)) for f in names for i in range(3)], "file_path string, idx long, value double").write.parquet(str(tmp_path / "sig"))
    config.compression, config.compressed_target, config.signals, config.channels, config.encode_least_bytes = True, str(tmp_path / "packed"), str(tmp_path / "sig"), str(tmp_path / "ch"), 1
    os.makedirs(config.target, exist_ok=True)
    with open(f"{config.target}/run", "w") as f:  # a file where the folder of rebuilt files should be
        f.write("x")
    got = run_pass(spark, config, now)
    assert got.stopped.startswith("5 rebuilt files") and got.encoded.count() == 16 and got.outcomes.count() == 0
    assert status_counts(spark, config) == {"failed": 16, "pending": 14}


def test_copy_failures(spark, tmp_path):
    put(tmp_path / "s", "ok", b"1", datetime(2024, 1, 1))
    plan = spark.createDataFrame([("ok",), ("gone",)], "file_path string")
    got = {r.file_path: r for r in copying.copy_files(plan, str(tmp_path / "s"), str(tmp_path / "t"), 2).collect()}
    assert got["ok"].success and got["ok"].sent_checksum == got["ok"].remote_checksum and got["ok"].bytes_transferred == 1
    assert not got["gone"].success and got["gone"].raised and os.listdir(tmp_path / "t") == ["ok"]


def test_ledger_versions_and_documents(spark, tmp_path):
    at = str(tmp_path / "l")
    assert ledger_store.read_ledger(spark, at).count() == 0
    df = with_defaults(spark.createDataFrame([("a", "x")], "file_path string, unknown_key string"))
    assert ledger_store.write_ledger(df, at) == 0 and ledger_store.write_ledger(df.union(df), at) == 1
    assert ledger_store.read_ledger(spark, at).count() == 2 and ledger_store.read_ledger(spark, at, 0).count() == 1
    doc = {"files": {"1": {"file_path": "a", "file_mtime": "2024-01-01T10:00:00.5", "zzz": 1}, "2": {"file_path": "b", "transfer_status": "failed"}}, "state": {"1": {"last_scan_time": "2024-01-01T00:00:00", "total_files_tracked": 2}}}
    (tmp_path / "d.json").write_text(json.dumps(doc, indent=1))
    files, state = ledger_store.read_document_store(spark, str(tmp_path / "d.json"))
    got = {r.file_path: r for r in files.collect()}
    assert got["a"].file_mtime == datetime(2024, 1, 1, 10, 0, 0, 500_000) and got["a"].transfer_status == "pending" and got["b"].transfer_status == "failed" and got["a"].last_verified_remote is None
    assert state.first().total_files_tracked == 2


def test_a_writer_that_stops_leaves_the_ledger_as_it_was(spark, tmp_path, monkeypatch):
    at = str(tmp_path / "l")
    df = with_defaults(spark.createDataFrame([("a",)], "file_path string"))
    assert ledger_store.write_ledger(df, at) == 0
    real = ledger_store.place

    class Stopped(Exception):
        pass

    def stop_at_the_mark(spark, path):
        fs, p = real(spark, path)

        class Fs:
            def __getattr__(self, name):
                if name == "create":
                    raise Stopped
                return getattr(fs, name)

        return Fs(), p

    monkeypatch.setattr(ledger_store, "place", stop_at_the_mark)
    with pytest.raises(Stopped):
        ledger_store.write_ledger(df.union(df).union(df), at)
    monkeypatch.setattr(ledger_store, "place", real)
    assert ledger_store.current_version(spark, at) == 0 and ledger_store.read_ledger(spark, at).count() == 1
    assert ledger_store.write_ledger(df.union(df), at) == 1 and ledger_store.read_ledger(spark, at).count() == 2


def test_fold_events_by_batches(spark):
    rows = [("a", 1, 1), ("a", 1, 2), ("a", 2, 3), ("b", 5, 4), ("a", 2, 5), ("b", 6, 6)]
    df = spark.createDataFrame(rows, "file_path string, file_size_bytes long, seq long")
    whole = {tuple(r) for r in stream.fold_events(None, df).collect()}
    state = stream.fold_events(stream.fold_events(None, df.where("seq <= 3")), df.where("seq > 2"))
    assert {tuple(r) for r in state.select("file_path", "file_size_bytes", "seq", "changes", "duplicates").collect()} == whole == {("a", 2, 5, 2, 2), ("b", 6, 6, 2, 0)}


def test_stream_ledger_rewrites_touched_buckets_and_keeps_few(spark, tmp_path):
    schema = "file_path string, file_size_bytes long, seq long"
    every = [(f"f{i}", i, i) for i in range(40)]
    batches = [every, [("f1", 5, 100), ("f1", 5, 101)], [("f1", 6, 102)], [("f2", 9, 103)], [("f1", 6, 104)], [("f1", 7, 105)]]
    at = f"file://{tmp_path}/ledger"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream.stream_ledger(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), at, str(tmp_path / "cp"), buckets=8, keep=2).awaitTermination()
    whole = {tuple(r) for r in stream.fold_events(None, spark.createDataFrame([r for rows in batches for r in rows], schema)).select("file_path", "file_size_bytes", "seq", "changes", "duplicates").collect()}
    got = stream.read_stream_ledger(spark, at).select("file_path", "file_size_bytes", "seq", "changes", "duplicates")
    assert {tuple(r) for r in got.collect()} == whole
    versions = stream._versions(spark, at)
    assert len(versions) == 8 and all(len(v) <= 2 for v in versions.values()) and sum(map(len, versions.values())) <= 10
    assert stream.read_stream_ledger(spark, f"file://{tmp_path}/none").count() == 0


def test_held_rows_come_later(spark):
    now = datetime(2024, 1, 1, 12)
    df = spark.createDataFrame([("a", now - timedelta(hours=1)), ("b", now), ("c", now - timedelta(minutes=10))], "file_path string, file_mtime timestamp_ntz")
    ready, held = stream.split_settled(None, df, now, 10)
    assert {r.file_path for r in ready.collect()} == {"a", "c"}
    ready, held = stream.split_settled(held, df.limit(0), now + timedelta(minutes=10), 10)
    assert {r.file_path for r in ready.collect()} == {"b"} and held.count() == 0


def test_periodic_stream(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "file_path string, n long")
    df.write.parquet(str(tmp_path / "in"))
    seen = []
    stream.start_stream(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), lambda b, i: seen.append(b.count()), str(tmp_path / "cp"), None).awaitTermination()
    assert seen == [1]


def test_codes_on_disk(spark, tmp_path):
    codes = spark.createDataFrame([("a", 0, 5), ("b", 0, 1 << 20)], "signal_id string, idx long, code long")
    meta = spark.createDataFrame([("a", 16), ("b", 24)], "signal_id string, bits_per_sample int")
    signals_store.write_codes(codes, meta, str(tmp_path / "c"))
    assert {tuple(r) for r in signals_store.read_codes(spark, str(tmp_path / "c")).collect()} == {("a", 0, 5), ("b", 0, 1 << 20)}


def test_scratch_tables_go_with_the_process(tmp_path):
    code = "import os, sys; from fileledger.session import local_session; from fileledger.sources.scratch import saved; s = local_session(1); saved(s.range(3), 't').count(); print('MADE', len([x for x in os.listdir(sys.argv[1] + '/shared') if x.startswith('fileledger-')]))"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if not k.startswith(("PYSPARK_GATEWAY", "SPARK_"))} | {"FILELEDGER_SCRATCH": str(tmp_path), "PYTHONPATH": root}
    out = subprocess.run([sys.executable, "-c", code, str(tmp_path)], env=env, cwd=root, capture_output=True, text=True, timeout=300)
    assert "MADE 1" in out.stdout, out.stderr[-2000:]
    for _ in range(100):
        if not [x for x in os.listdir(tmp_path / "shared") if x.startswith("fileledger-")]:
            return
        time.sleep(0.2)
    raise AssertionError("the folder is still there")


@pytest.mark.parametrize("detect", ["size_mtime", "hash"])
def test_three_full_passes_after_an_edit_of_equal_size(spark, config, detect):
    config.detect = detect
    now = datetime(2024, 5, 1, 12)
    put(config.source, "run/a.tdms", b"aaaa", now - timedelta(hours=3))
    put(config.source, "run/b.tdms", b"bbbb", now - timedelta(hours=3))
    run_pass(spark, config, now)
    put(config.source, "run/a.tdms", b"AAAA", now - timedelta(hours=2))
    sent, found = [], []
    for i in range(1, 4):
        got = run_pass(spark, config, now + timedelta(hours=i), full=True)
        sent.append(sorted(r.file_path for r in got.plan.where("needs_transfer").collect()))
        found.append({r.file_path: r.transfer_status for r in ledger_store.read_ledger(spark, config.ledger_path).collect()})
    assert sent == [["run/a.tdms"], [], []] and found == [{"run/a.tdms": "verified", "run/b.tdms": "verified"}] * 3
    assert open(f"{config.target}/run/a.tdms", "rb").read() == b"AAAA"
    times = {r.file_path: r.file_mtime for r in ledger_store.read_ledger(spark, config.ledger_path).collect()}
    assert times["run/a.tdms"] == (now - timedelta(hours=2) if detect == "size_mtime" else now - timedelta(hours=3))
    # a touched file with the same content is not sent
    put(config.source, "run/b.tdms", b"bbbb", now - timedelta(hours=1))
    for i in (5, 6):
        got = run_pass(spark, config, now + timedelta(hours=i), full=True)
        assert got.plan.where("needs_transfer").count() == 0 and status_counts(spark, config) == {"verified": 2}


def test_unknown_detection_is_refused_at_the_start(spark, config):
    config.detect = "sha"
    with pytest.raises(ValueError, match="sha"):
        run_pass(spark, config, datetime(2024, 5, 1))
    assert os.listdir(config.work) == []


def test_work_folder_holds_one_pass(spark, config):
    now = datetime(2024, 5, 1, 12)
    put(config.source, "run/a.tdms", b"aaaa", now - timedelta(hours=3))
    for i in range(3):
        got = run_pass(spark, config, now + timedelta(hours=i))
        folders = os.listdir(config.work)
        assert len(folders) == 1 and sorted(os.listdir(f"{config.work}/{folders[0]}")) in (["._ENDED.crc", "_ENDED", "results"], ["_ENDED", "results"])
        assert got.plan.count() == got.outcomes.count() == (1 if i == 0 else 0) and got.ledger.count() == 1 and got.stats.count() == 1
    run_verification(spark, config, now + timedelta(hours=4))
    assert len(os.listdir(config.work)) == 1


def test_quick_verification_takes_stale_records_only(spark, config):
    now = datetime(2024, 5, 1, 12)
    put(config.source, "run/a.tdms", b"aaaa", now - timedelta(hours=3))
    run_pass(spark, config, now)
    put(config.source, "run/b.tdms", b"bbbb", now + timedelta(hours=1))
    run_pass(spark, config, now + timedelta(hours=2))
    for p in "ab":
        with open(f"{config.target}/run/{p}.tdms", "wb") as f:
            f.write(b"zzzz")
    verdicts, summary = run_verification(spark, config, now + timedelta(hours=3), older_than=now + timedelta(hours=1))
    assert [(r.file_path, r.verdict) for r in verdicts.collect()] == [("run/a.tdms", "remote_mismatch")] and summary.first().mismatches == 1
    assert status_counts(spark, config) == {"pending": 1, "verified": 1}
    got = run_pass(spark, config, now + timedelta(hours=4))
    assert got.state.first().last_full_verify_time is None and [r.file_path for r in got.plan.where("needs_transfer").collect()] == ["run/a.tdms"]


def test_superseded_copies_go_only_when_asked_and_safe(spark, config, tmp_path):
    config.compressed_target = str(tmp_path / "packed")
    for p in "abc":
        put(config.target, f"run/{p}.tdms_index", b"x", datetime(2024, 1, 1))
    superseded = spark.createDataFrame([(f"run/{p}.tdms_index", "uncompressed") for p in "abc"], "file_path string, old_tree string")
    led = with_defaults(spark.createDataFrame([("run/a.tdms_index", "verified", "compressed"), ("run/b.tdms_index", "pending", "compressed"), ("run/c.tdms_index", "verified", "uncompressed")], "file_path string, transfer_status string, remote_tree string"))
    result = PassResult(None, None, led, None, None, superseded)
    assert [(r.copy, r.removed) for r in remove_superseded(result, config).collect()] == [(f"{config.target}/run/a.tdms_index", False)] and len(os.listdir(f"{config.target}/run")) == 3
    assert [(r.removed, r.error) for r in remove_superseded(result, config, dry_run=False).collect()] == [(True, None)]
    assert sorted(os.listdir(f"{config.target}/run")) == ["b.tdms_index", "c.tdms_index"]
    assert [r.removed for r in remove_superseded(result, config, dry_run=False).collect()] == [True]


def test_waves_grow_without_a_ceiling_while_nothing_fails(spark, config, monkeypatch):
    config.wave_files = 16
    now = datetime(2024, 5, 1, 12)
    many(config, 130, now - timedelta(hours=1))
    real, asked = copying.copy_files, []

    def seen(plan, *args, **more):
        asked.append(plan.count())
        return real(plan, *args, **more)

    monkeypatch.setattr(copying, "copy_files", seen)
    got = run_pass(spark, config, now)
    assert got.stopped is None and [n for n in asked if n < 130] == [16, 32, 64, 18] and status_counts(spark, config) == {"verified": 130}
