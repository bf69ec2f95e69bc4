"""Copies balanced by bytes and in ranges, and verification within a budget of bytes."""

import os
from datetime import UTC, datetime, timedelta

import pytest
import xxhash
from pyspark.sql import functions as F

from fileledger.operators.ledger import stalest
from fileledger.operators.prefix import running_sum
from fileledger.plans import passes as P
from fileledger.schema import with_defaults
from fileledger.sources import copying


def plan_of(spark, root, names):
    return spark.createDataFrame([(n, os.path.getsize(root / n) if (root / n).exists() else 7) for n in names], "file_path string, file_size_bytes long")


@pytest.fixture
def root(tmp_path):
    (tmp_path / "in/sub").mkdir(parents=True)
    (tmp_path / "in/large").write_bytes(os.urandom(100_003))
    (tmp_path / "in/exact").write_bytes(os.urandom(30_000))
    (tmp_path / "in/sub/empty").touch()
    for i in range(20):
        (tmp_path / f"in/sub/{i}").write_bytes(os.urandom(100 * i))
    return tmp_path / "in"


NAMES = ["large", "exact", "sub/empty", *(f"sub/{i}" for i in range(20))]


@pytest.mark.parametrize("size", [1, 10])
def test_running_sums(spark, size):
    df = spark.range(size * 100).select((F.col("id") * 37 % 101).alias("k"), "id", F.when(F.col("id") % 7 > 0, F.col("id")).alias("v"))
    got = running_sum(df, F.col("v"), F.desc("k"), "id").collect()
    rows = sorted(df.collect(), key=lambda r: (-r.k, r.id))
    want, total = {}, 0
    for n, r in enumerate(rows):
        want[r.id] = (n, total)
        total += r.v or 0
    assert {r.id: (r.seq, r.before) for r in got} == want
    assert running_sum(df.limit(0), F.col("v"), "k", "id").count() == 0


def test_one_file_of_half_the_bytes_is_dealt_over_the_tasks(spark):
    sizes = [("huge", 10**12), *((f"f{i}", 10**12 // 5000) for i in range(5000)), *((f"e{i}", 0) for i in range(1000)), ("unknown", None)]
    plan = spark.createDataFrame(sizes, "file_path string, file_size_bytes long").withColumn("target_file", F.col("file_path"))
    dealt = copying.deal_ranges(copying.file_ranges(plan, copying.range_size(2 * 10**12, 16)), 16)
    tasks = dealt.groupBy("task").agg(F.sum("length").alias("b")).collect()
    assert len(tasks) == 16 and max(r.b for r in tasks) < 2 * 2 * 10**12 / 16 and sum(r.b for r in tasks) == 2 * 10**12
    each = {r.file_path: r for r in dealt.groupBy("file_path").agg(F.sum("length").alias("b"), F.count_if("last").alias("ends"), F.count_distinct("start").alias("starts"), F.count("*").alias("n")).collect()}
    assert all(each[f].b == (b or 0) and each[f].ends == 1 and each[f].starts == each[f].n for f, b in sizes)


@pytest.mark.parametrize("range_bytes", [999, 30_000, 10**9])
def test_copies_are_whole(spark, root, tmp_path, range_bytes):
    plan = plan_of(spark, root, NAMES).unionByName(plan_of(spark, root, ["exact"]))  # one twice
    rows = copying.copy_ranged(plan, str(root), str(tmp_path / "out"), 4, range_bytes=range_bytes, chunk=4096).collect()
    assert len(rows) == len(NAMES)
    for r in rows:
        data = (root / r.file_path).read_bytes()
        assert (tmp_path / "out" / r.file_path).read_bytes() == data
        assert r.success and r.sent_checksum == r.remote_checksum == xxhash.xxh64_hexdigest(data) and r.bytes_transferred == len(data) and not r.remote_error
    assert not list((tmp_path / "out").rglob("*.part"))


def test_failures_leave_no_part(spark, root, tmp_path):
    plan = plan_of(spark, root, [*NAMES, "gone"])
    (root / "large").write_bytes(b"x" * 2500)  # became shorter since it was listed
    with open(root / "exact", "ab") as f:
        f.write(b"longer")
    rows = {r.file_path: r for r in copying.copy_ranged(plan, str(root), str(tmp_path / "out"), 3, attempt=2, range_bytes=1000).collect()}
    assert "shorter" in rows["large"].error and "FileNotFound" in rows["gone"].error and {r.attempt for r in rows.values()} == {2}
    for name in ("large", "gone"):
        assert rows[name].raised and not rows[name].success and rows[name].bytes_transferred == 0 and not (tmp_path / "out" / name).exists()
    assert rows["exact"].success and (tmp_path / "out/exact").read_bytes() == (root / "exact").read_bytes() and rows["exact"].sent_checksum == rows["exact"].remote_checksum
    assert not list((tmp_path / "out").rglob("*.part"))


def test_a_range_that_reads_back_differently_is_told_and_a_second_try_of_the_task_agrees(root, tmp_path):
    part, target = str(tmp_path / "t.part"), str(tmp_path / "t")
    sent = [(at, *copying.copy_range(str(root / "exact"), part, at, 10_000, at == 20_000)) for at in (20_000, 0, 10_000)]
    with open(part, "r+b") as f:
        f.seek(15_000)
        f.write(b"\0\1\2\3\4\5")
    first = copying.finish_ranges(str(root / "exact"), target, part, sent)
    assert first[0] == xxhash.xxh64_hexdigest((root / "exact").read_bytes()) != first[1] and first[2] is None
    assert copying.finish_ranges(str(root / "exact"), target, part, sent) == first
    with pytest.raises(FileNotFoundError):
        copying.finish_ranges(str(root / "exact"), str(tmp_path / "none"), part, sent)


def test_a_pass_copies_large_files_in_ranges(spark, root, tmp_path, monkeypatch):
    monkeypatch.setattr(copying, "LEAST_RANGE", 4_000)
    used, real = [], copying.copy_ranged
    monkeypatch.setattr(copying, "copy_ranged", lambda *a: used.append(a[-1]) or real(*a))
    config = P.PassConfig(str(root), str(tmp_path / "out"), str(tmp_path / "ledger"), str(tmp_path / "work"), parallelism=2, least_free_gb=0)
    now = datetime.now(UTC).replace(tzinfo=None) + timedelta(minutes=1)
    result = P.run_pass(spark, config, now)
    assert used and {r.transfer_status for r in result.ledger.collect()} == {"verified"}
    assert all((tmp_path / "out" / n).read_bytes() == (root / n).read_bytes() for n in NAMES)
    seen = []
    for hour in range(1, 4):  # a budget of one large file takes it alone, then the others, then begins anew
        verdicts, _ = P.run_verification(spark, config, now + timedelta(hours=hour), byte_budget=100_000)
        seen.append({r.file_path for r in verdicts.collect()})
    assert seen[0] and seen[0] | seen[1] | seen[2] == set(NAMES) and seen[0] != seen[1]


def test_budget_takes_the_stalest_and_always_goes_on(spark):
    day = datetime(2024, 1, 1)
    rows = [("b", 50, None), ("a", 60, None), ("old", 500, day), ("new", 5, day + timedelta(1)), ("unknown", None, day)]
    df = with_defaults(spark.createDataFrame(rows, "file_path string, file_size_bytes long, last_verified_remote timestamp_ntz"))
    take = lambda n: sorted(r.file_path for r in stalest(df, n).collect())
    assert take(0) == [] and take(1) == ["a"] and take(61) == ["a", "b"] and take(111) == ["a", "b", "old"]
    assert take(610) == ["a", "b", "old"] and take(611) == ["a", "b", "new", "old", "unknown"]
    assert stalest(df.limit(0), 10).count() == 0
