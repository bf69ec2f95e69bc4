"""The ledger of buckets: only touched buckets are written, writers that lose are refused, stopped ones do no harm."""

import os

import pytest
from pyspark.sql import functions as F

from fileledger.schema import with_defaults
from fileledger.sources import bucket_store as B


def records(spark, ids, status="pending", size=1):
    return with_defaults(spark.createDataFrame([(f"run/{i}.tdms", size, status) for i in ids], "file_path string, file_size_bytes long, transfer_status string"))


def folders(path):
    return sorted(f"{d}/{b}" for d in os.listdir(f"{path}/data") for b in os.listdir(f"{path}/data/{d}") if b.startswith("bucket="))


def statuses(spark, path, version=None):
    return {r.file_path: r.transfer_status for r in B.read(spark, path, version).collect()}


def test_a_change_writes_its_buckets_only(spark, tmp_path):
    at = str(tmp_path)
    assert B.current(spark, at) is None and B.read(spark, at).count() == 0 and B.totals(spark, at)["files"] == 0
    assert B.write_changes(spark, at, records(spark, range(400)), buckets=16) == 0
    first = folders(at)
    assert len(first) == 16
    changed = records(spark, [5, 77], "verified", 9)
    assert B.write_changes(spark, at, changed, 0) == 1
    more = set(folders(at)) - set(first)
    assert 1 <= len(more) <= 2
    now = statuses(spark, at)
    assert len(now) == 400 and {p for p, s in now.items() if s == "verified"} == {"run/5.tdms", "run/77.tdms"} and set(statuses(spark, at, 0).values()) == {"pending"}
    assert B.totals(spark, at) == {"files": 400, "bytes": 416, "status": {"pending": 398, "transferring": 0, "transferred": 0, "verified": 2, "failed": 0, "checksum_mismatch": 0}}
    assert B.check_totals(spark, at)
    # paths that go, new paths, a path in both, a change of nothing
    B.write_changes(spark, at, records(spark, [5, 1000], "failed"), gone=records(spark, [5, 6, 7]))
    now = statuses(spark, at)
    assert len(now) == 399 and now["run/5.tdms"] == now["run/1000.tdms"] == "failed" and "run/6.tdms" not in now and B.check_totals(spark, at)
    before = folders(at)
    assert B.write_changes(spark, at, records(spark, [])) == 3 and folders(at) == before and statuses(spark, at) == now


def test_of_two_writers_one_is_refused(spark, tmp_path, monkeypatch):
    at = str(tmp_path)
    B.write_changes(spark, at, records(spark, range(40)), buckets=4)
    B.write_changes(spark, at, records(spark, [1], "verified"), 0)
    kept = folders(at)
    with pytest.raises(B.Conflict):
        B.write_changes(spark, at, records(spark, [2], "failed"), 0)
    # the other one commits between our reading and our commit
    real = B._commit

    def late(spark, path, version, manifest):
        monkeypatch.setattr(B, "_commit", real)
        B.write_changes(spark, at, records(spark, [3], "verified"))
        real(spark, path, version, manifest)

    monkeypatch.setattr(B, "_commit", late)
    with pytest.raises(B.Conflict):
        B.write_changes(spark, at, records(spark, [2], "failed"))
    now = statuses(spark, at)
    assert now["run/2.tdms"] == "pending" and now["run/1.tdms"] == now["run/3.tdms"] == "verified" and len(folders(at)) == len(kept) + 1 and B.check_totals(spark, at)


def test_a_stopped_writer_does_no_harm(spark, tmp_path, monkeypatch):
    at = str(tmp_path)
    B.write_changes(spark, at, records(spark, range(40)), buckets=4)

    def stop(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(B, "_commit", stop)
        with pytest.raises(KeyboardInterrupt):
            B.write_changes(spark, at, records(spark, [2], "failed"))
    assert B.current(spark, at) == 0 and len(folders(at)) == 4
    # half a manifest counts for nothing, but its number is not given again
    with open(f"{at}/manifests/m00000001.json", "w") as f:
        f.write('{"count": 4, "buck')
    assert B.current(spark, at) == 0 and statuses(spark, at)["run/2.tdms"] == "pending"
    assert B.write_changes(spark, at, records(spark, [2], "failed"), 0) == 2 and statuses(spark, at)["run/2.tdms"] == "failed"


def test_old_versions_expire(spark, tmp_path):
    at = str(tmp_path)
    B.write_changes(spark, at, records(spark, range(40)), buckets=4)
    for i in range(5):
        B.write_changes(spark, at, records(spark, [i], "verified", i))
    want = statuses(spark, at)
    assert B.expire(spark, at, 2) == 4 and B.expire(spark, at, 2) == 0
    assert B.current(spark, at) == 5 and statuses(spark, at) == want and statuses(spark, at, 4)["run/4.tdms"] == "pending" and B.check_totals(spark, at)
    assert len(folders(at)) <= 5
    with pytest.raises(FileNotFoundError):
        B.read(spark, at, 1)
    assert B.write_changes(spark, at, records(spark, [9], "failed")) == 6 and B.read(spark, at).where(F.col("transfer_status") == "failed").count() == 1
