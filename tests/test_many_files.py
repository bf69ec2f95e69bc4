"""The archive and the stream inputs of the registered queries are many files, with the same results."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from fileledger.plans import queries as Q


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.fixture
def made(monkeypatch):
    """The scratch folders that the queries ask for."""
    seen, real = [], Q.scratch_path
    monkeypatch.setattr(Q, "scratch_path", lambda *a: seen.append(real(*a)) or seen[-1])
    return seen


def test_a_source_becomes_bounded_files(spark, sf, made, monkeypatch):
    whole = rows(Q.QUERIES["list_files"](spark, sf))
    monkeypatch.setattr(Q, "FILE_BYTES", 20_000, raising=False)
    root, _ = Q._as_files(spark, sf)
    sizes = {f: os.path.getsize(f) for f in glob.glob(f"{root}/source=*/*.txt")}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    longest, total, sources = docs.agg(F.max(F.octet_length("text")), F.sum(F.octet_length("text") + 1), F.count_distinct("source")).first()
    assert sum(sizes.values()) == total and len(sizes) > 2 * sources and max(sizes.values()) < 20_000 + 2 * longest
    for name in ("list_files", "read_content"):
        assert rows(Q.QUERIES[name](spark, sf)) == whole
    assert all(r.verified for r in Q.QUERIES["copy_files"](spark, sf).collect())


def test_stream_inputs_keep_their_partitions(spark, sf, made, monkeypatch):
    whole = {name: rows(Q.QUERIES[name](spark, sf)) for name in ("stream_ledger", "settle_stream")}
    events, frame = Q._event_files, Q.frame
    monkeypatch.setattr(Q, "_event_files", lambda *a: events(*a).repartition(5))
    monkeypatch.setattr(Q, "frame", lambda *a: frame(*a).repartition(5))
    for name in whole:
        made.clear()
        assert rows(Q.QUERIES[name](spark, sf)) == whole[name]
        at = made[0].removeprefix("file://")
        for folder in [f"{at}/in/part=0", f"{at}/in/part=1"] if name == "stream_ledger" else [f"{at}/in"]:
            assert len(glob.glob(f"{folder}/*.parquet")) == 5
