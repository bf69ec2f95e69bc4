"""The inventory as a data source, in batch and as a stream of changes."""

import os
from datetime import UTC, datetime, timedelta

import pytest

from fileledger.plans.passes import PassConfig, run_pass
from fileledger.sources.inventory_source import plan_shares, read_inventory, read_share, stream_inventory
from fileledger.sources.listing import list_files
from fileledger.streaming.stream import start_stream


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "in"
    for name in ["a/one.txt", "a/b/two.txt", "a/b/c/three.txt", "skip/four.txt", "five.txt", "_x/.hidden", "d e/ü.txt"]:
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(name)
    (root / "hollow").mkdir()
    (root / "a/empty.txt").touch()
    os.symlink(root / "a", root / "link")
    return root


def test_same_rows_as_the_listing(spark, tree):
    for ignore in ([], ["skip"]):
        want = sorted(map(repr, list_files(spark, str(tree), ignore).collect()))
        for tasks in (1, 3, 64):
            assert sorted(map(repr, read_inventory(spark, str(tree), ignore, tasks).collect())) == want
    with pytest.raises(Exception, match="nowhere"):
        read_inventory(spark, str(tree / "nowhere")).collect()
    assert read_inventory(spark, str(tree / "hollow")).count() == 0


@pytest.mark.parametrize("tasks", [1, 2, 8, 20])
def test_shares_hold_every_file_once_and_part_a_large_folder(tmp_path, tasks):
    for i in range(300):
        (tmp_path / f"f{i}").touch()
        (tmp_path / f"d{i % 150}").mkdir(exist_ok=True)
        (tmp_path / f"d{i % 150}" / f"g{i}").touch()
    shares = plan_shares(str(tmp_path), {"d7"}, tasks, None, None)
    counts = [sum(b.num_rows for b in read_share(s, str(tmp_path), {"d7"})) for s in shares]
    paths = [p for s in shares for b in read_share(s, str(tmp_path), {"d7"}) for p in b["path"].to_pylist()]
    assert len(paths) == len(set(paths)) == 598
    assert tasks == 1 or max(counts) < 0.75 * sum(counts)


def test_a_folder_of_very_many_folders_is_read_by_its_shares(tmp_path):
    for i in range(200):
        (tmp_path / f"d{i}").mkdir()
        (tmp_path / f"d{i}" / "f").touch()
    shares = plan_shares(str(tmp_path), set(), 2, None, None)
    assert all(s.folders == [str(tmp_path)] and s.deep for s in shares) and len(shares) == 2
    assert sum(b.num_rows for s in shares for b in read_share(s, str(tmp_path), set())) == 200


def streamed(spark, root, at, **how):
    seen = []
    start_stream(stream_inventory(spark, str(root), **how), lambda df, n: seen.extend(r.file_path for r in df.collect()), str(at), None).awaitTermination()
    return sorted(seen)


def test_stream_gives_changes_once_and_goes_on_after_a_stop(spark, tree, tmp_path):
    at = tmp_path / "checkpoint"
    assert streamed(spark, tree, at, ignore=["skip"]) == sorted(["a/one.txt", "a/b/two.txt", "a/b/c/three.txt", "five.txt", "_x/.hidden", "d e/ü.txt", "a/empty.txt"])
    assert streamed(spark, tree, at, ignore=["skip"]) == []
    (tree / "a/one.txt").write_text("more")
    (tree / "five.txt").rename(tree / "six.txt")  # keeps its time of change, but not that of its name
    os.utime(tree / "a/b/two.txt", (1, 1))
    assert streamed(spark, tree, at, ignore=["skip"]) == ["a/b/two.txt", "a/one.txt", "six.txt"]


def test_young_files_wait_for_the_settle_window(spark, tree, tmp_path):
    assert streamed(spark, tree, tmp_path / "c1", settle_minutes=60) == []
    assert len(streamed(spark, tree, tmp_path / "c1")) == 8


def test_stream_feeds_passes_and_pending_records_come_again(spark, tree, tmp_path):
    config = PassConfig(str(tree), str(tmp_path / "out"), str(tmp_path / "ledger"), str(tmp_path / "work"), ignore=["skip"], least_free_gb=0)
    clock, done = datetime.now(UTC).replace(tzinfo=None) + timedelta(minutes=1), []

    def run(batch, n):
        result = run_pass(spark, config, clock, inventory=batch)
        done.append((sorted(r.file_path for r in result.plan.where("needs_transfer").collect()), {r.file_path: r.transfer_status for r in result.ledger.collect()}))

    go = lambda: start_stream(stream_inventory(spark, str(tree), ["skip"]), run, str(tmp_path / "check"), None).awaitTermination()
    (tmp_path / "out/a").mkdir(parents=True)
    (tmp_path / "out/a/one.txt").mkdir()  # nothing can be copied there
    go()
    assert done[0][1].pop("a/one.txt") == "failed" and set(done[0][1].values()) == {"verified"}
    (tmp_path / "out/a/one.txt").rmdir()
    (tree / "a/b/two.txt").write_text("changed")
    go()
    assert "a/b/two.txt" in done[1][0] and done[1][1]["a/b/two.txt"] == "verified" and len(done[1][1]) == 7
    assert (tmp_path / "out/a/b/two.txt").read_text() == "changed"
