"""From a scan to a plan: new and changed files, routing, what must be sent."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.paths import desired_tree, priority_rank, target_path
from ..schema import ACTIONABLE, LEDGER_FIELDS
from .ledger import pending_transfers
from .scan import prune_ignored, stamp


def detect_changes(scan: DataFrame, ledger: DataFrame, detect: str = "size") -> DataFrame:
    """The scan's rows with ``change``: new, changed, unhashed or unchanged.

    ``detect``: ``size`` compares sizes only, so that a rewrite of equal size waits for a verification;
    ``size_mtime`` also sees later modification times; ``hash`` compares the scan's ``hash`` column.
    """
    known = ledger.select("file_path", F.col("file_size_bytes").alias("old_size"), F.col("file_mtime").alias("old_mtime"), F.col("local_checksum").alias("old_hash"), "transfer_status", F.lit(True).alias("known"))
    differs = {
        "size": ~F.col("file_size_bytes").eqNullSafe(F.col("old_size")),
        "size_mtime": ~F.col("file_size_bytes").eqNullSafe(F.col("old_size")) | ~F.col("file_mtime").eqNullSafe(F.col("old_mtime")),
    }
    if detect == "hash":
        differs["hash"] = ~F.col("hash").eqNullSafe(F.col("old_hash"))
    unhashed = F.coalesce(F.col("old_hash"), F.lit("")) == ""
    change = F.when(F.col("known").isNull(), "new").when(unhashed, "unhashed").when(differs[detect], "changed").otherwise("unchanged")
    return scan.join(known, "file_path", "left").withColumn("change", change).drop("known")


def to_hash(changes: DataFrame) -> DataFrame:
    """The paths whose content has to be read: all but unchanged ones."""
    return changes.where(F.col("change") != "unchanged").select("file_path")


def new_records(changes: DataFrame, now: datetime | str, compression: bool = False) -> DataFrame:
    """Ledger records of new files (with ``hash``): pending, first seen now, routed to their tree."""
    given = {
        "file_path": F.col("file_path"), "file_name": F.col("file_name"), "file_extension": F.col("file_extension"), "file_size_bytes": F.col("file_size_bytes"),
        "file_mtime": F.col("file_mtime"), "file_ctime": F.col("file_ctime"), "filename_timestamp": F.col("filename_timestamp"), "local_checksum": F.col("hash"),
        "first_seen": stamp(now), "remote_tree": desired_tree(F.col("file_extension"), compression),
    }
    new = changes.where(F.col("change") == "new")
    return new.select(*((given[n] if n in given and (n in new.columns or n in ("local_checksum", "first_seen", "remote_tree")) else F.expr(d) if d else F.lit(None)).cast(t).alias(n) for n, t, d in LEDGER_FIELDS))


def apply_changes(ledger: DataFrame, changes: DataFrame, now: datetime | str, compression: bool = False, detect: str = "size") -> DataFrame:
    """The ledger after a scan: changed and unhashed records get size and hash and become pending, new ones are added.

    The modification time of a changed record stays what it was, but with ``detect="size_mtime"``, which compares it, it
    becomes the scan's; else each later pass would find the file changed again.
    """
    seen = changes.where(F.col("change").isin("changed", "unhashed")).select("file_path", F.col("file_size_bytes").alias("__size"), F.col("hash").alias("__hash"), F.col("file_mtime").alias("__mtime"))
    joined = ledger.join(seen.withColumn("__seen", F.lit(True)), "file_path", "left")
    put = {"file_size_bytes": F.col("__size"), "local_checksum": F.col("__hash"), "transfer_status": F.lit("pending")}
    if detect == "size_mtime":
        put["file_mtime"] = F.col("__mtime")
    kept = joined.select(*(F.when(F.col("__seen"), put[n]).otherwise(F.col(n)).alias(n) if n in put else F.col(n) for n in ledger.columns))
    return kept.unionByName(new_records(changes, now, compression).select(*ledger.columns))


def desired_tree_for_record(ledger: DataFrame, compression: bool) -> DataFrame:
    """The ledger with ``desired_tree``: an index stays in the compressed tree while its sibling there is rebuilt."""
    siblings = ledger.where("compressed").select(F.concat("file_path", F.lit("_index")).alias("__index")).distinct()
    joined = ledger.join(siblings, F.col("file_path") == F.col("__index"), "left")
    is_index = (F.lower("file_extension") == ".tdms_index") & F.col("__index").isNotNull()
    return joined.withColumn("desired_tree", F.when(is_index, "compressed").otherwise(desired_tree(F.col("file_extension"), compression))).drop("__index")


def reroute(ledger: DataFrame, compression: bool) -> tuple[DataFrame, DataFrame]:
    """The ledger with unverified records in their desired tree, and the copies that this supersedes (path, old tree)."""
    wanted = desired_tree_for_record(ledger, compression)
    moves = (F.col("transfer_status") != "verified") & (F.col("desired_tree") != F.col("remote_tree"))
    superseded = wanted.where(moves & F.col("remote_checksum").isNotNull()).select("file_path", F.col("remote_tree").alias("old_tree"))
    return wanted.withColumn("remote_tree", F.when(moves, F.col("desired_tree")).otherwise(F.col("remote_tree"))).select(*ledger.columns), superseded


def plan_transfers(records: DataFrame, target: DataFrame, root: str = "", compressed_root: str | None = None) -> DataFrame:
    """``file_path, transfer_status, needs_transfer, reason`` of records against the target's files.

    ``target (file_path, hash)`` holds paths below ``root``, in the form of :func:`target_path`. Reasons: not_actionable,
    already_there, different_there, absent.
    """
    place = target_path(F.col("file_path"), F.col("remote_tree"), root, compressed_root) if root else F.col("file_path")
    there = target.select(F.col("file_path").alias("__place"), F.col("hash").alias("target_hash"), F.lit(True).alias("exists_there"))
    joined = records.withColumn("__at", place).join(there, F.col("__at") == F.col("__place"), "left")
    reason = (
        F.when(~F.coalesce(F.col("transfer_status").isin(ACTIONABLE), F.lit(False)), "not_actionable")
        .when(F.col("exists_there") & (F.col("target_hash") == F.col("local_checksum")), "already_there")
        .when(F.col("exists_there"), "different_there")
        .otherwise("absent")
    )
    return joined.withColumn("reason", reason).withColumn("needs_transfer", F.col("reason").isin("different_there", "absent")).select("file_path", "transfer_status", "local_checksum", "file_size_bytes", "target_hash", "needs_transfer", "reason")


def settle_matches(ledger: DataFrame, plan: DataFrame, now: datetime | str) -> DataFrame:
    """The ledger in which records that the plan finds already there are verified."""
    found = plan.where(F.col("reason") == "already_there").select("file_path", F.col("target_hash").alias("__hash"))
    joined = ledger.join(found, "file_path", "left")
    hit = F.col("__hash").isNotNull()
    put = {"remote_checksum": F.col("__hash"), "transfer_status": F.lit("verified"), "last_verified_remote": stamp(now)}
    return joined.select(*(F.when(hit, put[n]).otherwise(F.col(n)).alias(n) if n in put else F.col(n) for n in ledger.columns))


def target_state(plan: DataFrame, target: DataFrame) -> DataFrame:
    """``file_path, exists_there, target_size`` of planned files."""
    there = target.select("file_path", F.col("file_size_bytes").alias("target_size"), F.lit(True).alias("__there"))
    return plan.select("file_path").join(there, "file_path", "left").select("file_path", F.col("__there").isNotNull().alias("exists_there"), "target_size")


def requeue(ledger: DataFrame, inventory: DataFrame, scan: DataFrame, now: datetime | str, ignore: DataFrame | None = None, settle_minutes: float = 0) -> DataFrame:
    """Inventory rows of pending records that the scan doesn't have, with ``held``: still within the settle window.

    The ignore list and existence are honoured, files at the root aren't skipped.
    """
    waiting = pending_transfers(ledger).select("file_path")
    rows = inventory.join(waiting, "file_path", "left_semi").join(scan.select("file_path"), "file_path", "left_anti")
    rows = rows if ignore is None else prune_ignored(rows, ignore)
    if settle_minutes <= 0:
        return rows.withColumn("held", F.lit(False))
    now = datetime.fromisoformat(now) if isinstance(now, str) else now
    return rows.withColumn("held", F.col("file_mtime") > stamp(now - timedelta(minutes=settle_minutes)))


def work_list(scan: DataFrame, requeued: DataFrame) -> DataFrame:
    """The scan's rows and the re-queued ones that aren't held."""
    rows = requeued.where(~F.col("held")).drop("held")
    return scan.unionByName(rows.select(*scan.columns))


def stub_failed_checks(errors: DataFrame, ledger: DataFrame, now: datetime | str, compression: bool = False) -> DataFrame:
    """Pending records without hash for files whose check failed and that the ledger lacks, so that a later pass sees them."""
    lost = errors.join(ledger.select("file_path"), "file_path", "left_anti").dropDuplicates(["file_path"])
    return new_records(lost.withColumn("change", F.lit("new")).withColumn("hash", F.lit(None).cast("string")).withColumn("filename_timestamp", F.lit(None).cast("timestamp_ntz")), now, compression)


def order_plan(plan: DataFrame, names: list[str]) -> DataFrame:
    """Named top-level folders first, then by path."""
    return plan.withColumn("rank", priority_rank(F.col("file_path"), names)).orderBy("rank", "file_path")


def capacity_check(plan: DataFrame, free: DataFrame, floor_gb: float = 100) -> DataFrame:
    """``target, planned_bytes, free_bytes, refused, reason`` for each row of ``free (target, free_bytes)``.

    Refused: ``below_floor`` if less than the floor is free; ``does_not_fit`` if the plan is larger than what is free.
    """
    sums = plan.groupBy("target").agg(F.sum("file_size_bytes").alias("planned"))
    planned, left = F.coalesce(F.col("planned"), F.lit(0)), F.col("free_bytes")
    reason = F.when(left < F.lit(int(floor_gb * 1024**3)), "below_floor").when(planned > left, "does_not_fit")
    return free.join(sums, "target", "left").select("target", planned.alias("planned_bytes"), "free_bytes", reason.isNotNull().alias("refused"), reason.alias("reason"))

