"""Whole passes over real folders: scan, plan, copy, record; and verification."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import hash_files, target_hash
from ..functions.paths import target_path
from ..functions.text import is_conn_error
from ..operators import changes, codec, ledger, outcomes, reports, scan, verify
from ..operators.prefix import running_sum
from ..schema import INVENTORY
from ..sources import copying, encoded, ledger_store, listing
from ..sources.scratch import place, remove


@dataclass
class PassConfig:
    """Where things are and how a pass behaves. All folders are mounted on every executor.

    With ``compression``, a ``compressed_target`` and the tables ``signals (file_path, idx, value)`` and ``channels (file_path, group_name,
    channel_name, properties)``, files whose one signal codes keep exactly are sent encoded, and rebuilt at the target.
    """

    source: str
    target: str
    ledger_path: str
    work: str
    extensions: list[str] | None = None
    ignore: list[str] = field(default_factory=list)
    priority: list[str] = field(default_factory=list)
    skip_root: bool = False
    settle_minutes: float = 0
    detect: str = "size"
    compression: bool = False
    compressed_target: str | None = None
    parallelism: int = 8
    cursor: str = "settled"
    replica: str | None = None
    least_free_gb: float = 100
    signals: str | None = None
    channels: str | None = None
    encode_least_bytes: int = 10 << 20
    decode_limit: int = 5
    mismatch_limit: int = 5
    streak_limit: int = 12
    wave_files: int = 20_000


@dataclass
class PassResult:
    """What a pass found and did.

    ``superseded`` lists copies that a change of tree leaves behind. ``refused`` holds the targets without room for the
    plan, in which case nothing was copied and nothing recorded. ``stopped`` says why a pass gave up part of its plan.
    ``outcomes`` are the tries of plain copies, ``encoded`` those of encoded ones.
    """

    plan: DataFrame
    outcomes: DataFrame | None
    ledger: DataFrame
    state: DataFrame
    stats: DataFrame | None
    superseded: DataFrame | None = None
    refused: DataFrame | None = None
    stopped: str | None = None
    encoded: DataFrame | None = None


#: What a pass still needs when it has ended stands in the first folder, its steps in the second; the file marks a pass that has ended.
_RESULTS, _STEPS, _ENDED = "results", "steps", "_ENDED"


def _begin(spark: SparkSession, config: PassConfig) -> PassConfig:
    """The same settings with a folder of this pass's own; the folders of passes that have ended go."""
    fs, work = place(spark, config.work)
    if fs.exists(work):
        for child in fs.listStatus(work):
            at = f"{config.work}/{child.getPath().getName()}"
            if child.getPath().getName().startswith("pass-") and fs.exists(place(spark, f"{at}/{_ENDED}")[1]):
                remove(spark, at)
    return replace(config, work=f"{config.work}/pass-{uuid.uuid4().hex}")


def _end(spark: SparkSession, config: PassConfig) -> None:
    """Delete a pass's steps. What it gave back can be read until the next pass of the same folder begins."""
    remove(spark, f"{config.work}/{_STEPS}")
    fs, mark = place(spark, f"{config.work}/{_ENDED}")
    fs.create(mark, True).close()


def _saved(df: DataFrame, config: PassConfig, name: str, result: bool = False) -> DataFrame:
    """Write a step's result once: later steps must not copy or list again."""
    path = f"{config.work}/{_RESULTS if result else _STEPS}/{uuid.uuid4().hex}-{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _names(spark: SparkSession, names: list[str]) -> DataFrame:
    return spark.createDataFrame([(n,) for n in names], "name string")


def _state_path(config: PassConfig) -> str:
    return f"{config.ledger_path}/state"


def load_state(spark: SparkSession, config: PassConfig) -> DataFrame:
    version = ledger_store.current_version(spark, config.ledger_path)
    if version is None:
        return ledger.read_state(None, spark)
    return ledger.read_state(spark.read.parquet(f"{_state_path(config)}/v{version:08d}"))


def _publish(records: DataFrame, state: DataFrame, config: PassConfig) -> None:
    """State first, then the ledger, whose pointer makes both current."""
    spark = records.sparkSession
    now = ledger_store.current_version(spark, config.ledger_path)
    version = 0 if now is None else now + 1
    state.coalesce(1).write.mode("overwrite").parquet(f"{_state_path(config)}/v{version:08d}")
    ledger_store.write_ledger(records, config.ledger_path, version)
    if config.replica:
        ledger_store.replicate_ledger(records, config.replica, version)


def copy_in_waves(queue: DataFrame, config: PassConfig) -> tuple[DataFrame, str | None]:
    """Copy ``queue (seq, before, file_path, target_file, file_size_bytes)`` in waves, and stop at a sign of general failure: all tries, and why it stopped.

    Waves start small and double, so that a server that refuses every file is asked for a few only; beyond ``wave_files`` they
    grow as long as nothing fails, so the number of waves grows with the logarithm of the queue. After each wave one aggregation counts its
    mismatches and failures of the connection; only if these could reach a limit are they looked at in the plan's order.
    Tasks of a wave have equal bytes: ``before``, the bytes before a file, deals them, and a wave with a file above a task's share of it
    is copied in ranges. The files of later waves stay as they are. A wave that already failed in a row isn't tried a second time.
    """
    spark, folder = queue.sparkSession, f"{config.work}/{_RESULTS}/{uuid.uuid4().hex}-tries"
    total, at, size, number = queue.count(), 0, max(16, 2 * config.parallelism), 0
    mismatches, run, stopped = 0, 0, None  # run: failures of the connection at the end of what has been copied
    schema = copying.copy_files(queue, config.source, "/", config.parallelism).schema
    lost = ~F.col("success") & is_conn_error(F.col("error"))

    def judged(tries: DataFrame, wave: DataFrame) -> DataFrame:
        last = outcomes.resolve_outcomes(outcomes.final_outcomes(tries)).join(wave.select("file_path", "seq"), "file_path")
        return last.select(F.lit(0).alias("pass_id"), "seq", "success", "error", "result", "raised")

    def refused(done: DataFrame, failures: int) -> bool:
        if run + failures < config.streak_limit:
            return False
        before = spark.range(at - run, at).select(F.lit(0).alias("pass_id"), F.col("id").alias("seq"), F.lit(False).alias("success"), F.lit("connection").alias("error"), F.lit("failed").alias("result"), F.lit(True).alias("raised"))
        return outcomes.conn_streak_abort_point(done.unionByName(before), config.streak_limit).limit(1).count() > 0

    def copied(files: DataFrame, attempt: int) -> DataFrame:
        nonlocal number
        number += 1
        cost = F.coalesce("file_size_bytes", F.lit(0)) + F.lit(copying.FILE_COST)
        first, end, largest = files.agg(F.min("before"), F.max(F.col("before") + cost), F.max("file_size_bytes")).first()
        share = copying.range_size((end or 0) - (first or 0), config.parallelism)
        if (largest or 0) > share:
            done = copying.copy_ranged(files, config.source, "/", config.parallelism, attempt, share)
        else:
            task = F.expr(f"cast((before - {first or 0}) * {config.parallelism} / {max(1, (end or 0) - (first or 0))} as int)")
            done = copying.copy_files(files.withColumn("task", F.least(task, F.lit(config.parallelism - 1))), config.source, "/", config.parallelism, attempt)
        done.write.parquet(f"{folder}/part={number}")
        return spark.read.schema(schema).parquet(f"{folder}/part={number}")

    def counted(tries: DataFrame) -> tuple[int, int, int, int | None]:
        """Files to try again, mismatches, failures of the connection, and the place of the last file without such a failure."""
        again = ~F.col("success") & (F.col("raised") | is_conn_error(F.col("error")))
        return judged(tries, wave).agg(F.count_if(again), F.count_if(F.col("result") == "checksum_mismatch"), F.count_if(lost), F.max(F.when(~lost, F.col("seq")))).first()

    while at < total and not stopped:
        wave = queue.where(F.col("seq").between(at, at + size - 1))
        tries = copied(wave, 1)
        repeat, bad, failures, other = counted(tries)
        if repeat and not refused(judged(tries, wave), failures):
            again = outcomes.retry_plan(tries)
            tries = tries.unionByName(copied(wave.join(again.select("file_path"), "file_path", "left_semi"), 2))
            _, bad, failures, other = counted(tries)
        mismatches += bad
        if mismatches >= config.mismatch_limit:
            stopped = f"{config.mismatch_limit} copies differ from what was sent"
        elif refused(judged(tries, wave), failures):
            stopped = f"{config.streak_limit} failures of the connection in a row"
        end = min(at + size, total) - 1
        run = run + failures if other is None else end - other
        quiet = not (bad or failures or repeat)
        at, size = at + size, 2 * size if quiet else min(2 * size, max(size, config.wave_files))
    tries = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(folder) if number else spark.createDataFrame([], schema)
    return tries, stopped


def send_in_codes(send: DataFrame, records: DataFrame, config: PassConfig) -> tuple[DataFrame | None, str | None]:
    """Send those files of the plan encoded that can be: an outcome row for each of these, and why it stopped; None if none can.

    Files are rebuilt in waves that double; after rebuilding has failed too often in a row, the rest stays pending.
    """
    spark = send.sparkSession
    if not (config.compression and config.signals and config.channels and config.compressed_target):
        return None, None
    planned = records.join(send.select("file_path"), "file_path", "left_semi")
    eligible = _saved(codec.codec_eligibility(planned, spark.read.parquet(config.channels), True, config.encode_least_bytes), config, "eligible")
    signals = spark.read.parquet(config.signals).join(eligible.where("eligible").select("file_path"), "file_path", "left_semi").withColumnRenamed("file_path", "signal_id")
    codes, meta, levels = codec.encode_signals(signals)
    routes = codec.route(eligible, meta.select(F.col("signal_id").alias("file_path"), "exact"))
    chosen = send.join(routes.where("route = 'encoded'").select("file_path"), "file_path", "left_semi")
    chosen = _saved(outcomes.numbered(chosen.select(F.col("file_path").alias("signal_id"), "rank"), "rank", "signal_id"), config, "encoded")
    total, at, size, stopped = chosen.count(), 0, max(16, 2 * config.parallelism), None
    folder, number, schema = f"{config.work}/{_RESULTS}/{uuid.uuid4().hex}-sent", 0, None
    if not total:
        return None, None
    hashes = _saved(codec.signal_xxh64(signals.join(chosen.select("signal_id"), "signal_id", "left_semi")), config, "hashes")
    before: DataFrame | None = None
    while at < total and not stopped:
        wave = chosen.where(F.col("seq").between(at, at + size - 1))
        mine = lambda df, wave=wave: df.join(wave.select("signal_id"), "signal_id", "left_semi")
        written = _saved(encoded.write_encoded(mine(codes), mine(meta), mine(levels), config.compressed_target), config, "written")
        sent = encoded.send_encoded(written, mine(meta), hashes, config.compressed_target, config.target)
        number, schema = number + 1, sent.schema
        sent.write.parquet(f"{folder}/part={number}")
        done = spark.read.schema(schema).parquet(f"{folder}/part={number}")
        judged = done.join(wave.select(F.col("signal_id").alias("file_path"), "seq"), "file_path").select(F.lit(0).alias("pass_id"), "seq", "success", "decode_failure")
        judged = judged if before is None else before.unionByName(judged)
        if outcomes.decode_halt_point(judged, config.decode_limit).limit(1).count():
            stopped = f"{config.decode_limit} rebuilt files in a row failed"
        # successes clear a streak and other failures don't count, so the last few of the others are enough
        since = F.coalesce(F.lit(judged.where("success").agg(F.max("seq")).first()[0]), F.lit(-1))
        before = _saved(judged.where((F.col("seq") > since) & F.col("decode_failure")).orderBy(F.desc("seq")).limit(config.decode_limit), config, "tail")
        at, size = at + size, 2 * size
    out = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(folder)
    if stopped:  # those not tried take no other way in this pass
        rest = chosen.where(F.col("seq") >= at).select(F.col("signal_id").alias("file_path"))
        out = out.unionByName(rest, allowMissingColumns=True)
    return out, stopped


def run_pass(spark: SparkSession, config: PassConfig, now: datetime, full: bool = False, dry_run: bool = False, inventory: DataFrame | None = None) -> PassResult:
    """One incremental pass, or a full one that ignores the cursor. A dry run plans and changes nothing.

    ``inventory`` stands for a listing of the source: a batch of :func:`~fileledger.sources.inventory_source.stream_inventory`,
    say. All of its rows count, whatever the cursor says, and pending records are tried again with what the ledger knows of them.

    A plan that a target has no room for is refused as a whole; a pass that meets general failure stops, keeps what it did and
    leaves the rest pending. With ``detect="hash"`` every scanned file is read and compared by content. The result's frames
    stand in the pass's own folder below ``work`` and can be read until the next pass begins; all else there is deleted.
    """
    if config.detect not in ("size", "size_mtime", "hash"):
        raise ValueError(f"detect is {config.detect!r}, not size, size_mtime or hash")
    config = _begin(spark, config)
    state = _saved(load_state(spark, config), config, "state")
    records = _saved(ledger_store.read_ledger(spark, config.ledger_path), config, "ledger")
    since = None if full or inventory is not None else state.first()["last_scan_time"]
    ignore = _names(spark, config.ignore)
    given = inventory
    listed = listing.list_files(spark, config.source, config.ignore) if given is None else given
    inventory = _saved(listed.select(*INVENTORY.fieldNames()), config, "inventory")
    scanned = scan.scan_since(inventory, since, now, config.settle_minutes, config.extensions, ignore, config.skip_root)
    rows = scan.selected(scanned)
    known = inventory if given is None else inventory.unionByName(records.select(*inventory.columns).join(inventory.select("file_path"), "file_path", "left_anti"))
    again = changes.requeue(records, known, rows, now, ignore, config.settle_minutes)
    work = changes.work_list(rows, again)
    if config.detect == "hash":
        read = work.join(_saved(hash_files(work, config.source), config, "hashes"), "file_path", "left")
        checked = _saved(changes.detect_changes(read, records, config.detect), config, "checked")
    else:
        found = changes.detect_changes(work, records, config.detect)
        checked = _saved(found.join(hash_files(changes.to_hash(found), config.source), "file_path", "left"), config, "checked")
    good, bad = checked.where("error is null"), checked.where("error is not null")
    updated = changes.apply_changes(records, good, now, config.compression, config.detect)
    updated = updated.unionByName(changes.stub_failed_checks(bad.select(*inventory.columns), updated, now, config.compression).select(*updated.columns))
    updated, superseded = changes.reroute(updated, config.compression)
    candidates = updated.join(good.select("file_path"), "file_path", "left_semi")
    place = target_path(F.col("file_path"), F.col("remote_tree"), config.target, config.compressed_target)
    there = target_hash(candidates.select(place.alias("file_path")), "/").where("error is null").select("file_path", "hash")
    plan = _saved(changes.order_plan(changes.plan_transfers(candidates, there, config.target, config.compressed_target), config.priority), config, "plan", True)
    superseded = _saved(superseded, config, "superseded", True)
    if dry_run:
        records, state = _saved(records, config, "ledger", True), _saved(state, config, "state", True)
        _end(spark, config)
        return PassResult(plan, None, records, state, None, superseded)
    root = F.when((F.col("remote_tree") == "compressed") & F.lit(bool(config.compressed_target)), F.lit(config.compressed_target or "")).otherwise(F.lit(config.target))
    send = plan.where("needs_transfer").join(updated.select("file_path", "remote_tree"), "file_path")
    send = _saved(send.select("file_path", "file_size_bytes", "rank", place.alias("target_file"), root.alias("target")), config, "send")
    roots = [config.target, *([config.compressed_target] if config.compressed_target else [])]
    room = changes.capacity_check(send, copying.free_space(spark, roots), config.least_free_gb)
    refused = _saved(room.where("refused"), config, "refused", True)
    if refused.limit(1).count():
        records, state = _saved(records, config, "ledger", True), _saved(state, config, "state", True)
        _end(spark, config)
        return PassResult(plan, None, records, state, None, superseded, refused)
    in_codes, halted = send_in_codes(send, updated, config)
    if in_codes is not None:
        send = _saved(send.join(in_codes.select("file_path"), "file_path", "left_anti"), config, "plain")
    cost = F.coalesce("file_size_bytes", F.lit(0)) + F.lit(copying.FILE_COST)
    queue = _saved(running_sum(send, cost, "rank", "file_path"), config, "queue")
    tries, stopped = copy_in_waves(queue, config)
    done = outcomes.apply_outcomes(changes.settle_matches(updated, plan, now), tries, now)
    if in_codes is not None:
        in_codes = _saved(in_codes.where("attempt is not null"), config, "encoded", True)
        done = outcomes.apply_encoded_outcomes(done, in_codes, now)
        done = outcomes.reroute_index_siblings(done, in_codes.where("success").select("file_path"))
    done = _saved(done, config, "ledger", True)
    next_state = _saved(ledger.advance_cursor(state, done, now, config.cursor, config.settle_minutes), config, "state", True)
    _publish(done, next_state, config)
    stats = _saved(reports.sync_stats(scanned, plan, outcomes.resolve_outcomes(outcomes.final_outcomes(tries)), again), config, "stats", True)
    _end(spark, config)
    return PassResult(plan, tries, done, next_state, stats, superseded, None, stopped or halted, in_codes)


def run_verification(spark: SparkSession, config: PassConfig, now: datetime, quarantine: bool = True, older_than: datetime | None = None, byte_budget: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Verify records at both ends: the verdicts and a summary. Mismatches are moved aside and become pending.

    With ``older_than``, only records that were never verified at the target, or last before then; with ``byte_budget``, of these
    the stalest that it covers. With either, the time of the last full verification stays.
    """
    config = _begin(spark, config)
    records = _saved(ledger_store.read_ledger(spark, config.ledger_path), config, "ledger")
    chosen = records if older_than is None else records.join(ledger.unverified(records, older_than).select("file_path"), "file_path", "left_semi")
    if byte_budget is not None:
        chosen = ledger.stalest(chosen, byte_budget)
    local = hash_files(chosen, config.source).where("error is null").select("file_path", "hash")
    local = _saved(local, config, "local")
    artifacts = verify.expand_checks(chosen.join(local.select("file_path", F.col("hash").alias("now_local")), "file_path"), config.target, config.compressed_target)
    target = target_hash(artifacts.select(F.col("artifact").alias("file_path")).distinct(), "/").select(F.col("file_path").alias("artifact"), "hash", "error")
    verdicts = _saved(verify.verify_ledger(chosen, local, target, config.target, config.compressed_target), config, "verdicts", True)
    if quarantine:
        _saved(copying.move_files(verify.quarantine_plan(verdicts, now)), config, "moves")
    done = _saved(verify.apply_verdicts(records, verdicts, now), config, "ledger")
    state = load_state(spark, config)
    state = ledger.update_state(state, done, last_full_verify_time=now) if older_than is None and byte_budget is None else ledger.update_state(state, done)
    _publish(done, _saved(state, config, "state"), config)
    summary = _saved(reports.verify_summary(verdicts), config, "summary", True)
    _end(spark, config)
    return verdicts, summary


def remove_superseded(result: PassResult, config: PassConfig, dry_run: bool = True) -> DataFrame:
    """Copies that a change of tree left behind: ``file_path, old_tree, copy, removed, error``; a dry run only lists them.

    A copy goes only if its record is verified in its new tree.
    """
    place_of = target_path(F.col("file_path"), F.col("old_tree"), config.target, config.compressed_target)
    safe = result.superseded.join(result.ledger.select("file_path", "remote_tree", "transfer_status"), "file_path").where("transfer_status = 'verified' and remote_tree <> old_tree")
    listed = safe.select("file_path", "old_tree", place_of.alias("copy"))
    if dry_run:
        return listed.select("*", F.lit(False).alias("removed"), F.lit(None).cast("string").alias("error"))
    return copying.remove_files(listed)
