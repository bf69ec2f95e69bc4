"""Verification of a whole ledger against both ends, and what follows from it."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.paths import normalise, quarantine_path, target_path, with_suffix
from .scan import stamp


def expand_checks(records: DataFrame, root: str, compressed_root: str | None = None) -> DataFrame:
    """One row per record and artifact to check: ``check_order, label, artifact, expected, check_root, check_rel``.

    A plain record has its file. A compressed one has the rebuilt file, checked against its own recorded hash, then the
    encoded file and the sidecar where their hashes are known and there is a compressed root.
    """
    rel = normalise(F.col("file_path"))
    tree_root = F.when((F.col("remote_tree") == "compressed") & F.lit(bool(compressed_root)), F.lit(compressed_root or root)).otherwise(F.lit(root))
    place = target_path(F.col("file_path"), F.col("remote_tree"), root, compressed_root)

    def check(order: int, label: str, artifact, expected, at, path):
        return F.struct(F.lit(order).alias("check_order"), F.lit(label).alias("label"), artifact.alias("artifact"), expected.alias("expected"), at.alias("check_root"), path.alias("check_rel"))

    checks = [F.when(F.col("compressed"), check(1, "rebuilt", place, F.col("remote_checksum"), F.lit(root), rel)).otherwise(check(1, "file", place, F.col("now_local"), tree_root, rel))]
    if compressed_root:
        for order, label, suffix, column in ((2, "encoded", ".flac", "compressed_checksum"), (3, "sidecar", ".json", "sidecar_checksum")):
            path = with_suffix(F.col("file_path"), suffix)
            checks.append(F.when(F.col("compressed") & (F.coalesce(column, F.lit("")) != ""), check(order, label, F.concat(F.lit(compressed_root + "/"), path), F.col(column), F.lit(compressed_root), path)))
    return records.withColumn("check", F.explode(F.filter(F.array(*checks), lambda c: c.isNotNull()))).select("*", "check.*").drop("check")


def verify_ledger(ledger: DataFrame, local: DataFrame, target: DataFrame, root: str, compressed_root: str | None = None) -> DataFrame:
    """A verdict per record: ok, local_missing, local_changed, remote_error or remote_mismatch, with the first bad artifact.

    ``local (file_path, hash)``; ``target (artifact, hash, error)`` with whole paths at the target; an absent artifact is
    an error. Checks are ordered, and the first that isn't ok decides.
    """
    here = local.select("file_path", F.col("hash").alias("now_local"), F.lit(True).alias("present"))
    known = ledger.join(here, "file_path", "left")
    state = F.when(F.col("present").isNull(), "local_missing").when(~F.col("now_local").eqNullSafe(F.col("local_checksum")), "local_changed")
    known = known.withColumn("local_state", state)
    early = known.where(F.col("local_state").isNotNull())
    checks = expand_checks(known.where(F.col("local_state").isNull()), root, compressed_root)
    found = checks.join(target.select("artifact", F.col("hash").alias("found"), F.col("error").alias("read_error"), F.lit(True).alias("there")), "artifact", "left")
    bad = F.when(F.col("there").isNull(), "remote_error").when(F.col("read_error").isNotNull(), "remote_error").when(~F.col("found").eqNullSafe(F.col("expected")), "remote_mismatch")
    error = F.when(F.col("there").isNull(), "not found").otherwise(F.col("read_error"))
    detail = F.struct("check_order", bad.alias("verdict"), "label", "artifact", "expected", "found", error.alias("error"), "check_root", "check_rel")
    judged = found.groupBy("file_path").agg(F.min_by(F.when(bad.isNotNull(), detail), F.when(bad.isNotNull(), F.col("check_order"))).alias("first"), F.first("file_name").alias("file_name"), F.first("now_local").alias("now_local"))
    late = judged.select("file_path", "file_name", "now_local", F.coalesce("first.verdict", F.lit("ok")).alias("verdict"), *(F.col(f"first.{c}").alias(c) for c in ("label", "artifact", "expected", "found", "error", "check_root", "check_rel")))
    nothing = [F.lit(None).cast("string").alias(c) for c in ("label", "artifact", "expected", "found", "error", "check_root", "check_rel")]
    return late.unionByName(early.select("file_path", "file_name", "now_local", F.col("local_state").alias("verdict"), *nothing))


def apply_verdicts(ledger: DataFrame, verdicts: DataFrame, now: datetime | str) -> DataFrame:
    """The ledger after a verification.

    ok stamps both verification times and leaves the status; local_changed takes the new hash and becomes pending;
    remote_mismatch counts and becomes pending; local_missing and remote_error change nothing.
    """
    v = verdicts.select("file_path", F.col("verdict").alias("__v"), F.col("now_local").alias("__local"))
    joined = ledger.join(v, "file_path", "left")
    is_ = lambda *names: F.coalesce(F.col("__v").isin(*names), F.lit(False))
    put = {
        "local_checksum": F.when(is_("local_changed"), F.col("__local")).otherwise(F.col("local_checksum")),
        "transfer_status": F.when(is_("local_changed", "remote_mismatch"), "pending").otherwise(F.col("transfer_status")),
        "failed_checksum_count": F.col("failed_checksum_count") + is_("remote_mismatch").cast("int"),
        "last_verified_local": F.when(is_("ok"), stamp(now)).otherwise(F.col("last_verified_local")),
        "last_verified_remote": F.when(is_("ok"), stamp(now)).otherwise(F.col("last_verified_remote")),
    }
    return joined.select(*(put[n].alias(n) if n in put else F.col(n) for n in ledger.columns))


def quarantine_plan(verdicts: DataFrame, now: datetime | str) -> DataFrame:
    """``artifact, moved_to`` for each mismatch: below ``_mismatched`` of its own root."""
    return verdicts.where(F.col("verdict") == "remote_mismatch").select("artifact", quarantine_path(F.col("check_root"), F.col("check_rel"), stamp(now)).alias("moved_to"))


def hash_chain(links: DataFrame) -> DataFrame:
    """The first broken link of each artifact chain, or intact.

    ``links (file_path, link, link_order, expected, found)``; a missing found hash is a break.
    """
    broken = ~F.col("expected").eqNullSafe(F.col("found"))
    first = F.min_by(F.when(broken, F.col("link")), F.when(broken, F.col("link_order")))
    return links.groupBy("file_path").agg(F.count(F.lit(1)).alias("links"), F.coalesce(first, F.lit("intact")).alias("first_broken"))


def chain_links(ledger: DataFrame, found: DataFrame) -> DataFrame:
    """Links of compressed records: file, samples, encoded file, sidecar and rebuilt file, with the hashes found now.

    ``found (file_path, file_hash, samples_hash, encoded_hash, sidecar_hash, rebuilt_hash)``.
    """
    pairs = [("file", "local_checksum", "file_hash"), ("samples", "data_checksum", "samples_hash"), ("encoded", "compressed_checksum", "encoded_hash"), ("sidecar", "sidecar_checksum", "sidecar_hash"), ("rebuilt", "remote_checksum", "rebuilt_hash")]
    joined = ledger.where("compressed").join(found, "file_path", "left")
    steps = F.array(*(F.struct(F.lit(name).alias("link"), F.lit(i).alias("link_order"), F.col(a).alias("expected"), F.col(b).alias("found")) for i, (name, a, b) in enumerate(pairs, 1)))
    return joined.select("file_path", F.explode(steps).alias("s")).select("file_path", "s.*")

