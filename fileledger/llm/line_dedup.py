"""Removal of lines that many sites share.

A line's spread is its number of distinct sites. One HyperLogLog sketch per line hash is built and merged by
aggregation, so a line that a third of all documents carry costs one sketch per task. Sketches decide the lines
that are clearly above or below the threshold; those near it get an exact distinct count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, small, text_key

#: Standard errors of an estimate, on either side of the threshold, that count as near.
NEAR_ERRORS = 4


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row for each line that can be boilerplate, with its trimmed text's hash."""
    whole = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("site"),
        *(k.alias(f"t{i}") for i, k in enumerate(text_key(F.col("text").cast("string")))),
        F.posexplode(F.split(F.col("text").cast("string"), "\n")).alias("pos", "line"),
    ).withColumn("line", F.trim("line"))
    return whole.where(F.length("line") >= min_chars).select("doc_id", "site", "t0", "t1", "pos", *(k.alias(f"h{i}") for i, k in enumerate(text_key(F.col("line")))))


def spread_lines(lines: DataFrame, min_sites: int, scratch: Scratch, lg_k: int = 12) -> DataFrame:
    """``lines (h0, h1, site, doc_id, pos)`` to the lines on at least ``min_sites`` sites: ``h0, h1, first``.

    ``first`` is the smallest ``(doc_id, pos)`` at which the line stands. Null sites don't count. The exact counts start
    from distinct (line, site) pairs, so that a task passes on one row a site of a line, however often it has the line.
    """
    sketches = lines.groupBy("h0", "h1").agg(F.hll_sketch_agg("site", lg_k).alias("sketch"), F.min(F.struct("doc_id", "pos")).alias("first"))
    error = NEAR_ERRORS * 1.04 / (2 ** (lg_k / 2))
    low, high = min(min_sites - 1, min_sites * (1 - error)), max(min_sites + 1, min_sites * (1 + error))
    spread = scratch.save(sketches.select("h0", "h1", "first", F.hll_sketch_estimate("sketch").alias("estimate")).where(F.col("estimate") >= low), "spread")
    near = small(spread.where(F.col("estimate") <= high).select("h0", "h1"))
    pairs = lines.where("site is not null").select("h0", "h1", "site").distinct()
    exact = pairs.join(near, ["h0", "h1"], "left_semi").groupBy("h0", "h1").agg(F.count(F.lit(1)).alias("sites"))
    is_near = F.col("estimate") <= high
    return spread.join(exact, ["h0", "h1"], "left").where(F.when(is_near, F.coalesce("sites", F.lit(0)) >= min_sites).otherwise(F.lit(True))).select("h0", "h1", "first")


def line_dedup(docs: DataFrame, min_sites: int = 6, min_chars: int = 1, keep_first: bool = True) -> DataFrame:
    """``docs (doc_id, text, source, ...)`` without the lines that stand on ``min_sites`` sites (sources) or more.

    Lines are parted by ``\\n`` and compared with white space at both ends off (spaces only). Empty ones always stay, and
    those shorter than ``min_chars``, if a caller sets it. With ``keep_first`` a line stays where it first stands (smallest doc_id, then
    position), so that no content leaves the corpus. All columns stay, with ``text`` cleaned; the columns
    ``n_lines`` (before) and ``n_removed`` are added, or replaced if the table has such columns.

    Null text stays null, with 0 lines; an empty text is one empty line. A null doc_id sorts first among the
    places of a line. Repeated rows (same doc_id and text) are one place. A null source is no site.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    lines = scratch.save(_lines(docs, min_chars), "lines")
    common = scratch.save(spread_lines(lines, min_sites, scratch), "common")
    found = lines.join(small(common), ["h0", "h1"])
    if keep_first:
        found = found.where(~(F.struct("doc_id", "pos").eqNullSafe(F.col("first"))))
    gone = found.groupBy(F.col("doc_id").alias("d0"), F.col("t0").alias("d1"), F.col("t1").alias("d2")).agg(F.collect_set("pos").alias("gone"))
    gone = scratch.save(gone, "gone").hint("merge")  # at every size the same plan: texts are shuffled once
    own = docs.select(F.struct(*docs.columns).alias("doc"))  # apart from our own names
    text = F.col("doc.text").cast("string")
    t0, t1 = text_key(text)
    joined = own.join(gone, F.col("doc.doc_id").cast("long").eqNullSafe(F.col("d0")) & (t0 == F.col("d1")) & (t1 == F.col("d2")), "left")
    split = F.split(text, "\n")
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("gone")), lambda i: F.get(split, i))
    cleaned = F.when(F.col("gone").isNull(), text).otherwise(F.array_join(kept, "\n"))
    counts = [F.when(text.isNull(), F.lit(0)).otherwise(F.size(split)).alias("n_lines"), F.when(F.col("gone").isNull(), F.lit(0)).otherwise(F.size("gone")).alias("n_removed")]
    return joined.select(*(cleaned.alias(c) if c == "text" else F.col(f"doc.`{c}`") for c in docs.columns if c not in ("n_lines", "n_removed")), *counts)


def drop_boilerplate(docs: DataFrame, **options) -> DataFrame:
    """:func:`line_dedup` as a stage: the columns of ``docs``, ``n_chars`` brought up to date; documents that had nothing but lines kept elsewhere go."""
    named = docs.withColumnsRenamed({c: f"own {c}" for c in docs.columns if c in ("n_lines", "n_removed")})
    out = line_dedup(named, **options).where("n_removed = 0 or trim(text) <> ''")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*(F.col(f"own {c}").alias(c) if c in ("n_lines", "n_removed") else F.col(f"`{c}`") for c in docs.columns))
