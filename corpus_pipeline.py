"""From raw documents to packed training sequences.

Null, empty and very long texts, ties, repeated rows, empty tables and extra columns: each stage does what its operator's
docstring says. Documents with null or empty texts score low and go in the first stage; later stages keep them. Null
doc_ids take part everywhere; columns of any name pass through all stages but the last. Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage before it kept; all but the last return
the columns of ``documents``. ``run`` writes each stage's result to the shared folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fileledger.llm import decontaminate, line_dedup, near_dedup, quality, tier_packing
from fileledger.llm.common import Scratch, passing_tables


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.3 go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of six sites or more stay only where they first stand; documents left without text go."""
    return line_dedup.drop_boilerplate(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity of 0.8 or more."""
    return near_dedup.dedup(docs, k=5, threshold_pct=80)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 1,024 ids or a smaller power of two."""
    return tier_packing.pack_tiers(docs)


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_stage),
    ("decontamination", benchmark_stage),
    ("packing", packing_stage),
]

#: SQL can't express the classifier, MinHash groups, alignments or tokens; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents`` to packed pieces; what a stage read and what it wrote on the way go when its result is written."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with passing_tables():
            done = scratch.save(stage(spark, docs, sf_dir), name)
        scratch.drop(docs)
        docs = done
    return docs
