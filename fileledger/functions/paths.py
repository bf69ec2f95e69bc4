"""Paths as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normalise(path: Column) -> Column:
    """Backslashes become slashes."""
    return F.translate(path, "\\", "/")


def first_segment(path: Column) -> Column:
    """The top-level name of a path with at least two segments; null for a file at the root."""
    p = normalise(path)
    return F.when(F.instr(p, "/") > 0, F.substring_index(p, "/", 1))


def base_name(path: Column) -> Column:
    return F.substring_index(normalise(path), "/", -1)


def extension(name: Column) -> Column:
    """From the last dot, with case kept; empty for dotfiles and names that end in a dot."""
    return F.regexp_extract(name, r"(?s)^.+(\.[^.]+)$", 1)


def relative_path(df: DataFrame, root: str, column: str = "path") -> DataFrame:
    """``file_path`` below ``root``, whose trailing slash doesn't matter; a path elsewhere is null."""
    top = root.rstrip("/") + "/"
    return df.withColumn("file_path", F.when(F.col(column).startswith(top), F.substr(F.col(column), F.lit(len(top) + 1), F.length(column))))


def with_suffix(path: Column, suffix: str) -> Column:
    """The last extension replaced, as a name without one gets it added."""
    p = normalise(path)
    cut = F.length(extension(base_name(p)))
    return F.concat(F.substr(p, F.lit(1), F.length(p) - cut), F.lit(suffix))


def desired_tree(ext: Column, compression: bool) -> Column:
    """With compression on, index files belong to the compressed tree, whatever their case."""
    return F.when(F.lit(compression) & (F.lower(F.coalesce(ext, F.lit(""))) == ".tdms_index"), "compressed").otherwise("uncompressed")


def target_path(path: Column, tree: Column, root: str, compressed_root: str | None = None) -> Column:
    """Where a file is at the target; without a compressed root its tree falls back to the main one."""
    return normalise(F.concat_ws("/", F.when((tree == "compressed") & F.lit(bool(compressed_root)), F.lit(compressed_root or root)).otherwise(F.lit(root)), path))


def artifact_paths(df: DataFrame) -> DataFrame:
    """``encoded_path`` and ``sidecar_path`` beside each file."""
    return df.withColumn("encoded_path", with_suffix(F.col("file_path"), ".flac")).withColumn("sidecar_path", with_suffix(F.col("file_path"), ".json"))


def quarantine_path(root: Column, path: Column, at: Column) -> Column:
    """Below ``_mismatched`` of the artifact's own root, under its own name and the time."""
    return F.concat(root, F.lit("/_mismatched/"), path, F.lit("."), F.date_format(at, "yyyyMMdd'T'HHmmss"))


def priority_rank(path: Column, names: list[str]) -> Column:
    """0 for paths whose first segment is named, or if none is named; else 1."""
    if not names:
        return F.lit(0)
    return F.when(F.substring_index(normalise(path), "/", 1).isin(names), 0).otherwise(1)
