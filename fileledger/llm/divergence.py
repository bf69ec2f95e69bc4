"""Audit of how a language's sources differ in their words, by a frequent-pattern tree of term rows.

Terms are counted in each task first, then by two aggregations. Within a language, a term's row is its path: the sources
in which it occurs, in order, each with its smoothed share there. Equal paths become one with a multiplicity. Sorted
paths are the tree in depth-first order: neighbours that agree up to a depth share the node there, its multiplicity is that
of all paths through it, and its corrections against all its ancestors are added once. The rest of a pair's sum needs no
tree: what all terms would add if they occurred in neither source, and what each source's own terms change in that.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, small, strings

#: ASCII letters in lower case, bytes of other characters as they are, everything else a space.
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: A task hands on its counts once it holds so many.
HELD = 400_000
#: Longer texts are counted piece by piece.
PIECE = 1 << 22
SCALE = 1_000_000_000
ADDED = 5


def pieces(text: str) -> Iterator[list[bytes]]:
    """The terms ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` of a text with A-Z lower-cased, as UTF-8, in pieces that cut no term."""
    data = text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, source, text`` to sums of this task: ``lang, source, term, n, docs``."""
    n: dict[tuple[str, str], Counter] = defaultdict(Counter)
    docs: dict[tuple[str, str], Counter] = defaultdict(Counter)

    def sums() -> Iterator[pa.RecordBatch]:
        for (lang, source), counts in n.items():
            seen, terms = docs[lang, source], list(counts)
            for i in range(0, len(terms), 20_000):
                part = terms[i : i + 20_000]
                columns = [pa.array([lang] * len(part), pa.string()), pa.array([source] * len(part), pa.string()), pa.array(part, pa.binary()).cast(pa.string()), pa.array([counts[t] for t in part], pa.int64()), pa.array([seen[t] for t in part], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])
        n.clear()
        docs.clear()

    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for key, text in zip(zip(langs, sources, strict=True), strings(batch.column(2)), strict=True):
            once: set[bytes] = set()
            for terms in pieces(text):
                n[key].update(terms)
                once.update(terms)
            docs[key].update(once)
        if sum(map(len, n.values())) > HELD:
            yield from sums()
    yield from sums()


def share(count: Column, n: Column, v: Column) -> Column:
    """``1 + floor(10**9 * (count + 5) / (n + 5 * v))``, exact."""
    return F.expr("1L") + F.call_function("div", (count + F.lit(ADDED)).cast("decimal(28,0)") * F.lit(SCALE), (n + F.lit(ADDED) * v).cast("decimal(28,0)")).cast("long")


def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ``lang, path, m`` to sums ``lang, a, b, fix`` over the nodes ``b`` of each batch's tree and their ancestors ``a``.

    Rows in order share a node of depth ``d`` as long as they agree up to it, so all nodes of a depth, their multiplicities and
    their ancestors are found for a whole batch at once. A node that spans batches counts in each with the paths it has there.
    """
    for batch in batches:
        paths = batch.column(1)
        nodes, length = paths.flatten(), np.diff(paths.offsets.to_numpy())
        at = np.concatenate(([0], np.cumsum(length)))
        if not len(nodes):
            continue
        names, langs = nodes.field("source").dictionary_encode(), batch.column(0).dictionary_encode()
        source, p, z = names.indices.to_numpy().astype(np.int64), *(nodes.field(i).to_numpy(zero_copy_only=False) for i in ("p", "z"))
        lang = langs.indices.to_numpy().astype(np.int64)
        through = np.concatenate(([0], np.cumsum(batch.column(2).to_numpy())))
        k = len(names.dictionary)
        total = np.zeros(len(langs.dictionary) * k * k, np.int64)
        same = np.concatenate(([False], lang[1:] == lang[:-1]))  # the row goes through the same node as the one before
        for depth in range(int(length.max())):
            deep = length > depth
            same &= deep & np.concatenate(([False], deep[:-1]))
            i = np.flatnonzero(same)
            x, y = at[i] + depth, at[i - 1] + depth
            same[i] = (source[x] == source[y]) & (p[x] == p[y]) & (z[x] == z[y])
            edges = np.append(np.flatnonzero(~same), len(same))
            first = edges[:-1]
            here = deep[first]
            first, last = first[here], edges[1:][here]
            m, b = through[last] - through[first], at[first] + depth
            for up in range(depth):
                a = at[first] + up
                fix = m * (np.abs(p[a] - p[b]) - np.abs(p[a] - z[b]) - np.abs(p[b] - z[a]) + np.abs(z[a] - z[b]))
                np.add.at(total, (lang[first] * k + source[a]) * k + source[b], fix)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([langs.dictionary.take(pa.array(hit // (k * k))), names.dictionary.take(pa.array(hit // k % k)), names.dictionary.take(pa.array(hit % k)), pa.array(total[hit])], names=["lang", "a", "b", "fix"])


def source_divergence(docs: DataFrame, least_docs: int = 30, top: int = 50) -> DataFrame:
    """``docs (text, lang, source, ...)`` to ``lang, source, part, item, value, rank`` for every language and source that occur.

    A language keeps the terms in at least ``least_docs`` of its rows; repeated rows count each. A term's share in a source, or in
    the whole language, is ``1 + floor(10**9 * (count + 5) / (N + 5 V))`` with ``N`` the count of all ``V`` kept terms there.
    Part ``pair``: each other source of the language and the sum, over kept terms, of the shares' differences (0 without kept
    terms). Part ``term``: each kept term of the source whose share is above the language's, and by how much, to rank ``top``.
    Ranks fall with the value; ties rank by the item's UTF-8 bytes.

    Null texts, languages and sources are empty strings. Texts of any length are counted whole, in pieces. Other columns are
    ignored; an empty table gives an empty result. All sums are exact in longs, as long as a language keeps fewer than 10**9 terms.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "divergence")
    own = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    counted = own.mapInArrow(count_terms, "lang string, source string, term string, n long, docs long")
    counted = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = counted.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("all_n"), F.collect_list(F.struct("source", "n")).alias("counts"))
    terms = scratch.save(terms.where(F.col("docs") >= least_docs).select("lang", "term", "all_n", "counts"), "terms")

    langs = terms.groupBy("lang").agg(F.sum("all_n").alias("all_total"), F.count(F.lit(1)).alias("v"))
    inside = terms.select("lang", "term", "all_n", F.explode("counts").alias("c")).select("lang", "term", "all_n", "c.source", "c.n")
    totals = inside.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = own.select("lang", "source").distinct().join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
    groups = groups.select("lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "all_total", "v")))
    groups = scratch.save(groups.withColumn("z", F.when(F.col("v") > 0, share(F.lit(0), F.col("total"), F.col("v")))), "groups")

    found = inside.join(small(groups), ["lang", "source"])
    found = found.select("lang", "source", "term", share(F.col("n"), F.col("total"), F.col("v")).alias("p"), share(F.col("all_n"), F.col("all_total"), F.col("v")).alias("q"), "z")
    found = scratch.save(found, "found")

    # a term in neither source adds |z - z'|; a term in one of them turns that into |p - z'|
    once = found.groupBy("lang", "source", "p", "z").agg(F.count(F.lit(1)).alias("m")).withColumnRenamed("source", "a")
    others = groups.select("lang", F.col("source").alias("b"), F.col("z").alias("z2"), "v")
    singles = once.join(small(others), "lang").where("a <> b").select("lang", "a", "b", (F.col("m") * (F.abs(F.col("p") - F.col("z2")) - F.abs(F.col("z") - F.col("z2")))).alias("fix"))
    singles = singles.groupBy("lang", "a", "b").agg(F.sum("fix").alias("fix"))

    # a term in both sources: the tree
    paths = found.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("source", "p", "z"))).alias("path")).where(F.size("path") > 1)
    paths = scratch.save(paths.groupBy("lang", "path").agg(F.count(F.lit(1)).alias("m")), "paths")
    both = paths.repartitionByRange("lang", "path").sortWithinPartitions("lang", "path").mapInArrow(walk, "lang string, a string, b string, fix long")

    fixes = singles.unionByName(both).select("lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "fix").groupBy("lang", "a", "b").agg(F.sum("fix").alias("fix"))
    sides = groups.select("lang", F.col("source").alias("a"), F.col("z").alias("z1"))
    pairs = sides.join(others, "lang").where("a < b").join(fixes, ["lang", "a", "b"], "left")
    pairs = pairs.select("lang", "a", "b", F.coalesce(F.col("v") * F.abs(F.col("z1") - F.col("z2")) + F.coalesce("fix", F.lit(0)), F.lit(0)).alias("value"))
    pairs = scratch.save(pairs, "pairs")
    pair = pairs.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), "value")
    pair = pair.unionByName(pairs.select("lang", F.col("b").alias("source"), F.lit("pair").alias("part"), F.col("a").alias("item"), "value"))
    term = found.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pair.withColumn("rank", rank).unionByName(term.withColumn("rank", rank).where(F.col("rank") <= top))
