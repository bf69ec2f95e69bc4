"""Benchmark passages in documents, by the q-gram lemma and banded alignment.

Benchmark items are cut into overlapping segments. A document region within ``budget`` edits of a segment of length
``w`` shares at least ``w - q + 1 - budget * q`` character q-grams with it, and all of them lie within ``budget``
diagonals. So q-grams are counted in overlapping bands of diagonals, bands that reach that number are retained, and
a banded alignment verifies them, many at once. Items too short for that are looked up whole, on word borders.

Phrases that many items share cost little: equal segments are one, and q-grams that follow each other in the same
segments are one run, whose segments are looked up once for each place of the run in a text.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, mix64, powers, small, strings, text_key

_OTHER = re.compile(r"[\W_]+")
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Most (segment, band) counts and most alignments held at once.
COUNTS_AT_ONCE, ALIGNED_AT_ONCE = 1 << 20, 1 << 13
#: What stands before and after a text in alignments; no character.
_OUTSIDE = np.uint32(0xFFFFFFFF)


def normalise(text: str | None) -> str:
    """Lower case; every run of anything but letters and digits is one space."""
    return _OTHER.sub(" ", (text or "").lower()).strip()


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def grams(text: str, q: int) -> np.ndarray:
    """A 64-bit hash of the q-gram at each position."""
    codes = codes_of(text).astype(np.uint64)
    n = len(codes) - q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(q):
        out *= _ODD
        out += codes[i : i + n]
    return mix64(out)


@dataclass
class SegmentIndex:
    """The distinct segments of a block of items, the runs of their q-grams, and the short items."""

    q: int
    texts: list[str]
    owners: list[tuple[int | None, ...]]
    budgets: np.ndarray
    floors: np.ndarray
    keys: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    runs: np.ndarray | None = None
    offsets: np.ndarray | None = None
    starts: np.ndarray | None = None
    segments: np.ndarray | None = None
    places: np.ndarray | None = None
    present: np.ndarray | None = None
    band: int = 1
    least: int = 1
    span: int = 1
    short: dict[str, tuple[int | None, ...]] = field(default_factory=dict)
    short_keys: dict[int, np.ndarray] = field(default_factory=dict)


def _gathered(pairs: list[tuple[str, int | None]]) -> dict[str, tuple[int | None, ...]]:
    """Each distinct text with its distinct owners."""
    out: dict[str, dict[int | None, None]] = {}
    for text, owner in pairs:
        out.setdefault(text, {})[owner] = None
    return {text: tuple(owners) for text, owners in out.items()}


def build_index(items: list[tuple[int | None, str | None]], q: int = 10, width: int = 64, step: int = 32, edits: float = 0.0625, least_chars: int = 32) -> SegmentIndex:
    """Index ``(item_id, text)`` pairs. Items with fewer than ``least_chars`` normalised characters must stand in a text whole; empty ones stand in none."""
    cut, short = [], []
    for item, text in items:
        t = normalise(text)
        if len(t) < max(least_chars, 2 * q):
            if t:
                short.append((f" {t} ", item))
            continue
        cut += [(t[at : at + width], item) for at in sorted({*range(0, max(1, len(t) - width + 1), step), max(0, len(t) - width)})]
    owners = _gathered(cut)
    texts = list(owners)
    sizes = np.array([len(t) for t in texts], np.int64)
    budgets = np.minimum((sizes * edits).astype(np.int64), (sizes - q) // q)
    index = SegmentIndex(q, texts, list(owners.values()), budgets, sizes - q + 1 - budgets * q, short=_gathered(short))
    for size in {len(t) for t in index.short}:
        index.short_keys[size] = np.unique(np.concatenate([_window_hashes(codes_of(t), np.zeros(1, np.int64), size) for t in index.short if len(t) == size]))
    if not texts:
        return index
    every = np.concatenate([grams(t, q) for t in texts])
    many = sizes - q + 1
    seg = np.repeat(np.arange(len(texts)), many)
    place = np.arange(len(every)) - np.repeat(np.cumsum(many) - many, many)
    order = np.argsort(every, kind="stable")
    index.keys, starts, counts = np.unique(every[order], return_index=True, return_counts=True)
    # a q-gram goes on a run if it stands in the same segments as the one before it, one place further on
    key_of = np.empty(len(every), np.int64)
    key_of[order] = np.repeat(np.arange(len(starts)), counts)
    here = np.add.reduceat(mix64((seg[order] * 4096 + place[order] + 1).astype(np.uint64)), starts)
    before = np.add.reduceat(mix64((seg[order] * 4096 + place[order]).astype(np.uint64)), starts)
    first = order[starts]
    last = np.where(place[first] > 0, key_of[first - 1], -1)
    goes_on = (last >= 0) & (here[last] == before) & (counts[last] == counts)
    by_place = np.argsort(first, kind="stable")
    heads = np.flatnonzero(~goes_on[by_place])
    head_of = np.repeat(by_place[heads], np.diff(np.append(heads, len(by_place))))
    index.offsets, index.runs = np.empty(len(starts), np.int16), np.empty(len(starts), np.int32)
    index.offsets[by_place] = np.arange(len(by_place)) - np.repeat(heads, np.diff(np.append(heads, len(by_place))))
    index.runs[by_place] = (np.cumsum(~goes_on) - 1)[head_of]
    kept = np.repeat(~goes_on, counts)
    index.segments, index.places = seg[order][kept].astype(np.int32), place[order][kept].astype(np.int16)
    index.starts = np.concatenate(([0], np.cumsum(counts[~goes_on])))
    index.present = np.zeros(1 << 20, bool)
    index.present[(index.keys >> np.uint64(44)).astype(np.int64)] = True
    index.band = int(budgets.max()) + 1
    index.least, index.span = int(index.floors.min()), int(sizes.max()) + index.band
    return index


def _window_hashes(codes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` characters from each start."""
    up, down = powers(len(codes) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes.astype(np.uint64) * up[: len(codes)], dtype=np.uint64)))
    return mix64((sums[starts + size] - sums[starts]) * down[starts])


def short_items(t: str, index: SegmentIndex) -> list[tuple[str, int]]:
    """The short items that stand in a normalised text on word borders, each with its first place in the text."""
    padded = f" {t} "
    codes = codes_of(padded)
    spaces = np.flatnonzero(codes == 32)
    found: dict[str, int] = {}
    for size, keys in index.short_keys.items():
        starts = spaces[spaces + size <= len(codes)]
        starts = starts[codes[starts + size - 1] == 32]
        for at in starts[np.isin(_window_hashes(codes, starts, size), keys)].tolist() if len(starts) else ():
            if (text := padded[at : at + size]) in index.short:
                found.setdefault(text, at)
    return list(found.items())


def align(patterns: np.ndarray, regions: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """For each pattern (row) the fewest edits that turn it into a part of its region, and that part's end; ``budget + 1`` where there are more.

    A region is longer than its pattern by the number of diagonals less one, and all these diagonals are filled, row by
    row for all pairs at once; pairs whose whole row is above the budget leave.
    """
    n, size = patterns.shape
    width = regions.shape[1] - size + 1
    edits, ends = np.full(n, budget + 1), np.zeros(n, np.int64)
    alive, ramp = np.arange(n), np.arange(width, dtype=np.int8)
    row = np.zeros((n, width), np.int8)
    for i in range(size):
        new = row + (regions[:, i : i + width] != patterns[:, i, None])
        np.minimum(new[:, :-1], row[:, 1:] + np.int8(1), out=new[:, :-1])
        row = np.minimum.accumulate(new - ramp, axis=1) + ramp
        np.minimum(row, np.int8(budget + 1), out=row)
        if i % 4 == 3 and not (stays := row.min(axis=1) <= budget).all():
            alive, patterns, regions, row = alive[stays], patterns[stays], regions[stays], row[stays]
            if not len(alive):
                return edits, ends
    edits[alive], ends[alive] = row.min(axis=1), size + row.argmin(axis=1)
    return edits, ends


def candidates(t: str, index: SegmentIndex) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Parts of ``(segment, lowest diagonal, whether the shared q-grams stand in its first half)``: bands with enough shared q-grams."""
    h = grams(t, index.q)
    if not len(h) or not len(index.keys):
        return
    at = np.flatnonzero(index.present[(h >> np.uint64(44)).astype(np.int64)])
    need = index.least
    if len(at) < need:
        return
    slot = np.searchsorted(index.keys, h[at])
    slot[slot == len(index.keys)] = 0
    real = index.keys[slot] == h[at]
    at, slot = at[real], slot[real]
    if len(at) < need:
        return
    # only where enough shared q-grams stand within one segment's reach can a band come up to its floor
    dense = np.zeros(len(at) + 1, np.int64)
    opens = np.flatnonzero(at[need - 1 :] - at[: len(at) - need + 1] < index.span)
    np.add.at(dense, opens, 1)
    np.add.at(dense, opens + need, -1)
    inside = np.cumsum(dense)[:-1] > 0
    at, slot = at[inside], slot[inside]
    if not len(at):
        return
    shift = index.span + 64
    width = len(t) + 2 * shift
    hits, weights = np.unique(index.runs[slot].astype(np.int64) * width + at - index.offsets[slot] + shift, return_counts=True)
    runs, bases = hits // width, hits % width
    many = index.starts[runs + 1] - index.starts[runs]
    wide = 2 * index.band
    reach = width // wide + 3
    slices = -(-int(many.sum()) // COUNTS_AT_ONCE)
    edges = np.linspace(0, len(index.texts), slices + 1).astype(np.int64)
    if slices > 1:  # the runs' segments stand in order, so that a range of segments is a range of each run
        of_run = np.repeat(np.arange(len(index.starts) - 1), np.diff(index.starts)) * len(index.texts) + index.segments
    for low, high in zip(edges, edges[1:], strict=False):
        if slices > 1:
            begin, end = np.searchsorted(of_run, runs * len(index.texts) + low), np.searchsorted(of_run, runs * len(index.texts) + high)
            many = end - begin
        else:
            begin = index.starts[runs]
        if not (total := int(many.sum())):
            continue
        pick = np.repeat(begin, many) + np.arange(total) - np.repeat(np.cumsum(many) - many, many)
        seg, place, weight = index.segments[pick].astype(np.int64), index.places[pick].astype(np.int64), np.repeat(weights, many)
        diagonal = np.repeat(bases, many) - place + shift
        front = weight * (place < index.floors[seg] // 2)
        first = diagonal // wide  # bands of 2 * band diagonals, each overlapping the next by band
        second = np.where(diagonal % wide < index.band, first - 1, first)
        two = second != first
        bands, which = np.unique(np.concatenate((seg * reach + first + 1, (seg * reach + second + 1)[two])), return_inverse=True)
        shared = np.bincount(which, np.concatenate((weight, weight[two])))
        ahead = np.bincount(which, np.concatenate((front, front[two])))
        enough = shared >= index.floors[bands // reach]
        if enough.any():
            bands = bands[enough]
            yield bands // reach, (bands % reach - 1) * wide - 2 * shift, 2 * ahead[enough] > shared[enough]


def find_passages(text: str | None, index: SegmentIndex) -> list[tuple[int | None, int, int, int, int]]:
    """``(item_id, start, end, edits, segments)`` for each item with a segment in the text, and for each short item.

    Places count characters of the normalised text, from the first segment found to the last (a segment's start is its
    end less its length); ``edits`` is the least, ``segments`` the number of different segments.
    """
    t = normalise(text)
    found: dict[int | None, list] = {}

    def note(owners: tuple[int | None, ...], start: int, end: int, edits: int, segment: int | str) -> None:
        for item in owners:
            old = found.get(item)
            if old:
                old[:] = min(old[0], start), max(old[1], end), min(old[2], edits), old[3] | {segment}
            else:
                found[item] = [start, end, edits, {segment}]

    for item, at in short_items(t, index) if index.short else ():
        note(index.short[item], at, at + len(item) - 2, 0, item)
    pad, padded = 2 * index.span, None
    for segs, lows, ahead in candidates(t, index):
        if padded is None:
            padded = np.concatenate((np.full(pad, _OUTSIDE), codes_of(t), np.full(pad, _OUTSIDE)))
        sizes = np.array([len(index.texts[s]) for s in segs.tolist()])
        for size, budget in {*zip(sizes.tolist(), index.budgets[segs].tolist(), strict=True)}:
            mine = np.flatnonzero((sizes == size) & (index.budgets[segs] == budget))
            length = size + 3 * index.band - 1 + 2 * budget
            starts = np.clip(lows[mine] - budget + pad, 0, len(padded) - length)
            # equal regions are one, and each segment is aligned with a region once
            places, which = np.unique(starts, return_inverse=True)
            known: dict[bytes, int] = {}
            region_of = np.array([known.setdefault(padded[p : p + length].tobytes(), i) for i, p in enumerate(places.tolist())])[which]
            _, once, again = np.unique(segs[mine] * len(padded) + region_of, return_index=True, return_inverse=True)
            edits, ends = np.empty(len(once), np.int64), np.empty(len(once), np.int64)
            for k in range(0, len(once), ALIGNED_AT_ONCE):
                some = mine[once[k : k + ALIGNED_AT_ONCE]]
                patterns = codes_of("".join(index.texts[s] for s in segs[some].tolist())).reshape(len(some), size)
                regions = padded[starts[once[k : k + ALIGNED_AT_ONCE]][:, None] + np.arange(length)]
                got, end = np.full(len(some), budget + 1), np.zeros(len(some), np.int64)
                turned = ahead[some]
                # what is known to be alike comes last, so that most of the others leave after a few rows
                likely = np.flatnonzero(turned)[align(patterns[turned, ::-1], regions[turned, ::-1], budget)[0] <= budget]
                likely = np.concatenate((np.flatnonzero(~turned), likely))
                got[likely], end[likely] = align(patterns[likely], regions[likely], budget)
                edits[k : k + ALIGNED_AT_ONCE], ends[k : k + ALIGNED_AT_ONCE] = got, end
            ok = np.flatnonzero(edits[again] <= budget)
            for i, e in zip(ok.tolist(), again[ok].tolist(), strict=True):
                end = min(len(t), int(starts[i] + ends[e]) - pad)
                note(index.owners[segs[mine[i]]], max(0, end - size), end, int(edits[e]), int(segs[mine[i]]))
    return [(item, start, end, edits, len(segments)) for item, (start, end, edits, segments) in found.items()]


def _block_count(benchmark: DataFrame, chars: int) -> int:
    return max(1, -(-(benchmark.agg(F.sum(F.length(F.col("text").cast("string")))).first()[0] or 0) // chars))


def _indexes(benchmark: DataFrame, chars: int, scratch: Scratch, options: dict) -> Iterator[Broadcast]:
    """The benchmark's indexes, in blocks of about ``chars`` characters: each is made in a task, and one at a time is sent to all tasks."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").cast("string").alias("i"), F.col("text").cast("string").alias("t"))
    blocks = _block_count(benchmark, chars)

    def build(group: pd.DataFrame) -> pd.DataFrame:
        rows = [(None if i is None else int(i), t) for i, t in zip(group["i"], group["t"], strict=True)]
        return pd.DataFrame({"block": group["block"].iloc[:1], "index": [pickle.dumps(build_index(rows, **options))]})

    built = items.withColumn("block", F.pmod(F.xxhash64("i", "t"), F.lit(blocks)).cast("int")).groupBy("block").applyInPandas(build, "block int, index binary")
    built = scratch.save(built, "indexes")
    for block in range(blocks):
        for row in built.where(F.col("block") == block).collect():  # one row
            yield spark.sparkContext.broadcast(pickle.loads(row["index"]))


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, block_chars: int = 2_000_000, **options) -> DataFrame:
    """``docs (doc_id, text, ...)``, ``benchmark (item_id, text, ...)`` to one row per document and item found in it.

    Rows: ``doc_id, item_id, first_char, last_char, edits, segments`` (see :func:`find_passages`). Every document is
    read whole, once for each block of the benchmark; only one block's index, of bounded size, is sent to tasks at a time.
    Null and empty texts match nothing, and nothing matches null and empty items; items below ``least_chars`` must stand
    in a text exactly, as whole words. Repeated rows are repeated in the result; null ids stay null, and items with a
    null id count as one. Other columns are ignored.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_id long, first_char long, last_char long, edits int, segments int"
    scratch = Scratch(docs.sparkSession, "decontaminate")
    parts: list[DataFrame] = []
    for shared in _indexes(benchmark, block_chars, scratch, options):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for part in batches:
                rows = [(d, *m) for d, t in zip(part.column(0).to_pylist(), strings(part.column(1)), strict=True) for m in find_passages(t, shared.value)]
                if rows:
                    cols = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, [pa.int64()] * 4 + [pa.int32()] * 2, strict=True)], names=["doc_id", "item_id", "first_char", "last_char", "edits", "segments"])

        parts.append(scratch.save(base.mapInArrow(run, schema), "matches"))
        shared.destroy()
    out = parts[0] if parts else docs.sparkSession.createDataFrame([], schema)
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, block_chars: int = 2_000_000, **options) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found, with all their columns; rows with null and empty texts stay, and so do repeated ones that stay at all."""
    scratch = Scratch(docs.sparkSession, "decontaminate")

    def rows_where(found: bool, df: DataFrame, shared: Broadcast) -> DataFrame:
        at = df.columns.index("text")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in batches:
                yield part.filter(pa.array([bool(find_passages(t, shared.value)) == found for t in strings(part.column(at))], pa.bool_()))

        return df.mapInArrow(run, df.schema)

    blocks = _block_count(benchmark, block_chars)
    texts = docs.select(F.col("text").cast("string").alias("text"))
    gone: list[DataFrame] = []
    for shared in _indexes(benchmark, block_chars, scratch, options):
        if blocks == 1:
            return rows_where(False, docs, shared)
        found = rows_where(True, texts, shared)
        gone.append(scratch.save(found.select(*(k.alias(f"k{i}") for i, k in enumerate(text_key(F.col("text"))))).distinct(), "gone"))
        shared.destroy()
    own = docs.select(F.struct(*docs.columns).alias("doc"))  # apart from our own names
    text = F.col("doc.text").cast("string")
    own = own.select("doc", *(F.when(text.isNotNull(), key).alias(f"t{i}") for i, key in enumerate(text_key(text))))
    for part in gone:
        own = own.join(small(part), (F.col("t0") == F.col("k0")) & (F.col("t1") == F.col("k1")), "left_anti")
    return own.select("doc.*")
