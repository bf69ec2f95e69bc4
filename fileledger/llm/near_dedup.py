"""MinHash near-deduplication with sequential Bayesian verification.

Texts with equal shingle sets form one class, and only class representatives go on. Banded MinHash keys give
buckets. Within a bucket a few leaders are compared with the members of other components first, links join
components, and a bucket whose members are in one component is done. Small buckets that are left are compared pair by
pair, in the first band that a pair shares. Texts of larger ones, which share a template more often than they are copies,
meet by their rarest shingles instead: two sets that reach the threshold share a shingle among the first of both
in an order from rare to frequent, at places early enough for the overlap that is needed. Buckets of any kind that pass a bound are dealt to
blocks, and each two blocks meet in one group of rows.
Candidate pairs pass a size test, then a comparison of their signatures batch by batch which drops a pair once the
posterior probability that its similarity reaches the threshold is below ``miss``; survivors are confirmed on their
full shingle sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, mix64, shingles, small, strings, text_key
from .components import connected_components

_SEED = 41


def permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(_SEED)
    return (rng.integers(0, 1 << 31, count, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None], rng.integers(0, 1 << 32, count, dtype=np.uint32)[:, None]


def signature(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least value of each permutation over a set of 64-bit hashes."""
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(low), 2048):
        x = a * low[None, i : i + 2048] + b
        x ^= x >> np.uint32(15)
        np.minimum(out, (x * np.uint32(0x2C1B3C6D)).min(axis=1), out=out)
    return out


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band of a signature."""
    key = np.arange(bands, dtype=np.uint64)
    for row in sig[: bands * rows].reshape(bands, rows).T.astype(np.uint64):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + row)
    return key


def least_agreements(batches: int, batch: int, threshold: float, miss: float) -> list[int]:
    """For 1, 2, ... batches of compared one-byte hashes: the fewest agreements with which a pair stays.

    With a uniform prior, after ``a`` agreements of ``m`` the posterior probability that the agreement rate is at
    least ``p`` is the probability that a binomial of ``m + 1`` trials with ``p`` is at most ``a``.
    """
    p = threshold + (1 - threshold) / 256
    out = []
    for m in range(batch, batches * batch + 1, batch):
        total, a = 0.0, -1
        while total < miss:
            a += 1
            total += math.exp(math.lgamma(m + 2) - math.lgamma(a + 1) - math.lgamma(m + 2 - a) + a * math.log(p) + (m + 1 - a) * math.log(1 - p))
        out.append(a)
    return out


def posterior_filter(left: np.ndarray, right: np.ndarray, floors: list[int], batch: int) -> np.ndarray:
    """Which pairs of one-byte signature rows stay after all batches; pairs leave as soon as they fall below."""
    alive = np.arange(len(left))
    agree = np.zeros(len(left), np.int32)
    for i, floor in enumerate(floors):
        cols = slice(i * batch, (i + 1) * batch)
        agree = agree + (left[alive, cols] == right[alive, cols]).sum(axis=1, dtype=np.int32)
        stays = agree >= floor
        alive, agree = alive[stays], agree[stays]
    out = np.zeros(len(left), bool)
    out[alive] = True
    return out


def linked(x: np.ndarray, y: np.ndarray, threshold_pct: int) -> bool:
    """Whether two sorted sets reach the threshold."""
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= threshold_pct * (len(x) + len(y) - common)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, list[int]]]:
    """Sorted rows as tables that end with a group, and where each table's groups begin and end."""
    rest: pa.Table | None = None
    for part in batches:
        rows = pa.Table.from_batches([part])
        rows = rows if rest is None else pa.concat_tables([rest, rows])
        if not rows.num_rows:
            continue
        cols = [rows.column(c).to_numpy() for c in keys]
        cuts = (np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1).tolist()
        if cuts:
            yield rows.slice(0, cuts[-1]), [0, *cuts]
            rows = rows.slice(cuts[-1])
        rest = rows
    if rest is not None and rest.num_rows:
        yield rest, [0, rest.num_rows]


#: Counters of shingles by a part of their hash; they only make the order of shingles, whose every choice is exact.
RARITY_SLOTS = 1 << 20


def first_shingles(hashes: np.ndarray, counts: np.ndarray, threshold_pct: int) -> np.ndarray:
    """The shingles of a set, rare ones first, of which one at least is shared with any set that reaches the threshold."""
    order = np.lexsort((hashes, counts[hashes & np.uint64(RARITY_SLOTS - 1)]))
    return hashes[order[: len(hashes) - -(-threshold_pct * len(hashes) // 100) + 1]]


def early_enough(n: np.ndarray, pos: np.ndarray, rank: np.ndarray, rows: slice, at: int, threshold_pct: int) -> np.ndarray:
    """Which pairs (``rows`` x from ``at`` on) of sets with a common shingle at these places may have it as their first one.

    The smaller set of a pair (by size, then ``rank``) has it among ``n - ceil(2 t n / (1 + t)) + 1`` first ones, as its partner is no
    smaller; and what follows in both must be enough for the overlap ``t (n + m) / (1 + t)``.
    """
    leads = pos < n - -(-2 * threshold_pct * n // (100 + threshold_pct)) + 1
    left, right, x, y = n[rows, None], n[None, at:], rank[rows, None], rank[None, at:]
    ok = np.where((left < right) | ((left == right) & (x < y)), leads[rows, None], leads[None, at:])
    rest = n - pos
    return ok & ((100 + threshold_pct) * np.minimum(rest[rows, None], rest[None, at:]) >= threshold_pct * (left + right))


def block_pairs(n: np.ndarray, comp: np.ndarray, slot: np.ndarray, sigs: np.ndarray, across: bool, floors: list[int], batch: int, threshold_pct: int, places: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Of one group of rows, the places of the pairs of different components that may reach the threshold; with ``across`` only pairs of different slots, with ``places`` (of the common shingle, and ids) only early ones."""
    size, kept = len(n), [(np.empty(0, np.int64), np.empty(0, np.int64))]
    for at in range(0, size, 128):  # a strip of the matrix of pairs at a time
        rows = slice(at, min(size, at + 128))
        may = comp[rows, None] != comp[None, at:]
        may &= 100 * np.minimum(n[rows, None], n[None, at:]) >= threshold_pct * np.maximum(n[rows, None], n[None, at:])
        if across:
            may &= slot[rows, None] != slot[None, at:]
        if places is not None:
            may &= early_enough(n, *places, rows, at, threshold_pct)
        left, right = np.nonzero(np.triu(may, 1))
        left, right = left + at, right + at
        for k in range(0, len(left), 8192):
            x, y = left[k : k + 8192], right[k : k + 8192]
            stays = posterior_filter(sigs[x], sigs[y], floors, batch)
            kept.append((x[stays], y[stays]))
    return np.concatenate([x for x, _ in kept]), np.concatenate([y for _, y in kept])


def near_duplicates(docs: DataFrame, k: int = 5, threshold_pct: int = 80, **options) -> DataFrame:
    """``docs (doc_id, text, ...)`` to one row per row: ``doc_id, n_shingles, component_id, kept``.

    Two texts are linked if ``100 * |A & B| >= threshold_pct * |A | B|`` for their sets of distinct ``k``-word
    shingles (A-Z lower-cased; the whole sequence if a text has fewer words). ``component_id`` is the smallest
    doc_id reachable over links, ``kept`` says whether that is the row's own.

    Null, empty and blank texts have no shingles and are linked with nothing. A null doc_id lends no id: such a
    row has a null component and is kept. Repeated rows count as one document; of a doc_id that is repeated with
    different texts, each row gets the component of its own text, its id being one node. Other columns are
    ignored, so they may have any names. An empty table gives an empty result.

    The chance that a pair at the threshold shares none of the bands is ``(1 - t**rows) ** bands``, 5e-7 by default;
    all other steps are exact, with no cap on buckets, members or pairs.
    """
    out = components_of(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), k, threshold_pct, **options)
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def components_of(base: DataFrame, k: int, threshold_pct: int, bands: int = 48, rows: int = 6, miss: float = 1e-7, batch: int = 32, leaders: tuple[int, ...] = (1, 8), share: int = 12, block: int = 1024, dense: int = 64) -> DataFrame:
    """``base (doc_id long, text string)`` to ``doc_id, t0, t1, n, comp`` of each row: its text's key, its set's size, its component (null without shingles or id).

    Members of a large group share most bands, and so meet the same leader in most of them. Therefore the first leaders
    meet only one in ``share`` buckets; what they join is left out in all others.
    """
    spark = base.sparkSession
    scratch = Scratch(spark, "near")
    count = bands * rows
    base = base.select("doc_id", "text", *(key.alias(f"t{i}") for i, key in enumerate(text_key(F.col("text")))))
    signed_schema = "doc_id long, t0 long, t1 long, fp1 long, fp2 long, n long, sig binary, bands array<long>"

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = permutations(count)
        for part in batches:
            for at in range(0, part.num_rows, 512):
                piece = part.slice(at, 512)
                fp1, fp2, n, sigs, keys = [], [], [], [], []
                last, row = None, None
                for text in strings(piece.column(1)):
                    if row is None or text != last:
                        h, last = shingles(text, k), text
                        if len(h):
                            s = signature(h, a, b)
                            row = (int(h.sum(dtype=np.uint64).view(np.int64)), int(mix64(h ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)), len(h), (s >> np.uint32(8)).astype(np.uint8).tobytes(), band_keys(s, bands, rows).view(np.int64))
                        else:
                            row = (0, 0, 0, b"", np.empty(0, np.int64))
                    for out, x in zip((fp1, fp2, n, sigs, keys), row, strict=True):
                        out.append(x)
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in keys]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in (0, 2, 3)), pa.array(fp1, pa.int64()), pa.array(fp2, pa.int64()), pa.array(n, pa.int64()), pa.array(sigs, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(keys)))], names=["doc_id", "t0", "t1", "fp1", "fp2", "n", "sig", "bands"])

    signed = scratch.save(base.mapInArrow(sign, signed_schema), "signed")
    classes = scratch.save(signed.where("n > 0 and doc_id is not null").groupBy("fp1", "fp2", "n").agg(F.min("doc_id").alias("cid"), F.first("sig").alias("sig"), F.first("bands").alias("bands")), "classes")

    every = classes.select(F.explode("bands").alias("b"), "cid", "n")
    shared = every.groupBy("b").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("b")
    members = scratch.save(every.join(shared, "b").withColumn("comp", F.col("cid")), "members")
    ids = scratch.save(members.select("cid").distinct(), "ids")
    sigs = scratch.save(classes.select("cid", "sig", "bands").join(ids, "cid"), "sigs")
    texts = scratch.save(base.join(small(ids), F.col("doc_id") == F.col("cid"), "left_semi").select(F.col("doc_id").alias("cid"), "text").distinct(), "texts")

    floors = least_agreements(count // batch, batch, threshold_pct / 100, miss)

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            if part.num_rows:
                left, right = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint8).reshape(part.num_rows, count) for c in ("sa", "sb"))
                yield part.select(["a", "b", "ca", "cb"]).filter(pa.array(posterior_filter(left, right, floors, batch)))

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for part in batches:
            ok = []
            for ta, tb in zip(strings(part.column("ta")), strings(part.column("tb")), strict=True):
                for t in (ta, tb):
                    if t not in held:
                        held[t] = shingles(t, k)
                ok.append(linked(held[ta], held[tb], threshold_pct))
                if len(held) > 128:
                    held = {ta: held[ta]}
            yield part.select(["a", "b", "ca", "cb"]).filter(pa.array(ok, pa.bool_()))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a group that have a likely partner, each with its partners further on; a pair counts in the first band it shares."""
        for rows, cuts in whole_groups(batches, group):
            b, i, j, slot, cid, n, comp = (rows.column(c).to_numpy() for c in (*group, "slot", "cid", "n", "comp"))
            sig = np.frombuffer(b"".join(rows.column("sig").to_pylist()), np.uint8).reshape(len(b), count)
            keys = rows.column("bands").combine_chunks().flatten().to_numpy().reshape(len(b), bands)
            places, partners = [], []
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                left, right = block_pairs(n[lo:hi], comp[lo:hi], slot[lo:hi], sig[lo:hi], bool(i[lo] != j[lo]), floors, batch, threshold_pct)
                if len(left):
                    left, right = left + lo, right + lo
                    first = np.concatenate([keys[x, (keys[x] == keys[y]).argmax(axis=1)] for x, y in ((left[k : k + 2048], right[k : k + 2048]) for k in range(0, len(left), 2048))])
                    left, right = left[first == b[lo]], right[first == b[lo]]
                for at in np.union1d(left, right).tolist():
                    places.append(at)
                    partners.append(cid[right[left == at]])
            offsets = np.concatenate(([0], np.cumsum([len(p) for p in partners]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*(pa.array(c[places]) for c in (b, i, j, cid, comp)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(partners) if partners else np.empty(0, np.int64)))], names=[*group, "cid", "comp", "partners"])

    def compare_early(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Likely pairs among the rows that share an early shingle."""
        for rows, cuts in whole_groups(batches, group):
            i, j, slot, cid, n, comp, pos = (rows.column(c).to_numpy() for c in ("i", "j", "slot", "cid", "n", "comp", "pos"))
            sig = np.frombuffer(b"".join(rows.column("sig").to_pylist()), np.uint8).reshape(len(i), count)
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                x, y = block_pairs(n[lo:hi], comp[lo:hi], slot[lo:hi], sig[lo:hi], bool(i[lo] != j[lo]), floors, batch, threshold_pct, (pos[lo:hi], cid[lo:hi]))
                x, y = x + lo, y + lo
                x, y = x[cid[x] != cid[y]], y[cid[x] != cid[y]]
                swap = cid[x] > cid[y]
                x, y = np.where(swap, y, x), np.where(swap, x, y)
                for at in range(0, len(x), 1 << 16):
                    u, v = x[at : at + (1 << 16)], y[at : at + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in (cid[u], cid[v], comp[u], comp[v])], names=["a", "b", "ca", "cb"])

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How many texts of this task have shingles of each counter."""
        counts = np.zeros(RARITY_SLOTS, np.int64)
        for part in batches:
            for text in strings(part.column(0)):
                np.add.at(counts, shingles(text, k_words) & np.uint64(RARITY_SLOTS - 1), 1)
        full = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), pa.array(counts[full])], names=["at", "n"])

    def by_early_shingles(some: DataFrame) -> DataFrame:
        """Links between the texts of ``some (cid, comp)``, whatever buckets they share."""
        whole = scratch.save(some.join(texts, "cid"), "dense")
        counts = np.zeros(RARITY_SLOTS, np.int64)
        got = whole.select("text").mapInArrow(tally, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()  # bounded by RARITY_SLOTS
        counts[got["at"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
        rare = spark.sparkContext.broadcast(counts)

        def early(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in batches:
                for at in range(0, part.num_rows, 128):
                    piece = part.slice(at, 128)
                    sets = [shingles(t, k_words) for t in strings(piece.column("text"))]
                    heads = [first_shingles(h, rare.value, threshold_pct) for h in sets]
                    many = [len(h) for h in heads]
                    columns = [np.concatenate(heads).view(np.int64), np.repeat(piece.column("cid").to_numpy(), many), np.repeat([len(h) for h in sets], many), np.repeat(piece.column("comp").to_numpy(), many), np.concatenate([np.arange(m) for m in many])]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["b", "cid", "n", "comp", "pos"])

        rows = scratch.save(whole.select("cid", "comp", "text").mapInArrow(early, "b long, cid long, n long, comp long, pos long"), "early")
        met = rows.groupBy(F.col("b").alias("lb")).agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("lb")
        left = scratch.save(rows.join(met, F.col("b") == F.col("lb"), "left_semi"), "early")
        scratch.drop(rows)
        pairs = in_blocks(left, ["pos"]).repartition(*group).sortWithinPartitions(*group).mapInArrow(compare_early, pair_schema).distinct()
        if tested:
            pairs = pairs.join(reduce(DataFrame.unionByName, tested).select("a", "b"), ["a", "b"], "left_anti")
        pairs = scratch.save(pairs, "pairs")
        both = pairs.join(texts.select(F.col("cid").alias("b"), F.col("text").alias("tb")), "b").join(texts.select(F.col("cid").alias("a"), F.col("text").alias("ta")), "a")
        found = scratch.save(both.select("a", "b", "ca", "cb", "ta", "tb").mapInArrow(confirm, pair_schema), "links")
        scratch.drop(whole, left, pairs)
        return found

    def in_blocks(left: DataFrame, more: list[str]) -> DataFrame:
        """Members ``b, cid, n, comp`` of buckets as rows of groups ``b, i, j`` of bounded size; two members of a bucket that may reach the threshold meet in one group.

        Sets of linked texts have sizes of one class or of two neighbouring ones, so a block meets only blocks of these.
        """
        size_class = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / threshold_pct) + 1e-9).cast("int") if threshold_pct < 100 else F.col("n").cast("int")
        left = left.withColumn("class", size_class)
        blocks = left.groupBy("b", "class").agg(F.ceil(F.greatest(F.count(F.lit(1)) / block, F.sum("n") / (block * 1024))).cast("int").alias("blocks"))
        blocks = blocks.groupBy(F.col("b").alias("lb")).agg(F.map_from_entries(F.collect_list(F.struct("class", "blocks"))).alias("of_class"))
        dealt = left.join(blocks, F.col("b") == F.col("lb")).join(sigs, "cid")
        number = lambda c, i: c.cast("long") * (1 << 32) + i
        dealt = dealt.withColumn("slot", number(F.col("class"), F.pmod(F.xxhash64("cid"), F.try_element_at("of_class", F.col("class")))))
        near = F.filter(F.array(*(F.col("class") + i for i in (-1, 0, 1))), lambda c: F.map_contains_key("of_class", c))
        dealt = dealt.withColumn("other", F.explode(F.flatten(F.transform(near, lambda c: F.transform(F.sequence(F.lit(0), F.try_element_at("of_class", c) - 1), lambda i: number(c, i))))))
        return dealt.select("b", F.least("slot", "other").alias("i"), F.greatest("slot", "other").alias("j"), "slot", "cid", "n", "comp", "sig", *more)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The links that join a group's components, each pair confirmed on full sets; pairs already joined are passed over."""
        for rows, cuts in whole_groups(batches, group):
            cid, comp, partners = (rows.column(c).to_pylist() for c in ("cid", "comp", "partners"))
            found: list[tuple[int, int, int, int]] = []
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                sets: dict[int, list[np.ndarray]] = {}
                comp_of = dict(zip(cid[lo:hi], comp[lo:hi], strict=True))
                for k, text in enumerate(strings(rows.column("text").slice(lo, hi - lo)), lo):
                    sets.setdefault(cid[k], []).append(shingles(text, k_words))
                top = {c: c for c in comp_of.values()}

                def root(c: int, top: dict[int, int] = top) -> int:
                    while top[c] != c:
                        top[c] = c = top[top[c]]
                    return c

                for k in range(lo, hi):
                    for other in partners[k]:
                        x, y = root(comp_of[cid[k]]), root(comp_of[other])
                        if x != y and any(linked(s, t, threshold_pct) for s in sets[cid[k]] for t in sets[other]):
                            top[max(x, y)] = min(x, y)
                            found.append((cid[k], other, comp_of[cid[k]], comp_of[other]))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*found, strict=True) if found else [[]] * 4)], names=["a", "b", "ca", "cb"])

    group = ["b", "i", "j"]
    k_words = k
    pair_schema = "a long, b long, ca long, cb long"
    fits = f"least(n, m.n) * 100 >= {threshold_pct} * greatest(n, m.n) and comp <> m.comp"
    tested: list[DataFrame] = []
    maps: list[DataFrame] = []
    turns = [(leaders[0], share), *((n, 1) for n in leaders)] if leaders else []
    for turn, (count_of, one_in) in enumerate([*turns, (0, 1)]):
        chosen = F.pmod("b", F.lit(one_in)) == 0
        here = members.where(chosen)
        split = here.groupBy(F.col("b").alias("lb")).agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("size"), F.sum("n").alias("bulk"), *(F.min_by(F.struct("cid", "n", "comp"), F.struct(F.xxhash64("cid", F.lit(turn * 100 + i)) if count_of > 1 else F.col("cid"), "cid")).alias(f"l{i}") for i in range(count_of))).where("lo < hi")
        if count_of:
            # more leaders than one are for buckets that won't meet as a whole in the last turn
            heads = scratch.save(split.where(F.col("size") > (dense if count_of > 1 else 0)).select("lb", F.explode(F.array_distinct(F.array(*(f"l{i}" for i in range(count_of))))).alias("m")), "heads")
            if heads.limit(1).count() == 0:
                if one_in > 1 or count_of > 1:
                    continue
                break
            pairs = here.join(heads, F.col("b") == F.col("lb")).where(fits + " and cid <> m.cid")
            pairs = pairs.select(F.least("cid", "m.cid").alias("a"), F.greatest("cid", "m.cid").alias("b"), F.when(F.expr("cid < m.cid"), F.col("comp")).otherwise(F.col("m.comp")).alias("ca"), F.when(F.expr("cid < m.cid"), F.col("m.comp")).otherwise(F.col("comp")).alias("cb")).distinct()
            if tested:
                pairs = pairs.join(reduce(DataFrame.unionByName, tested).select("a", "b"), ["a", "b"], "left_anti")
            pairs = scratch.save(pairs, "pairs")
            tested.append(pairs)
            likely = pairs.join(sigs.select(F.col("cid").alias("b"), F.col("sig").alias("sb")), "b").join(sigs.select(F.col("cid").alias("a"), F.col("sig").alias("sa")), "a").mapInArrow(prune, pair_schema)
            both = likely.join(texts.select(F.col("cid").alias("b"), F.col("text").alias("tb")), "b").join(texts.select(F.col("cid").alias("a"), F.col("text").alias("ta")), "a")
            links = both.mapInArrow(confirm, pair_schema)
        else:  # what the leaders haven't joined
            heads = None
            links, here = None, members.join(split.select("lb", "size"), F.col("b") == F.col("lb"))
            many = here.where(F.col("size") > dense).select("cid", "comp").distinct()
            if many.limit(1).count():
                links = by_early_shingles(many)
            groups = in_blocks(here.where(F.col("size") <= dense).drop("lb", "size"), ["bands"])
            involved = scratch.save(groups.repartition(*group).sortWithinPartitions(*group).mapInArrow(compare, "b long, i long, j long, cid long, comp long, partners array<long>"), "involved")
            few = involved.join(texts, "cid").repartition(*group).sortWithinPartitions(*group).mapInArrow(settle, pair_schema)
            links = few if links is None else links.unionByName(few)
        links = scratch.save(links, "links")
        found = connected_components(links.select(F.col("ca").alias("u"), F.col("cb").alias("v")), scratch)
        maps.append(found)
        scratch.drop(links)
        if heads is None:
            break
        done = heads.select("lb", F.col("m.cid").alias("lc"))
        rest = here.join(done, (F.col("b") == F.col("lb")) & (F.col("cid") == F.col("lc")), "left_anti").join(split.select("lb"), F.col("b") == F.col("lb"), "left_semi")
        rest = rest if one_in == 1 else rest.unionByName(members.where(~chosen))
        rest = rest.join(found, F.col("comp") == F.col("node"), "left").select("b", "cid", "n", F.coalesce("component", "comp").alias("comp"))
        rest = scratch.save(rest, "members")
        scratch.drop(members, heads)
        members = rest
    scratch.drop(members, texts, ids, sigs, *tested)

    labels = classes.select("fp1", "fp2", "n", F.col("cid").alias("comp"))
    for found in maps:
        labels = labels.join(found, F.col("comp") == F.col("node"), "left").select("fp1", "fp2", "n", F.coalesce("component", "comp").alias("comp"))
    return signed.select("doc_id", "t0", "t1", "fp1", "fp2", "n").join(labels, ["fp1", "fp2", "n"], "left").select("doc_id", "t0", "t1", "n", "comp")


#: Ids given to texts without one start here, so that documents with ids are kept before them.
_NAMELESS = 1 << 62


def dedup(docs: DataFrame, k: int = 5, threshold_pct: int = 80, **options) -> DataFrame:
    """One document of each group of :func:`near_duplicates`, with all its columns: of the smallest doc_id, then of the least text hash.

    Rows without a doc_id take part: each distinct text counts as one document with an id above all others. Of rows
    that repeat a document's id and text one stays, whatever their other columns hold. Rows with null, empty and blank texts belong to no
    group and all stay.
    """
    text = F.col("doc.text").cast("string")
    own = docs.select(F.struct(*docs.columns).alias("doc"))  # apart from our own names
    t0, t1 = text_key(text)
    own = own.select("doc", F.coalesce(F.col("doc.doc_id").cast("long"), _NAMELESS + F.pmod(t0, F.lit(1 << 61))).alias("id"), t0.alias("t0"), t1.alias("t1"))
    scratch = Scratch(docs.sparkSession, "dedup")
    found = components_of(own.select(F.col("id").alias("doc_id"), text.alias("text")), k, threshold_pct, **options).where("n > 0")
    found = scratch.save(found.groupBy("doc_id", "t0", "t1").agg(F.first("comp").alias("comp"), F.count(F.lit(1)).alias("rows")), "found")
    first = found.where("doc_id = comp").groupBy("comp").agg(F.min(F.struct("t0", "t1")).alias("first"))
    judged = found.join(first, "comp").withColumn("kept", (F.col("doc_id") == F.col("comp")) & (F.struct("t0", "t1") == F.col("first")))
    judged = scratch.save(judged.where("not kept or rows > 1").select(F.col("doc_id").alias("g"), F.col("t0").alias("g0"), F.col("t1").alias("g1"), "kept"), "judged")
    same = (F.col("id") == F.col("g")) & (F.col("t0") == F.col("g0")) & (F.col("t1") == F.col("g1"))
    out = own.join(small(judged), same, "left_anti")
    repeated = judged.where("kept")
    if repeated.limit(1).count():
        out = out.unionByName(own.join(small(repeated), same, "left_semi").groupBy("id", "t0", "t1").agg(F.first("doc").alias("doc")).select(*own.columns))
    return out.select("doc.*")
