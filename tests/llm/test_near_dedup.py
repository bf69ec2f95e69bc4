import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fileledger.llm import near_dedup as N
from fileledger.llm.common import shingles, word_hashes
from fileledger.llm.components import connected_components
from fileledger.llm.common import Scratch

from .conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_set(text, k):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def brute(rows, k, pct=80):
    sets = [(d, plain_set(t, k)) for d, t in rows if d is not None]
    top = {d: d for d, _ in sets}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= pct * len(x | y):
                p, q = sorted((root(a), root(b)))
                top[q] = p
    return {d: root(d) for d in top}


@given(st.text(alphabet="aAbBé \t\n\x0b \x1c.", max_size=40), st.integers(1, 4))
@settings(max_examples=300, deadline=None)
def test_shingles_are_those_of_the_words(text, k):
    assert len(shingles(text, k)) == len(plain_set(text, k))
    assert np.array_equal(shingles(text, k), shingles(text.translate(LOWER), k))


@pytest.mark.parametrize("k", [2, 5])
def test_against_brute_force(spark, k):
    rng = random.Random(k)
    rows, n = [], 0
    for g in range(12):
        base = prose(g, rng.choice([8, 30, 90])).split()
        for _ in range(rng.randint(1, 9)):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(words) // 12))):
                words[rng.randrange(len(words))] = "new%d" % rng.randint(0, 999)
            rows.append((n * 7 % 1009, " ".join(words)))
            n += 1
    rows += [(2000 + i, rows[0][1]) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, k)
    for options in ({}, {"leaders": (), "block": 4}, {"leaders": (1,), "block": 3}, {"share": 1, "block": 3}):
        got = {r.doc_id: r for r in N.near_duplicates(df, k=k, **options).collect()}
        assert {d: r.component_id for d, r in got.items()} == want
        assert all(r.kept == (d == r.component_id) for d, r in got.items())
        assert all(got[d].n_shingles == len(plain_set(t, k)) for d, t in rows)


def test_odd_rows(odd_docs, no_docs):
    got = N.near_duplicates(odd_docs, k=2).collect()
    assert len(got) == odd_docs.count()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert [r.component_id for r in by[2]] == [1, 1] and not by[2][0].kept and by[1][0].kept
    assert all(r.component_id is None and r.kept for r in by[None])
    assert by[8][0].component_id == 7
    for blank in (3, 4, 5, 10):
        assert by[blank][0].n_shingles == 0 and by[blank][0].component_id == blank and by[blank][0].kept
    assert N.near_duplicates(no_docs).collect() == []
    kept = N.dedup(odd_docs, k=2)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect() if r.doc_id is not None) == [1, 3, 4, 5, 6, 7, 9, 10, 11]
    assert [r.text for r in kept.collect() if r.doc_id is None] == [None]
    assert N.dedup(no_docs).collect() == []


def test_one_row_of_each_group_stays(spark):
    a, b, near = prose(1, 60), prose(2, 60), prose(1, 60) + " more"
    rows = [(1, a, "x"), (1, a, "y"), (None, a, "x"), (None, a, "x"), (None, b, "x"), (None, b, "y"), (7, near, "x"), (7, prose(3, 60), "x"), (1, near, "x"), (None, " ", "x"), (None, " ", "x"), (9, None, "x"), (9, None, "x")]
    left = N.dedup(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    groups = lambda texts: sum(r.text in texts for r in left)
    assert groups({a, near}) == 1 and groups({b}) == 1 and groups({prose(3, 60)}) == 1 and groups({" "}) == 2 and groups({None}) == 2 and len(left) == 7
    assert {r.doc_id for r in left if r.text in (a, near)} == {1}


def test_long_words_of_a_known_collision_differ():
    bits = [bin(i).count("1") % 2 for i in range(1 << 12)]
    x, y = "".join("ab"[i] for i in bits), "".join("ba"[i] for i in bits)
    assert word_hashes(x)[0] != word_hashes(y)[0] and word_hashes(x)[0] == word_hashes(x.upper())[0]


def test_bucket_of_many_sizes_above_one_block(spark):
    """All texts share a template, so that buckets are large, and no leader joins them."""
    rng = random.Random(5)
    rows = []
    for i in range(120):
        template = prose(1, 60).split()
        words = template + prose(10 + i // 2, rng.choice([20, 25, 40])).split()
        if i % 2:
            words[rng.randrange(len(words))] = "changed"
        rows.append((i, " ".join(words)))
    got = {r.doc_id: r.component_id for r in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=2, leaders=(1,), block=8).collect()}
    assert got == brute(rows, 2)


def test_bounds_of_the_posterior():
    floors = N.least_agreements(9, 32, 0.8, 1e-7)
    assert floors == sorted(floors) and floors[-1] < 0.8 * 288
    rng = np.random.default_rng(0)
    left = rng.integers(0, 256, (500, 288), dtype=np.uint8)
    right = np.where(rng.random((500, 288)) < 0.8, left, rng.integers(0, 256, (500, 288), dtype=np.uint8)).astype(np.uint8)
    assert N.posterior_filter(left, right, floors, 32).all()
    assert not N.posterior_filter(left, left[::-1].copy(), floors, 32).any()


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 20)] + [(100, i) for i in range(101, 140)] + [(7, 7), (300, 300)]
    got = dict(connected_components(spark.createDataFrame(edges, "u long, v long"), Scratch(spark, "t")).collect())
    assert got == {i: 1 for i in range(1, 21)} | {i: 100 for i in range(100, 140)}
    none = spark.createDataFrame([], "u long, v long")
    assert connected_components(none, Scratch(spark, "t")).collect() == []


def test_early_shingles_find_every_link(spark):
    """All buckets go by their rarest shingles: groups near the threshold, of unequal sizes, on shared templates, with repeats and one-shingle texts."""
    rng = random.Random(8)
    rows, n = [], 0
    for g in range(16):
        base = prose(g % 5, 60).split() + prose(100 + g, rng.choice([6, 14, 40])).split()
        for _ in range(rng.randint(2, 8)):
            words = base[: len(base) - rng.randint(0, 9)]
            for _ in range(rng.randint(0, 8)):
                words[rng.randrange(len(words))] = "new%d" % rng.randint(0, 9999)
            rows.append((n * 13 % 997, " ".join(words)))
            n += 1
    rows += [(2000 + i, t) for i, t in enumerate(["a b", "A b", "b a", "a", rows[3][1], rows[3][1]])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for k, every in ((2, [{"dense": 0, "leaders": ()}, {"dense": 1, "leaders": (), "block": 3}, {"dense": 3}]), (5, [{"dense": 0, "leaders": ()}])):
        want = brute(rows, k)
        for options in every:
            assert {r.doc_id: r.component_id for r in N.near_duplicates(df, k=k, **options).collect()} == want


def test_first_shingles_and_places():
    """Two sets that reach the threshold share an early shingle at places that the test lets through, in any order of rarity."""
    rng = np.random.default_rng(4)
    for pct in (50, 80, 95, 100):
        for _ in range(300):
            size = int(rng.integers(1, 60))
            x = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
            y = np.unique(np.concatenate((x[rng.random(len(x)) < rng.choice([0.8, 0.9, 1.0])], rng.integers(0, 1 << 63, int(rng.integers(0, 1 + size // 4)), dtype=np.uint64))))
            if not len(y) or not N.linked(x, y, pct):
                continue
            counts = rng.integers(0, 3, N.RARITY_SLOTS)
            a, b = (N.first_shingles(s, counts, pct).tolist() for s in (x, y))
            met = [(a.index(s), b.index(s)) for s in set(a) & set(b)]
            n = np.array([len(x), len(y)])
            assert any(N.early_enough(n, np.array(p), np.array([1, 2]), slice(0, 2), 0, pct)[0, 1] for p in met)


def test_texts_of_one_template_are_not_compared_pair_by_pair(spark, monkeypatch):
    base = prose(3, 120).split()

    def text(i):
        rng, words = random.Random(i), list(base)
        for p in rng.sample(range(120), 16):
            words[p] = f"own{rng.randint(0, 10**9)}"
        return " ".join(words)

    sets = [shingles(text(i), 2) for i in range(300)]
    counts = np.zeros(N.RARITY_SLOTS, np.int64)
    for s in sets:
        np.add.at(counts, s & np.uint64(N.RARITY_SLOTS - 1), 1)
    where = {}
    for i, s in enumerate(sets):
        for pos, h in enumerate(N.first_shingles(s, counts, 80).tolist()):
            where.setdefault(h, []).append((i, pos))
    pairs = 0
    for members in where.values():
        i, pos = (np.array(c) for c in zip(*members))
        n = np.array([len(sets[j]) for j in i])
        pairs += int(np.triu(N.early_enough(n, pos, i, slice(0, len(i)), 0, 80), 1).sum())
    assert pairs < 300
    rows = [(i, text(i)) for i in range(300)]
    got = {r.doc_id: r.component_id for r in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=2).collect()}
    assert got == {i: i for i in range(300)}
