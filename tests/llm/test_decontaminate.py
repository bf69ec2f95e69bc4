import random
import time

import numpy as np

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fileledger.llm import decontaminate as D

from .conftest import prose


def edit_distance_within(pattern, text):
    """The fewest edits between the pattern and any part of the text, by the whole table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


@given(st.text("ab", min_size=4, max_size=14), st.text("abc", min_size=18, max_size=40), st.integers(0, 3))
@settings(max_examples=300, deadline=None)
def test_banded_alignment(pattern, text, budget):
    """The band covers the whole region, so the alignment is that of the whole table."""
    outside = np.full(len(pattern), 0xFFFFFFFF, np.uint32)
    codes, own = np.concatenate((outside, D.codes_of(text), outside)), D.codes_of(pattern)
    want = edit_distance_within(pattern, text)
    for p, r in ((own, codes), (own[::-1], codes[::-1])):
        edits, ends = D.align(np.stack([p, p]), np.stack([r, r]), budget)
        assert edits.tolist() == [min(want, budget + 1)] * 2
        if want == 0:
            assert (r[ends[0] - len(pattern) : ends[0]] == p).all()


def damaged(text, edits, rng):
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out))
        out[at : at + 1] = rng.choice([[], ["q"], [out[at], "q"]])
    return "".join(out)


def test_against_brute_force():
    rng = random.Random(4)
    items = [(i, prose(100 + i, rng.randint(6, 25))) for i in range(9)] + [(90, "short item"), (91, None), (92, "tiny"), (93, ""), (94, "short item"), (None, prose(300, 20))]
    index = D.build_index(items)
    for n in range(40):
        body = prose(1000 + n, rng.randint(0, 40))
        item, text = rng.choice([x for x in items if x[1]])
        body += rng.choice(["", " short item", " Short  item!", " shorts item", "tiny", " tiny"])
        planted = damaged(text, rng.choice([0, 0, 1, 2, 4, 30]), rng) if n % 3 else ""
        doc = (body + "!! " + planted.upper() + " " + prose(5000 + n, 8)) if planted else body
        t = D.normalise(doc)
        want = {o for owners, seg, budget in zip(index.owners, index.texts, index.budgets) if edit_distance_within(seg, t) <= budget for o in owners}
        want |= {i for i, x in items if x and len(x) < 32 and f" {x} " in f" {t} "}
        assert {m[0] for m in D.find_passages(doc, index)} == want


def test_query_finds_planted_and_nothing_else(spark, odd_docs, no_docs):
    passage = prose(77, 30)
    bench = spark.createDataFrame([(1, passage, 0), (2, "tiny", 0), (3, "", 0), (4, "?!", 0), (3, None, 0), (None, prose(78, 30), 0), (1, passage, 0)], "item_id long, text string, edits int")
    docs = odd_docs.select("doc_id", "text", "kept").unionByName(spark.createDataFrame([(50, "before " + passage + " after", "z"), (50, "before " + passage + " after", "z"), (51, prose(78, 30), "z")], "doc_id long, text string, kept string"))
    got = sorted((r.doc_id, r.item_id or 0, r.edits) for r in D.benchmark_matches(docs, bench).collect())
    assert got == [(50, 1, 0), (50, 1, 0), (51, 0, 0)]
    blocks = sorted((r.doc_id, r.item_id or 0, r.edits) for r in D.benchmark_matches(docs, bench, block_chars=1).collect())
    assert set(blocks) == set(got)
    in_blocks = D.drop_contaminated(docs, bench, block_chars=1)
    assert in_blocks.columns == docs.columns and sorted(r.doc_id or 0 for r in in_blocks.collect()) == sorted(r.doc_id or 0 for r in D.drop_contaminated(docs, bench).collect())
    left = D.drop_contaminated(docs, bench)
    assert left.columns == docs.columns and left.count() == odd_docs.count()
    assert D.benchmark_matches(no_docs, bench).count() == 0 and D.benchmark_matches(docs, bench.limit(0)).count() == 0
    assert D.drop_contaminated(docs, bench.limit(0)).count() == docs.count()


def test_short_items_stand_whole_on_word_borders():
    index = D.build_index([(1, "What is the capital of Spain?"), (2, "Paris"), (3, "x"), (None, "42"), (5, "paris!")])
    found = lambda text: sorted((m[0] or 0, m[1:]) for m in D.find_passages(text, index))
    assert found("so: what is the CAPITAL of spain") == [(1, (3, 31, 0, 1))]
    assert found("paris") == [(2, (0, 5, 0, 1)), (5, (0, 5, 0, 1))] and found("comparison parish x1 420") == []
    assert found("X marks 42") == [(0, (8, 10, 0, 1)), (3, (0, 1, 0, 1))] and found("") == found(None) == []


def test_runs_count_what_single_grams_count():
    rng = random.Random(8)
    stock = prose(1, 12)
    items = [(i, (stock[: rng.randint(0, 60)] if i % 2 else "") + prose(10 + i, 14)) for i in range(40)] + [(99, "ab" * 60), (98, prose(10, 14) + prose(11, 14))]
    index = D.build_index(items)
    posted = {}
    for key, run, offset in zip(index.keys.tolist(), index.runs.tolist(), index.offsets.tolist()):
        posted[key] = sorted((s, p + offset) for s, p in zip(index.segments[index.starts[run] : index.starts[run + 1]].tolist(), index.places[index.starts[run] : index.starts[run + 1]].tolist()))
    plain = {}
    for s, t in enumerate(index.texts):
        for p, key in enumerate(D.grams(t, 10).tolist()):
            plain.setdefault(key, []).append((s, p))
    assert posted == {k: sorted(v) for k, v in plain.items()} and len(index.segments) < sum(map(len, plain.values())) / 5


@pytest.mark.parametrize("at_once", [1 << 20, 50])
def test_slices_change_nothing(monkeypatch, at_once):
    items = [(i, prose(7, 9) + prose(100 + i, 12)) for i in range(30)]
    index = D.build_index(items)
    text = " ".join([prose(7, 9) + " and " + prose(900, 5)] * 3 + [items[4][1], items[21][1].replace("a", "b", 2)])
    want = sorted(D.find_passages(text, index))
    monkeypatch.setattr(D, "COUNTS_AT_ONCE", at_once)
    monkeypatch.setattr(D, "ALIGNED_AT_ONCE", 7)
    assert sorted(D.find_passages(text, index)) == want and {4, 21} <= {m[0] for m in want}


def test_stock_phrase_of_thousands_of_items():
    stock = "which of the following statements about the text is "
    items = [(i, stock + prose(i, 8)) for i in range(20_000)]
    index = D.build_index(items)
    text = (stock + "? ") * 10
    D.find_passages(text, index)
    began = time.time()
    assert D.find_passages(text, index) == []
    spent = time.time() - began
    whole = [m[0] for m in D.find_passages(text + items[77][1], index) if m[4] > 1]
    assert whole == [77] and spent < 8, spent
