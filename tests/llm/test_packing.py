import random
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fileledger.llm import best_fit as B
from fileledger.llm import tier_packing as T
from fileledger.llm.tokens import closed_ids, encoder, ids_of


@given(st.text(max_size=200))
@settings(max_examples=200, deadline=None)
def test_twin_vocabulary_gives_the_same_ids(text):
    assert encoder("byte_bpe_50k.json")([text]) == encoder("byte_bpe_50k.json", twin=False)([text])


@given(st.lists(st.sampled_from(["<|endoftext|>", "<|endoftext", "|>", " ", "a", "Wort", "\n", "é", "1"]) | st.text(max_size=5), max_size=12).map("".join))
@settings(max_examples=400, deadline=None)
def test_special_strings_are_tokens(text):
    assert ids_of([text]) == [contract(text)]
    assert ids_of([text])[0].count(50256) == text.count("<|endoftext|>")


def test_twin_vocabulary_on_documents(spark, sf):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    assert encoder("byte_bpe_50k.json")(texts) == encoder("byte_bpe_50k.json", twin=False)(texts)


@lru_cache
def plain_tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def contract(text):
    tokenizer = plain_tokenizer()
    return tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["a <|endoftext|> b", "<|endoftext|>", "a  <|endoftext|>\n<|endoftext|>b", "<|endoftext|", "", "a" + " " * 1_000_000 + "b", "\n" * 1_000_000, "x \t" * 20_000])
def test_closed_ids_are_those_of_the_plain_call(text):
    assert closed_ids([text, "c", text])[2].tolist() == contract(text) + [0]


def test_closed_ids_of_documents_are_those_of_the_plain_call(spark, sf):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(100).select("text").collect()] + ["a <|endoftext|> b"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert [x.tolist() for x in closed_ids(texts)] == [tokenizer.encode(t, add_special_tokens=False).ids + [0] for t in texts]


@given(st.lists(st.integers(1, 64), max_size=60))
@settings(max_examples=200, deadline=None)
def test_windows_are_full_and_lossless(lengths):
    done, rest = T.pack_window([(n, i, 0) for i, n in enumerate(lengths)], 64, 8)
    windows = done + T.lay_out(rest, 64)
    seen = defaultdict(list)
    for size, pieces in windows:
        assert sum(p[0] for p in pieces) == size and size & (size - 1) == 0 and size <= 64
        for n, doc, start in pieces:
            seen[doc].append((start, n))
    for i, n in enumerate(lengths):
        at = 0
        for start, length in sorted(seen[i]):
            assert start == at and length > 0
            at += length
        assert at == n
    assert sum(p[0] for p in rest) < 64


@pytest.mark.parametrize("window", [1 << 19, 3000])
def test_tiers_round_trip(spark, sf, odd_docs, window):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").unionByName(odd_docs.where("doc_id > 2 or doc_id = 1").selectExpr("doc_id + 100000 as doc_id", "text")).repartition(3, "doc_id")
    rows = T.pack_tiers(docs, window_tokens=window).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    ids = dict(zip(texts, closed_ids(list(texts.values()))))
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for d, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids[d]) and r.ids_crc32 == zlib.crc32(ids[d][at : at + r.length].astype("<u4").tobytes())
            at += r.length
        assert at == len(ids[d])
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == pieces[0].context and at & (at - 1) == 0 and at <= 1024
    steps = defaultdict(int)
    for s in {(r.sequence_id, r.step_id, r.context) for r in rows}:
        steps[s[1]] += s[2]
    assert max(steps.values()) <= 1 << 16


def test_odd_rows(odd_docs, no_docs):
    rows = T.pack_tiers(odd_docs).collect()
    assert sum(r.length for r in rows if r.doc_id in (3, 4)) == 2 and {r.ids_crc32 for r in rows if r.doc_id in (3, 4)} == {zlib.crc32(b"\0\0\0\0")}
    assert T.pack_tiers(no_docs).count() == 0 and B.packed_matrix(no_docs).count() == 0
    with pytest.raises(ValueError):
        T.pack_tiers(odd_docs, longest=1000)


@given(st.lists(st.integers(1, 50), max_size=80))
@settings(max_examples=200, deadline=None)
def test_best_fit_is_that_of_a_plain_search(lengths):
    rows, room = [], []
    for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        fits = [i for i in range(len(rows)) if room[i] >= lengths[k]]
        least = min((room[i] for i in fits), default=None)
        if least is None:
            rows.append([]), room.append(50)
            at = len(rows) - 1
        else:
            at = next(i for i in fits if room[i] == least)
        rows[at].append(k)
        room[at] -= lengths[k]
    got = B.best_fit(lengths, 50)
    assert sorted(k for r in got for k in r) == list(range(len(lengths)))
    sums = lambda rs: sorted(sum(lengths[k] for k in r) for r in rs)
    assert len(got) == len(rows) and all(s <= 50 for s in sums(got)) and sums(got) == sums(rows)


@pytest.mark.parametrize("window", [1 << 20, 5000])
def test_matrix_round_trip(spark, sf, window):
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(2)
    rows = B.packed_matrix(docs, size=512, window_tokens=window).collect()
    m = B.as_matrix([r.ids for r in rows])
    assert m.shape == (len(rows), 512) and len({r.row_id for r in rows}) == len(rows)
    parts = defaultdict(dict)
    for r, line in zip(rows, m):
        ends = r.cu_seqlens
        assert ends[0] == 0 and ends[-1] == r.n_tokens and not line[r.n_tokens :].any()
        assert r.resets == (ends[:-1] if r.n_tokens == 512 else ends)
        for a, b, d, s in zip(ends, ends[1:], r.doc_ids, r.doc_starts):
            parts[d][s] = line[a:b]
    texts = {r.doc_id: r.text for r in docs.collect()}
    for d, ids in zip(texts, closed_ids(list(texts.values()))):
        assert np.array_equal(np.concatenate([parts[d][s] for s in sorted(parts[d])]), ids)
    assert sum(r.n_tokens for r in rows) / m.size > 0.9


def test_rows_that_never_fill_do_not_wait_for_the_end(spark):
    n = 300
    docs = spark.createDataFrame([(i, " a" * (1100 + i * 7919 % 800)) for i in range(n)], "doc_id long, text string").coalesce(1)
    rows = sorted(B.packed_matrix(docs, window_tokens=20_000).collect(), key=lambda r: r.row_id)
    assert sorted(d for r in rows for d in r.doc_ids) == list(range(n))
    assert all(max(rows[k].doc_ids) < k + 100 for k in range(n))


def test_tiers_waste_less_than_a_plain_packer(spark):
    rng = random.Random(6)
    docs = spark.createDataFrame([(i, " a" * rng.choice([3, 40, 300, 700, 900, 1500])) for i in range(400)], "doc_id long, text string").coalesce(1)
    rows = T.pack_tiers(docs, window_tokens=20_000).collect()
    lengths = [r.doc_tokens for r in rows if r.start == 0]
    room: list[int] = []
    for n in (min(n - s, 1024) for n in lengths for s in range(0, n, 1024)):  # first fit, documents in order
        at = next((i for i, r in enumerate(room) if r >= n), None)
        if at is None:
            room.append(1024 - n)
        else:
            room[at] -= n
    sizes = {r.sequence_id: r.context for r in rows}
    assert sum(sizes.values()) == sum(lengths) <= 1024 * len(room)  # no padding
    assert sum(n for n in sizes.values() if n == 1024) > 0.8 * sum(lengths)


def test_binary_files_hold_the_matrix(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(3)
    packed = spark.createDataFrame(B.packed_matrix(docs, size=512).collect(), B.packed_matrix(docs).schema).repartition(2)
    files = B.write_matrix(packed, str(tmp_path / "out"), rows=50).collect()
    want = {r.row_id: r for r in packed.collect()}
    assert sum(f.n_rows for f in files) == len(want) and sum(f.n_tokens for f in files) == sum(r.n_tokens for r in want.values()) and max(f.n_rows for f in files) <= 50
    for f in files:
        m = np.memmap(tmp_path / "out" / f"{f.file}.bin", "<u4", "r").reshape(f.n_rows, 512)
        z = np.load(tmp_path / "out" / f"{f.file}.npz")
        for i, row_id in enumerate(z["row_ids"].tolist()):
            r = want.pop(row_id)
            a, b = z["cu_splits"][i : i + 2]
            c, d = z["reset_splits"][i : i + 2]
            assert m[i].tobytes() == r.ids and z["cu_seqlens"][a:b].tolist() == r.cu_seqlens and z["resets"][c:d].tolist() == r.resets
            assert z["doc_ids"][a - i : b - i - 1].tolist() == r.doc_ids and z["doc_starts"][a - i : b - i - 1].tolist() == r.doc_starts
    assert not want and not list((tmp_path / "out").glob("*.part"))
