import itertools
import zlib

import numpy as np
import pytest

from fileledger.llm import lang_id as L


def plain_marginals(scores, moves):
    """Sums over all label sequences."""
    n, k = scores.shape
    out = np.zeros((n, k))
    for path in itertools.product(range(k), repeat=n):
        weight = np.exp(sum(scores[i, y] for i, y in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:])))
        for i, y in enumerate(path):
            out[i, y] += weight
    return out / out.sum(axis=1, keepdims=True)


def slow_marginals(scores, moves):
    """Word after word, in logarithms."""
    n, k = scores.shape
    a, b = np.zeros((n, k)), np.zeros((n, k))
    a[0] = scores[0]
    for t in range(1, n):
        a[t] = scores[t] + np.logaddexp.reduce(a[t - 1][:, None] + moves, axis=0)
    for t in reversed(range(n - 1)):
        b[t] = np.logaddexp.reduce(moves + (scores[t + 1] + b[t + 1])[None, :], axis=1)
    x = a + b
    return np.exp(x - np.logaddexp.reduce(x, axis=1)[:, None])


@pytest.mark.parametrize("k", [1, 2, 3])
def test_forward_backward_against_all_paths(k):
    rng = np.random.default_rng(k)
    lengths = [1, 5, 3, 6, 1]
    scores, moves = rng.normal(size=(sum(lengths), k)) * 3, rng.normal(size=(k, k)) * 2
    for m in (moves, np.zeros((k, k))):
        got, at = L.forward_backward(scores, lengths, m), 0
        for n in lengths:
            assert np.allclose(got[at : at + n], plain_marginals(scores[at : at + n], m))
            at += n


def test_blocks_change_nothing():
    rng = np.random.default_rng(5)
    lengths = [1, 64, 65, 700, 3, 128, 129, 63]
    scores, moves = rng.normal(size=(sum(lengths), 4)) * 8, rng.normal(size=(4, 4))
    got, at = L.forward_backward(scores, lengths, moves), 0
    for n in lengths:
        assert np.allclose(got[at : at + n], slow_marginals(scores[at : at + n], moves), atol=1e-9)
        at += n


def test_gradient_raises_likelihood_and_learns_to_stay():
    rng = np.random.default_rng(1)
    streams = [["aa" + "bc"[i % 2] * int(rng.integers(1, 4)) if i % 3 else "same" for i in range(300)], ["zz" + "bc"[i % 2] * int(rng.integers(1, 4)) if i % 3 else "same" for i in range(300)]]
    weights, moves = L.train(streams, {}, 3, 40, 1e-6)
    model = L.Field(["a", "z"], weights, moves, {})
    assert (np.diag(moves) > moves[::-1].diagonal()).all()
    assert [x for x, _ in L.labelled(iter(["aab same same aac", "zzb same same zzc", None, "12 -", "same zzb"]), model)] == ["a", "z", "und", "und", "z"]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = L.predict_languages(docs).collect()
    assert len(rows) == len(lang) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r.lang_pred == lang[r.doc_id] for r in rows if r.held_out]
    assert len(held) > 1500 and np.mean(held) > 0.995


def test_switching_text_is_labelled_word_by_word(spark, sf):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = L.learn(docs)
    by_lang = {r.lang: r.text for r in docs.where("n_chars between 900 and 1500").groupBy("lang").agg({"text": "min"}).withColumnRenamed("min(text)", "text").collect()}
    pieces = [(lang, by_lang[lang].split()[:30]) for lang in ("en", "fr", "de", "es", "en")]
    words = [w for piece in L.words_of(" ".join(w for _, p in pieces for w in p)) for w in piece]
    scorer = L.Scorer(model)
    ids = np.array([scorer[w] for w in words])
    scorer.label([ids])
    said = [model.langs[i] for i in L.forward_backward(scorer.rows[ids], [len(ids)], model.moves).argmax(axis=1)]
    want = [lang for lang, p in pieces for piece in L.words_of(" ".join(p)) for _ in piece]
    assert len(want) == len(said) and np.mean([x == y for x, y in zip(said, want)]) > 0.9


def test_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.selectExpr("*", "case when doc_id % 3 = 0 then null when doc_id % 2 = 0 then 'xx' else 'yy' end as lang")
    rows = L.predict_languages(docs).collect()
    assert len(rows) == docs.count()
    blank = {3, 4, 5, 10}
    assert all((r.lang_pred == "und") == (r.doc_id in blank or (r.doc_id is None and r.score == 0)) and (r.held_out or r.doc_id is not None) for r in rows)
    assert {r.lang_pred for r in rows} <= {"und", "xx", "yy"}
    assert L.predict_languages(no_docs.selectExpr("*", "'a' as lang")).count() == 0
    assert {(r.lang_pred, r.score) for r in L.predict_languages(odd_docs.selectExpr("*", "cast(null as string) as lang")).collect()} == {("und", 0.0)}


def test_pieces_cut_no_word(monkeypatch):
    text = "Ein Wörtchen, zwei_drei 4fünf " * 50
    whole = [w for p in L.words_of(text) for w in p]
    monkeypatch.setattr(L, "PIECE", 7)
    assert [w for p in L.words_of(text) for w in p] == whole == ["ein", "wörtchen", "zwei", "drei", "fünf"] * 50
