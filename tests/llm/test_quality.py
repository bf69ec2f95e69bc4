import zlib

import numpy as np

from fileledger.llm import quality as Q


def auc(y, s):
    order = np.argsort(s, kind="stable")
    ranks = np.empty(len(s))
    ranks[order] = np.arange(1, len(s) + 1)
    for v in np.unique(s):
        ranks[s == v] = ranks[s == v].mean()
    pos = y == 1
    return (ranks[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    out = Q.quality_scores(docs, labels)
    rows = out.collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    y = {r.doc_id: r.quality for r in labels.collect()}
    held = [(y[r.doc_id], r.score, r.predicted) for r in rows if r.held_out and r.doc_id in y]
    labels_, scores, said = map(np.array, zip(*held))
    print(auc(labels_, scores), (labels_ == said).mean())
    assert auc(labels_, scores) > 0.97
    assert said[labels_ == 1].mean() > 0.99 and (1 - said[labels_ == 0]).mean() > 0.8
    kept = Q.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {r.doc_id for r in rows if r.predicted}


def plain_scores(docs, labels, features=160, gamma=0.02, ridge=1e-3, bins=500, seed=11):
    """The whole method on all rows at once, without partitions."""
    stats = {d: np.array(Q.statistics(t)) for d, t in docs}
    part = lambda d: zlib.crc32(str(d).encode()) % 5
    known = [(stats[d], y, part(d)) for d, y in labels if d in stats and y in (0, 1) and part(d) != 0]
    x, y, p = (np.array(c) for c in zip(*known))
    d = x.shape[1]
    rng = np.random.default_rng(seed)
    freq, phase = rng.normal(size=(d, features)) * np.sqrt(2 * gamma), rng.uniform(0, 2 * np.pi, features)
    mean, scale = x[p != 1].mean(0), x[p != 1].std(0)
    scale[scale < 1e-9] = 1

    def mapped(x):
        z = np.clip((x - mean) / scale, -6, 6)
        return np.hstack([np.ones((len(z), 1)), np.sqrt(2 / features) * np.cos(z @ freq + phase), z / 6])

    f = mapped(x[p != 1])
    penalty = np.sqrt(ridge * len(f) * np.array([1e-6] + [1.0] * (f.shape[1] - 1)))
    weights = np.linalg.lstsq(np.vstack([f, np.diag(penalty)]), np.concatenate([y[p != 1], np.zeros(f.shape[1])]), rcond=None)[0]
    raw = mapped(x[p == 1]) @ weights
    at = np.clip(((raw + 0.5) * (bins / 2)).astype(int), 0, bins - 1)
    full = np.unique(at)
    n, good = np.array([(at == b).sum() for b in full]), np.array([y[p == 1][at == b].sum() for b in full])
    prior = good.sum() / n.sum()
    values, weight = (good + 0.5 * prior) / (n + 0.5), n
    # min-max formula of isotonic regression
    mean_of = lambda i, j: (values[i : j + 1] * weight[i : j + 1]).sum() / weight[i : j + 1].sum()
    levels = np.array([max(min(mean_of(i, j) for j in range(k, len(full))) for i in range(k + 1)) for k in range(len(full))])
    every = mapped(np.array([stats[d] for d, _ in docs])) @ weights
    return {d: 0.999 * np.interp(r, (full + 0.5) / (bins / 2) - 0.5, levels) + 0.001 * min(max(r, 0), 1) for (d, _), r in zip(docs, every)}


def test_query_against_a_plain_fit(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = {r.doc_id: r.score for r in Q.quality_scores(docs, labels).collect()}
    want = plain_scores([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], [(r.doc_id, r.quality) for r in labels.collect()])
    assert set(got) == set(want)
    # a raw score beside the edge of a bin may fall into the next one
    off = [abs(got[k] - want[k]) for k in want]
    assert np.median(off) < 1e-6 and np.mean(np.array(off) < 1e-6) > 0.97 and max(off) < 0.05


def test_equal_texts_score_alike_whoever_wrote_them(spark):
    d = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    moved = docs.selectExpr("doc_id + 1000000000 as doc_id", "text", "'xx' as lang", "'none' as source", "0 as n_chars")
    got = {r.doc_id: r.score for r in Q.quality_scores(docs.unionByName(moved.select(docs.columns)), labels).collect()}
    assert all(got[k] == got[k + 1_000_000_000] for k in got if k < 1_000_000_000)


def test_isotonic():
    got = Q.isotonic(np.array([1, 1, 2, 1.0]), np.array([0.2, 0.6, 0.3, 0.9]))
    assert np.allclose(got, [0.2, 0.4, 0.4, 0.9])


def test_statistics_sum_over_partitions(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, len(Q.STATISTICS)))
    y = (x[:, 0] > 0).astype(float)
    rows = [(int(i), x[i].tolist(), float(y[i])) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, stats array<double>, y double")
    a, b = Q.fit(df.repartition(1), features=30), Q.fit(df.repartition(7), features=30)
    assert np.allclose(a.score(x), b.score(x), atol=1e-6)
    train = np.array([zlib.crc32(str(i).encode()) % 5 != 1 for i in range(300)])
    f = a.features(x[train])
    w = np.linalg.solve(f.T @ f + 1e-3 * train.sum() * np.diag([1e-6] + [1.0] * (f.shape[1] - 1)), f.T @ y[train])
    assert np.allclose(a.weights, w, atol=1e-6)


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0, "s"), (2, 0, 1, "s"), (6, None, None, "s"), (None, 1, 0, "s"), (9, 0, 0, "s"), (9, 0, 0, "s"), (77, 1, 1, "s"), (11, 1, 0, "s")], "doc_id long, quality int, toxic int, stats string")
    rows = Q.quality_scores(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out for r in rows if r.doc_id is None)
    blank = {round(r.score, 9) for r in rows if r.doc_id in (3, 4, 5, 10)}
    assert len(blank) == 1
    none = Q.quality_scores(odd_docs, labels.limit(0)).collect()
    assert all(abs(r.score - 0.5) < 0.01 for r in none)
    assert Q.quality_scores(no_docs, labels).count() == 0
    assert Q.keep_good(odd_docs, labels.limit(0)).count() == odd_docs.count()
    assert Q.keep_good(odd_docs, labels).columns == odd_docs.columns


def test_statistics_of_a_text():
    s = dict(zip(Q.STATISTICS, Q.statistics("Ab cd cd.\nEF!! x|y")))
    assert s["words"] == np.log1p(5) and s["caps"] == 0.2 and abs(s["bangs"] - 0.4) < 1e-9 and s["marks"] == 0.2
    assert Q.statistics(None) == Q.statistics(" ") == [0.0] * len(Q.STATISTICS)
