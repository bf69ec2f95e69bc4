import re
from collections import Counter, defaultdict

import pytest

from fileledger.llm import divergence as D

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, least_docs, top):
    rows = [tuple(x or "" for x in r) for r in rows]
    words = [(lang, source, TERM.findall(lower(text))) for text, lang, source in rows]
    out = set()
    for lang in {r[0] for r in words}:
        here = [(s, w) for own, s, w in words if own == lang]
        docs = Counter(t for _, w in here for t in set(w))
        kept = sorted(t for t, n in docs.items() if n >= least_docs)
        counts = defaultdict(Counter)
        for s, w in here:
            counts[s].update(t for t in w if docs[t] >= least_docs)
        whole = sum(counts.values(), Counter())
        n = {s: sum(c.values()) for s, c in counts.items()}

        def p(count, total):
            return 1 + 10**9 * (count + 5) // (total + 5 * len(kept))

        for s in counts:
            pairs = [(-sum(abs(p(counts[s][t], n[s]) - p(counts[o][t], n[o])) for t in kept), o.encode()) for o in counts if o != s]
            terms = [(p(whole[t], whole.total()) - p(counts[s][t], n[s]), t.encode()) for t in kept if counts[s][t]]
            terms = sorted(x for x in terms if x[0] < 0)[:top]
            for part, items in (("pair", sorted(pairs)), ("term", terms)):
                out |= {(lang, s, part, item.decode(), -v, i + 1) for i, (v, item) in enumerate(items)}
    return out


def check(spark, rows, least_docs=30, top=50):
    df = spark.createDataFrame(rows, "text string, lang string, source string").selectExpr("*", "1 as n", "2 as p", "'x' as term", "3 as docs", "'y' as path")
    got = D.source_divergence(df, least_docs, top)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows, least_docs, top)


@pytest.mark.parametrize("small_parts", [False, True])
def test_against_brute_force(spark, sf, small_parts, monkeypatch):
    if small_parts:
        monkeypatch.setattr(D, "HELD", 50)
        monkeypatch.setattr(D, "PIECE", 40)
    rows = [(r.text, r.lang, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check(spark, rows, 5, 7)
    if not small_parts:
        check(spark, rows)


def test_odd_rows(spark):
    rows = [("Éa éa EA ea", "fr", "s1")] * 3 + [(None, "fr", "s2"), ("éa\x7fea_Ea", "fr", None), ("", None, "s1"), (None, None, None), ("a " * 70_000 + "b", "de", "é"), ("a b", "de", "z"), ("b", "de", "z"), ("😀 a b", "de", "s3")]
    for least in (1, 2, 3, 100):
        check(spark, rows, least, 2)
    assert D.source_divergence(spark.createDataFrame([], "text string, lang string, source string")).count() == 0


def test_walk_counts_each_node_once_with_its_multiplicity():
    import pyarrow as pa

    paths = [("x", [("a", 9, 1), ("b", 7, 2)], 3), ("x", [("a", 9, 1), ("b", 7, 2), ("c", 5, 3)], 2), ("x", [("b", 4, 2), ("c", 5, 3)], 1), ("y", [("a", 2, 1), ("c", 8, 1)], 4)]
    batch = pa.RecordBatch.from_pylist([{"lang": lang, "path": [{"source": s, "p": p, "z": z} for s, p, z in path], "m": m} for lang, path, m in paths])
    want = Counter()
    for lang, path, m in paths:
        for i, (b, p, z) in enumerate(path):
            for a, x, y in path[:i]:
                want[lang, a, b] += m * (abs(x - p) - abs(x - z) - abs(y - p) + abs(y - z))
    got = Counter()
    for out in D.walk(iter([batch.slice(0, 1), batch.slice(1)])):
        for r in out.to_pylist():
            got[r["lang"], r["a"], r["b"]] += r["fix"]
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}
