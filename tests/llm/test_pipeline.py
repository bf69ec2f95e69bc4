import re
import zlib

import corpus_pipeline as P
from fileledger.llm import decontaminate, quality, tier_packing
from fileledger.llm.common import Scratch
from fileledger.llm.tokens import closed_ids
from pyspark.sql import functions as F

from .test_line_dedup import brute as brute_lines
from .test_near_dedup import brute as brute_near


def test_stages_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    scratch, seen = Scratch(spark, "test"), []
    for name, stage in P.STAGES[:-1]:
        before = docs
        docs = scratch.save(stage(spark, docs, sf), name)
        assert docs.columns == before.columns
        seen.append((before.collect(), docs.collect()))
    scores = {r.doc_id: r.predicted for r in quality.quality_scores(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")).collect()}
    assert {r.doc_id for r in seen[0][1]} == {r.doc_id for r in seen[0][0] if scores[r.doc_id]} and len(seen[0][1]) < len(seen[0][0])
    lines = brute_lines([(r.doc_id, r.text, r.source) for r in seen[1][0]], 6, 1)
    old = {r.doc_id: r.text for r in seen[1][0]}
    assert {r.doc_id: r.text for r in seen[1][1]} == {d: t for d, t in lines.items() if t == old[d] or t.strip(" ")}
    assert all(r.n_chars == len(r.text) for r in seen[1][1])
    groups = brute_near([(r.doc_id, r.text) for r in seen[2][0]], 5)
    assert {r.doc_id for r in seen[2][1]} == {d for d, c in groups.items() if d == c}
    index = decontaminate.build_index([(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()])
    assert {r.doc_id for r in seen[3][1]} == {r.doc_id for r in seen[3][0] if not any(s in decontaminate.normalise(r.text) for s in index.texts)}
    packed = P.run(spark, sf)
    assert packed.agg(F.sum("length")).first()[0] == tier_packing.pack_tiers(docs).agg(F.sum("length")).first()[0]
    kept = {r.doc_id: r.text for r in seen[3][1]}
    ids = dict(zip(kept, closed_ids(list(kept.values()))))
    pieces, sequences = {d: [] for d in kept}, {}
    for r in packed.collect():
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length, r.context))
    for d, found in pieces.items():
        at = 0
        for start, length, crc, tokens in sorted(found):
            assert (start, tokens, crc) == (at, len(ids[d]), zlib.crc32(ids[d][at : at + length].astype("<u4").tobytes()))
            at += length
        assert at == len(ids[d])
    for found in sequences.values():
        at = 0
        for offset, length, _ in sorted(found):
            assert offset == at
            at += length
        assert at == found[0][2] and at & (at - 1) == 0 and at <= 1024


def test_names():
    assert [n for n, _ in P.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "packing"] and all(re.fullmatch(r"\w+", n) for n, _ in P.STAGES)


def test_odd_rows_in_every_stage(spark, sf, odd_docs, no_docs):
    docs, scratch = odd_docs, Scratch(spark, "odd")
    for name, stage in P.STAGES[:-1]:
        assert stage(spark, no_docs, sf).collect() == []
        got = scratch.save(stage(spark, docs, sf), name)
        assert got.columns == docs.columns and got.count() <= docs.count()
    packed = P.packing_stage(spark, odd_docs, sf)
    assert packed.where("start = 0").count() == odd_docs.count() and P.packing_stage(spark, no_docs, sf).count() == 0
