from fileledger.llm import line_dedup as D


def brute(rows, sites, chars):
    places = {}
    for d, text, site in rows:
        for pos, line in enumerate((text or "").split("\n") if text is not None else []):
            if len(line.strip(" ")) >= chars:
                places.setdefault(line.strip(" "), []).append((d, pos, site))
    first = {x: min((d, p) for d, p, _ in at) for x, at in places.items() if len({s for _, _, s in at if s is not None}) >= sites}
    return {d: None if t is None else "\n".join(x for pos, x in enumerate(t.split("\n")) if x.strip(" ") not in first or first[x.strip(" ")] == (d, pos)) for d, t, _ in rows}


def test_against_brute_force(spark):
    rows = []
    for i in range(120):
        lines = [f"own line of document number {i} and more"]
        lines += [f"shared by {m} sites, a long line"] * 1 if (m := [2, 5, 6, 7, 30][i % 5]) and i // 5 < m else []
        lines += ["  padded shared line on all the sites   ", "short", ""]
        rows.append((i, "\n".join(lines), f"s{i // 5 % 40}"))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in D.line_dedup(df).collect()}
    assert {d: r.text for d, r in got.items()} == brute(rows, 6, 1)
    assert got[0].n_removed == 0 and got[1].text.endswith('\n') and got[119].n_removed >= 1 and got[3].n_lines == 5


def test_odd_rows(odd_docs, no_docs, spark):
    out = D.line_dedup(odd_docs, min_sites=2)
    rows = out.collect()
    assert len(rows) == odd_docs.count()
    assert {(r.doc_id, r.text is None) for r in rows if r.doc_id in (3, 4)} == {(3, False), (4, True)}
    # the null id sorts first, so the repeated text stays there
    assert [r.n_removed for r in rows if r.doc_id in (1, 2)] == [1, 1, 1]
    assert [r.n_removed for r in rows if r.doc_id is None] == [0, 0]
    assert "pos" in out.columns and D.drop_boilerplate(odd_docs, min_sites=2).columns == odd_docs.columns
    assert D.line_dedup(no_docs).count() == 0
    left = {r.doc_id for r in D.drop_boilerplate(odd_docs, min_sites=2).select("doc_id").collect()}
    assert left == {None, 3, 4, 5, 6, 7, 8, 9, 10, 11}
