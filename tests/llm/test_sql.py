"""Queries of the subpackage with SQL, against DuckDB."""

import duckdb
import pytest

from fileledger.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", ["op11_centroid_clusters", "op12_source_divergence"])
def test_query(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = QUERIES[name](spark, sf)
    got = con.execute(ORACLE_SQL[name])
    assert [d[0] for d in got.description] == df.columns
    want = got.fetchall()
    assert want and sorted(map(tuple, df.collect())) == sorted(want)
