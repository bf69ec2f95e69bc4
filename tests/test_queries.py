"""Every registered query of the library against its SQL in DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

from fileledger.plans.queries import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return repr(round(v, 9))
    return repr(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    rows = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name not in ORACLE_SQL:
        assert rows
        return
    got = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in got.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert rows == sorted(tuple(plain(r[i]) for i in at) for r in got.fetchall())


def test_every_name_has_a_query():
    assert set(ORACLE_SQL) <= set(QUERIES) and len(QUERIES) > 75
    assert os.path.basename(__file__) == "test_queries.py"
