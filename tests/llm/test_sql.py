"""Queries that have SQL, against it, on the smallest tables."""

import os

import pytest

from tracklake.llm.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    got = QUERIES[name](spark, DATA)
    columns = sorted(got.columns)
    want = con.sql(ORACLE_SQL[name])
    assert columns == sorted(want.columns)
    rows = lambda found: sorted(repr(tuple(r)) for r in found)
    assert rows(map(list, got.select(columns).collect())) == rows(want.project(", ".join(f'"{c}"' for c in columns)).fetchall())
