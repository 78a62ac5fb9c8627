"""Queries with SQL against DuckDB, and a run of the others, on the smallest tables."""

import os
from collections import Counter

import pytest

from knotwork.llm import queries as Q

duckdb = pytest.importorskip("duckdb")


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_against_sql(name, spark, data):
    c = duckdb.connect()
    for f in os.listdir(data):
        c.sql(f"create view {f.removesuffix('.parquet')} as select * from '{data}/{f}'")
    df = Q.QUERIES[name](spark, data)
    columns = sorted(df.columns)
    rel = c.sql(Q.SQL[name])
    at = [rel.columns.index(x) for x in columns]
    assert Counter(tuple(r[x] for x in columns) for r in df.collect()) == Counter(tuple(r[i] for i in at) for r in rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - set(Q.SQL) - {"p1_found", "p5_found"}))
def test_runs(name, spark, data):
    rows = Q.QUERIES[name](spark, data).collect()
    assert len(rows) == len({tuple(r) for r in rows})
