"""Every query with SQL against DuckDB on the smallest tables."""

import math
import os
from collections import Counter

import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="module")
def con(data):
    c = duckdb.connect()
    c.sql("set timezone='UTC'")
    for f in os.listdir(data):
        c.sql(f"create view {f.removesuffix('.parquet')} as select * from '{data}/{f}'")
    return c


CORE = [n for m in entry._modules() if ".llm." not in m.__name__ for n in m.QUERIES]


@pytest.mark.parametrize("name", sorted(set(CORE) & set(entry.oracle_sql())))
def test_against_sql(name, spark, data, con):
    df = entry.queries()[name](spark, data)
    columns = sorted(df.columns)
    rel = con.sql(entry.oracle_sql()[name])
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    got = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    assert got == Counter(tuple(plain(r[i]) for i in at) for r in rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(CORE) - set(entry.oracle_sql())))
def test_others_run(name, spark, data):
    df = entry.queries()[name](spark, data)
    assert df.columns and df.count() >= 0
