import random

import pytest
from pyspark.sql import functions as F

from knotwork.operators import skew
from knotwork.operators.skew import Lookup, hot_keys, lookup_join, lookups, many_join


@pytest.fixture(autouse=True)
def small_loads(monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 20)


def test_hot_null_and_missing_keys(spark):
    r = random.Random(0)
    rows = [(i, "hot" if i % 3 else r.choice([None, "gone", f"k{i % 50}"])) for i in range(3000)]
    big = spark.createDataFrame(rows, "id int, k string")
    small = spark.createDataFrame([("hot", 1), *[(f"k{i}", 10 + i) for i in range(50)], ("unused", 7)], "key string, v int")
    known = {"hot": 1, **{f"k{i}": 10 + i for i in range(50)}}
    kept = {x.id: x.out for x in lookup_join(big, "k", small, "key", "v", "out", keep=True).collect()}
    assert kept == {i: known.get(k) for i, k in rows}
    found = {x.id: x.out for x in lookup_join(big, "k", small, "key", "v", "out").collect()}
    assert found == {i: known[k] for i, k in rows if k in known}
    assert lookup_join(big.limit(0), "k", small, "key", "v", "out").count() == 0
    assert lookup_join(big, "k", small.limit(0), "key", "v", "out", keep=True).where(F.col("out").isNotNull()).count() == 0


def test_repeated_rows_stay(spark):
    big = spark.createDataFrame([("a",)] * 5 + [("b",)] * 2, "k string")
    small = spark.createDataFrame([("a", 1), ("b", 2)], "k2 string, v int")
    assert sorted(x.out for x in lookup_join(big, "k", small, "k2", "v", "out").collect()) == [1] * 5 + [2] * 2


def test_four_lookups_read_their_base_once(spark, tmp_path):
    r = random.Random(1)
    rows = [(i, *[r.choice(["hot", None, "gone", f"k{i % 40}"]) for _ in range(4)]) for i in range(2000)]
    spark.createDataFrame(rows, "id int, a string, b string, c string, d string").write.parquet(str(tmp_path / "base"))
    base = spark.read.parquet(str(tmp_path / "base"))
    small = spark.createDataFrame([("hot", "H"), *[(f"k{i}", f"v{i}") for i in range(40)]], "key string, v string")
    known = {"hot": "H", **{f"k{i}": f"v{i}" for i in range(40)}}
    assert set(hot_keys(base, "a")[1]["a"]) >= {"hot", "gone"}
    out = lookups(base, *[Lookup(k, small, "key", "v", f"{k}_out", keep=True) for k in "abcd"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1
    got = {x.id: (x.a_out, x.b_out, x.c_out, x.d_out) for x in out.collect()}
    assert got == {i: tuple(known.get(k) for k in ks) for i, *ks in rows}


def test_copies_of_a_hot_row_are_spread(spark):
    big = spark.range(4000).select(F.lit("hot").alias("k")).repartition(8)
    assert lookup_join(big, "k", spark.createDataFrame([("hot", 1)], "s string, v int"), "s", "v", "out").where("out = 1").count() == 4000


def test_many_to_many(spark, monkeypatch):
    monkeypatch.setattr(skew, "LIST", 7)
    r = random.Random(3)
    key = lambda: r.choice(["hot", None, *[f"k{i}" for i in range(9)]])
    left, right = [(i, key()) for i in range(200)], [(key(), f"v{i}") for i in range(150)] + [("hot", None)]
    got = many_join(spark.createDataFrame(left, "id int, k string"), "k", spark.createDataFrame(right, "key string, v string"), "key", "v", "out").collect()
    expected = {(i, v) for i, k in left for m, v in right if k is not None and k == m and v}
    assert len(got) == len(expected) and {(x.id, x.out) for x in got} == expected
