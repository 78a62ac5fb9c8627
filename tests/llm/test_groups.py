import random

import pytest
from pyspark.sql import functions as F

from knotwork.llm import groups
from knotwork.llm.groups import consolidate
from knotwork.llm.splits import broken_by_folds, components, split
from knotwork.llm.top_n import top_n
from knotwork.operators import skew
from knotwork.operators.skew import hot_keys
from knotwork.session import Scratch


@pytest.fixture(autouse=True)
def small_loads(monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 20)


def roots(edges, nodes):
    p = {n: n for n in nodes}

    def find(x):
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        if a != b:
            p[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def graphs():
    r = random.Random(5)
    yield "chain", [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(200)]
    yield "star", [("hub", f"n{i:03d}") for i in range(300)] + [("n000", "tail")]
    yield "random", [(f"n{r.randint(0, 150)}", f"n{r.randint(0, 150)}") for _ in range(110)]
    yield "self and repeats", [("a", "a"), ("b", "c"), ("c", "b"), ("b", "c"), ("d", "d")]


@pytest.mark.parametrize(("name", "edges"), list(graphs()))
def test_groups_against_union_find(spark, name, edges):
    rows = [*edges, ("lonely", None), (None, "also"), (None, None)]
    df = spark.createDataFrame([(a, b, "x") for a, b in rows], "l string, r string, record_id string")
    expected = roots(edges, {x for e in rows for x in e if x})
    got = consolidate(spark, df, "l", "r").collect()
    assert len(got) == len(expected) and {r.record_id: r.group_id for r in got} == expected


def test_rounds_grow_with_the_logarithm(spark, monkeypatch):
    n, side = 100_000, 316
    i, pad, ids = F.col("id"), lambda c: F.lpad(c.cast("string"), 9, "0"), spark.range(n)
    shapes = {
        "sorted": ids.select(pad(i).alias("a"), pad(i + 1).alias("b")),
        "reversed": ids.select(pad(n - i).alias("a"), pad(n - i - 1).alias("b")),
        "shuffled": ids.select(F.hex(F.xxhash64(i)).alias("a"), F.hex(F.xxhash64(i + 1)).alias("b")),
        "star": ids.select(F.lit("hub").alias("a"), pad(i).alias("b")),
        "grid": ids.select(pad(i).alias("a"), F.explode(F.array(pad(i + 1), pad(i + side))).alias("b")),
    }
    edges = None
    for name, e in shapes.items():
        e = e.select(F.concat(F.lit(name), "a").alias("a"), F.concat(F.lit(name), "b").alias("b"))
        edges = e if edges is None else edges.unionByName(e)
    passes = []
    monkeypatch.setattr(groups, "hot_keys", lambda *a: passes.append(1) or hot_keys(*a))
    labels = groups.labels_of(spark, edges, Scratch(spark))
    shape = F.regexp_extract("id", "^(sorted|reversed|shuffled|star|grid)", 1).alias("shape")
    ends = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    expected = {r.shape: (r.n, r.n, r.least, r.least) for r in ends.groupBy(shape).agg(F.count("*").alias("n"), F.min("id").alias("least")).collect()}
    found = labels.groupBy(shape).agg(F.count("*"), F.count_distinct("id"), F.min("label"), F.max("label")).collect()
    assert {r[0]: tuple(r[1:]) for r in found} == expected and len(expected) == 5
    assert len(passes) - 1 <= 30


def test_no_rows(spark):
    assert consolidate(spark, spark.createDataFrame([], "l string, r string"), "l", "r").count() == 0


@pytest.mark.parametrize(("name", "edges"), list(graphs())[:3])
def test_breadth_first_components(spark, name, edges):
    df = spark.createDataFrame(edges, "a string, b string")
    got = {r.id: r.component for r in components(spark, df, Scratch(spark)).collect()}
    expected = roots(edges, {x for e in edges for x in e if e[0] != e[1]})
    pairs = lambda m: {frozenset(k for k in m if m[k] == v) for v in m.values()}
    assert pairs(got) == pairs({k: expected[k] for k in got}) and set(got) == {x for a, b in edges if a != b for x in (a, b)}


def test_top_n_against_sorting(spark):
    r = random.Random(2)
    rows = [("hot" if r.random() < 0.4 else f"g{r.randint(0, 20)}", f"t{r.randint(0, 60)}", r.choice([1.0, 2.0, 3.5, None, float("nan")]), r.choice([None, 1, 2, 3]), "clash") for _ in range(1500)]
    rows += [("g1", None, 9.0, 1, ""), (None, "t1", 9.0, 1, "")]
    df = spark.createDataFrame(rows, "g string, t string, s double, k int, place string")
    got = {}
    for x in top_n(df, "g", "t", "s", "k", 5, salts=4).collect():
        got.setdefault(x.g, []).append((x.place, x.t))
    best = {}
    for g, t, s, k, _ in rows:
        if g and t and s is not None and s == s:
            key = (-s, k if k is not None else 2**31)
            best.setdefault(g, {})
            best[g][t] = min(best[g].get(t, key), key)
    expected = {g: list(enumerate((t for _, t in sorted((k, t) for t, k in ts.items())[:5]), 1)) for g, ts in best.items()}
    assert {g: sorted(x) for g, x in got.items()} == expected
    assert top_n(df.limit(0), "g", "t", "s", "k", 5).count() == 0
    with pytest.raises(ValueError):
        top_n(df, "g", "t", "s", "k", 0)


def records(spark):
    folds = [("S1-1", "US", 0), (" s1-2 ", "usa", 1), ("S1-3", None, 2), ("S1-4", "IN", 0), ("S1-4", "India", None), ("S1-5", "France", 3), ("S1-5", "FR", 4), (None, "US", 1)]
    matches = [("S1-1", "S2-1, S3-9"), ("S1-2", '"S2-1 | review"'), ("S1-9", "s3-9"), ("S1-3", ""), ("S1-4", None), ("S1-4", "none")]
    f = spark.createDataFrame(folds, "entity_id string, country string, fold_id int")
    return f, spark.createDataFrame(matches, "source1_entity_id string, matched_entity_ids string")


def test_broken_relations(spark):
    f, m = records(spark)
    assert {r.entity_id for r in broken_by_folds(spark, f, m).collect()} == {"S1-1", "S1-2", "S1-5"}
    assert broken_by_folds(spark, f.limit(0), m).count() == 0
    assert {r.entity_id for r in broken_by_folds(spark, f, m.limit(0)).collect()} == {"S1-5"}


def test_split_keeps_groups(spark):
    r = random.Random(7)
    f = spark.createDataFrame([(f"S1-{i}", r.choice(["US", "India", None]), 0) for i in range(600)], "entity_id string, country string, fold_id int")
    m = spark.createDataFrame([(f"S1-{i}", f"S2-{i // 3}") for i in range(600)], "source1_entity_id string, matched_entity_ids string")
    parts = {"train": 0.7, "validation": 0.2, "test": 0.1}
    rows = split(spark, f, m, parts).collect()
    assert len(rows) == 600 == len({x.entity_id for x in rows})
    by, sizes = {}, {}
    for x in rows:
        by.setdefault(x.component, set()).add(x.part)
        sizes.setdefault(x.country, {}).setdefault(x.part, 0)
        sizes[x.country][x.part] += 1
    assert all(len(p) == 1 for p in by.values()) and len(by) == 200
    for c, n in sizes.items():
        total = sum(n.values())
        assert all(abs(n.get(p, 0) - s * total) <= 3 for p, s in parts.items()), (c, n)
    with pytest.raises(ValueError):
        split(spark, f, m, {})
