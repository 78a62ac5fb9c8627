"""Blocking without rows of pairs, against brute force."""

from collections import Counter

import numpy as np

from knotwork.operators import blocking as B
from knotwork.operators import grid
from knotwork.operators import staged as G


def texts(rows, n):
    """Packed keys of entities: two common words and a rare one each."""
    r = np.random.default_rng(n)
    return [(f"{rows}{i:04}", "X", sorted({f"c{r.integers(3)}", f"d{r.integers(4)}", f"e{r.integers(40)}"})) for i in range(n)]


def plan(df):
    return df._jdf.queryExecution().toString()


def test_best_passes_no_target_over():
    r = np.random.default_rng(1)
    acc, cut = np.zeros(5_000, dtype=np.int64), 0
    for _ in range(200):
        lists = [np.sort(r.choice(5_000, n, replace=False)).astype(np.int32) for n in r.integers(1, [40, 300, 900, 3_000, 4_000])]
        weights = r.integers(0, [900, 500, 300, 60, 40])
        k = int(r.integers(1, 40))
        total, touched = np.zeros(5_000, dtype=np.int64), np.zeros(5_000, dtype=bool)
        for p, w in zip(lists, weights):
            total[p] += w
            touched[p] = True
        for least in (0, 1):
            c, v, cost = grid._best(lists, weights, k, acc, grid.same, grid.same, least)
            want = sorted((-total[i], i) for i in np.flatnonzero(touched) if total[i] >= least)[:k]
            assert list(zip(-v, c)) == want and not acc.any()
            cut += cost < sum(map(len, lists))
    assert cut > 100  # long lists are mostly not gone through


def sides(spark, left, right):
    l = [(a, c, grid.BETWEEN.join(k), [int(10 * len(x) + (x[0] == "e") * 50) for x in k], [False] * len(k), "") for a, c, k in left]
    a = spark.createDataFrame(l, "s1 string, country string, keys string, weights array<bigint>, sure array<boolean>, words string")
    b = spark.createDataFrame([(a, c, grid.BETWEEN.join(k)) for a, c, k in right], "tgt string, country string, keys string")
    return a, b


def test_sums_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(grid, "ENTITIES", 40)
    monkeypatch.setattr(grid, "TARGETS", 30)
    left, right = texts("l", 120) + [("lone", "Y", ["c1"])], texts("r", 100) + [("none", "X", []), ("away", "Z", ["c1"])]
    a, b = sides(spark, left, right)
    df = grid.best_by_sum(a, b, 7)
    assert "CoGroup" in plan(df)
    weight = lambda x: 10 * len(x) + (x[0] == "e") * 50
    want = {}
    for s, c, k in left:
        found = sorted((-sum(map(weight, set(k) & set(m))), t) for t, d, m in right if c == d and set(k) & set(m))
        want |= {(s, t): (-w, i) for i, (w, t) in enumerate(found[:7], 1)}
    assert {(r.s1, r.tgt): (r.w, r["rank"]) for r in df.collect()} == want


ENTITIES = "entity_id string, country string, name_clean string, name_tokens array<string>, addr_tokens array<string>, postal_clean string"


def test_scored_has_no_rows_of_pairs_and_keeps_sums_of_nothing(spark):
    l = spark.createDataFrame([("a", "X", "foo bar", ["foo", "bar"], [], "")], ENTITIES)
    r = spark.createDataFrame([("t", "X", "bar baz", ["bar", "baz"], [], "")], ENTITIES)
    df = G.summed_blocking(l, r, *G.SUMS["scored"], least=0)
    assert "_list" not in plan(df) and "CoGroup" in plan(df)
    assert [tuple(x) for x in df.collect()] == [("a", "t", 0.0, 1)]  # ln(1 / 1), which the SQL counts


def test_intersection_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(grid, "TARGETS", 30)
    entity = lambda i, c, t, p: (f"{c}{i:03}", "X", " ".join(t), t, p, "")
    side = lambda c, n: [entity(i, c, ["common" + "ab"[i % 2], f"word{i % 9}"], [f"town{i % 5}", "road"]) for i in range(n)]
    left, right = side("l", 40), side("r", 90)
    l, r = spark.createDataFrame(left, ENTITIES), spark.createDataFrame(right, ENTITIES)
    idf = spark.createDataFrame([("X", f, t, 1.0 + len(t)) for f, t in [("name", f"word{i}") for i in range(9)] + [("addr", f"town{i}") for i in range(5)]], "country string, field string, token string, idf double")
    df = B.intersection_blocking(l, r, idf, top=2, k=6)
    assert "CoGroup" in plan(df)
    want = {}
    for s in left:
        shared = [(len(set(s[3]) & set(t[3])), len(set(s[4]) & set(t[4])), t[0]) for t in right]
        found = sorted((-(n + p), t) for n, p, t in shared if n and n + p >= 2)
        want |= {(s[0], t): (-w, i) for i, (w, t) in enumerate(found[:6], 1)}
    assert {(x.s1, x.tgt): (x.shared, x["rank"]) for x in df.collect()} == want


def test_union_counted_without_pairs(spark, monkeypatch):
    monkeypatch.setattr(grid, "ENTITIES", 50)
    monkeypatch.setattr(grid, "TARGETS", 200)
    monkeypatch.setattr(grid, "DENSE", 8)  # some keys as bits, some as lists
    side = lambda c, n: [(f"{c}{i}", "X", "same" * (i % 3 == 0), [f"a{i % 2}", f"b{i % 3}", f"c{i % 50}"], [f"d{i % 4}", f"e{i % 70}", "f"] * (i % 5 > 0), str(1000 + i % 60) * (i % 7 > 0)) for i in range(n)]
    left, right = side("l", 130) + [("bare", "X", "", [], [], "")], side("r", 333) + [("none", "X", "", [], [], "")]
    l, r = spark.createDataFrame(left, ENTITIES), spark.createDataFrame(right, ENTITIES)
    df = B.union_counts(l, r)
    assert "Join Inner" not in plan(df).split("CoGroup")[0] and "CoGroup" in plan(df)
    keys = lambda x: {("n", x[2])} - {("n", "")} | {("t", t) for t in x[3]} | {("a", t) for t in x[4]} | ({("p", x[5])} if x[5] else set())
    want = Counter(n for s in left for t in right if (n := len(keys(s) & keys(t))))
    assert {x["shared"]: x["count"] for x in df.collect()} == want


def test_weighted_has_no_rows_of_pairs_and_confirms_by_words(spark):
    l = spark.createDataFrame([("a", "X", "foo bar", ["foo", "bar"], [], "123")], ENTITIES)
    r = spark.createDataFrame([("t", "X", "bar baz", ["bar", "baz"], [], "123"), ("u", "X", "qux", ["qux"], [], "123")], ENTITIES)
    df = G.summed_blocking(l, r, *G.SUMS["weighted"])
    assert "_list" not in plan(df) and "CoGroup" in plan(df)
    assert [(x.s1, x.tgt, x.score) for x in df.collect()] == [("a", "t", 20.69)]  # postal code 20, token ln(2 / 1); u shares no word
