import random

import pytest
from pyspark.sql import functions as F

from knotwork.operators import blocking as B
from knotwork.operators import metrics as M
from knotwork.operators import sampling as P
from knotwork.operators.idf import idf_table
from knotwork.operators.truth import ranked_candidates, truth_pairs
from knotwork.operators.validate import malformed_lines, violations
from knotwork.sources import tables as IO


def test_idf(spark):
    docs = spark.createDataFrame([(c, ["aaa", "aaa", f"t{i}", "zz"]) if i < 2 else (c, [f"tok{i}"]) for c in ("US", None) for i in range(12)], "country string, toks array<string>")
    rows = {r.token: r for r in idf_table(docs, {"name": "toks"}).collect()}
    assert rows["aaa"].df == 2 and rows["aaa"].n_docs == 12 and "zz" not in rows
    import math

    assert rows["aaa"].idf == pytest.approx(math.log(13 / 3) + 1)
    few = spark.createDataFrame([("US", ["abc"])] * 3, "country string, toks array<string>")
    assert idf_table(few, {"name": "toks"}).count() == 0


@pytest.mark.parametrize(("true", "pred", "expected"), [(set(), set(), 1.0), (set(), {"x"}, 0.0), ({"a", "b"}, {"a", "c"}, 0.5), ({"a", "b"}, {"a"}, 0.8333333), ({"a"}, set(), 0.0)])
def test_f_half(spark, true, pred, expected):
    mk = lambda s: spark.createDataFrame([("e", t) for t in s], "s1 string, tgt string")
    row = M.entity_scores(mk(pred), mk(true), spark.createDataFrame([("e",)], "s1 string")).collect()[0]
    assert row.f05 == pytest.approx(expected, abs=1e-6)


def test_sweep_equals_plain_form(spark):
    r = random.Random(3)
    ids = [f"e{i}" for i in range(40)]
    pairs = {(r.choice(ids), f"t{r.randint(0, 9)}"): r.randint(0, 5) for _ in range(150)}
    truth = {(r.choice(ids), f"t{r.randint(0, 9)}") for _ in range(60)}
    df = spark.createDataFrame([(*k, v) for k, v in pairs.items()], "s1 string, tgt string, step int")
    got = {x.step: x.f05 for x in M.sweep(df, spark.createDataFrame(sorted(truth), "s1 string, tgt string"), spark.createDataFrame([(i,) for i in ids], "s1 string"), 5).collect()}

    def f(t, p):
        if not t:
            return float(not p)
        tp = len(t & p)
        return 0.0 if not tp else 1.25 * (tp / len(p)) * (tp / len(t)) / (0.25 * tp / len(p) + tp / len(t))

    for k in range(1, 6):
        per = [f({t for s, t in truth if s == i}, {t for (s, t), v in pairs.items() if s == i and v >= k}) for i in ids]
        assert got[k] == pytest.approx(sum(per) / len(per))


def test_steps(spark):
    rows = spark.createDataFrame([(0.19,), (0.2,), (0.205,), (0.95,), (1.0,), (None,)], "p double").select(M.step_of(F.col("p"), 0.20, 0.01, 76).alias("k")).collect()
    assert [r.k for r in rows] == [0, 1, 1, 76, 76, 0]


def test_margin(spark):
    df = spark.createDataFrame([("e", t, p) for t, p in (("a", 0.98), ("b", 0.60), ("c", 0.90))], "s1 string, tgt string, prob double")
    assert {r.tgt for r in M.within_margin(df, F.lit(0.55)).collect()} == {"a", "c"}


def test_tiers(spark):
    million = B.MILLION
    rows = [("e", f"t{i:02d}", (100 - i) * million, (50 if i == 11 else 0) * million, (20 if i == 10 else 0) * million, 1, 1) for i in range(12)]
    df = spark.createDataFrame(rows, "s1 string, tgt string, score long, name long, addr long, mask int, channels int")
    got = {r.tgt: r["rank"] for r in B.tiered(df, 10).collect()}
    assert len(got) == 10 and {f"t{i:02d}" for i in (0, 1, 2, 3, 4, 5, 10, 11)} <= set(got) and {"t06", "t07"} <= set(got)
    assert sorted(got.values()) == list(range(1, 11)) and got["t00"] == 1
    assert B.tiered(df.limit(0), 10).count() == 0


def test_folds_and_lots(spark):
    e = spark.createDataFrame([(f"e{i}", "US" if i % 3 else None, "x" if i % 2 else None) for i in range(101)], "entity_id string, country string, business_address string")
    n = spark.createDataFrame([(f"e{i}", i % 8) for i in range(101)], "s1 string, n_true int")
    got = P.folds(e, n).collect()
    assert len(got) == 101
    by = {}
    for r in got:
        by.setdefault((r.country, r.match_cardinality, r.has_address), []).append(r.fold_id)
    assert all(max(x.count(k) for k in range(5)) - min(x.count(k) for k in range(5)) <= 1 for x in by.values())
    labelled = spark.createDataFrame([(f"s{i}", f"t{i}", 1 if i < 10 else 0) for i in range(200)], "source1_entity_id string, target_entity_id string, label int")
    kept = P.hard_negatives(labelled)
    assert kept.where("label = 1").count() == 10 and kept.where("label = 0").count() == 30
    assert P.holdout(e, "country", 0.1).count() == 3 + 6


def test_truth_and_candidates(spark):
    t = spark.createDataFrame([("a", "x, y"), ("a", "x, y"), ("b", None), (None, "z")], "s1_id string, target_id string")
    assert {tuple(r) for r in truth_pairs(t).collect()} == {("a", "x"), ("a", "y")}
    c = spark.createDataFrame([("a", "x", 1.0, 3, 2), ("a", "x", 2.0, 1, 1), ("a", "y", float("nan"), 1, 1), ("a", None, None, 1, 1)], "source1_entity_id string, target_entity_id string, candidate_score double, channel_mask int, num_channels int")
    assert [tuple(r) for r in ranked_candidates(c).collect()] == [("a", "x", 2.0, 1, 1, 1)]


def test_violations(spark):
    res = spark.createDataFrame([("S1-1", "S2-1,S2-1"), ("S1-1", ""), ("S1-9", "S1-9"), ("S1-3", "X-1")], "source1_entity_id string, matched_entity_ids string")
    cand = spark.createDataFrame([("S1-1", "S2-1"), ("S1-3", "S2-7")], "source1_entity_id string, candidate_entity_ids string")
    need = spark.createDataFrame([("S1-1",), ("S1-2",), ("S1-3",)], "source1_entity_id string")
    got = {(r.rule, r.id, r.value) for r in violations(res, cand, need).collect()}
    assert got == {
        ("repeated id", "S1-1", "2"), ("missing id", "S1-2", None), ("unknown id", "S1-9", None), ("repeated match", "S1-1", "S2-1"), ("match with itself", "S1-9", "S1-9"),
        ("wrong kind of id", "S1-9", "S1-9"), ("wrong kind of id", "S1-3", "X-1"), ("match that is no candidate", "S1-9", "S1-9"), ("match that is no candidate", "S1-3", "X-1"),
    }


def test_tables(spark, tmp_path):
    p = str(tmp_path / "t.tsv")
    rows = [("S1-1", 'The "A" Co', "1 Mainé St", "US"), ("S1-2", None, "", "India")]
    df = spark.createDataFrame(rows, IO.RAW)
    IO.write_tsv(df, p, "entity_id")
    back = IO.read_tsv(spark, p).orderBy("entity_id").collect()
    assert back[0].business_name == 'The "A" Co' and back[0].business_address == "1 Mainé St" and not back[1].business_name
    q = str(tmp_path / "q")
    assert IO.once(spark, q, lambda: df).count() == 2 and IO.once(spark, q, lambda: 1 / 0).count() == 2
    assert IO.resolve(spark, str(tmp_path / "none.tsv"), p).count() == 2
    with pytest.raises(FileNotFoundError):
        IO.resolve(spark, str(tmp_path / "none"))
    r = str(tmp_path / "r")
    IO.write_parquet(df, r, "country")
    IO.write_parquet(df.where("country = 'US'"), r, "country")
    assert spark.read.parquet(r).count() == 2
    lines = spark.createDataFrame([("a\tb",), ("x\ty",), ("bad",), ("a\tb\tc",)], "value string")
    assert {x.value for x in malformed_lines(lines, "a\tb").collect()} == {"bad", "a\tb\tc"}
    assert '"entity_id": "S1-1"' in IO.to_report(df.limit(1))
    packed = IO.packed_lists(spark.createDataFrame([("S1-1", "b", 2), ("S1-1", "a", 1)], "s1 string, tgt string, rank int"), df).orderBy("source1_entity_id").collect()
    assert [x.matched_entity_ids for x in packed] == ["a,b", ""]


def test_union_blocking_and_forensics(spark):
    from knotwork.functions.normalize import clean_entities
    from knotwork.operators.diagnostics import miss_forensics

    cols = "entity_id string, business_name string, business_address string, country string"
    l = clean_entities(spark.createDataFrame([("S1-1", "Kelmavor Plumbing", "12 Main St 10001", "US"), ("S1-2", None, None, "US")], cols))
    r = clean_entities(spark.createDataFrame([("S2-1", "Kelmavor Plumbing", "9 Side Rd 10001", "US"), ("S2-2", "Kelmavor Plumbing", None, "India"), ("S2-3", None, None, None)], cols))
    got = {(x.s1, x.tgt): x.shared for x in B.union_blocking(l, r).collect()}
    # the whole name, both of its words, the postal code as such and as a word
    assert got == {("S1-1", "S2-1"): 5}
    missed = miss_forensics(spark.createDataFrame([("S1-1", "S2-2"), ("S1-1", "S9-9")], "s1 string, tgt string"), l, r).collect()
    assert [(x.shared_name_tokens, x.shared_addr_tokens, x.same_country, x.edits) for x in missed] == [(2, 0, False, 0)]


def test_samples_repeat(spark):
    df = spark.range(500).select(F.concat(F.lit("e"), "id").alias("entity_id"))
    one = {r.entity_id for r in P.random_sample(df, 20).collect()}
    assert len(one) == 20 and one == {r.entity_id for r in P.random_sample(df.repartition(7), 20).collect()} and one != {r.entity_id for r in P.random_sample(df, 20, seed=1).collect()}
    share = df.select(P.chance(3, F.col("entity_id")).alias("x")).agg(F.avg("x")).collect()[0][0]
    assert 0.4 < share < 0.6


def test_french_guise(spark):
    from knotwork.operators.stress import french_set

    df = spark.createDataFrame([(f"S1-{i}", "Acme Bakery LLC", "12 Main Street", "US") for i in range(300)] + [("S1-x", None, None, None)], "entity_id string, business_name string, business_address string, country string")
    rows = {r.original_entity_id: r for r in french_set(df).collect()}
    assert rows["S1-x"].name == "" and all(r.address == "12 main rue" for k, r in rows.items() if k != "S1-x")
    accented = [r for r in rows.values() if not r.name.isascii()]
    assert 60 < len(accented) < 140 and all(r.country == "France" and r.entity_id == f"FR_SYN_{r.original_entity_id}" for r in rows.values())
    assert any(r.name == "acme bakery sarl" for r in rows.values())
