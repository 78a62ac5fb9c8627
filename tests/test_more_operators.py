"""Fold isolation, lots, files by line, contracts, and keeping of models."""

from pyspark.sql import functions as F

from knotwork.ml import model
from knotwork.operators import diagnostics as D
from knotwork.operators import sampling as P
from knotwork.operators.validate import contract, unlike_count
from knotwork.sources import tables as IO


def test_places_by_lot_are_those_of_one_order(spark):
    df = spark.range(5000).select(F.concat(F.lit("e"), "id").alias("entity_id"), F.when(F.col("id") % 3 == 0, "US").when(F.col("id") % 7 == 0, None).otherwise("India").alias("c"))
    rows = [(r.entity_id, r.c, r._k, r._n) for r in P.placed_by_lot(df, ["c"], 42, "entity_id").collect()]
    assert len(rows) == 5000
    lots = {r.entity_id: r.l for r in df.select("entity_id", P.lot(42, "entity_id").alias("l")).collect()}
    for c in {r[1] for r in rows}:
        part = sorted((r for r in rows if r[1] == c), key=lambda r: (lots[r[0]], r[0]))
        assert [r[2] for r in part] == list(range(1, len(part) + 1)) and {r[3] for r in part} == {len(part)}


def test_folds_are_isolated(spark):
    folds = spark.createDataFrame([("a", 0), ("b", 1), ("c", None), ("d", 2), ("d", 0), (None, 1)], "entity_id string, fold_id int")
    train, held = P.fold_split(folds)
    assert {r.entity_id for r in train.collect()} == {"b"} and {r.entity_id for r in held.collect()} == {"a", "d"}
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("d", 4)], "source1_entity_id string, x int")
    assert {(r.x, r.part) for r in P.isolated(rows, folds).collect()} == {(1, "validation"), (2, "train"), (4, "validation")}


def test_quality_of_a_continuous_feature(spark):
    df = spark.range(3000).select((F.sqrt("id") * 1.25).alias("x"), (F.col("id") % 4 == 0).cast("int").alias("y"))
    q = D.quality(df, ["x"], "y").first()
    p, n = sorted(r.x for r in df.where("y = 1").collect()), sorted(r.x for r in df.where("y = 0").collect())
    wins = sum((a > b) + (a == b) / 2 for a in p for b in n) / (len(p) * len(n))
    assert abs(q.auc - max(wins, 1 - wins)) < 1e-9
    middle = lambda v: (v[(len(v) - 1) // 2] + v[len(v) // 2]) / 2
    assert q.median_positive == middle(p) and q.median_negative == middle(n)


def test_lines_have_numbers(spark, tmp_path):
    (tmp_path / "a.txt").write_text("".join(f"line {i}\n" for i in range(1, 400)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        rows = IO.numbered_lines(spark, str(tmp_path / "a.txt")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {r.line: r.value for r in rows} == {i: f"line {i}" for i in range(1, 400)}


def test_lists_in_the_order_of_the_entities(spark, tmp_path):
    path = str(tmp_path / "t.tsv")
    IO.write_tsv(spark.createDataFrame([(i, f"S1-{9 - i}", "n", "a", "US") for i in range(9)], f"position int, {IO.RAW}"), path, "position", with_order=False)
    entities = IO.in_file_order(IO.read_tsv(spark, path))
    lists = IO.packed_lists(spark.createDataFrame([("S1-5", "S2-1", 1)], "s1 string, tgt string, rank int"), entities, position="position")
    IO.write_tsv(lists, str(tmp_path / "o.tsv"), "position", with_order=False)
    back = IO.in_file_order(spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "o.tsv"))).orderBy("position").collect()
    assert [r.source1_entity_id for r in back] == [f"S1-{9 - i}" for i in range(9)] and [r.matched_entity_ids for r in back if r.matched_entity_ids] == ["S2-1"]


def test_one_country_is_read(spark, tmp_path):
    path = str(tmp_path / "p")
    IO.write_parquet(spark.createDataFrame([("a", "US"), ("b", "India")], "x string, country string"), path, "country")
    df = IO.read_country(spark, path, "US")
    assert [r.x for r in df.collect()] == ["a"] and "PartitionFilters: [isnotnull(country" in df._jdf.queryExecution().executedPlan().toString()


def test_contract_and_count(spark):
    assert '"separator": "\\t"' in contract()
    df = spark.range(3)
    assert unlike_count(df, 3).count() == 0 and unlike_count(df, 5).first().value == "3 instead of 5"


def test_pair_samples_and_profile(spark):
    side = lambda i, n: (i, n, n.split(), "1 main st", ["main", "st"], "", "", "12345", n.replace(" ", ""), "US", "X", n, "1")
    schema = "entity_id string, name_clean string, name_tokens array<string>, addr_clean string, addr_tokens array<string>, addr_unit_num string, name_acronym string, postal_clean string, name_core string, country string, name_phonetic string, c string, addr_digits string"
    left, right = spark.createDataFrame([side("a", "alpha beta")], schema), spark.createDataFrame([side("b", "alpha betta"), side("c", "gamma delta")], schema)
    joined = D.pair_records(spark.createDataFrame([("a", "b"), ("a", "c")], "s1 string, tgt string"), left, right)
    p = D.profile(joined, alike=True).first()
    assert (p.pairs, p.token, p.exact_name, p.alike, p.any_key) == (2, 1, 0, 1, 2)
    assert D.samples(joined, 1).count() == 1
    assert {r.tgt: r.alike > 80 for r in D.miss_forensics(joined.select("s1", "tgt"), left, right, alike=True).collect()} == {"b": True, "c": False}


def test_models_are_kept_and_the_better_decision_wins(spark, tmp_path):
    rows = spark.range(400).select(F.concat(F.lit("s"), F.col("id") % 40).alias("s1"), F.concat(F.lit("S2-"), "id").alias("tgt"), (F.col("id") % 10).cast("double").alias("x"), (F.col("id") % 10 >= 8).cast("int").alias("label"), (F.col("id") % 5 == 0).alias("held"))
    one = model.train(rows, ["x"], learner=model.Learner(trees=60, depth=2, step=0.5, least_rows=1, tolerance=0.2), validation="held")
    two = model.train(rows, ["x"], "forest", 5, 2)
    assert one.stages[-1].getNumTrees < 60  # stopped early
    scored = model.probability(two, model.probability(one, rows, "p1"), "p2").select("s1", "tgt", F.lit("S2").alias("source"), "p1", "p2")
    truth = rows.where("label = 1").select("s1", "tgt")
    entities = rows.select("s1").distinct().withColumn("country", F.lit("US"))
    winner, tried = model.choose(scored, truth, entities)
    assert winner.f05 > 0.95 and winner.f05 == max(d.f05 for d in tried) and len(tried) == 8 and winner.name.startswith("weight")
    model.save(str(tmp_path / "m"), spark, {"one": one, "two": two}, ["x"], winner)
    models, features, decision = model.load(str(tmp_path / "m"), spark)
    assert decision == winner and features == ["x"]
    again = model.probability(models["two"], model.probability(models["one"], rows, "p1"), "p2").select("s1", "tgt", F.lit("S2").alias("source"), "p1", "p2").join(entities, "s1")
    assert {(r.s1, r.tgt) for r in model.decide(again, decision).collect()} == {(r.s1, r.tgt) for r in truth.collect()}
    d = decision._replace(by_country={"US": 0.3, "India": 0.4}, by_source={"US|S2": 0.9}, general=0.5)
    of = spark.createDataFrame([("US", "S2"), ("US", "S3"), ("India", "S2"), (None, "S2")], "country string, source string")
    assert [r.t for r in of.select(d.threshold().alias("t")).collect()] == [0.9, 0.3, 0.4, 0.5]
