"""The whole linkage from raw tables to result lists, stage by stage, each written once and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from knotwork.functions.normalize import clean_entities
from knotwork.ml import model
from knotwork.operators import blocking as B
from knotwork.operators import features as X
from knotwork.operators import sampling as P
from knotwork.operators.idf import idf_table
from knotwork.operators.truth import truth_entities, truth_pairs
from knotwork.operators.validate import violations
from knotwork.sources import tables as IO

#: Candidates of an entity that are scored; share of the training entities that only tell boosted trees when to stop.
SCORED, STOPPING = 35, 0.1


def _prepared(spark: SparkSession, queries: DataFrame, targets: DataFrame, at, k: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(clean query entities, candidates, their features) of raw entities."""
    left = IO.once(spark, at("queries_clean"), lambda: clean_entities(B.deliveries_once(queries)))
    right = IO.once(spark, at("targets_clean"), lambda: clean_entities(B.deliveries_once(targets)))
    idf = IO.once(spark, at("idf"), lambda: idf_table(right, {"name": "name_tokens", "addr": "addr_tokens"}))
    found = IO.once(spark, at("candidates"), lambda: B.candidates(left, right, idf, k))
    rows = lambda: X.pair_features(found.where(F.col("candidate_rank") <= SCORED), X.prepare(left, idf), X.prepare(right, idf))
    return left, found, IO.once(spark, at("features"), rows)


def _scored(rows: DataFrame, left: DataFrame, one, two) -> DataFrame:
    both = model.probability(two, model.probability(one, rows, "p1"), "p2")
    pairs = both.select(F.col("source1_entity_id").alias("s1"), F.col("target_entity_id").alias("tgt"), F.substring("target_entity_id", 1, 2).alias("source"), "p1", "p2")
    return pairs.join(left.select(F.col("entity_id").alias("s1"), "country"), "s1")


def fit(spark: SparkSession, queries: DataFrame, targets: DataFrame, labels: DataFrame, out: str, k: int = 50, learners: tuple[model.Learner, model.Learner] = model.QUICK, folds: DataFrame | None = None) -> str:
    """Train on the labelled entities, choose how to decide on held-out ones, and keep both under ``out``/model, whose place is given.

    With ``folds`` the entities of fold 0 are held out, otherwise a part of all chosen by lot. What was kept before isn't trained again.
    """
    at = lambda name: f"{out.rstrip('/')}/{name}"
    if IO.exists(spark, at("model/config/_SUCCESS")):
        return at("model")
    left, _, rows = _prepared(spark, queries, targets, at, k)
    truth, known = truth_pairs(labels), truth_entities(labels).select(F.col("s1").alias("source1_entity_id"))
    split = P.isolated(known, folds) if folds is not None else P.disjoint_split(known, "source1_entity_id")
    labelled = P.labelled_candidates(rows, truth).join(split, "source1_entity_id")
    train = P.hard_negatives(labelled.where("part = 'train'")).withColumn("stopping", P.chance(7, "source1_entity_id") < STOPPING)
    train = IO.once(spark, at("train"), lambda: train)
    names = X.feature_names()
    one = model.train(train, names, learner=learners[0], validation="stopping" if learners[0].kind == "boosted" else None)
    two = model.train(train, names, learner=learners[1], validation="stopping" if learners[1].kind == "boosted" else None)
    held = split.where("part = 'validation'").select(F.col("source1_entity_id").alias("s1")).join(left.select(F.col("entity_id").alias("s1"), "country"), "s1")
    scored = IO.once(spark, at("held"), lambda: _scored(labelled.where("part = 'validation'").drop("part", "label"), left, one, two).drop("country"))
    decision, tried = model.choose(scored, truth.join(held.select("s1"), "s1", "left_semi"), held)
    IO.write_parquet(spark.createDataFrame([(d.name, d.weight, d.general, d.gap, d.f05) for d in tried], "name string, weight double, theta double, gap double, f05 double"), at("experiments"))
    model.save(at("model"), spark, {"one": one, "two": two}, names, decision)
    return at("model")


def infer(spark: SparkSession, queries: DataFrame, targets: DataFrame, kept: str, out: str, k: int = 50) -> dict[str, DataFrame]:
    """Link ``queries`` with ``targets`` by the models kept at ``kept``; nothing is trained.

    Gives the tables matches and candidates (packed lists, a row an entity), report and violations.
    """
    at = lambda name: f"{out.rstrip('/')}/{name}"
    models, _, decision = model.load(kept, spark)
    left, found, rows = _prepared(spark, queries, targets, at, k)
    scored = IO.once(spark, at("scores"), lambda: _scored(rows, left, models["one"], models["two"]))
    ranked = model.decide(scored, decision).withColumn("rank", F.row_number().over(Window.partitionBy("s1").orderBy(F.desc("prob"), "tgt")))
    lists = IO.once(spark, at("matches"), lambda: IO.packed_lists(ranked, queries))
    all_ = found.select(F.col("source1_entity_id").alias("s1"), F.col("target_entity_id").alias("tgt"), F.col("candidate_rank").alias("rank"))
    listed = IO.once(spark, at("candidate_lists"), lambda: IO.packed_lists(all_, queries, out="candidate_entity_ids"))
    wrong = violations(lists, listed, queries.select(F.col("entity_id").alias("source1_entity_id")).where("source1_entity_id is not null"))
    countries = left.select("country").where("country is not null").distinct()
    report = countries.select("country", decision.threshold("country", F.lit("")).alias("theta"), F.lit(decision.name).alias("decision"), F.lit(decision.f05).alias("f05"))
    return {"matches": lists, "candidates": listed, "report": report, "violations": wrong}


def run(spark: SparkSession, queries: DataFrame, targets: DataFrame, labels: DataFrame, out: str, k: int = 50, learners: tuple[model.Learner, model.Learner] = model.QUICK, folds: DataFrame | None = None) -> dict[str, DataFrame]:
    """``fit`` and ``infer``; stages lie under ``out``.

    A stage that was written completely before is read, so a run that broke off goes on where it stopped.
    """
    kept = fit(spark, queries, targets, labels, out, k, learners, folds)
    return infer(spark, queries, targets, kept, out, k)
