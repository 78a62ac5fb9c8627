"""Entity metrics of predicted matches and the search for decision thresholds.

The F measure weighs precision over recall (beta 0.5) and is averaged over entities; an entity that has no match counts
as right only if none is predicted. Sweeps don't repeat the pairs for every threshold: an entity's measure changes only
where one of its own pairs comes in, so the changes are summed by threshold step and accumulated over the steps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BETA2 = 0.25


def f_half(tp: Column, n_pred: Column, n_true: Column) -> tuple[Column, Column, Column]:
    """(precision, recall, F) of one entity from its counts."""
    p = F.when((n_true == 0) & (n_pred == 0), 1.0).when(n_pred > 0, tp / n_pred).otherwise(0.0)
    r = F.when((n_true == 0) & (n_pred == 0), 1.0).when(n_true > 0, tp / n_true).otherwise(0.0)
    p = F.when((n_true == 0) & (n_pred > 0), 0.0).otherwise(p)
    f = F.when((n_true == 0) & (n_pred == 0), 1.0).when(tp > 0, (1 + BETA2) * p * r / (BETA2 * p + r)).otherwise(0.0)
    return p, r, f


def entity_scores(predicted: DataFrame, truth: DataFrame, entities: DataFrame) -> DataFrame:
    """(s1, n_true, n_pred, tp, precision, recall, f05) for every s1 of ``entities(s1)``; pairs are (s1, tgt)."""
    hit = predicted.join(truth.withColumn("_t", F.lit(1)), ["s1", "tgt"], "left").groupBy("s1").agg(F.count("*").alias("n_pred"), F.count("_t").alias("tp"))
    n = truth.groupBy("s1").agg(F.count("*").alias("n_true"))
    e = entities.select("s1").join(hit, "s1", "left").join(n, "s1", "left").fillna(0, ["n_pred", "tp", "n_true"])
    p, r, f = f_half(F.col("tp"), F.col("n_pred"), F.col("n_true"))
    return e.select("s1", "n_true", "n_pred", "tp", p.alias("precision"), r.alias("recall"), f.alias("f05"))


def macro(scores: DataFrame, *by: str) -> DataFrame:
    """Averages over entities, and the share of entities without a match for which none was predicted."""
    single = F.when(F.col("n_true") == 0, (F.col("n_pred") == 0).cast("double"))
    return scores.groupBy(*by).agg(
        F.count("*").alias("entities"), F.avg("precision").alias("precision"), F.avg("recall").alias("recall"), F.avg("f05").alias("f05"), F.avg(single).alias("singleton_accuracy")
    )


def step_of(prob: Column, start: float, step: float, n: int) -> Column:
    """How many of the ``n`` thresholds from ``start`` on a probability reaches; null reaches none."""
    k = F.floor((prob - start) / step + 1e-7) + 1
    return F.when(prob.isNull(), 0).otherwise(F.greatest(F.lit(0), F.least(F.lit(n), k))).cast("int")


def sweep(pairs: DataFrame, truth: DataFrame, entities: DataFrame, n: int, by: list[str] | None = None) -> DataFrame:
    """(by, step 1..n, entities, f05) averaged over ``entities(s1, by)`` when the pairs with ``step`` or more are taken.

    ``pairs(s1, tgt, step)`` holds how many thresholds each pair reaches.
    """
    by = by or []
    t = truth.withColumn("_t", F.lit(1))
    per = pairs.where("step > 0").join(t, ["s1", "tgt"], "left").groupBy("s1", "step").agg(F.count("*").alias("c"), F.count("_t").alias("h"))
    n_true = truth.groupBy("s1").agg(F.count("*").alias("n_true"))
    e = entities.select("s1", *by).join(n_true, "s1", "left").fillna(0, ["n_true"])
    w = Window.partitionBy("s1").orderBy(F.desc("step"))
    run = per.withColumns({"n_pred": F.sum("c").over(w), "tp": F.sum("h").over(w)}).join(e, "s1")
    f = lambda tp, n_pred: f_half(tp, n_pred, F.col("n_true"))[2]
    change = f(F.col("tp"), F.col("n_pred")) - f(F.col("tp") - F.col("h"), F.col("n_pred") - F.col("c"))
    changes = run.groupBy(*by, "step").agg(F.sum(change).alias("d"))
    start = e.groupBy(*by).agg(F.count("*").alias("entities"), F.sum(f(F.lit(0), F.lit(0))).alias("f0"))
    grid = start.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n))))
    # n rows a group
    w = Window.partitionBy(*by).orderBy(F.desc("step")) if by else Window.orderBy(F.desc("step"))
    joined = grid.join(changes, [*by, "step"], "left").withColumn("d", F.coalesce("d", F.lit(0.0)))
    return joined.select(*by, "step", "entities", ((F.col("f0") + F.sum("d").over(w)) / F.col("entities")).alias("f05"))


def best_step(swept: DataFrame, *by: str) -> DataFrame:
    """The row of the highest F of each group, the lowest threshold among equals (to nine places)."""
    w = Window.partitionBy(*by).orderBy(F.desc(F.round("f05", 9)), "step")
    return swept.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def within_margin(pairs: DataFrame, threshold: Column, gap: float = 0.35) -> DataFrame:
    """Pairs that reach their threshold and are the entity's best or at most ``gap`` below it."""
    best = F.max("prob").over(Window.partitionBy("s1"))
    return pairs.withColumn("_b", best).where((F.col("prob") >= threshold) & (F.col("_b") - F.col("prob") <= gap + 1e-9)).drop("_b")


def contradiction_penalty(similarity: Column, house_conflict: Column, postal_conflict: Column) -> Column:
    """What contradicting house numbers or postal codes add to a threshold, less the more alike the names are."""
    house = F.when(house_conflict, F.when(similarity < 0.90, 0.10).when(similarity < 0.95, 0.04).otherwise(0.01)).otherwise(0.0)
    postal = F.when(postal_conflict, F.when(similarity < 0.90, 0.08).otherwise(0.02)).otherwise(0.0)
    return house + postal


def disagreement(pairs: DataFrame, truth: DataFrame, low: float = 0.75, high: float = 0.95, cut: float = 0.85) -> DataFrame:
    """One row: how two classifiers (p1, p2) agree with the truth where either is undecided, and how much p2 rescues."""
    near = pairs.where(F.col("p1").between(low, high) | F.col("p2").between(low, high)).join(truth.withColumn("_t", F.lit(1)), ["s1", "tgt"], "left")
    right = lambda c: (F.col(c) >= cut) == F.col("_t").isNotNull()
    n = near.agg(
        F.count("*").alias("pairs"), F.count_if(right("p1") & right("p2")).alias("both_right"), F.count_if(right("p1") & ~right("p2")).alias("first_only"),
        F.count_if(~right("p1") & right("p2")).alias("second_only"), F.count_if(~right("p1") & ~right("p2")).alias("both_wrong"),
    )
    return n.withColumn("rescue_rate", F.when(F.col("pairs") > 0, F.col("second_only") / F.col("pairs")).otherwise(0.0))
