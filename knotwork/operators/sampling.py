"""Holdouts, folds, labels and negatives, all chosen by hashes, so that a run can be repeated and needs no global order."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lot(seed: int, *columns) -> Column:
    """A text that orders rows by chance but alike in every run."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *columns))


def placed_by_lot(df: DataFrame, by: list[str], seed: int, id_column: str) -> DataFrame:
    """``df`` with ``_k``, the place of a row in its group by lot and id from 1, and ``_n``, the group's rows.

    A group is counted in 4096 ranges of the lot first, so no task orders more than one range of a group.
    """
    rows = df.withColumn("_l", lot(seed, id_column)).withColumn("_r", F.substring("_l", 1, 3))
    ranges = rows.groupBy(*by, "_r").agg(F.count("*").alias("_c"))
    group = Window.partitionBy(*by)  # at most 4096 rows a group
    ranges = ranges.withColumns({"_b": F.sum("_c").over(group.orderBy("_r")) - F.col("_c"), "_n": F.sum("_c").over(group)}).drop("_c")
    same = lambda c: F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}"))
    joined = rows.alias("x").join(ranges.alias("y"), reduce(and_, [same(c) for c in by]) & (F.col("x._r") == F.col("y._r"))).select("x.*", "y._b", "y._n")
    w = Window.partitionBy(*by, "_r").orderBy("_l", id_column)
    return joined.withColumn("_k", F.col("_b") + F.row_number().over(w)).drop("_l", "_r", "_b")


def holdout(df: DataFrame, by: str, share: float, seed: int = 42, id_column: str = "entity_id") -> DataFrame:
    """Exactly the whole part of ``share`` of each group's rows."""
    return placed_by_lot(df, [by], seed, id_column).where(F.col("_k") <= F.floor(F.col("_n") * share + 1e-9)).drop("_k", "_n")


def cardinality(n: Column) -> Column:
    return F.when(n == 0, "singleton").when(n == 1, "1_to_1").when(n <= 5, "2_to_5").otherwise("6_plus")


def folds(entities: DataFrame, truth_counts: DataFrame, n: int = 5, seed: int = 42) -> DataFrame:
    """The fold table: entities with match count, its class, and a fold; folds of one stratum differ by one row at most.

    A stratum is a country, a class of match counts, and whether there is an address.
    """
    e = entities.join(truth_counts.select(F.col("s1").alias("entity_id"), "n_true"), "entity_id", "left")
    e = e.select("entity_id", "country", F.coalesce("n_true", F.lit(0)).cast("int").alias("match_count"), (F.trim(F.coalesce("business_address", F.lit(""))) != "").cast("tinyint").alias("has_address"))
    e = e.withColumn("match_cardinality", cardinality(F.col("match_count")))
    e = placed_by_lot(e, ["country", "match_cardinality", "has_address"], seed, "entity_id")
    return e.withColumn("fold_id", ((F.col("_k") - 1) % n).cast("tinyint")).select("entity_id", "country", "match_cardinality", "has_address", "match_count", "fold_id")


def labelled_candidates(candidates: DataFrame, truth: DataFrame) -> DataFrame:
    """Candidates with ``label`` 1 where the pair is true, 0 elsewhere."""
    t = truth.select(F.col("s1").alias("source1_entity_id"), F.col("tgt").alias("target_entity_id"), F.lit(1).cast("tinyint").alias("label"))
    return candidates.join(t, ["source1_entity_id", "target_entity_id"], "left").withColumn("label", F.coalesce("label", F.lit(0).cast("tinyint")))


def hard_negatives(labelled: DataFrame, ratio: int = 3, seed: int = 42) -> DataFrame:
    """All positives and so many times as many negatives, chosen by lot.

    The cut is found by counting lots in 4096 ranges first, so only one range is ranked.
    """
    n_pos = labelled.where("label = 1").count() * ratio  # one number
    neg = labelled.where("label = 0").withColumn("_l", lot(seed, "source1_entity_id", "target_entity_id")).withColumn("_r", F.substring("_l", 1, 3))
    ranges = neg.groupBy("_r").count()
    ranges = ranges.withColumn("_b", F.sum("count").over(Window.orderBy("_r")) - F.col("count"))  # at most 4096 rows
    w = Window.partitionBy("_r").orderBy("_l", "source1_entity_id", "target_entity_id")
    taken = neg.join(F.broadcast(ranges.where(F.col("_b") < n_pos).select("_r", "_b")), "_r").withColumn("_k", F.row_number().over(w)).where(F.col("_b") + F.col("_k") <= n_pos)
    return labelled.where("label = 1").unionByName(taken.select(*labelled.columns))


def disjoint_split(df: DataFrame, id_column: str, share: float = 0.85, seed: int = 42) -> DataFrame:
    """Rows with ``part`` train or validation; all rows of one id fall into one part."""
    bucket = F.conv(F.substring(lot(seed, id_column), 1, 7), 16, 10).cast("double") / 16**7
    return df.withColumn("part", F.when(bucket < share, "train").otherwise("validation"))


def chance(seed: int, *columns) -> Column:
    """A number from 0 up to 1 that depends on the columns alone."""
    return F.conv(F.substring(lot(seed, *columns), 1, 7), 16, 10).cast("double") / 16**7


def random_sample(df: DataFrame, n: int, id_column: str = "entity_id", seed: int = 42) -> DataFrame:
    """``n`` rows by lot, the same in every run; every task first keeps its own ``n`` lowest lots."""
    return df.withColumn("_l", lot(seed, id_column)).orderBy("_l", id_column).limit(n).drop("_l")


def fold_split(folds_table: DataFrame, fold: int = 0) -> tuple[DataFrame, DataFrame]:
    """(ids to train on, ids to check on) of a fold table: the entities outside and inside ``fold``; null folds are in neither."""
    ids = folds_table.where("entity_id is not null").select("entity_id", "fold_id").distinct()
    inside = ids.where(F.col("fold_id") == fold).select("entity_id").distinct()
    return ids.where(F.col("fold_id") != fold).select("entity_id").distinct().join(inside, "entity_id", "left_anti"), inside


def isolated(rows: DataFrame, folds_table: DataFrame, fold: int = 0, id_column: str = "source1_entity_id") -> DataFrame:
    """``rows`` of labelled entities with ``part``: validation for those of ``fold``, train for the others; others' rows drop."""
    train, held = (x.select(F.col("entity_id").alias(id_column)) for x in fold_split(folds_table, fold))
    parts = train.withColumn("part", F.lit("train")).unionByName(held.withColumn("part", F.lit("validation")))
    return rows.join(parts, id_column)
