"""Ground truth and candidates in one clean form."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from knotwork.operators.packed import unpack

# Names under which the two columns of a ground truth are known.
LEFT_NAMES = ("source1_entity_id", "source_entity_id", "s1_id")
RIGHT_NAMES = ("matched_entity_ids", "matched_entity_id", "target_entity_id", "s2_id", "s3_id", "target_id")


def truth_pairs(df: DataFrame) -> DataFrame:
    """(s1, tgt) once for every pair of a ground truth whose right column packs ids in any way; remarks are cut off."""
    left, right = (next(c for c in names if c in df.columns) for names in (LEFT_NAMES, RIGHT_NAMES))
    v = unpack(df, right, [left], value="_v")
    return v.select(F.col(left).alias("s1"), F.regexp_extract("_v", r"^\s*([^\s,;|/()]+)", 1).alias("tgt")).where("s1 is not null and tgt <> ''").distinct()


def truth_entities(df: DataFrame) -> DataFrame:
    """(s1, n_true) of every entity of a ground truth, those without a match included."""
    left = next(c for c in LEFT_NAMES if c in df.columns)
    n = truth_pairs(df).groupBy("s1").agg(F.count("*").alias("n_true"))
    return df.select(F.col(left).alias("s1")).where("s1 is not null").distinct().join(n, "s1", "left").select("s1", F.coalesce("n_true", F.lit(0)).alias("n_true"))


def ranked_candidates(df: DataFrame) -> DataFrame:
    """Candidates once a pair with their best score, all columns of that row, and ``rank`` by score and target.

    Rows without a target or a number as score don't count. Of rows of one pair with equal scores the one with the
    largest channel mask is taken.
    """
    s = F.col("candidate_score")
    rows = df.where(F.col("target_entity_id").isNotNull() & s.isNotNull() & ~F.isnan(s))
    one = rows.groupBy(F.col("source1_entity_id").alias("s1"), F.col("target_entity_id").alias("tgt")).agg(
        F.max(F.struct("candidate_score", "channel_mask", "num_channels")).alias("b")
    )
    w = Window.partitionBy("s1").orderBy(F.desc("score"), "tgt")
    return one.select("s1", "tgt", F.col("b.candidate_score").cast("double").alias("score"), F.col("b.channel_mask").alias("mask"), F.col("b.num_channels").alias("channels")).withColumn("rank", F.row_number().over(w))


def scored_once(df: DataFrame) -> DataFrame:
    """(s1, tgt, prob, country, source) of scored pairs, once a pair with the highest probability; NaN counts as null."""
    prob = F.when(~F.isnan("prob"), F.col("prob"))
    return df.where("s1_id is not null").groupBy(F.col("s1_id").alias("s1"), F.col("tgt_id").alias("tgt")).agg(F.max(prob).alias("prob"), F.min("country").alias("country"), F.min("source").alias("source"))
