"""Linking new entities as they arrive against tables that stand still."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knotwork.functions.normalize import clean_entities
from knotwork.operators import blocking as B


def link_stream(arrivals: DataFrame, postings: DataFrame, idf: DataFrame, out: str, checkpoint: str, k: int = 50):
    """A started stream that writes the candidates of every micro-batch of raw entities to ``out``.

    ``postings`` and ``idf`` are the target side's tables, written once and read anew by each batch. Batches are
    written under their number, so one that is repeated after a failure replaces itself.
    """

    def one(batch: DataFrame, number: int) -> None:
        q = B.query_keys(clean_entities(B.deliveries_once(batch)), idf)
        found = B.candidate_schema(B.tiered(B.accumulate(q, postings), k))
        found.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out)

    return arrivals.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def arrivals_by_window(scored: DataFrame, late: str = "30 days", width: str = "1 day") -> DataFrame:
    """(window start, source, pairs, mean_prob) of scored pairs as they stream in, by the time of scoring.

    Pairs that come more than ``late`` after the newest time seen are left out, as the state of their window is gone.
    """
    w = F.window("scored_at", width)
    return scored.withWatermark("scored_at", late).groupBy(w.alias("w"), "source").agg(F.count("*").alias("pairs"), F.avg("prob").alias("mean_prob")).select(F.col("w.start").alias("start"), "source", "pairs", "mean_prob")
