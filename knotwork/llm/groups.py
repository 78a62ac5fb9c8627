"""Consolidating pairwise matches into groups.

Method: minimum labels are propagated across the edges and the label pointers are shortened by jumping, round by
round, each round written to the shared folder, until no label changes.

A round works on the graph of current labels: every label takes the smallest label in its neighbourhood (a
combining aggregation, so a hub of any degree costs one value per task), pointers jump to their pointer's pointer,
and the edges are rewritten to the new labels, where those inside one group vanish. *Smallest* is meant in the order of
a hash that is fresh in every round: in the ids' own order a sorted chain would lose two labels a round, in a random
order any graph loses a constant share of its labels (on average more than a third, in chains more than half), so the rounds grow with the logarithm of
the labels and the work of all rounds is a small multiple of the first one's. Afterwards the rounds' tables are composed from
the last to the first, and every group takes its smallest id. Lookups go through ``lookups``, which keeps hubs out of
the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knotwork.operators.skew import Lookup, hot_keys, lookup_join, lookups
from knotwork.session import Scratch


def _ordered(e: DataFrame) -> DataFrame:
    """Each link once, its smaller end first; self links vanish."""
    return (
        e.where(F.col("a") != F.col("b"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def _both_ways(e: DataFrame) -> DataFrame:
    return e.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))


def labels_of(spark: SparkSession, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, label) for every id in ``edges(a, b)``: the smallest id of its component. Null ends are ignored."""
    now = scratch.cut(_ordered(edges.select("a", "b").where("a is not null and b is not null")))
    rounds: list[DataFrame] = []
    while True:
        # one pass: are there edges left, and which labels are hubs
        n, hot = hot_keys(_both_ways(now), "a")
        if not n:
            break
        hubs = hot["a"]
        rank = lambda c: F.struct(F.xxhash64(F.lit(str(len(rounds))), c).alias("h"), F.col(c).alias("id"))  # noqa: B023, E731
        parent = _both_ways(now).groupBy(F.col("a").alias("id")).agg(F.min(rank("b")).alias("m"))
        parent = parent.select("id", F.least(rank("id"), "m")["id"].alias("p"))
        # every id is an end of an edge, so each lookup finds its row
        jumped = scratch.cut(lookups(parent, Lookup("p", parent, "id", "p", "label"), hot={"p": hubs}).select("id", "label"))
        moved = lookups(now, Lookup("a", jumped, "id", "label", "la"), Lookup("b", jumped, "id", "label", "lb"), hot={"a": hubs, "b": hubs})
        after = scratch.cut(_ordered(moved.select(F.col("la").alias("a"), F.col("lb").alias("b"))))
        scratch.drop(now)
        rounds.append(jumped)
        now = after
    scratch.drop(now)
    if not rounds:
        kind = edges.schema["a"].dataType.simpleString()
        return spark.createDataFrame([], f"id {kind}, label {kind}")
    # hot labels of all rounds in one pass
    places = range(len(rounds))
    side_by_side = [r.select(*[(F.col("label") if i == k else F.lit(None).cast(r.schema["label"].dataType)).alias(f"l{k}") for k in places]) for i, r in enumerate(rounds)]
    hot = hot_keys(reduce(DataFrame.unionByName, side_by_side), *[f"l{k}" for k in places])[1]
    final, whole = rounds[-1], True
    for k in reversed(places[:-1]):
        # a label that is no end of a later edge has reached its group's label
        if hot[f"l{k}"] and not whole:  # it is read twice
            final, whole = scratch.cut(final), True
        found = lookups(rounds[k], Lookup("label", final.withColumnRenamed("label", "top"), "id", "top", "top", keep=True), hot={"label": hot[f"l{k}"]})
        final, whole = found.select("id", F.coalesce("top", "label").alias("label")), False
    if not whole:
        final = scratch.cut(final)
    least = final.groupBy("label").agg(F.least(F.min("id"), F.col("label")).alias("least"))
    named = scratch.cut(lookup_join(final, "label", least.withColumnRenamed("label", "of"), "of", "least", "least").select("id", F.col("least").alias("label")))
    scratch.drop(final, *rounds)
    return named


def consolidate(spark: SparkSession, pairs: DataFrame, left: str, right: str, record: str = "record_id", group: str = "group_id") -> DataFrame:
    """(record, group) once for every non-null id of both columns; group is the smallest id linked with it.

    A row with both ids is a link, whatever else it holds; repeated rows and self links change nothing; an id whose
    partner is null is at least its own group. Ids are compared as they stand. An empty table gives no row.
    """
    scratch = Scratch(spark)
    links = pairs.select(F.col(f"`{left}`").alias("a"), F.col(f"`{right}`").alias("b"))
    labels = labels_of(spark, links, scratch)
    everyone = links.select(F.explode(F.array("a", "b")).alias("id")).where("id is not null").distinct()
    return everyone.join(labels, "id", "left").select(F.col("id").alias(record), F.coalesce("label", "id").alias(group))
