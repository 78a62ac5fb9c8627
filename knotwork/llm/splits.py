"""Splits that keep related records together.

Method: frontier breadth-first components. Adjacency lists are hash-partitioned; every local minimum of a hash of
the ids is a seed (so each component has at least one) and all seeds expand concurrently, level by level. Where two
seeds meet, a link between them goes into a small graph, whose groups merge the seeds. Components are then taken in
the order of a hash of their name and cut at the given proportions of rows, in each country by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from knotwork.llm.groups import labels_of
from knotwork.operators.packed import unpack
from knotwork.operators.skew import Lookup, hot_keys, lookup_join, lookups
from knotwork.session import Scratch

#: Spellings of a country, upper case without marks.
COUNTRIES = {
    "US": ("US", "USA", "UNITED STATES", "UNITED STATES OF AMERICA", "AMERICA"),
    "India": ("INDIA", "IN", "IND", "BHARAT"),
    "France": ("FRANCE", "FR", "FRA"),
}


def canonical_country(c) -> F.Column:
    """A country's usual name, ``unknown`` for null or empty; other spellings stay, trimmed and in upper case."""
    plain = F.upper(F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"[.\s]+", " ")))
    squeezed = F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), r"[^A-Z]", "")
    out = F.when(plain == "", F.lit("unknown"))
    for name, forms in COUNTRIES.items():
        out = out.when(plain.isin(*forms) | squeezed.isin(*[f.replace(" ", "") for f in forms]), F.lit(name))
    return out.otherwise(plain)


def components(spark: SparkSession, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, component) for every id in ``edges(a, b)``, by concurrent breadth-first search from many seeds.

    From every id a path of falling hashes leads to a seed, so the levels are as many as the longest such path at most,
    which grows with the logarithm of the ids. Adjacency lists are hash-partitioned by both ends, so that a hub's list
    lies in many partitions.
    """
    adjacent = scratch.cut(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
        .select("e.a", "e.b").distinct().repartition("a", "b")
    )
    hubs = hot_keys(adjacent, "a")[1]["a"]
    h = lambda c: F.struct(F.xxhash64(c), F.col(c))
    seeds = adjacent.groupBy("a").agg(F.min(h("b")).alias("m")).where(h("a") < F.col("m"))
    levels = [scratch.cut(seeds.select(F.col("a").alias("id"), F.col("a").alias("seed")))]
    meetings: list[DataFrame] = []
    while not levels[-1].isEmpty():
        steps = scratch.cut(lookups(adjacent, Lookup("a", levels[-1], "id", "seed", "seed"), hot={"a": hubs}).select(F.col("b").alias("id"), "seed").distinct())
        # a neighbour of the frontier is new, in the frontier, or one level before it
        near = levels[-1] if len(levels) == 1 else levels[-1].unionByName(levels[-2])
        touched = scratch.cut(
            steps.groupBy("id").agg(F.min("seed").alias("seed")).join(near.withColumnRenamed("seed", "had"), "id", "left")
        )
        met = lookup_join(steps, "id", touched.select("id", F.coalesce("had", "seed").alias("to")), "id", "to", "to").where(F.col("seed") != F.col("to"))
        meetings.append(scratch.cut(met.select(F.col("seed").alias("a"), F.col("to").alias("b")).distinct()))
        levels.append(scratch.cut(touched.where("had is null").select("id", "seed")))
        scratch.drop(steps, touched)
    seen = levels[0]
    for x in levels[1:]:
        seen = seen.unionByName(x)
    if not meetings:
        return seen.select("id", F.col("seed").alias("component"))
    links = meetings[0]
    for m in meetings[1:]:
        links = links.unionByName(m)
    merged = labels_of(spark, links, scratch)
    out = lookup_join(seen, "seed", merged, "id", "label", "label", keep=True)
    return out.select("id", F.coalesce("label", "seed").alias("component"))


def entity_id(c) -> F.Column:
    """An id without white space at either end (of any kind) and in upper case; empty becomes null."""
    out = F.upper(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))
    return F.when(out != "", out)


def relations(spark: SparkSession, matches: DataFrame, left: str, packed: str, scratch: Scratch) -> DataFrame:
    """(id, component) of the entities of ``matches`` that share an id packed in ``packed``, directly or through others.

    Of a value with a remark the leading id counts. A component is named by its smallest entity.
    """
    values = unpack(matches, packed, [left])
    m = values.select(entity_id(F.col(f"`{left}`")).alias("e"), entity_id(F.regexp_extract("matched_value", r"^\s*([^\s,;|/()]+)", 1)).alias("v"))
    links = m.where("e is not null and v is not null").select(F.concat(F.lit("e:"), "e").alias("a"), F.concat(F.lit("m:"), "v").alias("b"))
    found = scratch.cut(components(spark, links, scratch).where(F.col("id").startswith("e:")).withColumn("id", F.expr("substring(id, 3)")))
    least = found.groupBy(F.col("component").alias("of")).agg(F.min("id").alias("least"))
    return lookup_join(found, "component", least, "of", "least", "least").select("id", F.col("least").alias("component"))


def grouped(spark: SparkSession, records: DataFrame, matches: DataFrame, scratch: Scratch) -> DataFrame:
    """``records`` (entity_id, country, fold_id) with ids and countries in their usual form and their ``component``."""
    rel = relations(spark, matches, "source1_entity_id", "matched_entity_ids", scratch)
    rows = records.select(entity_id(F.col("entity_id")).alias("entity_id"), canonical_country(F.col("country")).alias("country"), F.col("fold_id")).where("entity_id is not null")
    rows = lookup_join(rows, "entity_id", rel, "id", "component", "found", keep=True)
    return rows.select("entity_id", "country", "fold_id", F.coalesce("found", "entity_id").alias("component"))


def broken_by_folds(spark: SparkSession, records: DataFrame, matches: DataFrame) -> DataFrame:
    """(entity_id) of ``records`` whose related group, itself included, lies in two or more folds.

    Null folds don't count. Rows without an id are left out; an entity without matches is its own group, so only
    its repeated rows can break it.
    """
    scratch = Scratch(spark)
    rows = scratch.cut(grouped(spark, records, matches, scratch))
    bad = rows.groupBy("component").agg(F.min("fold_id").alias("lo"), F.max("fold_id").alias("hi")).where("lo < hi")
    return lookup_join(rows, "component", bad, "component", "lo", "broken").select("entity_id").distinct()


def split(spark: SparkSession, records: DataFrame, matches: DataFrame, parts: dict[str, float], seed: int = 0) -> DataFrame:
    """(entity_id, component, country, part) once for every entity of ``records``.

    Components are ordered by a hash within their country (the smallest country name of their rows that isn't
    ``unknown``) and cut where the running share of entities passes the proportions, so each part misses its share
    by less than one component in every country. The running share comes from two levels: sums over 4096 ranges of
    the hash, then the order within one range; no task holds a whole country.
    """
    total = sum(parts.values())
    if not parts or total <= 0 or min(parts.values()) < 0:
        raise ValueError("proportions must be positive")
    scratch = Scratch(spark)
    rows = scratch.cut(grouped(spark, records, matches, scratch))
    one = rows.groupBy("entity_id", "component").agg(F.min(F.when(F.col("country") != "unknown", F.col("country"))).alias("c"))
    size = one.groupBy("component").agg(F.count("*").alias("n"), F.coalesce(F.min("c"), F.lit("unknown")).alias("country"))
    size = size.withColumn("h", F.md5(F.concat_ws("|", F.lit(str(seed)), "component"))).withColumn("range", F.substring("h", 1, 3))
    ranges = size.groupBy("country", "range").agg(F.sum("n").alias("in_range"))
    by = Window.partitionBy("country").orderBy("range")  # at most 4096 rows a country
    ranges = ranges.select("country", "range", (F.sum("in_range").over(by) - F.col("in_range")).alias("before"), F.sum("in_range").over(Window.partitionBy("country")).alias("all"))
    w = Window.partitionBy("country", "range").orderBy("h", "component")
    placed = size.join(ranges, ["country", "range"]).withColumn("middle", (F.col("before") + F.sum("n").over(w) - F.col("n") / 2) / F.col("all"))
    part, edge = F.lit(list(parts)[-1]), 0.0
    steps = []
    for name, share in list(parts.items())[:-1]:
        edge += share / total
        steps.append((edge, name))
    for edge, name in reversed(steps):
        part = F.when(F.col("middle") < edge, F.lit(name)).otherwise(part)
    placed = placed.select("component", F.struct("country", part.alias("part")).alias("p"))
    return lookup_join(one.select("entity_id", "component"), "component", placed, "component", "p", "placed").select("entity_id", "component", "placed.country", "placed.part")
