"""Blocking by stages: targets by one kind of key after another, and sums of weights over several kinds of keys.

A cascade keeps the first ``k`` targets of an entity by stage and target, so of a key's list only the first ``k`` can
count, and lists are cut to them in every task before they are shuffled. Entities look lists up by ``lookup_join``, so
a key that many entities have costs no more than others.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from knotwork.operators import grid
from knotwork.operators.skew import lookup_join

MILLION = 1_000_000


class Stage(NamedTuple):
    """One kind of key, see ``keys_of``.

    Keys that more than ``most`` targets have are passed over; of an entity's others the ``rarest`` count (all, if 0), and of a key's
    targets the first ``take`` (all, if 0). With ``below`` the stage serves entities with fewer targets so far.
    """

    kind: str
    most: int = 2**31 - 1
    rarest: int = 0
    take: int = 0
    below: int = 0


def _neighbours(tokens: Column) -> Column:
    """Two tokens in a row, each once."""
    i = F.sequence(F.lit(0), F.greatest(F.size(tokens) - 2, F.lit(0)))
    pairs = F.transform(i, lambda k: F.concat_ws(" ", F.get(tokens, k), F.get(tokens, k + 1)))
    return F.array_distinct(F.when(F.size(tokens) >= 2, pairs).otherwise(F.array().cast("array<string>")))


def keys_of(kind: str) -> Column:
    """The keys of an entity: name, bigram, first (bigram), token, place (address token), place bigram, postal, prefix."""
    c = F.col
    one = lambda x: F.filter(F.array(x), lambda v: v != "")
    return {
        "name": one(c("name_clean")), "bigram": _neighbours(c("name_tokens")), "first": F.slice(_neighbours(c("name_tokens")), 1, 1), "token": F.array_distinct("name_tokens"),
        "place": F.array_distinct("addr_tokens"), "place bigram": _neighbours(c("addr_tokens")), "postal": one(c("postal_clean")),
        "prefix": F.filter(F.array(F.substring("name_clean", 1, 4)), lambda v: F.length(v) == 4),
    }[kind]


def _keyed(df: DataFrame, kinds: list[str], out: str) -> DataFrame:
    """(out, stage, kk) for every key; ``kk`` holds country, stage and key."""
    def staged(stage: int, keys: Column) -> Column:
        return F.transform(keys, lambda k: F.struct(F.lit(stage).alias("stage"), k.alias("key")))

    rows = F.flatten(F.array(*[staged(i, keys_of(x)) for i, x in enumerate(kinds, 1)]))
    keys = df.where("country is not null").select(F.col("entity_id").alias(out), "country", F.explode(rows).alias("r"))
    return keys.select(out, "r.stage", "r.key", F.concat_ws("\x01", "country", "r.stage", "r.key").alias("kk"))


def staged_blocking(left: DataFrame, right: DataFrame, stages: list[Stage], k: int) -> DataFrame:
    """(s1, tgt, stage, rank): the first ``k`` targets of every entity by stage and target; a target counts in its first stage."""
    by_stage = lambda f: F.element_at(F.array(*[F.lit(f(s)) for s in stages]), F.col("stage"))
    kinds = [s.kind for s in stages]
    r = _keyed(right, kinds, "tgt")
    few = r.groupBy("kk", "stage").agg(F.count("*").alias("df")).where(F.col("df") <= by_stage(lambda s: s.most))
    w = Window.partitionBy("kk").orderBy("tgt")
    first = r.withColumn("pos", F.row_number().over(w)).where(F.col("pos") <= k).where(F.col("pos") <= by_stage(lambda s: s.take or k))
    lists = first.groupBy("kk").agg(F.collect_list("tgt").alias("list")).join(few.select("kk", "df"), "kk").select("kk", F.struct("df", "list").alias("v"))
    hits = lookup_join(_keyed(left, kinds, "s1"), "kk", lists.withColumnRenamed("kk", "_pk"), "_pk", "v", "v")
    if any(s.rarest for s in stages):
        n = F.row_number().over(Window.partitionBy("s1", "stage").orderBy("v.df", "key"))
        hits = hits.withColumn("_n", n).where(F.col("_n") <= by_stage(lambda s: s.rarest or 2**31 - 1))
    out = hits.select("s1", "stage", F.explode("v.list").alias("tgt")).groupBy("s1", "tgt").agg(F.min("stage").alias("stage"))
    for i, s in enumerate(stages, 1):
        if s.below:
            before = F.count_if(F.col("stage") < i).over(Window.partitionBy("s1"))
            out = out.withColumn("_b", before).where((F.col("stage") != i) | (F.col("_b") < s.below)).drop("_b")
    return out.withColumn("rank", F.row_number().over(Window.partitionBy("s1").orderBy("stage", "tgt"))).where(F.col("rank") <= k)


#: Known mixtures of stages with the number of targets kept.
CASCADES = {
    "cascade": ([Stage("name"), Stage("bigram", 15_000), Stage("token", 20_000), Stage("postal", 500)], 25),
    "multikey": ([Stage("name"), Stage("bigram", 15_000), Stage("token", 25_000, rarest=4), Stage("place bigram", 5_000, take=15), Stage("postal", 500, below=5)], 35),
    "recall": ([Stage("name", take=20), Stage("token", 35_000, rarest=3, take=15), Stage("place", 8_000, rarest=2, take=10), Stage("postal", 800, take=10)], 40),
    "first_bigram": ([Stage("name"), Stage("first"), Stage("token", 49_999, rarest=2)], 20),
    "prefix": ([Stage("name"), Stage("token", 99_999, take=10), Stage("postal", 499), Stage("prefix", 1_999, below=5)], 25),
}


class Part(NamedTuple):
    """One kind of key of a sum: its weight in terms of ``n`` targets of the country and ``df`` with the key.

    Keys of fewer than ``least`` or more than ``most`` targets are passed over. With ``confirmed`` a hit counts only for pairs that share a name token, too, whatever its frequency.
    """

    kind: str
    weight: str
    most: int = 2**31 - 1
    confirmed: bool = False
    least: int = 1


SUMS = {
    "scored": ([Part("name", "100.0"), Part("token", "ln(n / df)", 35_000), Part("place", "0.7 * ln(n / df)", 10_000, least=2), Part("postal", "2.0", 1_000)], 35),
    "power": ([Part("name", "100.0"), Part("token", "10.0 / pow(df, 0.3)", 25_000), Part("first", "15.0"), Part("postal", "20.0", 1_000, True)], 30),
    "weighted": ([Part("name", "100.0"), Part("bigram", "35.0"), Part("token", "ln(n / df)", 35_000), Part("place", "0.7 * ln(n / df)", 10_000), Part("postal", "20.0", 1_000, True)], 35),
}


def summed_blocking(left: DataFrame, right: DataFrame, parts: list[Part], k: int, least: int = 1) -> DataFrame:
    """(s1, tgt, score, rank): the best ``k`` targets by the sum of the weights of shared keys, ties by target.

    Weights are whole millionths, so sums don't depend on their order; sums below ``least`` don't count. Keys with more
    targets than stated are not looked up. The pairs that share a key are never rows, see ``grid``.
    """
    kinds = [p.kind for p in parts]
    r = _keyed(right, kinds, "tgt")
    n = right.where("country is not null").groupBy("country").agg(F.count("*").alias("n"))
    weight = F.coalesce(*[F.when(F.col("stage") == i, F.round(F.expr(p.weight) * MILLION).cast("long")) for i, p in enumerate(parts, 1)])
    by_stage = lambda f: F.element_at(F.array(*[F.lit(f(p)) for p in parts]), F.col("stage"))
    df = r.groupBy("kk", "stage").agg(F.count("*").alias("df")).where(F.col("df").between(by_stage(lambda p: p.least), by_stage(lambda p: p.most)))
    # a row a country
    df = df.withColumn("country", F.substring_index("kk", "\x01", 1)).join(F.broadcast(n), "country").select("kk", weight.alias("w"))
    q = lookup_join(_keyed(left, kinds, "s1"), "kk", df.withColumnRenamed("kk", "_wk"), "_wk", "w", "w")
    hit = F.struct(F.concat_ws(grid.KIND, "stage", "key").alias("key"), "w", by_stage(lambda p: p.confirmed).alias("sure"))
    q = q.groupBy("s1").agg(F.collect_list(hit).alias("hits"))
    # words that confirm a hit count whatever their frequency
    sure = any(p.confirmed for p in parts)
    kinds += ["token"] * (sure and "token" not in kinds)
    words = _tagged("token", kinds.index("token") + 1) if sure else F.array().cast("array<string>")
    q = q.join(left.select(F.col("entity_id").alias("s1"), "country", grid.packed(words).alias("words")), "s1")
    q = q.select("s1", "country", grid.packed(F.col("hits.key")).alias("keys"), F.col("hits.w").alias("weights"), F.col("hits.sure").alias("sure"), "words")
    keys = grid.packed(F.flatten(F.array(*[_tagged(x, i) for i, x in enumerate(kinds, 1)])))
    found = grid.best_by_sum(q, right.where("country is not null").select(F.col("entity_id").alias("tgt"), "country", keys.alias("keys")), k, least)
    return found.select("s1", "tgt", (F.floor((F.col("w") + 5_000) / 10_000) / 100).alias("score"), "rank")


def _tagged(kind: str, stage: int) -> Column:
    """The keys of a kind with its stage before each."""
    return F.transform(keys_of(kind), lambda k: F.concat_ws(grid.KIND, F.lit(stage).cast("string"), k))
