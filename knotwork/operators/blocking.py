"""Candidate retrieval through nine key channels in one shuffle, and simpler blocking strategies.

Every target emits keys of all channels, every query entity its keys with a weight and a limit. Targets are listed by
(partition, channel, key), each list cut at the channel's cap, and queries look their lists up in one skew-proof join. A
pair's contributions are added in whole millionths, so sums don't depend on their order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from knotwork.functions.normalize import char_grams, without_domain
from knotwork.operators import grid
from knotwork.operators.idf import SHORTEST, rarest
from knotwork.operators.skew import lookup_join

# Channels from the highest bit, each with the cap of its lists.
CHANNELS = {
    "c_name_core": (8, 1500), "c_name_token": (7, 1500), "c_name_contain": (6, 1500), "c_char_3gram": (5, 600), "c_acronym": (4, 600),
    "c_addr_token": (3, 1500), "c_addr_numeric": (2, 500), "c_postal": (1, 600), "c_phonetic": (0, 500),
}
# Weights of a hit as (score, name part, address part).
WEIGHTS = {
    "core": (100, 100, 0), "concat": (95, 95, 0), "stripped": (90, 90, 0), "stem": (45, 45, 0), "gram": (8, 8, 0), "acronym": (35, 20, 15),
    "digit": (35, 0, 35), "unit": (40, 0, 40), "postal": (15, 0, 15), "phonetic": (25, 15, 10),
}
NAME_FACTOR, ADDRESS_FACTOR = 6.0, 5.5
CHANNEL_BONUS, BOTH_BONUS, WORTH = 25, 30, 15
TOP_RARE, GRAMS = 4, 5
MILLION = 1_000_000

_KEY = "\x01"


def _micro(c) -> Column:
    return F.round((c if isinstance(c, Column) else F.lit(float(c))) * MILLION).cast("long")


def _two_places(c) -> Column:
    """Millionths as a number with two places, half up, by whole-number arithmetic."""
    return F.floor((F.col(c) + 5_000) / 10_000) / 100


def deliveries_once(df: DataFrame) -> DataFrame:
    """One row an entity_id: the first by name, address and country, nulls last."""
    w = Window.partitionBy("entity_id").orderBy(*[F.asc_nulls_last(c) for c in ("business_name", "business_address", "country")])
    return df.where("entity_id is not null").withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def _emit(channel: str, key: Column, keep: Column, **more) -> Column:
    bit = CHANNELS[channel][0]
    fields = [F.lit(bit).alias("bit"), key.alias("key")] + [v.alias(k) for k, v in more.items()]
    return F.when(keep, F.array(F.struct(*fields)))


def target_keys(clean: DataFrame) -> DataFrame:
    """(country, bit, key, ord, tgt, postal) of every target; ``clean`` has the representations of entities."""
    c = F.col
    e = clean.where("country is not null").withColumns({"_sc": without_domain(c("name_core")), "_st": without_domain(c("name_clean"))})
    e = e.withColumns({"_cat": F.replace("_st", F.lit(" "), F.lit("")), "_d": F.get(F.split("addr_digits", " "), F.lit(0))})
    tokens = lambda x: F.filter(x, lambda t: F.length(t) >= SHORTEST)
    many = lambda ch, arr: F.transform(arr, lambda k: F.struct(F.lit(CHANNELS[ch][0]).alias("bit"), k.alias("key")))
    has_post = c("postal_clean") != ""
    with_post = lambda x: F.concat_ws(_KEY, "postal_clean", x)
    empty = F.array().cast("array<struct<bit:int,key:string>>")
    lists = [
        _emit("c_name_core", c("name_core"), F.length("name_core") >= 3),
        _emit("c_name_core", c("_sc"), (c("_sc") != c("name_core")) & (F.length("_sc") >= 3)),
        _emit("c_name_core", c("_cat"), (c("_cat") != c("name_core")) & (c("_cat") != c("_sc")) & (F.length("_cat") >= 4)),
        many("c_name_token", tokens(F.array_union("name_tokens", F.filter(F.split("_st", " "), lambda w: w != "")))),
        _emit("c_name_contain", F.concat_ws("_", F.get("name_tokens", F.lit(0)), F.get("name_tokens", F.lit(1))), F.size("name_tokens") >= 2),
        many("c_char_3gram", F.when(F.length("_cat") >= 4, F.array_distinct(char_grams(c("_cat"), 3))).otherwise(F.array().cast("array<string>"))),
        _emit("c_acronym", c("name_acronym"), F.length("name_acronym") >= 2),
        many("c_addr_token", F.array_distinct(tokens(c("addr_tokens")))),
        _emit("c_addr_numeric", with_post("_d"), has_post & (c("_d") != "")),
        _emit("c_addr_numeric", with_post("addr_unit_num"), has_post & (c("addr_unit_num") != "")),
        _emit("c_postal", c("postal_clean"), has_post),
        _emit("c_phonetic", F.concat_ws(_KEY, "name_phonetic", F.substring("postal_clean", 1, 4)), has_post & (c("name_phonetic") != "")),
    ]
    all_keys = F.flatten(F.array(*[F.coalesce(x, empty) for x in lists]))
    return e.select("country", F.col("entity_id").alias("tgt"), "postal_clean", F.posexplode(all_keys).alias("ord", "k")).select("country", "k.bit", "k.key", "ord", "tgt", F.col("postal_clean").alias("postal"))


def postings(clean: DataFrame) -> DataFrame:
    """(country, bit, key, pos, tgt, postal): the targets of every key in order of their ids, cut at the channel's cap."""
    cap = F.element_at(F.create_map(*[F.lit(x) for b, n in CHANNELS.values() for x in (b, n)]), F.col("bit"))
    w = Window.partitionBy("country", "bit", "key").orderBy("tgt", "ord")
    p = target_keys(clean).withColumn("pos", F.row_number().over(w)).where(F.col("pos") <= max(n for _, n in CHANNELS.values()))
    return p.where(F.col("pos") <= cap).drop("ord")


def query_keys(clean: DataFrame, idf: DataFrame) -> DataFrame:
    """(s1, country, bit, key, most, score, name, addr, postal) of every query entity, weights in millionths.

    ``most`` is how many targets of the list count; postal is set where a hit needs the same postal code.
    """
    c = F.col
    e = clean.where("country is not null").withColumns({"_sc": without_domain(c("name_core")), "_cat": F.replace(without_domain(c("name_clean")), F.lit(" "), F.lit(""))})
    e = e.withColumn("_d", F.get(F.split("addr_digits", " "), F.lit(0)))
    none = F.lit(None).cast("string")

    def one(channel: str, weight: str, key: Column, keep: Column, most: int, postal: Column = none) -> Column:
        s, n, a = WEIGHTS[weight]
        return _emit(channel, key, keep, most=F.lit(most), score=F.lit(s * MILLION).cast("long"), name=F.lit(n * MILLION).cast("long"), addr=F.lit(a * MILLION).cast("long"), postal=postal)

    has_post = c("postal_clean") != ""
    with_post = lambda x: F.concat_ws(_KEY, "postal_clean", x)
    every = CHANNELS["c_name_core"][1]
    s, n, a = WEIGHTS["gram"]
    grams = F.transform(F.slice(F.when(F.length("name_clean") >= 4, char_grams(c("name_clean"), 3)).otherwise(F.array().cast("array<string>")), 1, GRAMS), lambda g: F.struct(
        F.lit(CHANNELS["c_char_3gram"][0]).alias("bit"), g.alias("key"), F.lit(20).alias("most"), F.lit(s * MILLION).cast("long").alias("score"),
        F.lit(n * MILLION).cast("long").alias("name"), F.lit(a * MILLION).cast("long").alias("addr"), none.alias("postal")))
    t = F.filter("name_tokens", lambda x: F.length(x) >= SHORTEST)
    lists = [
        one("c_name_core", "core", c("name_core"), F.length("name_core") >= 3, every),
        one("c_name_core", "concat", c("_cat"), F.length("_cat") >= 4, every),
        one("c_name_core", "stripped", c("_sc"), (c("_sc") != c("name_core")) & (F.length("_sc") >= 3), every),
        one("c_name_contain", "stem", F.concat_ws("_", F.get(t, F.lit(0)), F.get(t, F.lit(1))), F.size(t) >= 2, 40),
        grams,
        one("c_acronym", "acronym", c("name_acronym"), (F.length("name_acronym") >= 2) & has_post, 40, c("postal_clean")),
        one("c_addr_numeric", "digit", with_post("_d"), has_post & (c("_d") != ""), 40),
        one("c_addr_numeric", "unit", with_post("addr_unit_num"), has_post & (c("addr_unit_num") != ""), 40),
        one("c_postal", "postal", c("postal_clean"), has_post, 25),
        one("c_phonetic", "phonetic", F.concat_ws(_KEY, "name_phonetic", F.substring("postal_clean", 1, 4)), has_post & (c("name_phonetic") != ""), 40),
    ]
    empty = F.array().cast("array<struct<bit:int,key:string,most:int,score:bigint,name:bigint,addr:bigint,postal:string>>")
    fixed = e.select(F.col("entity_id").alias("s1"), "country", F.explode(F.flatten(F.array(*[F.coalesce(x, empty) for x in lists]))).alias("k")).select("s1", "country", "k.*")

    def rare(field: str, column: str, channel: str, factor: float, steps: tuple[int, int, int], is_name: bool) -> DataFrame:
        i = c("idf")
        w = _micro(i * factor)
        return rarest(e, idf, field, column, TOP_RARE).select(
            F.col("entity_id").alias("s1"), "country", F.lit(CHANNELS[channel][0]).alias("bit"), F.col("token").alias("key"),
            F.when(i >= 3, steps[0]).when(i >= 2, steps[1]).otherwise(steps[2]).alias("most"), w.alias("score"),
            (w if is_name else F.lit(0).cast("long")).alias("name"), (F.lit(0).cast("long") if is_name else w).alias("addr"), none.alias("postal"),
        )

    return fixed.unionByName(rare("name", "name_tokens", "c_name_token", NAME_FACTOR, (60, 30, 15), True)).unionByName(rare("addr", "addr_tokens", "c_addr_token", ADDRESS_FACTOR, (50, 25, 10), False))


def accumulate(queries: DataFrame, lists: DataFrame) -> DataFrame:
    """(s1, tgt, score, name, addr, mask, channels) of every pair that shares a key, bonuses included, in millionths."""
    key = lambda: F.concat_ws("\x02", "country", "bit", "key")
    # a key's list is bounded by its cap, so the hot keys' lists may be broadcast
    grouped = lists.groupBy(key().alias("_pk")).agg(F.sort_array(F.collect_list(F.struct("pos", "tgt", F.col("postal").alias("tp")))).alias("list"))
    hits = lookup_join(queries.withColumn("_qk", key()), "_qk", grouped, "_pk", "list", "list")
    hits = hits.select("s1", "bit", "score", "name", "addr", "postal", "most", F.explode(F.slice("list", F.lit(1), F.col("most"))).alias("h"))
    hits = hits.where(F.col("postal").isNull() | (F.col("postal") == F.col("h.tp")))
    acc = hits.groupBy("s1", F.col("h.tgt").alias("tgt")).agg(
        F.sum("score").alias("score"), F.sum("name").alias("name"), F.sum("addr").alias("addr"), F.expr("bit_or(shiftleft(1, bit))").alias("mask")
    )
    n = F.bit_count("mask")
    bonus = F.when(n >= 2, n * CHANNEL_BONUS).otherwise(0) + F.when((F.col("name") > 0) & (F.col("addr") > 0), BOTH_BONUS).otherwise(0)
    return acc.withColumns({"channels": n, "score": F.col("score") + bonus * MILLION})


def tiered(pairs: DataFrame, k: int) -> DataFrame:
    """The best ``k`` pairs of every s1 in three tiers, with ``rank``.

    All if there are no more than k; otherwise 60 % by score, up to 20 % more by address part, the open places by name
    part (both only from a worth of 15), and what is left by score. Ties: higher score, then smaller target.
    """
    n1, n2 = max(1, int(k * 0.6)), max(1, int(k * 0.2))
    by_score = [F.desc("score"), F.asc("tgt")]
    s1 = Window.partitionBy("s1")
    p = pairs.withColumn("r1", F.row_number().over(s1.orderBy(*by_score)))
    p = p.withColumn("in1", F.col("r1") <= n1)
    p = p.withColumn("r2", F.row_number().over(Window.partitionBy("s1", "in1").orderBy(F.desc("addr"), *by_score)))
    p = p.withColumn("in2", ~F.col("in1") & (F.col("r2") <= n2) & (F.col("addr") >= WORTH * MILLION))
    p = p.withColumns({"has": F.count_if(F.col("in1") | F.col("in2")).over(s1), "in12": F.col("in1") | F.col("in2")})
    p = p.withColumn("r3", F.row_number().over(Window.partitionBy("s1", "in12").orderBy(F.desc("name"), *by_score)))
    p = p.withColumn("in3", ~F.col("in12") & (F.col("r3") <= k - F.col("has")) & (F.col("name") >= WORTH * MILLION))
    p = p.withColumns({"has": F.count_if(F.col("in12") | F.col("in3")).over(s1), "in123": F.col("in12") | F.col("in3")})
    p = p.withColumn("r4", F.row_number().over(Window.partitionBy("s1", "in123").orderBy(*by_score)))
    p = p.where(F.col("in123") | (F.col("r4") <= k - F.col("has")))
    return p.withColumn("rank", F.row_number().over(s1.orderBy(*by_score))).drop("r1", "r2", "r3", "r4", "in1", "in2", "in3", "in12", "in123", "has")


def candidate_schema(pairs: DataFrame) -> DataFrame:
    """Ranked pairs in the layout of the candidate table: score to two places, channel flags, number and mask."""
    flags = [F.getbit("mask", F.lit(b)).cast("tinyint").alias(c) for c, (b, _) in CHANNELS.items()]
    return pairs.select(
        F.col("s1").alias("source1_entity_id"), F.col("tgt").alias("target_entity_id"), _two_places("score").cast("float").alias("candidate_score"),
        F.col("rank").cast("smallint").alias("candidate_rank"), *flags, F.col("channels").cast("tinyint").alias("num_channels"), F.col("mask").cast("smallint").alias("channel_mask"),
    )


def candidates(s1_clean: DataFrame, target_clean: DataFrame, idf: DataFrame, k: int = 50) -> DataFrame:
    """The candidate table of all query entities: up to ``k`` targets of the same country each."""
    return candidate_schema(tiered(accumulate(query_keys(s1_clean, idf), postings(target_clean)), k))


# ---- simpler strategies -------------------------------------------------------------------------------------------


def intersection_blocking(left: DataFrame, right: DataFrame, idf: DataFrame, top: int = 3, k: int = 25) -> DataFrame:
    """(s1, tgt, shared, rank): targets that share two of an entity's ``top`` rarest name tokens, or one and a rare address token."""
    names = rarest(left, idf, "name", "name_tokens", top).select("entity_id", "country", "token", F.lit("n").alias("f"))
    places = rarest(left, idf, "addr", "addr_tokens", 2).select("entity_id", "country", "token", F.lit("a").alias("f"))
    q = names.unionByName(places).withColumnRenamed("entity_id", "s1").distinct()
    hit = F.struct(F.concat_ws(grid.KIND, "f", "token").alias("key"), (F.lit(grid.HIT).cast("long") + F.when(F.col("f") == "n", 1).otherwise(0)).alias("w"))
    q = q.groupBy("s1", "country").agg(F.collect_list(hit).alias("hits"))
    sure = F.transform("hits", lambda _: F.lit(False))
    q = q.select("s1", "country", grid.packed(F.col("hits.key")).alias("keys"), F.col("hits.w").alias("weights"), sure.alias("sure"), F.lit("").alias("words"))
    of = lambda c, f: F.transform(F.array_distinct(c), lambda t: F.concat_ws(grid.KIND, F.lit(f), t))
    keys = grid.packed(F.concat(of("name_tokens", "n"), of("addr_tokens", "a")))
    found = grid.best_by_count(q, right.where("country is not null").select(F.col("entity_id").alias("tgt"), "country", keys.alias("keys")), k, 2)
    return found.select("s1", "tgt", F.col("w").alias("shared"), "rank")


def _union_list() -> Column:
    """All keys of an entity."""
    tag = lambda t, a: F.transform(a, lambda k: F.concat(F.lit(t), k))
    return F.flatten(F.array(
        tag("n:", F.filter(F.array("name_clean"), lambda x: x != "")), tag("t:", F.array_distinct("name_tokens")),
        tag("a:", F.array_distinct("addr_tokens")), tag("p:", F.filter(F.array("postal_clean"), lambda x: F.length(x) >= 4)),
    ))


def _union_keys(df: DataFrame, out: str) -> DataFrame:
    return df.where("country is not null").select("country", F.col("entity_id").alias(out), F.explode(_union_list()).alias("key"))


def union_blocking(left: DataFrame, right: DataFrame) -> DataFrame:
    """(s1, tgt, shared) of all pairs of one country with an equal name, a shared token, or an equal postal code.

    ``shared`` counts what they share. No key is passed over, so this is for small tables and as a measure of recall.
    """
    return _union_keys(left, "s1").join(_union_keys(right, "tgt"), ["country", "key"]).groupBy("s1", "tgt").agg(F.count("*").alias("shared"))


def union_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """(shared, count): the pairs that ``union_blocking`` gives, counted by ``shared`` without making them."""
    side = lambda df, out: df.where("country is not null").select(F.col("entity_id").alias(out), "country", grid.packed(_union_list()).alias("keys"))
    return grid.counts_by_shared(side(left, "s1"), side(right, "tgt"))


def union_recall(left: DataFrame, right: DataFrame, truth: DataFrame) -> DataFrame:
    """(source, true_pairs, captured, recall) of the true pairs of delivered entities that ``union_blocking`` gives.

    Only the true pairs are compared, so the cost grows with them and not with the pairs that share a key.
    """
    true = truth.join(left.select(F.col("entity_id").alias("s1")), "s1", "left_semi").join(right.select(F.col("entity_id").alias("tgt")), "tgt", "left_semi").distinct()
    hits = true.join(_union_keys(left, "s1"), "s1").join(_union_keys(right, "tgt"), ["tgt", "country", "key"]).select("s1", "tgt").distinct()
    of = true.join(hits.withColumn("hit", F.lit(1)), ["s1", "tgt"], "left").groupBy(F.substring("tgt", 1, 2).alias("source"))
    return of.agg(F.count("*").alias("true_pairs"), F.count("hit").alias("captured"), (F.count("hit") / F.count("*")).alias("recall"))
