"""Where candidates and matches are lost: recall curves, ceilings, attribution, coverage of signals, error records."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from knotwork.functions.normalize import char_grams
from knotwork.functions.pairs import weighted_ratio
from knotwork.operators.metrics import entity_scores
from knotwork.operators.sampling import random_sample

# Cut-offs of the recall curve.
CUTS = (5, 10, 15, 20, 25, 30, 35, 40, 50, 60, 75, 100, 150)


def recall_at(candidates: DataFrame, truth: DataFrame, cuts: tuple[int, ...] = CUTS) -> DataFrame:
    """(k, true_pairs, captured, candidates, recall, precision) over the entities of ``truth`` that have a match."""
    total = truth.count()  # one number
    hit = candidates.join(truth.select("s1").distinct(), "s1", "left_semi").join(truth.withColumn("_t", F.lit(1)), ["s1", "tgt"], "left")
    cols = [c for k in cuts for c in (F.count_if((F.col("rank") <= k) & F.col("_t").isNotNull()).alias(f"h{k}"), F.count_if(F.col("rank") <= k).alias(f"c{k}"))]
    one = hit.agg(*cols)
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"h{k}").alias("captured"), F.col(f"c{k}").alias("candidates")) for k in cuts])).alias("r")
    n = F.lit(total)
    return one.select(rows).select("r.*").select(
        "k", n.cast("long").alias("true_pairs"), "captured", "candidates", F.when(n > 0, F.col("captured") / n).otherwise(0.0).alias("recall"),
        F.when(F.col("candidates") > 0, F.col("captured") / F.col("candidates")).otherwise(0.0).alias("precision"),
    )


def recall_by(candidates: DataFrame, truth: DataFrame, of: DataFrame, k: int, by: str = "country") -> DataFrame:
    """(by, true_pairs, captured, recall, oracle) by group and, as ALL, over all; oracle is the F that recall allows."""
    hit = truth.join(of, "s1").join(candidates.where(F.col("rank") <= k).select("s1", "tgt").withColumn("_c", F.lit(1)), ["s1", "tgt"], "left")
    n = hit.rollup(by).agg(F.count("*").alias("true_pairs"), F.count("_c").alias("captured"), F.grouping(by).alias("_g"))
    r = F.col("captured") / F.col("true_pairs")
    return n.select(
        F.when(F.col("_g") == 1, "ALL").otherwise(F.coalesce(by, F.lit("unknown"))).alias(by), "true_pairs", "captured", r.alias("recall"), (1.25 * r / (0.25 + r)).alias("oracle")
    )


def oracle_ceiling(predicted: DataFrame, candidates: DataFrame, truth: DataFrame, entities: DataFrame) -> DataFrame:
    """One row: the F reached, the F that perfect choice among candidates would reach, and what each step loses."""
    reached = entity_scores(predicted, truth, entities).agg(F.avg("f05").alias("reached"))
    best = entity_scores(truth.join(candidates.select("s1", "tgt").distinct(), ["s1", "tgt"], "left_semi"), truth, entities).agg(F.avg("f05").alias("ceiling"))
    return reached.join(F.broadcast(best)).select("reached", "ceiling", (1 - F.col("ceiling")).alias("lost_in_blocking"), (F.col("ceiling") - F.col("reached")).alias("lost_in_choice"))  # one row each


def error_records(predicted: DataFrame, candidates: DataFrame, truth: DataFrame, entities: DataFrame) -> DataFrame:
    """(s1, tgt, error) of wrong predictions, of truths that weren't candidates, and of those that weren't chosen."""
    singles = entities.select("s1").join(truth.select("s1").distinct(), "s1", "left_anti").withColumn("_single", F.lit(True))
    wrong = predicted.select("s1", "tgt").join(truth, ["s1", "tgt"], "left_anti").join(singles, "s1", "left")
    wrong = wrong.select("s1", "tgt", F.when(F.col("_single"), "SINGLETON_FALSE_POSITIVE").otherwise("CLASSIFIER_FALSE_POSITIVE").alias("error"))
    c = candidates.select("s1", "tgt").distinct()
    dropped = truth.join(c, ["s1", "tgt"], "left_anti").withColumn("error", F.lit("BLOCKER_DROP_MISS"))
    missed = truth.join(c, ["s1", "tgt"], "left_semi").join(predicted.select("s1", "tgt"), ["s1", "tgt"], "left_anti").withColumn("error", F.lit("CLASSIFIER_FALSE_NEGATIVE"))
    return wrong.unionByName(dropped).unionByName(missed)


def attribution(candidates: DataFrame, truth: DataFrame, channels: dict[str, int]) -> DataFrame:
    """(channel, hits, true_hits, unique_true_hits) of candidate pairs; unique: no other channel found the pair."""
    t = candidates.join(truth.withColumn("_t", F.lit(1)), ["s1", "tgt"], "left")
    cols = []
    for c, b in channels.items():
        on = F.getbit(F.col("mask").cast("int"), F.lit(b)) == 1
        cols += [F.count_if(on).alias(f"a_{c}"), F.count_if(on & F.col("_t").isNotNull()).alias(f"b_{c}"), F.count_if(on & F.col("_t").isNotNull() & (F.bit_count(F.col("mask").cast("int")) == 1)).alias(f"c_{c}")]
    rows = [F.struct(F.lit(c).alias("channel"), F.col(f"a_{c}").alias("hits"), F.col(f"b_{c}").alias("true_hits"), F.col(f"c_{c}").alias("unique_true_hits")) for c in channels]
    return t.agg(*cols).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def missed(candidates: DataFrame, truth: DataFrame) -> DataFrame:
    """(s1, tgt) of the truth that no candidate is."""
    return truth.join(candidates.select("s1", "tgt").distinct(), ["s1", "tgt"], "left_anti")


def pair_records(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """``pairs(s1, tgt, ...)`` with the representations of both ends as structs ``l`` and ``r``; pairs without either drop."""
    a = left.select(F.col("entity_id").alias("s1"), F.struct(*left.columns).alias("l"))
    b = right.select(F.col("entity_id").alias("tgt"), F.struct(*right.columns).alias("r"))
    return pairs.join(a, "s1").join(b, "tgt")


def signals(p: str = "l", q: str = "r") -> dict[str, Column]:
    """What two entities may have in common, each true or false."""
    l, r = (lambda f: F.col(f"{p}.{f}")), (lambda f: F.col(f"{q}.{f}"))
    same = lambda f: (l(f) == r(f)) & (l(f) != "")
    out = {
        "name_exact": same("name_clean"), "core_exact": same("name_core"), "name_token": F.arrays_overlap(l("name_tokens"), r("name_tokens")),
        "acronym": same("name_acronym"), "phonetic": same("name_phonetic"), "addr_token": F.arrays_overlap(l("addr_tokens"), r("addr_tokens")),
        "digit": F.arrays_overlap(F.filter(F.split(l("addr_digits"), " "), lambda x: x != ""), F.split(r("addr_digits"), " ")), "postal": same("postal_clean"), "unit": same("addr_unit_num"),
    }
    out = {k: F.coalesce(v, F.lit(False)) for k, v in out.items()}
    out["captured"] = out["name_exact"] | out["core_exact"] | out["name_token"] | out["addr_token"] | (out["acronym"] & out["postal"]) | (out["phonetic"] & out["postal"])
    out["name_or_postal"] = out["name_token"] | out["postal"]
    out["name_or_addr"] = out["name_token"] | out["addr_token"]
    out["any"] = reduce(lambda x, y: x | y, [v for k, v in out.items() if k not in ("captured",)])
    return out


def coverage(joined: DataFrame, by: str = "country") -> DataFrame:
    """(by, pairs, and for each signal how many pairs have it) of joined pairs, by the left side's ``by``."""
    return joined.groupBy(F.coalesce(F.col(f"l.{by}"), F.lit("unknown")).alias(by)).agg(F.count("*").alias("pairs"), *[F.count_if(v).alias(k) for k, v in signals().items()])


@F.pandas_udf(T.DoubleType())
def weighted_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """The weighted edit similarity of two texts, 0 to 100."""
    return pd.Series(weighted_ratio(a.fillna("").tolist(), b.fillna("").tolist()), dtype="float64")


def profile(joined: DataFrame, alike: bool = False) -> DataFrame:
    """(country, pairs, signals, and combinations of signals) of joined pairs: how many pairs have each, by the left side's country.

    ``alike`` adds the pairs whose weighted edit similarity is 80 or more, which Python computes.
    """
    l, r = (lambda f: F.col(f"l.{f}")), (lambda f: F.col(f"r.{f}"))
    same = lambda f: F.coalesce((l(f) == r(f)) & (l(f) != ""), F.lit(False))
    overlap = lambda f: F.coalesce(F.arrays_overlap(l(f), r(f)), F.lit(False))
    common, all_ = F.size(F.array_intersect(l("name_tokens"), r("name_tokens"))), F.size(F.array_union(l("name_tokens"), r("name_tokens")))
    grams = F.size(F.array_intersect(char_grams(l("name_clean"), 3), char_grams(r("name_clean"), 3)))
    one = {
        "exact_name": same("name_clean"), "token": overlap("name_tokens"), "half_of_tokens": F.coalesce((all_ > 0) & (common >= all_ * 0.5), F.lit(False)),
        "place": overlap("addr_tokens"), "postal": same("postal_clean"), "sound": same("name_phonetic"), "two_trigrams": F.coalesce(grams >= 2, F.lit(False)),
    }
    if alike:
        one["alike"] = weighted_similarity(l("name_clean"), r("name_clean")) >= 80
    has = joined.select(F.coalesce(l("country"), F.lit("unknown")).alias("country"), *[v.alias(k) for k, v in one.items()])
    some = {
        "exact_or_token": "exact_name or token", "exact_token_or_place": "exact_name or token or place", "token_and_postal": "token and postal", "token_and_place": "token and place",
        "sound_or_token": "sound or token", "trigrams_or_token": "two_trigrams or token", "any_key": "exact_name or token or place or postal or sound",
    }
    return has.groupBy("country").agg(F.count("*").alias("pairs"), *[F.count_if(F.col(k)).alias(k) for k in one], *[F.count_if(F.expr(v)).alias(k) for k, v in some.items()])


def samples(joined: DataFrame, n: int = 10, seed: int = 42) -> DataFrame:
    """``n`` of the joined pairs by lot, with names and addresses of both ends and whether nothing links them."""
    some = random_sample(joined.withColumn("_id", F.concat_ws("|", "s1", "tgt")), n, "_id", seed)
    texts = [F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in "lr" for c in ("name_clean", "addr_clean", "postal_clean")]
    return some.select("s1", "tgt", *texts, (~signals()["any"]).alias("nothing_shared"))


def collisions(entities: DataFrame, columns: list[str], top: int = 10) -> DataFrame:
    """(column, rows, distinct_values, largest, top_share) of non-empty values; top_share: share of the ``top`` values."""
    long = entities.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("v")) for c in columns])).alias("r")).select("r.*").where("v <> ''")
    n = long.groupBy("column", "v").agg(F.count("*").alias("n"))
    w = Window.partitionBy("column").orderBy(F.desc("n"), "v")
    # the rank limit is applied in every task before the rows meet
    first = n.withColumn("k", F.row_number().over(w)).where(F.col("k") <= top).groupBy("column").agg(F.sum("n").alias("t"))
    one = n.groupBy("column").agg(F.sum("n").alias("rows"), F.count("*").alias("distinct_values"), F.max("n").alias("largest"))
    return one.join(first, "column").select("column", "rows", "distinct_values", "largest", (F.col("t") / F.col("rows")).alias("top_share"))


#: Parts of the distinct values of a feature.
RANGES = 256


def quality(rows: DataFrame, features: list[str], label: str = "label") -> DataFrame:
    """(feature, means, medians and deviations by label, auc, ks) of numeric features against a label of 0 and 1.

    auc is the rank statistic with ties averaged, turned so that it is at least one half; ks the largest distance of
    the two distributions. Values are counted once by value and label, and the distinct values of a feature are divided
    into RANGES parts at their quantiles, so no task orders more than one part of a continuous feature.
    """
    long = rows.select(F.col(label).alias("y"), F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x")) for f in features])).alias("v")).select("y", "v.*").where("x is not null")
    c = long.groupBy("feature", "x").agg(F.count_if(F.col("y") == 1).alias("p"), F.count_if(F.col("y") == 0).alias("n"))
    edges = c.groupBy("feature").agg(F.percentile_approx("x", [i / RANGES for i in range(1, RANGES)], 10_000).alias("_e"))
    # a row a feature
    c = c.join(F.broadcast(edges), "feature").withColumn("_r", F.size(F.filter("_e", lambda e: e < F.col("x")))).drop("_e")
    all_ = Window.partitionBy("feature")  # at most RANGES rows a feature
    parts = c.groupBy("feature", "_r").agg(F.sum("p").alias("rp"), F.sum("n").alias("rn"))
    parts = parts.select("feature", "_r", *[(F.sum(f"r{s}").over(all_.orderBy("_r")) - F.col(f"r{s}")).alias(f"b{s}") for s in "pn"], *[F.sum(f"r{s}").over(all_).alias(f"{s}s") for s in "pn"])
    w = Window.partitionBy("feature", "_r").orderBy("x")
    c = c.join(parts, ["feature", "_r"]).withColumns({f"c{s}": F.col(f"b{s}") + F.sum(s).over(w) for s in "pn"})
    u = F.sum(F.col("p") * (F.col("cn") - F.col("n") + F.col("n") / 2))
    sums = lambda s: F.sum(F.col("x") * F.col(s))
    squares = lambda s: F.sum(F.col("x") * F.col("x") * F.col(s))
    # the mean of the two middle values
    at = lambda s, k: F.min(F.when(F.col(f"c{s}") >= k, F.col("x")))
    middle = lambda s: (at(s, F.expr(f"({s}s + 1) div 2")) + at(s, F.expr(f"{s}s div 2 + 1"))) / 2
    g = c.groupBy("feature").agg(
        middle("p").alias("mp"), middle("n").alias("mn"),
        F.max("ps").alias("positives"), F.max("ns").alias("negatives"), sums("p").alias("sp"), sums("n").alias("sn"), squares("p").alias("qp"), squares("n").alias("qn"),
        u.alias("u"), F.max(F.abs(F.col("cp") / F.col("ps") - F.col("cn") / F.col("ns"))).alias("ks"),
    )
    a = F.col("u") / (F.col("positives") * F.col("negatives"))
    mean = lambda s, n: F.col(s) / F.col(n)
    sd = lambda q, s, n: F.sqrt(F.greatest(F.col(q) / F.col(n) - mean(s, n) * mean(s, n), F.lit(0.0)))
    return g.select(
        "feature", "positives", "negatives", mean("sp", "positives").alias("mean_positive"), mean("sn", "negatives").alias("mean_negative"), F.col("mp").alias("median_positive"), F.col("mn").alias("median_negative"),
        sd("qp", "sp", "positives").alias("sd_positive"), sd("qn", "sn", "negatives").alias("sd_negative"), F.greatest(a, 1 - a).alias("auc"), "ks",
    )


def miss_forensics(misses: DataFrame, left: DataFrame, right: DataFrame, alike: bool = False) -> DataFrame:
    """(s1, tgt, shared_name_tokens, shared_addr_tokens, same_country, edits) of missed pairs; edits of the cleaned names.

    ``alike`` adds their weighted edit similarity, which Python computes.
    """
    more = [weighted_similarity("l.name_clean", "r.name_clean").alias("alike")] if alike else []
    p = pair_records(misses, left, right)
    shared = lambda f: F.size(F.array_intersect(F.col(f"l.{f}"), F.col(f"r.{f}")))
    return p.select(
        "s1", "tgt", shared("name_tokens").alias("shared_name_tokens"), shared("addr_tokens").alias("shared_addr_tokens"),
        F.coalesce(F.col("l.country") == F.col("r.country"), F.lit(False)).alias("same_country"), F.levenshtein("l.name_clean", "r.name_clean").alias("edits"), *more,
    )
