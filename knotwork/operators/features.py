"""The 82 features of a candidate pair.

What depends on one entity alone (token lists, letter runs, skeletons, token weights) is prepared once for each entity.
The pair's features are Column expressions in generated code, except the edit similarities, which one Arrow function
computes for whole batches.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from knotwork.functions import normalize as N
from knotwork.functions import vocabulary as V
from knotwork.functions.pairs import partial_ratio, similar, sorted_tokens, token_set_ratio, weighted_ratio
from knotwork.functions.similarity import ratio
from knotwork.operators.blocking import CHANNELS
from knotwork.operators.idf import UNKNOWN
from knotwork.operators.skew import lookup_join

# The edit similarities, each of two texts of the pair, and the rank of a pair without one.
FUZZY = (
    "name_clean_fuzz_ratio", "name_clean_token_sort_ratio", "name_clean_token_set_ratio", "name_clean_wratio", "name_clean_jaro_winkler", "name_core_fuzz_ratio",
    "name_core_token_set_ratio", "name_core_jaro_winkler", "name_first_token_similarity", "name_last_token_similarity", "phonetic_similarity",
    "name_consonant_skeleton_sim", "addr_clean_fuzz_ratio", "addr_clean_token_set_ratio", "addr_clean_partial_ratio",
)
NO_RANK = 60


def prepare(clean: DataFrame, idf: DataFrame) -> DataFrame:
    """(entity_id, e) with everything features need of one entity; tokens fall back to all words where none count."""
    c = F.col
    or_words = lambda tokens, text: F.when(F.size(tokens) > 0, c(tokens)).otherwise(N.words(c(text)))
    e = clean.withColumns({"nt": or_words("name_tokens", "name_clean"), "at": or_words("addr_tokens", "addr_clean"), "ds": N.words(c("addr_digits"))})
    weights = idf.select(F.concat_ws("\x01", "field", "country", "token").alias("k"), "idf")
    for column, field, out in (("nt", "name", "nw"), ("at", "addr", "aw")):
        t = e.select("entity_id", "country", F.explode(F.array_distinct(column)).alias("token")).withColumn("_k", F.concat_ws("\x01", F.lit(field), "country", "token"))
        t = lookup_join(t, "_k", weights, "k", "idf", "idf", keep=True)
        m = t.groupBy("entity_id").agg(F.map_from_entries(F.collect_list(F.struct("token", F.coalesce("idf", F.lit(UNKNOWN)).alias("w")))).alias(out))
        e = e.join(m, "entity_id", "left")
    return e.select("entity_id", F.struct(
        "country", "name_clean", "name_core", "legal_form", "name_acronym", "name_phonetic", "addr_clean", "postal_clean", "addr_unit_num", "nt", "at", "ds", "nw", "aw",
        F.replace("name_clean", F.lit(" "), F.lit("")).alias("cat"), F.array_distinct(N.char_grams(c("name_core"), 3)).alias("g3"),
        F.array_distinct(N.char_grams(c("name_core"), 4)).alias("g4"), N.consonant_skeleton(c("name_core")).alias("skeleton"),
        F.array_intersect("at", F.lit(V.LOCALITY_WORDS)).alias("loc"), F.array_intersect("at", F.lit(V.LANDMARK_WORDS)).alias("land"),
    ).alias("e"))


@F.pandas_udf(T.StructType([T.StructField(f, T.DoubleType()) for f in FUZZY]))
def fuzzy(
    name_a: pd.Series, name_b: pd.Series, core_a: pd.Series, core_b: pd.Series, first_a: pd.Series, first_b: pd.Series, last_a: pd.Series, last_b: pd.Series,
    sound_a: pd.Series, sound_b: pd.Series, bones_a: pd.Series, bones_b: pd.Series, addr_a: pd.Series, addr_b: pd.Series,
) -> pd.DataFrame:
    def scored(f, a: pd.Series, b: pd.Series, scale: float = 100.0) -> np.ndarray:
        """Zero unless both texts have something."""
        x, y = a.fillna("").tolist(), b.fillna("").tolist()
        on = np.array([bool(p) and bool(q) for p, q in zip(x, y)], bool)
        out = np.zeros(len(x))
        at = np.nonzero(on)[0]
        if len(at):
            out[at] = f([x[i] for i in at], [y[i] for i in at]) / scale
        return out

    def by_sorted(a: list[str], b: list[str]) -> np.ndarray:
        return ratio([sorted_tokens(x) for x in a], [sorted_tokens(x) for x in b])

    return pd.DataFrame({
        "name_clean_fuzz_ratio": scored(ratio, name_a, name_b), "name_clean_token_sort_ratio": scored(by_sorted, name_a, name_b), "name_clean_token_set_ratio": scored(token_set_ratio, name_a, name_b),
        "name_clean_wratio": scored(weighted_ratio, name_a, name_b), "name_clean_jaro_winkler": scored(similar, name_a, name_b, 1.0),
        "name_core_fuzz_ratio": scored(ratio, core_a, core_b), "name_core_token_set_ratio": scored(token_set_ratio, core_a, core_b), "name_core_jaro_winkler": scored(similar, core_a, core_b, 1.0),
        "name_first_token_similarity": scored(ratio, first_a, first_b), "name_last_token_similarity": scored(ratio, last_a, last_b), "phonetic_similarity": scored(ratio, sound_a, sound_b),
        "name_consonant_skeleton_sim": scored(ratio, bones_a, bones_b), "addr_clean_fuzz_ratio": scored(ratio, addr_a, addr_b),
        "addr_clean_token_set_ratio": scored(token_set_ratio, addr_a, addr_b), "addr_clean_partial_ratio": scored(partial_ratio, addr_a, addr_b),
    })


def _flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False)).cast("double")


def _weighted(l: Column, r: Column, wl: Column, wr: Column) -> Column:
    """Weight of shared tokens by weight of all; tokens of either side weigh what that side's table says."""
    total = lambda tokens, w: F.aggregate(F.transform(tokens, lambda t: F.coalesce(F.element_at(w, t), F.lit(UNKNOWN))), F.lit(0.0), lambda a, x: a + x)
    both, only = F.array_intersect(l, r), F.array_except(r, l)
    whole = total(F.array_distinct(l), wl) + total(only, wr)
    return F.when(whole > 0, total(both, wl) / whole).otherwise(0.0)


def plain_features() -> dict[str, Column]:
    """All features that need no edit similarity, of structs ``l`` and ``r``, ``tgt``, and the candidate's columns."""
    l, r = (lambda f: F.col(f"l.{f}")), (lambda f: F.col(f"r.{f}"))
    given = lambda f: (l(f) != "") & (r(f) != "")
    same = lambda f: given(f) & (l(f) == r(f))
    other = lambda f: given(f) & (l(f) != r(f))
    legal = (l("legal_form") != "NONE") & (r("legal_form") != "NONE")
    n1, n2 = F.length(l("name_clean")), F.length(r("name_clean"))
    both_addr, both_post = given("addr_clean"), given("postal_clean")
    h1, h2 = F.get(l("ds"), F.lit(0)), F.get(r("ds"), F.lit(0))
    country = l("country")
    prefix = [N.postal_prefix(x, country) for x in (l("postal_clean"), r("postal_clean"))]
    flag = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    hit = lambda c: flag(c) > 0
    in_addr = lambda c: F.when(both_addr, c).otherwise(0.0)
    rank = F.coalesce(F.col("candidate_rank").cast("double"), F.lit(float(NO_RANK)))
    core = same("name_core")
    house = F.coalesce(h1 == h2, F.lit(False))
    return {
        "name_core_exact_match": _flag(core), "name_concat_exact_match": _flag((F.length(l("cat")) >= 4) & (l("cat") == r("cat"))),
        "name_len_diff_ratio": F.abs(n1 - n2) / F.greatest(n1, n2, F.lit(1)), "name_containment_s1_in_tgt": N.containment(l("nt"), r("nt")),
        "name_containment_tgt_in_s1": N.containment(r("nt"), l("nt")), "name_idf_weighted_overlap": _weighted(l("nt"), r("nt"), l("nw"), r("nw")), "name_token_jaccard": N.jaccard(l("nt"), r("nt")),
        "legal_form_match": _flag(legal & (l("legal_form") == r("legal_form"))), "legal_form_both_present": _flag(legal), "legal_form_conflict": _flag(legal & (l("legal_form") != r("legal_form"))),
        "acronym_exact_match": _flag(same("name_acronym")),
        "acronym_in_name": _flag(((l("name_acronym") != "") & F.array_contains(r("nt"), l("name_acronym"))) | ((r("name_acronym") != "") & F.array_contains(l("nt"), r("name_acronym")))),
        "acronym_initials_s1_in_tgt": N.initials_contain(l("name_acronym"), r("nt")), "acronym_initials_tgt_in_s1": N.initials_contain(r("name_acronym"), l("nt")),
        "phonetic_code_match": _flag(same("name_phonetic")), "char_3gram_jaccard": N.jaccard(l("g3"), r("g3")), "char_4gram_jaccard": N.jaccard(l("g4"), r("g4")),
        "name_consonant_skeleton_exact": _flag(same("skeleton")), "addr_token_jaccard": in_addr(N.jaccard(l("at"), r("at"))),
        "addr_token_overlap_count": in_addr(F.size(F.array_intersect(l("at"), r("at"))).cast("double")), "addr_idf_weighted_overlap": in_addr(_weighted(l("at"), r("at"), l("aw"), r("aw"))),
        "addr_locality_jaccard": N.jaccard(l("loc"), r("loc")), "addr_landmark_jaccard": N.jaccard(l("land"), r("land")), "postal_exact_match": _flag(same("postal_clean")),
        "postal_prefix_match": _flag((prefix[0] != "") & (prefix[0] == prefix[1])), "postal_conflict": _flag(other("postal_clean")), "unit_num_match": _flag(same("addr_unit_num")),
        "unit_num_conflict": _flag(other("addr_unit_num")), "house_num_match": _flag(house), "house_num_conflict": _flag(h1 != h2), "addr_digits_jaccard": N.jaccard(l("ds"), r("ds")),
        "target_name_missing": _flag(r("name_clean") == ""), "target_addr_missing": _flag(r("addr_clean") == ""), "target_postal_missing": _flag(r("postal_clean") == ""),
        "source_addr_missing": _flag(l("addr_clean") == ""), "source_postal_missing": _flag(l("postal_clean") == ""), "has_both_addr": _flag(both_addr), "has_both_postals": _flag(both_post),
        "blocker_candidate_score": flag("candidate_score"), "blocker_candidate_rank": rank, "blocker_reciprocal_rank": F.when(rank > 0, 1 / rank).otherwise(0.0),
        **{c: flag(c) for c in CHANNELS}, "num_channels": flag("num_channels"),
        "c_name_and_addr_hit": _flag((hit("c_name_core") | hit("c_name_token")) & (hit("c_addr_token") | hit("c_addr_numeric"))), "c_phonetic_and_postal_hit": _flag(hit("c_phonetic") & hit("c_postal")),
        "exact_core_name_and_postal": _flag(core & same("postal_clean")), "exact_core_name_and_house": _flag(core & house), "exact_core_name_and_locality": _flag(core & F.arrays_overlap(l("loc"), r("loc"))),
        "is_target_s2": _flag(F.col("tgt").startswith("S2")), "is_target_s3": _flag(F.col("tgt").startswith("S3")), "is_country_india": _flag(country == "India"),
        "is_country_us": _flag(country == "US"), "is_country_france": _flag(country == "France"),
    }


def crossed_features() -> dict[str, Column]:
    """Features made of others."""
    c = F.col
    return {
        "name_sim_when_target_addr_missing": F.when(c("target_addr_missing") > 0, c("name_clean_fuzz_ratio")).otherwise(0.0),
        "addr_sim_when_target_name_missing": F.when(c("target_name_missing") > 0, c("addr_clean_fuzz_ratio")).otherwise(0.0),
        "name_core_x_addr_jaccard": c("name_core_token_set_ratio") * c("addr_token_jaccard"), "name_core_x_postal_match": c("name_core_jaro_winkler") * c("postal_exact_match"),
        "addr_fuzz_x_postal_match": c("addr_clean_fuzz_ratio") * c("postal_exact_match"), "three_way_consistency": c("name_core_jaro_winkler") * c("addr_clean_fuzz_ratio") * c("postal_exact_match"),
    }


def feature_names() -> list[str]:
    """Names of all features in the order of the columns."""
    return [*plain_features(), *FUZZY, *crossed_features()]


def pairs_with_entities(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """``pairs(s1, tgt, ...)`` with prepared entities ``l`` and ``r``; of an end that is unknown all texts are empty."""

    def side(df: DataFrame, key: str, out: str) -> DataFrame:
        return df.select(F.col("entity_id").alias(key), F.col("e").alias(out))

    def filled(end: str) -> Column:
        empty = {"string": F.lit(""), "array<string>": F.array().cast("array<string>")}
        fields = []
        for f in left.schema["e"].dataType.fields:
            c, kind = F.col(f"{end}.{f.name}"), f.dataType.simpleString()
            if f.name == "legal_form":
                c = F.coalesce(c, F.lit("NONE"))
            elif kind in empty and f.name != "country":
                c = F.coalesce(c, empty[kind])
            fields.append(c.alias(f.name))
        return F.struct(*fields)

    joined = pairs.join(side(left, "s1", "l"), "s1", "left").join(side(right, "tgt", "r"), "tgt", "left")
    return joined.withColumns({"l": filled("l"), "r": filled("r")})


def pair_features(pairs: DataFrame, left: DataFrame, right: DataFrame, only_plain: bool = False) -> DataFrame:
    """(source1_entity_id, target_entity_id, features) of ``pairs``, a candidate table; other columns of it stay in front.

    ``left`` and ``right`` are prepared entities. With ``only_plain`` the edit similarities and what is made of them
    are left out.
    """
    keep = [c for c in pairs.columns if c in ("label",)]
    named = pairs.withColumnsRenamed({"source1_entity_id": "s1", "target_entity_id": "tgt"})
    p = pairs_with_entities(named, left, right)
    head = [F.col("s1").alias("source1_entity_id"), F.col("tgt").alias("target_entity_id"), *keep]
    plain = [v.alias(k) for k, v in plain_features().items()]
    if only_plain:
        return p.select(*head, *plain)
    l, r = (lambda f: F.col(f"l.{f}")), (lambda f: F.col(f"r.{f}"))
    ends = lambda t: [F.coalesce(F.get(t, F.lit(0)), F.lit("")), F.coalesce(F.get(t, F.size(t) - 1), F.lit(""))]
    (fa, la), (fb, lb) = ends(l("nt")), ends(r("nt"))
    f = fuzzy(l("name_clean"), r("name_clean"), l("name_core"), r("name_core"), fa, fb, la, lb, l("name_phonetic"), r("name_phonetic"), l("skeleton"), r("skeleton"), l("addr_clean"), r("addr_clean"))
    out = p.select(*head, *plain, f.alias("_f"))
    out = out.select(*[c for c in out.columns if c != "_f"], "_f.*")
    return out.select("*", *[v.alias(k) for k, v in crossed_features().items()])
