"""Queries of the text normalisers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knotwork.functions import normalize as N
from knotwork.functions import vocabulary as V
from knotwork.plans import sql as S
from knotwork.session import table

SOURCES = ("top50_train_source1", "top50_train_source2", "top50_train_source3")


def raw(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """Raw entities of some sources, one below the other."""
    out = table(spark, sf_dir, names[0])
    for n in names[1:]:
        out = out.unionByName(table(spark, sf_dir, n))
    return out


def _joined(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.array_join(c, " ") for c in ("name_tokens", "addr_tokens")})


def clean_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(N.clean_entities(raw(spark, sf_dir, *SOURCES)))


def name_representations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_entities(spark, sf_dir).select("entity_id", "name_clean", "name_core", "legal_form", "name_tokens", "name_acronym", "name_phonetic")


def address_representations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_entities(spark, sf_dir).select("entity_id", "addr_clean", "postal_clean", "addr_unit_num", "addr_digits", "addr_tokens", "has_address")


def basic_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.basic_entities(raw(spark, sf_dir, *SOURCES))


def name_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = N.clean_entities(raw(spark, sf_dir, "top50_train_source2", "top50_train_source3"))
    c = F.col
    return e.select(
        "entity_id", N.without_domain(c("name_clean")).alias("stripped"), F.array_join(N.char_grams(N.without_domain(c("name_clean")), 3), " ").alias("grams"),
        N.consonant_skeleton(c("name_core")).alias("skeleton"), N.postal_prefix(c("postal_clean"), c("country")).alias("prefix"),
        N.initials_contain(c("name_acronym"), c("name_tokens")).alias("initials"), F.size(N.text_grams(c("name_clean"))).alias("n_text_grams"),
        F.array_join(F.array_intersect(c("addr_tokens"), F.lit(V.LOCALITY_WORDS)), " ").alias("localities"),
    )


QUERIES = {f.__name__: f for f in (clean_entities, name_representations, address_representations, basic_entities, name_fragments)}

ALL = "(" + " union all ".join(f"select * from {s}" for s in SOURCES) + ")"
_TWO = "(select * from top50_train_source2 union all select * from top50_train_source3)"
_FLAT = "replace (array_to_string(name_tokens, ' ') as name_tokens, array_to_string(addr_tokens, ' ') as addr_tokens)"

_BASIC_NAME = S.squeeze(S.chained("n", V.LEGAL_REPLACEMENTS))
_BASIC_ADDRESS = S.squeeze(S.chained("a", V.ADDRESS_REPLACEMENTS))
_CORE = f"list_filter({S.words('name_clean')}, lambda w: w not in {S.listed(V.BASIC_STOPWORDS)})"

SQL = {
    "clean_entities": f"with {S.clean_entities(ALL)} select * {_FLAT} from entities",
    "name_representations": f"with {S.clean_entities(ALL)} select entity_id, name_clean, name_core, legal_form, array_to_string(name_tokens, ' ') as name_tokens, name_acronym, name_phonetic from entities",
    "address_representations": f"with {S.clean_entities(ALL)} select entity_id, addr_clean, postal_clean, addr_unit_num, addr_digits, array_to_string(addr_tokens, ' ') as addr_tokens, has_address from entities",
    "basic_entities": f"""
with one as (
  select entity_id, country, coalesce(business_address, '') as raw, {S.clean_name("coalesce(business_name, '')")} as n, {S.clean_name("coalesce(business_address, '')")} as a from {ALL}),
two as materialized (select entity_id, country, raw, {_BASIC_NAME} as name_clean, {_BASIC_ADDRESS} as addr_clean from one)
select entity_id, country, name_clean, addr_clean, array_to_string({S.tokens('name_clean', V.BASIC_STOPWORDS)}, ' ') as name_tokens,
       case when len({_CORE}) > 0 then array_to_string(({_CORE})[1:2], ' ') else name_clean[1:10] end as core_stem,
       {S.digit_blocks('raw', 3, 6)} as postal_digits, cast(trim(raw) <> '' as tinyint) as has_address
from two""",
    "name_fragments": f"""
with {S.clean_entities(_TWO)},
s as materialized (select *, {S.without_domain('name_clean')} as stripped from entities)
select entity_id, stripped, array_to_string({S.char_grams('stripped', 3)}, ' ') as grams, {S.skeleton('name_core')} as skeleton,
       case when country = 'France' then postal_clean[1:2] else postal_clean[1:3] end as prefix,
       cast(length(name_acronym) >= 2 and len(name_tokens) > 0 and contains(array_to_string(list_transform(name_tokens, lambda t: t[1]), ''), name_acronym) as double) as initials,
       cast(case when length(name_clean) >= 3 then len(list_distinct(list_transform(range(1, length(name_clean) - 1), lambda i: name_clean[i:i + 2]))) when name_clean <> '' then 1 else 0 end as integer) as n_text_grams,
       array_to_string(list_filter(addr_tokens, lambda t: t in {S.listed(V.LOCALITY_WORDS)}), ' ') as localities
from s""",
}
