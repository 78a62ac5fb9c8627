"""Queries of token statistics and candidate retrieval."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knotwork.functions import normalize as N
from knotwork.operators import blocking as B
from knotwork.operators import staged as G
from knotwork.operators.idf import idf_table
from knotwork.plans import sql as S
from knotwork.plans.text_queries import raw
from knotwork.session import Scratch, table

K = 50


def queries_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean entities of the query side, written once, since every channel reads them again."""
    return Scratch(spark).cut(N.clean_entities(B.deliveries_once(table(spark, sf_dir, "top50_train_source1"))))


def targets_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean entities of the target side, written once."""
    return Scratch(spark).cut(N.clean_entities(B.deliveries_once(raw(spark, sf_dir, "top50_train_source2", "top50_train_source3"))))


def idf_of(targets: DataFrame) -> DataFrame:
    """Token weights of the target side, written once."""
    return Scratch(targets.sparkSession).cut(idf_table(targets, {"name": "name_tokens", "addr": "addr_tokens"}))


def idf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idf_of(targets_side(spark, sf_dir)).withColumn("idf", F.round("idf", 9))


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.postings(targets_side(spark, sf_dir)).select("country", "bit", F.replace("key", F.lit("\x01"), F.lit("/")).alias("key"), "pos", "tgt")


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = targets_side(spark, sf_dir)
    return B.candidates(queries_side(spark, sf_dir), t, idf_of(t), K)


def blocking_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = lambda df: df.where("name_clean <> ''")
    return G.summed_blocking(named(queries_side(spark, sf_dir)), named(targets_side(spark, sf_dir)), *G.SUMS["scored"], least=0)


def blocking_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.staged_blocking(queries_side(spark, sf_dir), targets_side(spark, sf_dir), *G.CASCADES["cascade"])


def blocking_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = targets_side(spark, sf_dir)
    return B.intersection_blocking(queries_side(spark, sf_dir), t, idf_of(t))


QUERIES = {f.__name__: f for f in (idf_weights, postings, candidates, blocking_scored, blocking_cascade, blocking_intersection)}


def _once(names: tuple[str, ...], out: str) -> str:
    rows = " union all ".join(f"select * from {n}" for n in names)
    return f"""
{out}_once as (
  select * from (
    select *, row_number() over (partition by entity_id order by business_name nulls last, business_address nulls last, country nulls last) as n from ({rows}) where entity_id is not null)
  where n = 1)"""


@cache
def sides() -> str:
    """CTEs ``l`` and ``r`` (clean entities of both sides) and ``idf``."""
    fields = " union all ".join(f"select distinct country, '{f}' as field, entity_id, unnest({c}) as token from r where country is not null" for f, c in (("name", "name_tokens"), ("addr", "addr_tokens")))
    return f"""
{_once(('top50_train_source1',), 'l')}, {S.clean_entities('l_once', 'l')},
{_once(('top50_train_source2', 'top50_train_source3'), 'r')}, {S.clean_entities('r_once', 'r')},
n_docs as (select country, count(*) as n_docs from r where country is not null group by country),
idf as materialized (
  select country, field, token, df, n_docs, ln((n_docs + 1) / (df + 1)) + 1 as idf
  from (select country, field, token, count(*) as df from ({fields}) where length(token) >= 3 group by all) join n_docs using (country)
  where df <= floor(n_docs * 0.25))"""


def _rare(side: str, field: str, column: str, top: int) -> str:
    return f"""
  select entity_id, country, token, w from (
    select *, row_number() over (partition by entity_id, country order by w desc, place) as n from (
      select t.entity_id, t.country, t.token, t.place, coalesce(i.idf, 1.0) as w
      from (select entity_id, country, unnest({column}) as token, unnest(range(1, len({column}) + 1)) as place from {side} where country is not null) t
      left join idf i on i.country = t.country and i.field = '{field}' and i.token = t.token
      where length(t.token) >= 3))
  where n <= {top}"""


_POST = "postal_clean || chr(1) || "
_FIRST = "coalesce(string_split(addr_digits, ' ')[1], '')"


@cache
def posting_lists() -> str:
    one = lambda o, bit, key, keep: f"select country, {bit} as bit, {key} as key, {o} as ord, entity_id as tgt, postal_clean as postal from rr where {keep}"
    many = lambda o, bit, arr: f"select country, {bit}, unnest({arr}), {o}, entity_id, postal_clean from rr"
    # within one target and channel only the two numeric keys may be equal, so an order by kind is enough
    rows = " union all ".join([
        one(0, 8, "name_core", "length(name_core) >= 3"), one(1, 8, "sc", "sc <> name_core and length(sc) >= 3"),
        one(2, 8, "cat", "cat <> name_core and cat <> sc and length(cat) >= 4"),
        many(3, 7, f"list_filter(list_distinct(name_tokens || {S.words('st')}), lambda t: length(t) >= 3)"),
        one(4, 6, "name_tokens[1] || '_' || name_tokens[2]", "len(name_tokens) >= 2"),
        many(5, 5, f"case when length(cat) >= 4 then list_distinct({S.char_grams('cat', 3)}) else [] end"),
        one(6, 4, "name_acronym", "length(name_acronym) >= 2"), many(7, 3, "list_filter(addr_tokens, lambda t: length(t) >= 3)"),
        one(8, 2, _POST + _FIRST, f"postal_clean <> '' and {_FIRST} <> ''"), one(9, 2, _POST + "addr_unit_num", "postal_clean <> '' and addr_unit_num <> ''"),
        one(10, 1, "postal_clean", "postal_clean <> ''"), one(11, 0, "name_phonetic || chr(1) || postal_clean[1:4]", "postal_clean <> '' and name_phonetic <> ''"),
    ])
    caps = " ".join(f"when {b} then {n}" for b, n in B.CHANNELS.values())
    return f"""
rr as materialized (select *, replace(st, ' ', '') as cat from (select *, {S.without_domain('name_core')} as sc, {S.without_domain('name_clean')} as st from r where country is not null)),
lists as materialized (
  select country, bit, key, pos, tgt, postal from (
    select *, row_number() over (partition by country, bit, key order by tgt, ord) as pos from ({rows}))
  where pos <= case bit {caps} end)"""


@cache
def candidate_sql(k: int) -> str:
    def one(bit: int, weight: str, key: str, keep: str, most: int, postal: str = "null") -> str:
        s, n, a = (x * B.MILLION for x in B.WEIGHTS[weight])
        return f"select entity_id as s1, country, {bit} as bit, {key} as key, {most} as most, {s} as score, {n} as name, {a} as addr, {postal} as postal from ll where {keep}"

    gram = B.WEIGHTS["gram"][0] * B.MILLION
    w6, w5 = (f"cast(round(w * {f} * {B.MILLION}) as bigint)" for f in (B.NAME_FACTOR, B.ADDRESS_FACTOR))
    rows = " union all ".join([
        one(8, "core", "name_core", "length(name_core) >= 3", 1500), one(8, "concat", "cat", "length(cat) >= 4", 1500),
        one(8, "stripped", "sc", "sc <> name_core and length(sc) >= 3", 1500), one(6, "stem", "t[1] || '_' || t[2]", "len(t) >= 2", 40),
        f"select entity_id, country, 5, unnest(({S.char_grams('name_clean', 3)})[1:{B.GRAMS}]), 20, {gram}, {gram}, 0, null from ll where length(name_clean) >= 4",
        one(4, "acronym", "name_acronym", "length(name_acronym) >= 2 and postal_clean <> ''", 40, "postal_clean"),
        one(2, "digit", _POST + _FIRST, f"postal_clean <> '' and {_FIRST} <> ''", 40), one(2, "unit", _POST + "addr_unit_num", "postal_clean <> '' and addr_unit_num <> ''", 40),
        one(1, "postal", "postal_clean", "postal_clean <> ''", 25),
        one(0, "phonetic", "name_phonetic || chr(1) || postal_clean[1:4]", "postal_clean <> '' and name_phonetic <> ''", 40),
        f"select entity_id, country, 7, token, case when w >= 3 then 60 when w >= 2 then 30 else 15 end, {w6}, {w6}, 0, null from rare_names",
        f"select entity_id, country, 3, token, case when w >= 3 then 50 when w >= 2 then 25 else 10 end, {w5}, 0, {w5}, null from rare_places",
    ])
    n1, n2, worth = max(1, int(k * 0.6)), max(1, int(k * 0.2)), B.WORTH * B.MILLION
    flags = ", ".join(f"cast((mask >> {b}) & 1 as tinyint) as {c}" for c, (b, _) in B.CHANNELS.items())
    return f"""
with {sides()}, {posting_lists()},
rare_names as materialized ({_rare('l', 'name', 'name_tokens', B.TOP_RARE)}),
rare_places as materialized ({_rare('l', 'addr', 'addr_tokens', B.TOP_RARE)}),
ll as materialized (select *, {S.without_domain('name_core')} as sc, replace({S.without_domain('name_clean')}, ' ', '') as cat, list_filter(name_tokens, lambda x: length(x) >= 3) as t from l where country is not null),
keys as materialized ({rows}),
acc as (
  select s1, tgt, sum(score) as score, sum(name) as name, sum(addr) as addr, bit_or(cast(1 << bit as integer)) as mask
  from keys join lists using (country, bit, key)
  where pos <= most and (keys.postal is null or keys.postal = lists.postal) group by s1, tgt),
scored as (
  select s1, tgt, name, addr, mask, cast(bit_count(mask) as integer) as n,
         cast(score + (case when bit_count(mask) >= 2 then cast(bit_count(mask) as integer) * {B.CHANNEL_BONUS} else 0 end + case when name > 0 and addr > 0 then {B.BOTH_BONUS} else 0 end) * {B.MILLION} as bigint) as score
  from acc),
t1 as (select *, row_number() over (partition by s1 order by score desc, tgt) <= {n1} as in1 from scored),
t2 as (select *, not in1 and row_number() over (partition by s1, in1 order by addr desc, score desc, tgt) <= {n2} and addr >= {worth} as in2 from t1),
t3 as (select *, in1 or in2 as in12, count(*) filter (in1 or in2) over (partition by s1) as has from t2),
t4 as (select *, not in12 and row_number() over (partition by s1, in12 order by name desc, score desc, tgt) <= {k} - has and name >= {worth} as in3 from t3),
t5 as (select *, in12 or in3 as in123, count(*) filter (in12 or in3) over (partition by s1) as has2 from t4),
t6 as (select *, row_number() over (partition by s1, in123 order by score desc, tgt) as r4 from t5)
select s1 as source1_entity_id, tgt as target_entity_id, cast(((score + 5000) // 10000) / 100 as float) as candidate_score,
       cast(row_number() over (partition by s1 order by score desc, tgt) as smallint) as candidate_rank, {flags},
       cast(n as tinyint) as num_channels, cast(mask as smallint) as channel_mask
from t6 where in123 or r4 <= {k} - has2"""


def _tokens_hit(column: str, least: int, most: int, factor: float) -> str:
    t = f"(select distinct country, entity_id as tgt, unnest({column}) as token from r where country is not null and name_clean <> '')"
    n = "(select country, count(*) as n from r where country is not null and name_clean <> '' group by country)"
    df = f"(select country, token, cast(round(ln(any_value(n) / count(*)) * {factor} * {B.MILLION}) as bigint) as w from {t} join {n} using (country) group by country, token having count(*) between {least} and {most})"
    return f"""
  select q.entity_id as s1, t.tgt, d.w from (select distinct country, entity_id, unnest({column}) as token from l where country is not null and name_clean <> '') q
  join {df} d using (country, token) join {t} t using (country, token)"""


def _stages(side: str, out: str) -> str:
    bigrams = "list_distinct(list_transform(range(1, len(name_tokens)), lambda i: name_tokens[i] || ' ' || name_tokens[i + 1]))"
    parts = ((1, "[name_clean]"), (2, bigrams), (3, "name_tokens"), (4, "[postal_clean]"))
    return " union all ".join(f"select country, entity_id as {out}, {s} as stage, unnest(list_filter({a}, lambda x: x <> '')) as key from {side} where country is not null" for s, a in parts)


SQL = {
    "idf_weights": f"with {sides()} select country, field, token, df, n_docs, round(idf, 9) as idf from idf",
    "postings": f"with {sides()}, {posting_lists()} select country, cast(bit as integer) as bit, replace(key, chr(1), '/') as key, cast(pos as integer) as pos, tgt from lists",
    "candidates": candidate_sql(K),
    "blocking_scored": f"""
with {sides()},
few as (select country, postal_clean from r where country is not null and name_clean <> '' and postal_clean <> '' group by all having count(*) <= 1000),
hits as (
  select l.entity_id as s1, r.entity_id as tgt, 100 * {B.MILLION} as w from l join r using (country, name_clean) where name_clean <> ''
  union all {_tokens_hit('name_tokens', 1, 35000, 1.0)} union all {_tokens_hit('addr_tokens', 2, 10000, 0.7)}
  union all select l.entity_id, r.entity_id, 2 * {B.MILLION} from l join few using (country, postal_clean) join r using (country, postal_clean) where l.name_clean <> '' and r.name_clean <> ''),
summed as (select s1, tgt, sum(w) as score from hits group by s1, tgt),
ranked as (select *, row_number() over (partition by s1 order by score desc, tgt) as rank from summed)
select s1, tgt, ((cast(score as bigint) + 5000) // 10000) / 100 as score, cast(rank as integer) as rank from ranked where rank <= 35""",
    "blocking_cascade": f"""
with {sides()}, rk as materialized ({_stages('r', 'tgt')}), lk as ({_stages('l', 's1')}),
few as (select country, stage, key from rk group by all having count(*) <= case any_value(stage) when 1 then 2147483647 when 2 then 15000 when 3 then 20000 else 500 end),
firsts as (select s1, tgt, min(stage) as stage from lk join few using (country, stage, key) join rk using (country, stage, key) group by s1, tgt)
select s1, tgt, cast(stage as integer) as stage, cast(rank as integer) as rank
from (select *, row_number() over (partition by s1 order by stage, tgt) as rank from firsts) where rank <= 25""",
    "blocking_intersection": f"""
with {sides()},
q as (select distinct entity_id as s1, country, token, f from (select *, 'n' as f from ({_rare('l', 'name', 'name_tokens', 3)}) union all select *, 'a' from ({_rare('l', 'addr', 'addr_tokens', 2)}))),
t as (select distinct country, entity_id as tgt, unnest(name_tokens) as token, 'n' as f from r where country is not null union all select distinct country, entity_id, unnest(addr_tokens), 'a' from r where country is not null),
two as (select s1, tgt, count(*) as shared from q join t using (country, token, f) group by s1, tgt having count(*) >= 2 and count(*) filter (f = 'n') >= 1)
select s1, tgt, shared, cast(rank as integer) as rank from (select *, row_number() over (partition by s1 order by shared desc, tgt) as rank from two) where rank <= 25""",
}
