"""Queries of this subpackage with the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from knotwork.llm.addresses import same_premises
from knotwork.llm.groups import consolidate
from knotwork.llm.leaks import leaked, spans
from knotwork.llm.matching import labelled, match, unlabelled_matches
from knotwork.llm.names import variants
from knotwork.llm.packing import fill, pack
from knotwork.llm.splits import COUNTRIES, broken_by_folds, split
from knotwork.llm.top_n import top_n
from knotwork.llm.truncated import truncated, truncation_rates
from knotwork.plans.core_queries import SQL as CORE_SQL
from knotwork.session import table

P7_SQL = CORE_SQL["p7_found"]


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(spark, table(spark, sf_dir, "top50_train_source3"), "entity_id", "business_name")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consolidate(spark, table(spark, sf_dir, "candidate_schema"), "source1_entity_id", "target_entity_id")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    one, three, labels = (table(spark, sf_dir, t) for t in ("top50_train_source1", "top50_train_source3", "train_matched_ids"))
    return unlabelled_matches(spark, one, three, labels)


def p3_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    one, three, labels = (table(spark, sf_dir, t) for t in ("top50_train_source1", "top50_train_source3", "train_matched_ids"))
    return match(spark, one, three, labelled(labels))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_n(table(spark, sf_dir, "candidate_schema"), "source1_entity_id", "target_entity_id", "candidate_score", "candidate_rank", 5)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return same_premises(spark, table(spark, sf_dir, "top50_train_source3"), "entity_id", "business_address")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return broken_by_folds(spark, table(spark, sf_dir, "train_folds"), table(spark, sf_dir, "train_matched_ids"))


def p6_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = {"train": 0.8, "validation": 0.1, "test": 0.1}
    return split(spark, table(spark, sf_dir, "train_folds"), table(spark, sf_dir, "train_matched_ids"), parts)


#: Tokens a container holds.
CAPACITY = 4096


def p8_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark, table(spark, sf_dir, "documents"), CAPACITY)


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill(pack(spark, table(spark, sf_dir, "documents"), CAPACITY), CAPACITY)


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaked(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p9_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncated(spark, table(spark, sf_dir, "documents"))


def p10_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation_rates(spark, table(spark, sf_dir, "documents"))


QUERIES = {"p1_found": p1_found, "p5_found": p5_found, "p2_found": p2_found, "p3_found": p3_found, "p3_matches": p3_matches, "p4_found": p4_found, "p6_found": p6_found, "p6_split": p6_split, "p8_packed": p8_packed, "p8_fill": p8_fill, "p9_found": p9_found, "p9_spans": p9_spans, "p10_found": p10_found, "p10_rates": p10_rates}

#: Smallest label of every node over the symmetric table ``edges(a, b)``, from a table ``nodes(id)``.
_LABELS = """
labels(id, label) using key (id) as (
  select id, id from nodes
  union
  select e.b, min(w.label) from labels w join edges e on e.a = w.id join recurring.labels r on r.id = e.b where w.label < r.label group by e.b)"""

#: Entities of ``train_folds`` in their usual form with the smallest entity related to them.
_RELATED = f"""
v as (
  select 'e:' || upper(regexp_replace(source1_entity_id, '^\\s+|\\s+$', '', 'g')) as e, 'm:' || upper(regexp_extract(matched_value, '^\\s*([^\\s,;|/()]+)', 1)) as m from ({P7_SQL}) where source1_entity_id is not null),
f as (select * from (select upper(regexp_replace(entity_id, '^\\s+|\\s+$', '', 'g')) as id, fold_id, country from train_folds) where id <> ''),
edges as (select e as a, m as b from v union select m, e from v), nodes as (select e as id from v union select m from v union select 'e:' || id from f),
{_LABELS},
rows_ as (select f.id, fold_id, country, label from f join labels l on l.id = 'e:' || f.id)"""

_COUNTRY = "case " + " ".join(
    f"when regexp_replace(upper(country), '[^A-Z]', '', 'g') in ({', '.join(repr(x.replace(' ', '')) for x in forms)}) then '{name}'" for name, forms in COUNTRIES.items()
) + " when trim(regexp_replace(coalesce(country, ''), '[.\\s]+', ' ', 'g')) = '' then null else upper(trim(regexp_replace(country, '[.\\s]+', ' ', 'g'))) end"

SQL = {
    "p6_split": f"""
with recursive {_RELATED},
one as (select id as entity_id, label[3:] as component, min({_COUNTRY}) as c from rows_ group by all),
size as (select component, count(*) as n, coalesce(min(c), 'unknown') as country from one group by component),
placed as (select *, (sum(n) over (partition by country order by md5('0|' || component), component) - n / 2) / sum(n) over (partition by country) as middle from size)
select entity_id, component, country, case when middle < 0.8 then 'train' when middle < 0.9 then 'validation' else 'test' end as part from one join placed using (component)""",
    "p2_found": f"""
with recursive nodes as (
  select distinct unnest([source1_entity_id, target_entity_id]) as id from candidate_schema),
edges as (
  select source1_entity_id as a, target_entity_id as b from candidate_schema where source1_entity_id is not null and target_entity_id is not null
  union select target_entity_id, source1_entity_id from candidate_schema where source1_entity_id is not null and target_entity_id is not null),
{_LABELS.replace('from nodes', 'from nodes where id is not null')}
select id as record_id, label as group_id from labels""",
    "p6_found": f"""
with recursive {_RELATED}
select distinct id as entity_id from rows_ where label in (select label from rows_ group by label having count(distinct fold_id) > 1)""",
    "p4_found": """
with once as (
  select source1_entity_id, target_entity_id, cast(candidate_score as double) as s, candidate_rank as r
  from candidate_schema
  where source1_entity_id is not null and target_entity_id is not null
    and candidate_score is not null and not isnan(candidate_score)),
best as (
  select source1_entity_id, target_entity_id, s, min(coalesce(r, 2147483647)) as r
  from once
  where (source1_entity_id, target_entity_id, s) in
        (select (source1_entity_id, target_entity_id, max(s)) from once group by source1_entity_id, target_entity_id)
  group by all)
select source1_entity_id, target_entity_id, cast(n as integer) as place
from (select *, row_number() over (partition by source1_entity_id order by s desc, r, target_entity_id) as n from best)
where n <= 5
""",
}
