"""Queries of the general data-processing operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from knotwork.operators.packed import unpack
from knotwork.session import table


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unpack(table(spark, sf_dir, "train_matched_ids"), "matched_entity_ids", ["source1_entity_id"]).distinct()


QUERIES = {"p7_found": p7_found}

#: Values of every packed field, in order; fields without any have an empty list.
UNPACKED = r"""
select source1_entity_id, v from (
with parts as (
  select source1_entity_id,
         regexp_extract_all(matched_entity_ids, '"(?:[^"]|"")*"|''[^'']*''|[^\s,;|，/\[\]{}()]+') as raw
  from train_matched_ids where matched_entity_ids is not null),
vals as (
  select source1_entity_id,
         list_filter(
           list_transform(raw, lambda x: trim(case when x[1] = '"' then replace(x[2:-2], '""', '"') when x[1] = '''' then x[2:-2] else x end)),
           lambda x: lower(x) not in ('', 'none', 'null', 'nan', '-')) as v
  from parts)
select * from vals)
"""

SQL = {
    "p7_found": f"""
select distinct source1_entity_id, cast(i as integer) as value_no, v[i] as matched_value
from (select source1_entity_id, v, unnest(range(1, len(v) + 1)) as i from ({UNPACKED}))
""",
}
