"""Queries of the staged and summed blockers with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from knotwork.operators import staged as G
from knotwork.plans.blocking_queries import queries_side, sides, targets_side


def _cascade(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: G.staged_blocking(queries_side(spark, sf_dir), targets_side(spark, sf_dir), *G.CASCADES[name])


def _sum(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: G.summed_blocking(queries_side(spark, sf_dir), targets_side(spark, sf_dir), *G.SUMS[name])


MORE = [n for n in G.CASCADES if n != "cascade"]
MORE_SUMS = [n for n in G.SUMS if n != "scored"]
QUERIES = {f"blocking_{n}": _cascade(n) for n in MORE} | {f"blocking_{n}": _sum(n) for n in MORE_SUMS}


def _neighbours(tokens: str) -> str:
    return f"list_distinct(list_transform(range(1, len({tokens})), lambda i: {tokens}[i] || ' ' || {tokens}[i + 1]))"


_KEYS = {
    "name": "list_filter([name_clean], lambda v: v <> '')", "bigram": _neighbours("name_tokens"), "first": "case when len(name_tokens) >= 2 then [name_tokens[1] || ' ' || name_tokens[2]] else [] end",
    "token": "list_distinct(name_tokens)", "place": "list_distinct(addr_tokens)", "place bigram": _neighbours("addr_tokens"), "postal": "list_filter([postal_clean], lambda v: v <> '')",
    "prefix": "list_filter([name_clean[1:4]], lambda v: length(v) = 4)",
}


def _keyed(side: str, kinds: list[str], out: str) -> str:
    return " union all ".join(f"select country, entity_id as {out}, {i} as stage, unnest({_KEYS[k]}) as key from {side} where country is not null" for i, k in enumerate(kinds, 1))


def _by_stage(values: list) -> str:
    return "case stage " + " ".join(f"when {i} then {v}" for i, v in enumerate(values, 1)) + " end"


def cascade_sql(stages: list[G.Stage], k: int) -> str:
    kinds, last, steps = [s.kind for s in stages], "firsts", []
    for i, s in enumerate(stages, 1):
        if s.below:
            steps.append(f"open{i} as (select s1, tgt, stage from (select *, count(*) filter (stage < {i}) over (partition by s1) as b from {last}) where stage <> {i} or b < {s.below})")
            last = f"open{i}"
    more = "".join(", " + x for x in steps)
    return f"""
with {sides()}, rk as materialized ({_keyed('r', kinds, 'tgt')}), lk as ({_keyed('l', kinds, 's1')}),
few as (select country, stage, key, count(*) as df from rk group by all having count(*) <= {_by_stage([s.most for s in stages])}),
rr as (select * from (select *, row_number() over (partition by country, stage, key order by tgt) as pos from rk) where pos <= {_by_stage([s.take or 2**31 - 1 for s in stages])}),
ll as (select * from (select *, row_number() over (partition by s1, stage order by df, key) as n from lk join few using (country, stage, key)) where n <= {_by_stage([s.rarest or 2**31 - 1 for s in stages])}),
firsts as (select s1, tgt, min(stage) as stage from ll join rr using (country, stage, key) group by s1, tgt){more}
select s1, tgt, cast(stage as integer) as stage, cast(rank as integer) as rank
from (select *, row_number() over (partition by s1 order by stage, tgt) as rank from {last}) where rank <= {k}"""


def sum_sql(parts: list[G.Part], k: int) -> str:
    kinds = [p.kind for p in parts]
    sure = _by_stage([str(p.confirmed).lower() for p in parts])
    return f"""
with {sides()}, rk as materialized ({_keyed('r', kinds, 'tgt')}), lk as ({_keyed('l', kinds, 's1')}),
sizes as (select country, count(*) as n from r where country is not null group by country),
counted as (select country, stage, key, count(*) as df from rk group by all having count(*) <= {_by_stage([p.most for p in parts])}),
w as (select country, stage, key, cast(round(({_by_stage([p.weight for p in parts])}) * {G.MILLION}) as bigint) as w from counted join sizes using (country)),
hits as (select s1, tgt, {sure} as sure, w from lk join w using (country, stage, key) join rk using (country, stage, key)),
pairs as (select s1, tgt, coalesce(sum(w) filter (not sure), 0) as plain, coalesce(sum(w) filter (sure), 0) as if_token from hits group by s1, tgt),
summed as (select s1, tgt, cast(plain + case when if_token > 0 and list_has_any(l.name_tokens, r.name_tokens) then if_token else 0 end as bigint) as w
  from pairs join l on l.entity_id = s1 join r on r.entity_id = tgt)
select s1, tgt, ((w + 5000) // 10000) / 100 as score, cast(rank as integer) as rank
from (select *, row_number() over (partition by s1 order by w desc, tgt) as rank from summed where w > 0) where rank <= {k}"""


SQL = {f"blocking_{n}": cascade_sql(*G.CASCADES[n]) for n in MORE} | {f"blocking_{n}": sum_sql(*G.SUMS[n]) for n in MORE_SUMS}
