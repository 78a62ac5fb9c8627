"""Queries of entity metrics, threshold searches and diagnostics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knotwork.functions import normalize as N
from knotwork.operators import blocking as B
from knotwork.operators import diagnostics as D
from knotwork.operators import metrics as M
from knotwork.operators import truth as T
from knotwork.plans import core_queries
from knotwork.plans.blocking_queries import queries_side, sides, targets_side
from knotwork.plans.text_queries import SOURCES, raw
from knotwork.plans.text_queries import ALL as ALL_SOURCES
from knotwork.plans import sql as S
from knotwork.session import table

# Thresholds of the global and the country search, and the decision of the reports.
GLOBAL, BY_COUNTRY = (0.20, 0.01, 76), (0.25, 0.01, 71)
DEFAULT, DECISION, GAP = 0.55, 0.55, 0.35
START_S2, START_S3 = 0.89, 0.91


def _truth(spark, d) -> DataFrame:
    return T.truth_pairs(table(spark, d, "train_matched_ids"))


def _entities(spark, d) -> DataFrame:
    return T.truth_entities(table(spark, d, "train_matched_ids"))


def _candidates(spark, d) -> DataFrame:
    return T.ranked_candidates(table(spark, d, "candidate_schema"))


def _scored(spark, d) -> DataFrame:
    return T.scored_once(table(spark, d, "scored_pairs"))


def _universe(scored: DataFrame, entities: DataFrame) -> DataFrame:
    """(s1, country) of all entities in pairs or truth; those without a pair have the country Unknown."""
    c = scored.groupBy("s1").agg(F.min("country").alias("country"))
    return c.join(entities.select("s1"), "s1", "full_outer").select("s1", F.coalesce("country", F.lit("Unknown")).alias("country"))


def _stepped(scored: DataFrame, grid: tuple) -> DataFrame:
    return scored.withColumn("step", M.step_of(F.col("prob"), *grid))


def _theta(step, grid: tuple):
    return F.round(grid[0] + (step - 1) * grid[1], 2)


def ground_truth_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _truth(spark, sf_dir)


def ranked_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _candidates(spark, sf_dir)


def entity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _scored(spark, sf_dir)
    out = M.entity_scores(s.where(F.col("prob") >= DECISION), _truth(spark, sf_dir), _universe(s, _entities(spark, sf_dir)))
    return out.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f05")})


def macro_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _scored(spark, sf_dir)
    u = _universe(s, _entities(spark, sf_dir))
    scores = M.entity_scores(s.where(F.col("prob") >= DECISION), _truth(spark, sf_dir), u).join(u, "s1")
    out = M.macro(scores, "country")
    return out.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f05", "singleton_accuracy")})


def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _scored(spark, sf_dir)
    out = M.sweep(_stepped(s, GLOBAL), _truth(spark, sf_dir), _universe(s, _entities(spark, sf_dir)), GLOBAL[2])
    return out.select(_theta(F.col("step"), GLOBAL).alias("theta"), "entities", F.round("f05", 9).alias("f05"))


def country_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _scored(spark, sf_dir)
    u = _universe(s, _entities(spark, sf_dir))
    out = M.best_step(M.sweep(_stepped(s, BY_COUNTRY), _truth(spark, sf_dir), u, BY_COUNTRY[2], ["country"]), "country")
    theta = F.when(F.col("country") == "Unknown", DEFAULT).otherwise(_theta(F.col("step"), BY_COUNTRY))
    return out.select("country", theta.alias("theta"), "entities", F.round("f05", 9).alias("f05"))


def source_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best thresholds by country and source: first for S2 with that of S3 fixed, then for S3."""
    s = _scored(spark, sf_dir)
    truth, u = _truth(spark, sf_dir), _universe(s, _entities(spark, sf_dir))
    n = BY_COUNTRY[2]
    step = M.step_of(F.col("prob"), *BY_COUNTRY)
    fixed = s.withColumn("step", F.when(F.col("source") == "S2", step).otherwise(F.when(F.col("prob") >= START_S3, n).otherwise(0)))
    two = M.best_step(M.sweep(fixed, truth, u, n, ["country"]), "country").select("country", F.col("step").alias("k2"))
    with_two = s.join(u.select("s1", F.col("country").alias("c")), "s1").join(F.broadcast(two), F.col("c") == two["country"]).drop(two["country"])  # a row a country
    fixed = with_two.withColumn("step", F.when(F.col("source") == "S3", step).otherwise(F.when(step >= F.col("k2"), n).otherwise(0)))
    three = M.best_step(M.sweep(fixed.select("s1", "tgt", "step"), truth, u, n, ["country"]), "country").select("country", "entities", F.col("step").alias("k3"), "f05")
    return three.join(F.broadcast(two), "country").where("country <> 'Unknown'").select(
        "country", _theta(F.col("k2"), BY_COUNTRY).alias("theta_s2"), _theta(F.col("k3"), BY_COUNTRY).alias("theta_s3"), "entities", F.round("f05", 9).alias("f05")
    )


def margin_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.when(F.col("country") == "India", 0.5).when(F.col("source") == "S3", 0.6).otherwise(DECISION)
    return M.within_margin(_scored(spark, sf_dir), t, GAP).select("s1", "tgt", "prob", "source")


def contradiction_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from knotwork.functions.pairs import jaro_winkler_of

    p = D.pair_records(_scored(spark, sf_dir).where("prob is not null"), queries_side(spark, sf_dir), targets_side(spark, sf_dir))
    first = lambda side: F.get(F.split(F.col(f"{side}.addr_digits"), " "), F.lit(0))
    conflict = lambda a, b: (a != "") & (b != "") & (a != b)
    jw = jaro_winkler_of(F.col("l.name_clean"), F.col("r.name_clean"))
    p = p.select("s1", "tgt", "prob", F.round(jw, 6).alias("jw"), conflict(first("l"), first("r")).alias("house"), conflict(F.col("l.postal_clean"), F.col("r.postal_clean")).alias("postal"))
    needed = F.lit(DECISION) + M.contradiction_penalty(F.col("jw"), F.col("house"), F.col("postal"))
    return p.where(F.col("prob") >= needed).select("s1", "tgt", "prob", F.round("jw", 4).alias("jw"), F.round(needed, 4).alias("needed"))


def _two(spark, d) -> DataFrame:
    c = _candidates(spark, d).select("s1", "tgt", F.least(F.lit(1.0), F.col("score") / 250).alias("p2"))
    return _scored(spark, d).where("prob is not null").join(c, ["s1", "tgt"]).select("s1", "tgt", F.col("prob").alias("p1"), "p2")


def classifier_disagreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = M.disagreement(_two(spark, sf_dir), _truth(spark, sf_dir), 0.3, 0.8, 0.5)
    return out.withColumn("rescue_rate", F.round("rescue_rate", 9))


def blend_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best threshold for eleven weights of two scores; every weight is a group of the sweep."""
    s = _two(spark, sf_dir)
    weights = F.explode(F.array(*[F.lit(i / 10) for i in range(11)])).alias("w")
    pairs = s.select("s1", "tgt", "p1", "p2", weights).withColumn("prob", F.round(F.col("w") * F.col("p1") + (1 - F.col("w")) * F.col("p2"), 6))
    key = lambda c: F.concat_ws("|", F.col("w").cast("string"), c)
    truth = _truth(spark, sf_dir)
    ids = s.select("s1").distinct().select("s1", weights)
    tagged = truth.select("s1", "tgt", weights).select(key("s1").alias("s1"), "tgt")
    out = M.sweep(pairs.select(key("s1").alias("s1"), "tgt", M.step_of(F.col("prob"), *GLOBAL).alias("step")), tagged, ids.select(key("s1").alias("s1"), "w"), GLOBAL[2], ["w"])
    return M.best_step(out, "w").select("w", _theta(F.col("step"), GLOBAL).alias("theta"), "entities", F.round("f05", 9).alias("f05"))


def recall_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = D.recall_at(_candidates(spark, sf_dir), _truth(spark, sf_dir))
    return out.withColumns({"recall": F.round("recall", 9), "precision": F.round("precision", 9)})


def recall_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    of = B.deliveries_once(table(spark, sf_dir, "top50_train_source1")).select(F.col("entity_id").alias("s1"), "country")
    return D.recall_by(_candidates(spark, sf_dir), _truth(spark, sf_dir), of, 50).withColumns({"recall": F.round("recall", 9), "oracle": F.round("oracle", 9)})


def ceiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _scored(spark, sf_dir)
    out = D.oracle_ceiling(s.where(F.col("prob") >= DECISION), _candidates(spark, sf_dir), _truth(spark, sf_dir), _universe(s, _entities(spark, sf_dir)))
    return out.select(*[F.round(c, 9).alias(c) for c in out.columns])


def error_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _scored(spark, sf_dir)
    return D.error_records(s.where(F.col("prob") >= DECISION).select("s1", "tgt"), _candidates(spark, sf_dir), _truth(spark, sf_dir), _universe(s, _entities(spark, sf_dir)))


def error_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return error_records(spark, sf_dir).groupBy("error").count()


def channel_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.attribution(_candidates(spark, sf_dir), _truth(spark, sf_dir), {c: b for c, (b, _) in B.CHANNELS.items()})


def blocking_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.missed(_candidates(spark, sf_dir), _truth(spark, sf_dir))


def signal_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.coverage(D.pair_records(_truth(spark, sf_dir), queries_side(spark, sf_dir), targets_side(spark, sf_dir)))


def signal_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.profile(D.pair_records(_truth(spark, sf_dir), queries_side(spark, sf_dir), targets_side(spark, sf_dir)))


def key_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = N.clean_entities(raw(spark, sf_dir, *SOURCES))
    return D.collisions(e, ["name_clean", "name_core", "name_acronym", "name_phonetic", "postal_clean"]).withColumn("top_share", F.round("top_share", 9))


FLAGS = [*B.CHANNELS, "num_channels", "candidate_score"]


def feature_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("candidate_score")
    c = table(spark, sf_dir, "candidate_schema").where(F.col("target_entity_id").isNotNull() & s.isNotNull() & ~F.isnan(s))
    t = _truth(spark, sf_dir).select(F.col("s1").alias("source1_entity_id"), F.col("tgt").alias("target_entity_id"), F.lit(1).alias("label"))
    out = D.quality(c.join(t, ["source1_entity_id", "target_entity_id"], "left").fillna(0, ["label"]), FLAGS)
    return out.select("feature", "positives", "negatives", *[F.round(x, 6).alias(x) for x in ("mean_positive", "mean_negative", "median_positive", "median_negative", "sd_positive", "sd_negative", "auc", "ks")])


QUERIES = {
    f.__name__: f
    for f in (
        ground_truth_pairs, ranked_candidates, entity_scores, macro_scores, threshold_sweep, country_thresholds, source_thresholds, margin_filter,
        contradiction_gate, classifier_disagreement, blend_sweep, recall_curve, recall_by_country, ceiling, error_records, error_counts,
        channel_attribution, blocking_misses, signal_coverage, signal_profile, key_collisions, feature_quality,
    )
}

TRUTH = f"""
truth as materialized (
  select distinct source1_entity_id as s1, regexp_extract(matched_value, '^\\s*([^\\s,;|/()]+)', 1) as tgt from ({core_queries.SQL['p7_found']})
  where source1_entity_id is not null),
known as (select distinct source1_entity_id as s1 from train_matched_ids where source1_entity_id is not null)"""
CAND = """
cand as materialized (
  select *, row_number() over (partition by s1 order by score desc, tgt) as rank from (
    select source1_entity_id as s1, target_entity_id as tgt, cast(b.candidate_score as double) as score, b.channel_mask as mask, b.num_channels as channels from (
      select source1_entity_id, target_entity_id, max({'candidate_score': candidate_score, 'channel_mask': channel_mask, 'num_channels': num_channels}) as b
      from candidate_schema where target_entity_id is not null and candidate_score is not null and not isnan(candidate_score) group by 1, 2)))"""
SCORED = """
scored as materialized (
  select s1_id as s1, tgt_id as tgt, max(case when not isnan(prob) then prob end) as prob, min(country) as country, min(source) as source
  from scored_pairs where s1_id is not null group by 1, 2),
universe as materialized (
  select s1, coalesce(max(country), 'Unknown') as country from (select s1, min(country) as country from scored group by s1 union all select s1, null from known) group by s1)"""


def f_half(tp: str = "tp", n_pred: str = "n_pred", n_true: str = "n_true") -> str:
    p, r = f"({tp} / {n_pred})", f"({tp} / {n_true})"
    return f"case when {n_true} = 0 and {n_pred} = 0 then 1.0 when {tp} > 0 then 1.25 * {p} * {r} / (0.25 * {p} + {r}) else 0.0 end"


def entity_cte(predicted: str, name: str = "per") -> str:
    return f"""
{name} as (
  select s1, coalesce(n_true, 0) as n_true, coalesce(n_pred, 0) as n_pred, coalesce(tp, 0) as tp
  from universe left join (select s1, count(*) as n_true from truth group by s1) using (s1)
  left join (select p.s1, count(*) as n_pred, count(t.s1) as tp from ({predicted}) p left join truth t on t.s1 = p.s1 and t.tgt = p.tgt group by p.s1) using (s1))"""


_PR = "case when n_true = 0 and n_pred = 0 then 1.0 when n_pred > 0 and n_true > 0 then tp / n_pred else 0.0 end"
_RC = "case when n_true = 0 and n_pred = 0 then 1.0 when n_true > 0 then tp / n_true else 0.0 end"


def swept(pairs: str, grid: tuple, by: str = "1", entities: str = "universe", truth: str = "truth") -> str:
    """The plain form: every pair against every threshold."""
    start, step, n = grid
    return f"""
  select {by} as g, k, count(*) as entities, avg({f_half()}) as f05 from (
    select e.*, k, coalesce(n_true, 0) as n_true, coalesce(n_pred, 0) as n_pred, coalesce(tp, 0) as tp
    from {entities} e cross join (select unnest(range(1, {n} + 1)) as k) grid
    left join (select s1, count(*) as n_true from {truth} group by s1) using (s1)
    left join (
      select p.s1, g.k, count(*) as n_pred, count(t.s1) as tp from {pairs} p join (select unnest(range(1, {n} + 1)) as k) g on p.step >= g.k
      left join {truth} t on t.s1 = p.s1 and t.tgt = p.tgt group by all) using (s1, k))
  group by all"""


def step_sql(grid: tuple, prob: str = "prob") -> str:
    start, step, n = grid
    return f"(case when {prob} is null then 0 else greatest(0, least({n}, cast(floor(({prob} - {start}) / {step} + 1e-7) as integer) + 1)) end)"


def theta_sql(k: str, grid: tuple) -> str:
    return f"cast(round({grid[0]} + ({k} - 1) * {grid[1]}, 2) as double)"


_TAKEN = f"select s1, tgt from scored where prob >= {DECISION}"
_TWO = "select s.s1, s.tgt, s.prob as p1, least(1.0, c.score / 250) as p2 from scored s join cand c on c.s1 = s.s1 and c.tgt = s.tgt where s.prob is not null"
_BEST = lambda rel: f"select * from (select *, row_number() over (partition by g order by round(f05, 9) desc, k) as n from ({rel})) where n = 1"
_OF = "(select entity_id as s1, country from (select *, row_number() over (partition by entity_id order by business_name nulls last, business_address nulls last, country nulls last) as n from top50_train_source1 where entity_id is not null) where n = 1)"
_FIRST = lambda s: f"coalesce(string_split({s}.addr_digits, ' ')[1], '')"
_CONFLICT = lambda a, b: f"({a} <> '' and {b} <> '' and {a} <> {b})"
_OVER = lambda c: f"len(list_intersect(l.{c}, r.{c})) > 0"
_SAME = lambda c: f"(l.{c} = r.{c} and l.{c} <> '')"
_SIGNALS = {
    "name_exact": _SAME("name_clean"), "core_exact": _SAME("name_core"), "name_token": _OVER("name_tokens"), "acronym": _SAME("name_acronym"), "phonetic": _SAME("name_phonetic"),
    "addr_token": _OVER("addr_tokens"), "digit": f"len(list_intersect({S.words('l.addr_digits')}, {S.words('r.addr_digits')})) > 0", "postal": _SAME("postal_clean"), "unit": _SAME("addr_unit_num"),
}
_COLLIDE = ["name_clean", "name_core", "name_acronym", "name_phonetic", "postal_clean"]
_BITS = {c: f"((mask >> {b}) & 1) = 1" for c, (b, _) in B.CHANNELS.items()}

SQL = {
    "ground_truth_pairs": f"with {TRUTH} select * from truth where tgt <> ''",
    "ranked_candidates": f"with {CAND} select s1, tgt, score, mask, channels, cast(rank as integer) as rank from cand",
    "entity_scores": f"with {TRUTH}, {SCORED}, {entity_cte(_TAKEN)} select s1, n_true, n_pred, tp, round({_PR}, 9) as precision, round({_RC}, 9) as recall, round({f_half()}, 9) as f05 from per",
    "macro_scores": f"""
with {TRUTH}, {SCORED}, {entity_cte(_TAKEN)}
select country, count(*) as entities, round(avg({_PR}), 9) as precision, round(avg({_RC}), 9) as recall, round(avg({f_half()}), 9) as f05,
       round(avg(case when n_true = 0 then cast(n_pred = 0 as double) end), 9) as singleton_accuracy
from per join universe using (s1) group by country""",
    "threshold_sweep": f"""
with {TRUTH}, {SCORED}, stepped as (select *, {step_sql(GLOBAL)} as step from scored)
select {theta_sql('k', GLOBAL)} as theta, entities, round(f05, 9) as f05 from ({swept('stepped', GLOBAL)})""",
    "country_thresholds": f"""
with {TRUTH}, {SCORED}, stepped as (select *, {step_sql(BY_COUNTRY)} as step from scored)
select g as country, case when g = 'Unknown' then cast({DEFAULT} as double) else {theta_sql('k', BY_COUNTRY)} end as theta, entities, round(f05, 9) as f05 from ({_BEST(swept('stepped', BY_COUNTRY, 'country'))})""",
    "source_thresholds": f"""
with {TRUTH}, {SCORED},
first as (select s1, tgt, case when source = 'S2' then {step_sql(BY_COUNTRY)} when prob >= {START_S3} then {BY_COUNTRY[2]} else 0 end as step from scored),
two as materialized ({_BEST(swept('first', BY_COUNTRY, 'country'))}),
second as (select s.s1, s.tgt, case when source = 'S3' then {step_sql(BY_COUNTRY)} when {step_sql(BY_COUNTRY)} >= two.k then {BY_COUNTRY[2]} else 0 end as step from scored s join universe u using (s1) join two on two.g = u.country),
three as ({_BEST(swept('second', BY_COUNTRY, 'country'))})
select three.g as country, {theta_sql('two.k', BY_COUNTRY)} as theta_s2, {theta_sql('three.k', BY_COUNTRY)} as theta_s3, three.entities, round(three.f05, 9) as f05
from three join two using (g) where g <> 'Unknown'""",
    "margin_filter": f"""
with {SCORED.replace('known', '(select distinct source1_entity_id as s1 from train_matched_ids)')}
select s1, tgt, prob, source from (select *, max(prob) over (partition by s1) as best from scored)
where prob >= case when country = 'India' then 0.5 when source = 'S3' then 0.6 else {DECISION} end and best - prob <= {GAP} + 1e-9""",
    "contradiction_gate": f"""
with {sides()}, {SCORED.replace('known', '(select distinct source1_entity_id as s1 from train_matched_ids)')},
p as (
  select s.s1, s.tgt, s.prob, round(case when l.name_clean = '' or r.name_clean = '' then cast(l.name_clean = r.name_clean as double) else jaro_winkler_similarity(l.name_clean, r.name_clean) end, 6) as jw,
         {_CONFLICT(_FIRST('l'), _FIRST('r'))} as house, {_CONFLICT('l.postal_clean', 'r.postal_clean')} as postal
  from scored s join l on l.entity_id = s.s1 join r on r.entity_id = s.tgt where s.prob is not null),
n as (select *, {DECISION} + case when house then case when jw < 0.90 then 0.10 when jw < 0.95 then 0.04 else 0.01 end else 0 end + case when postal then case when jw < 0.90 then 0.08 else 0.02 end else 0 end as needed from p)
select s1, tgt, prob, round(jw, 4) as jw, round(cast(needed as double), 4) as needed from n where prob >= needed""",
    "classifier_disagreement": f"""
with {TRUTH}, {SCORED}, {CAND},
near as (select t.s1 is not null as y, p1 >= 0.5 as a, p2 >= 0.5 as b from ({_TWO}) p left join truth t using (s1, tgt) where p1 between 0.3 and 0.8 or p2 between 0.3 and 0.8)
select count(*) as pairs, count(*) filter (a = y and b = y) as both_right, count(*) filter (a = y and b <> y) as first_only,
       count(*) filter (a <> y and b = y) as second_only, count(*) filter (a <> y and b <> y) as both_wrong,
       round(count(*) filter (a <> y and b = y) / count(*), 9) as rescue_rate from near""",
    "blend_sweep": f"""
with {TRUTH}, {SCORED}, {CAND}, two as materialized ({_TWO}), ws as (select unnest(range(0, 11)) / 10 as w),
pairs as (select w || '|' || s1 as s1, tgt, {step_sql(GLOBAL, 'round(w * p1 + (1 - w) * p2, 6)')} as step from two cross join ws),
ids as (select distinct w || '|' || s1 as s1, w from two cross join ws), tagged as (select w || '|' || s1 as s1, tgt from truth cross join ws)
select g as w, {theta_sql('k', GLOBAL)} as theta, entities, round(f05, 9) as f05 from ({_BEST(swept('pairs', GLOBAL, 'w', 'ids', 'tagged'))})""",
    "recall_curve": f"""
with {TRUTH}, {CAND}, ks as (select unnest([{', '.join(map(str, D.CUTS))}]) as k),
c as (select c.rank, t.s1 is not null as y from cand c semi join truth h on h.s1 = c.s1 left join truth t on t.s1 = c.s1 and t.tgt = c.tgt),
n as (select count(*) as true_pairs from truth)
select cast(k as integer) as k, any_value(true_pairs) as true_pairs, count(*) filter (y) as captured, count(*) as candidates,
       round(count(*) filter (y) / any_value(true_pairs), 9) as recall, round(count(*) filter (y) / count(*), 9) as precision
from ks join c on c.rank <= ks.k cross join n group by k""",
    "recall_by_country": f"""
with {TRUTH}, {CAND}, hit as (select o.country, c.s1 is not null as y from truth t join {_OF} o using (s1) left join cand c on c.s1 = t.s1 and c.tgt = t.tgt and c.rank <= 50)
select country, true_pairs, captured, round(captured / true_pairs, 9) as recall, round(1.25 * (captured / true_pairs) / (0.25 + captured / true_pairs), 9) as oracle
from (select case when grouping(country) = 1 then 'ALL' else coalesce(country, 'unknown') end as country, count(*) as true_pairs, count(*) filter (y) as captured from hit group by rollup (country))""",
    "ceiling": f"""
with {TRUTH}, {SCORED}, {CAND}, {entity_cte(_TAKEN)}, {entity_cte('select s1, tgt from truth semi join cand using (s1, tgt)', 'best')},
a as (select avg({f_half()}) as reached from per), b as (select avg({f_half()}) as ceiling from best)
select round(reached, 9) as reached, round(ceiling, 9) as ceiling, round(1 - ceiling, 9) as lost_in_blocking, round(ceiling - reached, 9) as lost_in_choice from a, b""",
    "error_records": f"""
with {TRUTH}, {SCORED}, {CAND}, taken as ({_TAKEN})
select s1, tgt, case when s1 in (select s1 from truth) then 'CLASSIFIER_FALSE_POSITIVE' else 'SINGLETON_FALSE_POSITIVE' end as error from taken anti join truth using (s1, tgt)
union all select s1, tgt, 'BLOCKER_DROP_MISS' from truth anti join cand using (s1, tgt)
union all select s1, tgt, 'CLASSIFIER_FALSE_NEGATIVE' from (select * from truth semi join cand using (s1, tgt)) anti join taken using (s1, tgt)""",
    "channel_attribution": f"with {TRUTH}, {CAND}, t as (select mask, t.s1 is not null as y from cand c left join truth t using (s1, tgt)) "
    + " union all ".join(f"select '{c}' as channel, count(*) filter ({on}) as hits, count(*) filter ({on} and y) as true_hits, count(*) filter ({on} and y and bit_count(mask) = 1) as unique_true_hits from t" for c, on in _BITS.items()),
    "blocking_misses": f"with {TRUTH}, {CAND} select s1, tgt from truth anti join cand using (s1, tgt)",
    "signal_coverage": f"""
with {sides()}, {TRUTH},
s as (select coalesce(l.country, 'unknown') as country, {', '.join(f'{v} as {k}' for k, v in _SIGNALS.items())} from truth t join l on l.entity_id = t.s1 join r on r.entity_id = t.tgt)
select country, count(*) as pairs, {', '.join(f'count(*) filter ({k}) as {k}' for k in _SIGNALS)},
       count(*) filter (name_exact or core_exact or name_token or addr_token or acronym and postal or phonetic and postal) as captured,
       count(*) filter (name_token or postal) as name_or_postal, count(*) filter (name_token or addr_token) as name_or_addr,
       count(*) filter ({' or '.join(_SIGNALS)}) as any from s group by country""",
    "signal_profile": f"""
with {sides()}, {TRUTH},
s as (
  select coalesce(l.country, 'unknown') as country, l.name_clean = r.name_clean and l.name_clean <> '' as exact_name, list_has_any(l.name_tokens, r.name_tokens) as token,
         len(list_distinct(l.name_tokens || r.name_tokens)) > 0 and len(list_intersect(l.name_tokens, r.name_tokens)) >= 0.5 * len(list_distinct(l.name_tokens || r.name_tokens)) as half_of_tokens,
         list_has_any(l.addr_tokens, r.addr_tokens) as place, l.postal_clean = r.postal_clean and l.postal_clean <> '' as postal, l.name_phonetic = r.name_phonetic and l.name_phonetic <> '' as sound,
         len(list_intersect({S.char_grams('l.name_clean', 3)}, {S.char_grams('r.name_clean', 3)})) >= 2 as two_trigrams
  from truth t join l on l.entity_id = t.s1 join r on r.entity_id = t.tgt)
select country, count(*) as pairs, {', '.join(f'count(*) filter ({k}) as {k}' for k in ('exact_name', 'token', 'half_of_tokens', 'place', 'postal', 'sound', 'two_trigrams'))},
       count(*) filter (exact_name or token) as exact_or_token, count(*) filter (exact_name or token or place) as exact_token_or_place, count(*) filter (token and postal) as token_and_postal,
       count(*) filter (token and place) as token_and_place, count(*) filter (sound or token) as sound_or_token, count(*) filter (two_trigrams or token) as trigrams_or_token,
       count(*) filter (exact_name or token or place or postal or sound) as any_key
from s group by country""",
    "key_collisions": f"with {S.clean_entities(ALL_SOURCES)} "
    + " union all ".join(
        f"select '{c}' as column, cast(sum(n) as bigint) as rows, count(*) as distinct_values, max(n) as largest, round(cast(sum(n) filter (k <= 10) as bigint) / cast(sum(n) as bigint), 9) as top_share"
        f" from (select *, row_number() over (order by n desc, v) as k from (select {c} as v, count(*) as n from entities where {c} <> '' group by 1))"
        for c in _COLLIDE
    ),
    "feature_quality": f"""
with {TRUTH},
c as (select c.*, cast(t.s1 is not null as integer) as y from candidate_schema c left join truth t on t.s1 = source1_entity_id and t.tgt = target_entity_id
      where target_entity_id is not null and candidate_score is not null and not isnan(candidate_score)),
long as ({' union all '.join(f"select '{f}' as feature, y, cast({f} as double) as x from c" for f in FLAGS)}),
n as (select feature, x, count(*) filter (y = 1) as p, count(*) filter (y = 0) as n from long group by feature, x),
w as (select *, sum(p) over a as cp, sum(n) over a as cn, sum(p) over b as ps, sum(n) over b as ns from n window a as (partition by feature order by x), b as (partition by feature)),
u as (select feature, sum(p * (cn - n + n / 2)) / (max(ps) * max(ns)) as a, max(abs(cp / ps - cn / ns)) as ks from w group by feature)
select feature, count(*) filter (y = 1) as positives, count(*) filter (y = 0) as negatives, round(avg(x) filter (y = 1), 6) as mean_positive, round(avg(x) filter (y = 0), 6) as mean_negative,
       round(median(x) filter (y = 1), 6) as median_positive, round(median(x) filter (y = 0), 6) as median_negative,
       round(stddev_pop(x) filter (y = 1), 6) as sd_positive, round(stddev_pop(x) filter (y = 0), 6) as sd_negative, round(greatest(any_value(a), 1 - any_value(a)), 6) as auc, round(any_value(ks), 6) as ks
from long join u using (feature) group by feature""",
}
SQL["error_counts"] = f"select error, count(*) as count from ({SQL['error_records']}) group by error"
