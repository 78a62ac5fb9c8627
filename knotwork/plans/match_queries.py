"""Queries of pair features, sampling, training, decisions and result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knotwork.functions import vocabulary as V
from knotwork.ml import model
from knotwork.functions import normalize as N
from knotwork.operators import blocking as B
from knotwork.operators import diagnostics as D
from knotwork.operators import features as X
from knotwork.operators import metrics as M
from knotwork.operators import sampling as P
from knotwork.operators import stress as Z
from knotwork.operators import truth as T
from knotwork.operators.validate import violations
from knotwork.plans import sql as S
from knotwork.plans.core_queries import UNPACKED
from knotwork.plans.blocking_queries import _once, idf_of, queries_side, sides, targets_side
from knotwork.plans.quality_queries import CAND, SCORED, TRUTH
from knotwork.session import Scratch, table
from knotwork.sources.tables import packed_lists


def _truth(spark, d) -> DataFrame:
    return T.truth_pairs(table(spark, d, "train_matched_ids"))


def candidate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate rows once a pair: the row of the best score, mask and rank, with a usable score."""
    s = F.col("candidate_score")
    c = table(spark, sf_dir, "candidate_schema").where(F.col("target_entity_id").isNotNull() & s.isNotNull() & ~F.isnan(s))
    rest = [x for x in c.columns if x not in ("source1_entity_id", "target_entity_id")]
    best = F.max(F.struct("candidate_score", "channel_mask", F.coalesce("candidate_rank", F.lit(-1)).alias("_r"), *[x for x in rest if x not in ("candidate_score", "channel_mask")])).alias("b")
    one = c.groupBy("source1_entity_id", "target_entity_id").agg(best)
    return one.select("source1_entity_id", "target_entity_id", *[F.col(f"b.{x}").alias(x) for x in rest])


def _features(spark, d, only_plain: bool) -> DataFrame:
    t = targets_side(spark, d)
    idf = idf_of(t)
    return X.pair_features(candidate_rows(spark, d), X.prepare(queries_side(spark, d), idf), X.prepare(t, idf), only_plain)


def plain_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _features(spark, sf_dir, True)
    return out.select("source1_entity_id", "target_entity_id", *[F.round(c, 6).alias(c) for c in out.columns[2:]])


def pair_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir, False)


def edit_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Those of the edit similarities that SQL can say."""
    out = _features(spark, sf_dir, False)
    return out.select("source1_entity_id", "target_entity_id", *[F.round(c, 6).alias(c) for c in (*EDITS, *WINKLER)])


def holdout_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.holdout(table(spark, sf_dir, "top50_train_source1").select("entity_id", "country"), "country", 0.1)


def fold_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "train_matched_ids")
    one = B.deliveries_once(table(spark, sf_dir, "top50_train_source1"))
    known = T.truth_entities(labels)
    return P.folds(one.join(known.select(F.col("s1").alias("entity_id")), "entity_id", "left_semi"), known)


def labelled_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.labelled_candidates(candidate_rows(spark, sf_dir).select("source1_entity_id", "target_entity_id"), _truth(spark, sf_dir))


def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.hard_negatives(labelled_candidates(spark, sf_dir))


def entity_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.disjoint_split(labelled_candidates(spark, sf_dir), "source1_entity_id")


def matched_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = T.scored_once(table(spark, sf_dir, "scored_pairs")).where("prob >= 0.55").withColumn("rank", -F.col("prob"))
    return packed_lists(s, table(spark, sf_dir, "top50_train_source1"))


def result_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks of the given training matches as if they were results, against the candidates."""
    c = table(spark, sf_dir, "candidate_schema").where("target_entity_id is not null").groupBy("source1_entity_id").agg(F.array_join(F.collect_set("target_entity_id"), ",").alias("candidate_entity_ids"))
    required = table(spark, sf_dir, "top50_train_source1").select(F.col("entity_id").alias("source1_entity_id"))
    return violations(table(spark, sf_dir, "train_matched_ids"), c, required)


def random_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.random_sample(B.deliveries_once(table(spark, sf_dir, "top50_train_source3")), 500)


def french_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Z.french_set(B.deliveries_once(table(spark, sf_dir, "top50_train_source1")))


def blocking_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All shared keys of the query entities with source 2, counted by how much is shared."""
    r = Scratch(spark).cut(N.clean_entities(B.deliveries_once(table(spark, sf_dir, "top50_train_source2"))))
    return B.union_counts(queries_side(spark, sf_dir), r)


def union_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of the query entities with the targets of both sources that share a key, none passed over."""
    return B.union_blocking(queries_side(spark, sf_dir), targets_side(spark, sf_dir))


def union_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """True pairs among the delivered entities of both sides, and how many of them share a key, by the target's source."""
    return B.union_recall(queries_side(spark, sf_dir), targets_side(spark, sf_dir), _truth(spark, sf_dir))


def miss_forensics(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = T.ranked_candidates(table(spark, sf_dir, "candidate_schema"))
    return D.miss_forensics(D.missed(c, _truth(spark, sf_dir)), queries_side(spark, sf_dir), targets_side(spark, sf_dir))


def trained_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Macro scores of a blend of two classifiers on entities neither was trained on, by threshold.

    The classifiers are fitted on all positives and three negatives each of the training entities.
    """
    rows = P.labelled_candidates(candidate_rows(spark, sf_dir), _truth(spark, sf_dir))
    known = T.truth_entities(table(spark, sf_dir, "train_matched_ids"))
    rows = rows.join(known.select(F.col("s1").alias("source1_entity_id")), "source1_entity_id", "left_semi")
    t = targets_side(spark, sf_dir)
    idf = idf_of(t)
    f = Scratch(spark).cut(P.disjoint_split(X.pair_features(rows, X.prepare(queries_side(spark, sf_dir), idf), X.prepare(t, idf)), "source1_entity_id"))
    train = P.hard_negatives(f.where("part = 'train'"))
    names = X.feature_names()
    one, two = model.train(train, names), model.train(train, names, "forest")
    scored = model.probability(two, model.probability(one, f.where("part = 'validation'"), "p1"), "p2")
    scored = model.blend(scored, "p1", "p2", 0.7).select(F.col("source1_entity_id").alias("s1"), F.col("target_entity_id").alias("tgt"), "prob")
    entities = P.disjoint_split(known, "s1").where("part = 'validation'")
    grid = (0.20, 0.05, 16)
    out = M.sweep(scored.withColumn("step", M.step_of(F.col("prob"), *grid)), _truth(spark, sf_dir).join(entities.select("s1"), "s1", "left_semi"), entities, grid[2])
    return out.select(F.round(grid[0] + (F.col("step") - 1) * grid[1], 2).alias("theta"), "entities", "f05")


QUERIES = {
    f.__name__: f
    for f in (candidate_rows, plain_features, pair_features, edit_features, holdout_entities, fold_table, labelled_candidates, hard_negatives, entity_split, matched_lists, result_violations, random_sample, french_set, blocking_union, union_pairs, union_recall, miss_forensics, trained_scores)
}

ROWS = """
rows_ as materialized (
  select source1_entity_id, target_entity_id, b.* exclude (_r) from (
    select source1_entity_id, target_entity_id, max({'candidate_score': candidate_score, 'channel_mask': channel_mask, '_r': coalesce(candidate_rank, -1), 'candidate_rank': candidate_rank,
      'c_name_core': c_name_core, 'c_name_token': c_name_token, 'c_name_contain': c_name_contain, 'c_char_3gram': c_char_3gram, 'c_acronym': c_acronym, 'c_addr_token': c_addr_token,
      'c_addr_numeric': c_addr_numeric, 'c_postal': c_postal, 'c_phonetic': c_phonetic, 'num_channels': num_channels}) as b
    from candidate_schema where target_entity_id is not null and candidate_score is not null and not isnan(candidate_score) group by 1, 2))"""


def _prepared(side: str) -> str:
    weight = lambda f, t: f"list_transform({t}, lambda x: coalesce(list_extract(map_extract(m, '{f}' || chr(1) || country || chr(1) || x), 1), 1.0))"
    return f"""
{side}p as materialized (
  select *, list_distinct(nt) as ns, list_distinct(at_) as as_, replace(name_clean, ' ', '') as cat, list_distinct({S.char_grams('name_core', 3)}) as g3, list_distinct({S.char_grams('name_core', 4)}) as g4,
         {S.skeleton('name_core')} as skeleton, list_filter(at_, lambda x: x in {S.listed(V.LOCALITY_WORDS)}) as loc, list_filter(at_, lambda x: x in {S.listed(V.LANDMARK_WORDS)}) as land
  from (select *, case when len(name_tokens) > 0 then name_tokens else {S.words('name_clean')} end as nt, case when len(addr_tokens) > 0 then addr_tokens else {S.words('addr_clean')} end as at_,
               {S.words('addr_digits')} as ds from {side}))"""


def _pair_rows() -> str:
    """CTEs up to ``p``: candidate rows with the prepared entities of both ends, columns ``l_`` and ``r_``."""
    columns = ["country", "name_clean", "name_core", "legal_form", "name_acronym", "name_phonetic", "addr_clean", "postal_clean", "addr_unit_num", "nt", "at_", "ds", "cat", "g3", "g4", "skeleton", "loc", "land"]
    empty = {"country": "{}", "legal_form": "coalesce({}, 'NONE')"}
    take = lambda s: ", ".join(empty.get(c, "coalesce({}, [])" if c in ("nt", "at_", "ds", "g3", "g4", "loc", "land") else "coalesce({}, '')").format(f"{s}p.{c}") + f" as {s}_{c}" for c in columns)
    return f"""{sides()}, {_prepared('l')}, {_prepared('r')}, {ROWS},
p as materialized (select rows_.*, {take('l')}, {take('r')} from rows_ left join lp on lp.entity_id = source1_entity_id left join rp on rp.entity_id = target_entity_id)"""


#: Edit similarities of one text of both ends each: the feature, its text and whether it is Jaro-Winkler.
EDITS = {
    "name_clean_fuzz_ratio": "{}_name_clean", "name_core_fuzz_ratio": "{}_name_core", "name_first_token_similarity": "coalesce({}_nt[1], '')", "name_last_token_similarity": "coalesce({}_nt[-1], '')",
    "phonetic_similarity": "{}_name_phonetic", "name_consonant_skeleton_sim": "{}_skeleton", "addr_clean_fuzz_ratio": "{}_addr_clean",
    "name_clean_token_sort_ratio": "array_to_string(list_sort(list_filter(string_split({}_name_clean, ' '), lambda w: w <> '')), ' ')",
}
WINKLER = {"name_clean_jaro_winkler": "name_clean", "name_core_jaro_winkler": "name_core"}


def _edit_sql() -> str:
    """Common subsequences by the bits of a whole number: one step for each letter of one text, over all places of the other."""
    texts = ", ".join(f"{v.format(s)} as {s}{i}" for i, v in enumerate(EDITS.values()) for s in "lr")
    long = " union all ".join(f"select source1_entity_id, target_entity_id, '{k}' as f, l{i} as a, r{i} as b from t" for i, k in enumerate(EDITS))
    mask = "coalesce(list_sum(list_transform(range(0, n), lambda i: case when b[i + 1] = c then cast(1 as hugeint) << cast(i as integer) else cast(0 as hugeint) end)), 0)"
    return f"""
with {_pair_rows()},
t as (select source1_entity_id, target_entity_id, {texts} from p),
long as (select *, length(b) as n, (cast(1 as hugeint) << length(b)) - 1 as full_ from ({long}) where a <> '' and b <> ''),
v as (
  select source1_entity_id, target_entity_id, f, length(a) as m, n,
         list_reduce(list_prepend(full_, list_transform(string_split(a, ''), lambda c: cast({mask} as hugeint))), lambda v, x: ((v + (v & x)) | (v - (v & x))) & full_) as v from long),
ratios as (select source1_entity_id, target_entity_id, f, 2 * (n - bit_count(v)) / (m + n) as x from v),
w as (select source1_entity_id, target_entity_id, {', '.join(f"coalesce(max(x) filter (f = '{k}'), 0) as {k}" for k in EDITS)} from ratios group by all)
select source1_entity_id, target_entity_id, {', '.join(f'round(coalesce({k}, 0.0), 6) as {k}' for k in EDITS)},
       {', '.join(f"round(case when l_{c} <> '' and r_{c} <> '' then jaro_winkler_similarity(l_{c}, r_{c}) else 0.0 end, 6) as {k}" for k, c in WINKLER.items())}
from p left join w using (source1_entity_id, target_entity_id)"""


def _plain_sql() -> str:
    l, r = (lambda c: f"l_{c}"), (lambda c: f"r_{c}")
    given = lambda c: f"({l(c)} <> '' and {r(c)} <> '')"
    same = lambda c: f"({given(c)} and {l(c)} = {r(c)})"
    other = lambda c: f"({given(c)} and {l(c)} <> {r(c)})"
    flag = lambda c: f"cast(coalesce({c}, false) as double)"
    jac = lambda c: S.jaccard(l(c), r(c))
    legal = "(l_legal_form <> 'NONE' and r_legal_form <> 'NONE')"
    size = lambda c: f"len(list_distinct({c}))"
    shared = lambda a, b: f"len(list_intersect(list_distinct({a}), list_distinct({b})))"
    prefix = lambda p: f"case when l_country = 'France' then {p}[1:2] else {p}[1:3] end"
    start = lambda a, t: f"cast(length({a}) >= 2 and len({t}) > 0 and contains(array_to_string(list_transform({t}, lambda w: w[1]), ''), {a}) as double)"
    core, post = same("name_core"), same("postal_clean")
    house = "(len(l_ds) > 0 and len(r_ds) > 0 and l_ds[1] = r_ds[1])"
    both_addr = given("addr_clean")
    f = {
        "name_core_exact_match": flag(core), "name_concat_exact_match": flag("length(l_cat) >= 4 and l_cat = r_cat"),
        "name_len_diff_ratio": "abs(length(l_name_clean) - length(r_name_clean)) / greatest(length(l_name_clean), length(r_name_clean), 1)",
        "name_containment_s1_in_tgt": f"case when {size('l_nt')} > 0 then {shared('l_nt', 'r_nt')} / {size('l_nt')} else 0 end", "name_containment_tgt_in_s1": f"case when {size('r_nt')} > 0 then {shared('l_nt', 'r_nt')} / {size('r_nt')} else 0 end",
        "name_token_jaccard": jac("nt"), "legal_form_match": flag(f"{legal} and l_legal_form = r_legal_form"), "legal_form_both_present": flag(legal), "legal_form_conflict": flag(f"{legal} and l_legal_form <> r_legal_form"),
        "acronym_exact_match": flag(same("name_acronym")), "acronym_in_name": flag("(l_name_acronym <> '' and list_contains(r_nt, l_name_acronym)) or (r_name_acronym <> '' and list_contains(l_nt, r_name_acronym))"),
        "acronym_initials_s1_in_tgt": start("l_name_acronym", "r_nt"), "acronym_initials_tgt_in_s1": start("r_name_acronym", "l_nt"), "phonetic_code_match": flag(same("name_phonetic")),
        "char_3gram_jaccard": jac("g3"), "char_4gram_jaccard": jac("g4"), "name_consonant_skeleton_exact": flag(same("skeleton")),
        "addr_token_jaccard": f"case when {both_addr} then {jac('at_')} else 0 end", "addr_token_overlap_count": f"case when {both_addr} then {shared('l_at_', 'r_at_')} else 0 end",
        "addr_locality_jaccard": jac("loc"), "addr_landmark_jaccard": jac("land"), "postal_exact_match": flag(post),
        "postal_prefix_match": flag(f"({prefix('l_postal_clean')}) <> '' and ({prefix('l_postal_clean')}) = ({prefix('r_postal_clean')})"), "postal_conflict": flag(other("postal_clean")),
        "unit_num_match": flag(same("addr_unit_num")), "unit_num_conflict": flag(other("addr_unit_num")), "house_num_match": flag(house), "house_num_conflict": flag("len(l_ds) > 0 and len(r_ds) > 0 and l_ds[1] <> r_ds[1]"),
        "addr_digits_jaccard": jac("ds"), "target_name_missing": flag("r_name_clean = ''"), "target_addr_missing": flag("r_addr_clean = ''"), "target_postal_missing": flag("r_postal_clean = ''"),
        "source_addr_missing": flag("l_addr_clean = ''"), "source_postal_missing": flag("l_postal_clean = ''"), "has_both_addr": flag(both_addr), "has_both_postals": flag(given("postal_clean")),
        "blocker_candidate_score": "cast(candidate_score as double)", "blocker_candidate_rank": "coalesce(candidate_rank, 60)", "blocker_reciprocal_rank": "case when coalesce(candidate_rank, 60) > 0 then 1 / coalesce(candidate_rank, 60) else 0 end",
        **{c: f"cast(coalesce({c}, 0) as double)" for c in B.CHANNELS}, "num_channels": "cast(coalesce(num_channels, 0) as double)",
        "c_name_and_addr_hit": flag("(coalesce(c_name_core, 0) > 0 or coalesce(c_name_token, 0) > 0) and (coalesce(c_addr_token, 0) > 0 or coalesce(c_addr_numeric, 0) > 0)"), "c_phonetic_and_postal_hit": flag("coalesce(c_phonetic, 0) > 0 and coalesce(c_postal, 0) > 0"),
        "exact_core_name_and_postal": flag(f"{core} and {post}"), "exact_core_name_and_house": flag(f"{core} and {house}"), "exact_core_name_and_locality": flag(f"{core} and len(list_intersect(l_loc, r_loc)) > 0"),
        "is_target_s2": flag("starts_with(target_entity_id, 'S2')"), "is_target_s3": flag("starts_with(target_entity_id, 'S3')"),
        **{f"is_country_{c.lower()}": flag(f"l_country = '{c}'") for c in ("India", "US", "France")},
    }
    # weights of tokens by side and country, joined pair by pair
    def weighted(field: str, column: str) -> str:
        return f"""
{field}_w as (
  select s, t, sum(w) filter (inl and inr) as both_, sum(w) as all_ from (
    select s, t, token, max(inl) as inl, max(inr) as inr, coalesce(any_value(w) filter (inl), any_value(w)) as w from (
      select x.*, coalesce(i.idf, 1.0) as w from (
        select source1_entity_id as s, target_entity_id as t, l_country as c, unnest(list_distinct(l_{column})) as token, true as inl, false as inr from p
        union all select source1_entity_id, target_entity_id, r_country, unnest(list_distinct(r_{column})), false, true from p) x
      left join idf i on i.country = x.c and i.field = '{field}' and i.token = x.token)
    group by s, t, token) group by s, t)"""
    rounded = ", ".join(f"round(cast({v} as double), 6) as {k}" for k, v in f.items())
    return f"""
with {_pair_rows()},
{weighted('name', 'nt')}, {weighted('addr', 'at_')}
select source1_entity_id, target_entity_id, {rounded},
       round(case when n.all_ > 0 then coalesce(n.both_, 0) / n.all_ else 0 end, 6) as name_idf_weighted_overlap,
       round(case when {both_addr} and a.all_ > 0 then coalesce(a.both_, 0) / a.all_ else 0 end, 6) as addr_idf_weighted_overlap
from p left join name_w n on n.s = source1_entity_id and n.t = target_entity_id left join addr_w a on a.s = source1_entity_id and a.t = target_entity_id"""


_LABELLED = f"{ROWS}, labelled as materialized (select source1_entity_id, target_entity_id, cast(t.s1 is not null as tinyint) as label from rows_ left join truth t on t.s1 = source1_entity_id and t.tgt = target_entity_id)"
_ONCE = "(select * from (select *, row_number() over (partition by entity_id order by business_name nulls last, business_address nulls last, country nulls last) as n from top50_train_source1 where entity_id is not null) where n = 1)"

_CHANCE = lambda *c: f"cast(('0x' || md5('42|' || {' || chr(124) || '.join(c)})[1:7]) as bigint) / 268435456"
_LETTER = "case " + " ".join(f"when c = '{p}' then '{f}'[cast(floor({_CHANCE('entity_id', chr(39) + 'form' + chr(39), '(i - 1)')} * {len(f)}) as integer) + 1]" for p, f in V.ACCENTED.items()) + " else c end"
_ENDING = "case " + " ".join(f"when regexp_matches(n, {S.q(p)}) then regexp_replace(n, {S.q(p)}, {S.q(e)}, 'g')" for p, e in V.FRENCH_ENDINGS) + " else n end"
# word boundaries here know only plain letters, so both are spelt out
_STREETS = [("(^|[^\\p{L}\\p{N}_])(?:" + p.removeprefix(r"\b(").removesuffix(r"\b") + "([^\\p{L}\\p{N}_]|$)", rf"\1{kind}\2") for p, kind in V.FRENCH_STREETS]
_SHARED_KEYS = " union all ".join(
    f"select country, entity_id, '{t}' || k as key from (select country, entity_id, unnest({a}) as k from {{side}} where country is not null)"
    for t, a in (("n:", "list_filter([name_clean], lambda x: x <> '')"), ("t:", "name_tokens"), ("a:", "addr_tokens"), ("p:", "list_filter([postal_clean], lambda x: length(x) >= 4)"))
)
_ONCE_OF = lambda t: f"(select * exclude (n) from (select *, row_number() over (partition by entity_id order by business_name nulls last, business_address nulls last, country nulls last) as n from {t} where entity_id is not null) where n = 1)"

SQL = {
    "random_sample": f"select * from {_ONCE_OF('top50_train_source3')} order by md5('42|' || entity_id), entity_id limit 500",
    "french_set": f"""
with a as (select entity_id, lower(coalesce(business_name, '')) as n, lower(coalesce(business_address, '')) as ad from {_ONCE_OF('top50_train_source1')}),
b as (select *, {_ENDING} as m, {S.chained('ad', _STREETS)} as address from a)
select 'FR_SYN_' || entity_id as entity_id, 'France' as country,
       case when {_CHANCE('entity_id', "'name'")} < 0.35 then array_to_string(list_transform(list_filter(string_split(m, ''), lambda c: c <> ''),
         lambda c, i: case when {_CHANCE('entity_id', "'letter'", '(i - 1)')} < 0.25 then {_LETTER} else c end), '') else m end as name,
       address, ([{', '.join(map(S.q, V.FRENCH_POSTAL_CODES))}])[cast(floor({_CHANCE('entity_id', "'code'")} * {len(V.FRENCH_POSTAL_CODES)}) as integer) + 1] as postal_code, entity_id as original_entity_id
from b""",
    "blocking_union": f"""
with {sides()}, {_once(('top50_train_source2',), 'x')}, {S.clean_entities('x_once', 'x')},
a as ({_SHARED_KEYS.format(side='l')}), b as ({_SHARED_KEYS.format(side='x')}),
p as (select a.entity_id as s1, b.entity_id as tgt, count(*) as shared from a join b using (country, key) group by all)
select shared, count(*) as count from p group by shared""",
    "miss_forensics": f"""
with {sides()}, {TRUTH}, {CAND}
select s1, tgt, cast(len(list_intersect(l.name_tokens, r.name_tokens)) as integer) as shared_name_tokens, cast(len(list_intersect(l.addr_tokens, r.addr_tokens)) as integer) as shared_addr_tokens,
       coalesce(l.country = r.country, false) as same_country, cast(levenshtein(l.name_clean, r.name_clean) as integer) as edits
from (select * from truth anti join cand using (s1, tgt)) m join l on l.entity_id = m.s1 join r on r.entity_id = m.tgt""",
    "candidate_rows": f"with {ROWS} select * from rows_",
    "union_recall": f"""
with {sides()}, {TRUTH},
u as (select distinct t.s1, t.tgt, coalesce(l.country = r.country and (l.name_clean = r.name_clean and l.name_clean <> '' or list_has_any(l.name_tokens, r.name_tokens) or list_has_any(l.addr_tokens, r.addr_tokens)
    or l.postal_clean = r.postal_clean and length(l.postal_clean) >= 4), false) as hit
  from truth t join l on l.entity_id = t.s1 join r on r.entity_id = t.tgt)
select tgt[1:2] as source, count(*) as true_pairs, count(*) filter (hit) as captured, count(*) filter (hit) / count(*) as recall from u group by 1""",
    "plain_features": _plain_sql(),
    "edit_features": _edit_sql(),
    "holdout_entities": """
select entity_id, country from (
  select entity_id, country, row_number() over (partition by country order by md5('42|' || entity_id), entity_id) as k, count(*) over (partition by country) as n from top50_train_source1)
where k <= floor(n * 0.1 + 1e-9)""",
    "fold_table": f"""
with {TRUTH},
e as (
  select entity_id, country, cast(coalesce(n, 0) as integer) as match_count, cast(trim(coalesce(business_address, '')) <> '' as tinyint) as has_address
  from {_ONCE} o left join (select s1, count(*) as n from truth group by s1) t on t.s1 = o.entity_id where entity_id in (select s1 from known)),
c as (select *, case when match_count = 0 then 'singleton' when match_count = 1 then '1_to_1' when match_count <= 5 then '2_to_5' else '6_plus' end as match_cardinality from e)
select entity_id, country, match_cardinality, has_address, match_count,
       cast((row_number() over (partition by country, match_cardinality, has_address order by md5('42|' || entity_id), entity_id) - 1) % 5 as tinyint) as fold_id
from c""".replace("coalesce(n, 0)", "coalesce(t.n, 0)"),
    "labelled_candidates": f"with {TRUTH}, {_LABELLED} select * from labelled",
    "hard_negatives": f"""
with {TRUTH}, {_LABELLED}
select source1_entity_id, target_entity_id, label from (
  select *, row_number() over (partition by label order by md5('42|' || source1_entity_id || '|' || target_entity_id), source1_entity_id, target_entity_id) as k from labelled)
where label = 1 or k <= 3 * (select count(*) from labelled where label = 1)""",
    "entity_split": f"""
with {TRUTH}, {_LABELLED}
select *, case when cast(('0x' || md5('42|' || source1_entity_id)[1:7]) as bigint) / 268435456 < 0.85 then 'train' else 'validation' end as part from labelled""",
    "matched_lists": f"""
with {SCORED.replace('known', '(select distinct source1_entity_id as s1 from train_matched_ids)')}
select entity_id as source1_entity_id, coalesce(ids, '') as matched_entity_ids from (select distinct entity_id from top50_train_source1 where entity_id is not null)
left join (select s1, string_agg(tgt, ',' order by prob desc, tgt) as ids from scored where prob >= 0.55 group by s1) on s1 = entity_id""",
    "result_violations": """
with v as materialized (select source1_entity_id as id, unnest(v) as v from (UNPACKED)),
ids as (select source1_entity_id as id from train_matched_ids), need as (select distinct entity_id as id from top50_train_source1),
k as (select distinct source1_entity_id as id, target_entity_id as v from candidate_schema where target_entity_id is not null)
select 'repeated id' as rule, id, cast(count(*) as varchar) as value from ids group by id having count(*) > 1
union all select 'missing id', id, null from need anti join ids using (id)
union all select 'unknown id', id, null from (select distinct id from ids) anti join need using (id)
union all select 'repeated match', id, v from v group by id, v having count(*) > 1
union all select 'match with itself', id, v from v where v = id
union all select 'wrong kind of id', id, v from v where v[1:3] not in ('S2-', 'S3-')
union all select 'match that is no candidate', id, v from (select distinct id, v from v) anti join k using (id, v)""".replace("UNPACKED", UNPACKED),
}
