"""Union blocking over both targets by brute force."""

import __spark_entry__ as entry

from knotwork.operators import truth as T
from knotwork.plans.blocking_queries import queries_side, targets_side
from knotwork.session import table


def keys(r):
    return {("n", r.name_clean)} - {("n", "")} | {("t", x) for x in r.name_tokens} | {("a", x) for x in r.addr_tokens} | ({("p", r.postal_clean)} if len(r.postal_clean or "") >= 4 else set())


def test_pairs_and_recall_cover_both_targets(spark, data):
    l, r = ([(x.entity_id, x.country, keys(x)) for x in side(spark, data).collect() if x.country is not None] for side in (queries_side, targets_side))
    expected = {(a, b): len(k & m) for a, c, k in l for b, d, m in r if c == d and k & m}
    assert {b[:2] for _, b in expected} == {"S2", "S3"}
    rows = entry.queries()["union_pairs"](spark, data).collect()
    assert len(rows) == len(expected) and {(x.s1, x.tgt): x.shared for x in rows} == expected
    ones, targets = ({x.entity_id for x in side(spark, data).collect()} for side in (queries_side, targets_side))
    true = {(x.s1, x.tgt) for x in T.truth_pairs(table(spark, data, "train_matched_ids")).collect() if x.s1 in ones and x.tgt in targets}
    got = {x.source: (x.true_pairs, x.captured) for x in entry.queries()["union_recall"](spark, data).collect()}
    assert got == {s: (sum(t[:2] == s for _, t in true), sum(p in expected for p in true if p[1][:2] == s)) for s in ("S2", "S3")}
