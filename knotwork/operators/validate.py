"""Checks of result tables: every rule gives the offending rows, none is silently repaired."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knotwork.operators.packed import unpack


def violations(results: DataFrame, candidates: DataFrame | None, required: DataFrame, id_column: str = "source1_entity_id", matched: str = "matched_entity_ids", listed: str = "candidate_entity_ids", prefixes: tuple[str, ...] = ("S2-", "S3-")) -> DataFrame:
    """(rule, id, value) of everything a result table may not have.

    ``results`` holds an id and a packed list; ``candidates``, where given, an id and the list its matches must be part
    of; ``required(id_column)`` names the ids that must come exactly once.
    """
    c = F.col(id_column)
    rule = lambda df, name, value: df.select(F.lit(name).alias("rule"), c.alias("id"), value.alias("value"))
    none = F.lit(None).cast("string")
    ids = results.select(id_column)
    v = unpack(results, matched, [id_column], value="v")
    out = [
        rule(ids.groupBy(id_column).count().where("count > 1"), "repeated id", F.col("count").cast("string")),
        rule(required.select(id_column).distinct().join(ids.distinct(), id_column, "left_anti"), "missing id", none),
        rule(ids.distinct().join(required.select(id_column).distinct(), id_column, "left_anti"), "unknown id", none),
        rule(v.groupBy(id_column, "v").count().where("count > 1"), "repeated match", F.col("v")),
        rule(v.where(F.col("v") == c), "match with itself", F.col("v")),
        rule(v.where(~F.substring("v", 1, 3).isin(*prefixes)), "wrong kind of id", F.col("v")),
    ]
    if candidates is not None:
        k = unpack(candidates, listed, [id_column], value="v").select(id_column, "v").distinct()
        out.append(rule(v.select(id_column, "v").distinct().join(k, [id_column, "v"], "left_anti"), "match that is no candidate", F.col("v")))
    all_ = out[0]
    for x in out[1:]:
        all_ = all_.unionByName(x)
    return all_


def malformed_lines(lines: DataFrame, header: str) -> DataFrame:
    """(value) of text lines without exactly one tab; the header line is none of them."""
    return lines.where((F.col("value") != header) & (F.length("value") - F.length(F.replace("value", F.lit("\t"), F.lit(""))) != 1))


def unlike_count(results: DataFrame, expected: int) -> DataFrame:
    """One row (rule, id, value) as of ``violations`` if ``results`` hasn't ``expected`` rows, none if it has."""
    n = results.agg(F.count("*").alias("n")).where(F.col("n") != expected)
    return n.select(F.lit("number of rows").alias("rule"), F.lit(None).cast("string").alias("id"), F.concat_ws(" instead of ", "n", F.lit(str(expected))).alias("value"))


#: What a result table looks like.
CONTRACT = {
    "id_column": "source1_entity_id", "matched_column": "matched_entity_ids", "candidate_column": "candidate_entity_ids", "separator": "\t", "list_separator": ",",
    "header": "source1_entity_id\tmatched_entity_ids", "target_prefixes": ["S2-", "S3-"], "query_prefix": "S1-", "one_row_per_query_entity": True, "empty_list_allowed": True,
}


def contract() -> str:
    """The contract of result tables as JSON text."""
    return json.dumps(CONTRACT, sort_keys=True, indent=2)
