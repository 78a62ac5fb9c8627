"""Joins whose cost does not depend on how the keys are spread."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A key of more than 1 / HOT_SHARE of the rows is hot, so there are at most so many, and no shuffle partition of the
#: remaining join gets more than such a share from one key.
HOT_SHARE = 512
#: Counters of the sketch that finds hot keys; with so many no key of that share is missed.
TRACKED = 8 * HOT_SHARE
#: So few rows are no load for a task, whatever their share, so a key of no more isn't hot.
HOT_ROWS = 5_000

#: Values of one key that stand in one list of ``many_join``.
LIST = 1_000


class Lookup(NamedTuple):
    """One column to add: ``out`` becomes the ``value`` that ``small`` has where its unique ``small_key`` equals ``key``.

    Without ``keep`` rows that find nothing are dropped, with it ``out`` is null there.
    """

    key: str
    small: DataFrame
    small_key: str
    value: str
    out: str
    keep: bool = False


def hot_keys(df: DataFrame, *keys: str) -> tuple[int, dict[str, list]]:
    """(rows, hot values by column) of ``df``, found in one pass by a sketch of fixed size; at most HOT_SHARE values a column."""
    distinct = list(dict.fromkeys(keys))
    sketches = [F.expr(f"approx_top_k(`{k}`, {HOT_SHARE}, {TRACKED}) filter (where `{k}` is not null)").alias(f"h{i}") for i, k in enumerate(distinct)]
    row = df.select(*distinct).agg(F.count(F.lit(1)).alias("n"), *sketches).first()
    return row["n"], {k: [x["item"] for x in row[f"h{i}"] or () if x["count"] > max(HOT_ROWS, row["n"] // HOT_SHARE)] for i, k in enumerate(distinct)}


def lookups(big: DataFrame, *wanted: Lookup, hot: dict[str, list] | None = None) -> DataFrame:
    """``big`` with the columns of all ``wanted`` lookups, each by a column that ``big`` has from the start.

    Hot keys of all lookups are found in one pass over the key columns (or given as ``hot``); they find their values in
    broadcast tables of at most HOT_SHARE rows. A shuffle join for each lookup serves the rest; rows already served, and
    those with a null key, which finds nothing, pass through it under a second join column that spreads them evenly and
    meets nothing. ``big`` itself is read once.
    """
    if hot is None:
        hot = hot_keys(big, *[w.key for w in wanted])[1]
    x = big
    # the partition spreads equal rows, and is the same when a lost task runs again
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in big.columns]), F.lit(1 << 30)) + 1
    x = x.withColumn("_spread", spread)
    for w in wanted:
        key = F.col(w.key)
        served = F.lit(False)
        if hot[w.key]:
            schema = T.StructType([T.StructField("_hk", big.schema[w.key].dataType)])
            found = big.sparkSession.createDataFrame([(v,) for v in hot[w.key]], schema)
            values = w.small.select(F.col(w.small_key).alias("_sk"), F.col(w.value).alias("_hv"))
            found = F.broadcast(found).join(values, F.col("_hk") == F.col("_sk")).select("_hk", "_hv")
            x = x.join(F.broadcast(found), key == F.col("_hk"), "left")
            served = F.col("_hk").isNotNull()
        x = x.withColumn("_salt", F.when(~served & key.isNotNull(), F.lit(0).cast("long")).otherwise(F.col("_spread")))
        values = w.small.select(F.col(w.small_key).alias("_lk"), F.lit(0).cast("long").alias("_ls"), F.col(w.value).alias("_lv"))
        x = x.join(values, (key == F.col("_lk")) & (F.col("_salt") == F.col("_ls")), "left")
        x = x.withColumn(w.out, F.coalesce("_hv", "_lv") if hot[w.key] else F.col("_lv")).drop("_hk", "_hv", "_salt", "_lk", "_ls", "_lv")
        if not w.keep:
            x = x.where(F.col(f"`{w.out}`").isNotNull())
    return x.drop("_spread")


def lookup_join(big: DataFrame, key: str, small: DataFrame, small_key: str, value: str, out: str, keep: bool = False) -> DataFrame:
    """``lookups`` of one column."""
    return lookups(big, Lookup(key, small, small_key, value, out, keep))


def many_join(big: DataFrame, key: str, many: DataFrame, many_key: str, value: str, out: str) -> DataFrame:
    """Inner join of two tables of which both may have a key many times; adds ``out``, the ``value`` of ``many``.

    A key's values lie in lists of about LIST values (by a hash of the value), a row of ``big`` goes once to each list
    of its key, and lists are found by ``lookups``, so neither side's hot key meets in one task. Null values are passed over.
    """
    values = many.where(F.col(many_key).isNotNull() & F.col(value).isNotNull()).select(F.col(many_key).alias("_mk"), F.col(value).alias("_mv")).distinct()
    lists = values.groupBy("_mk").agg(F.ceil(F.count("*") / LIST).alias("_n"))
    listed = lookup_join(values, "_mk", lists.withColumnRenamed("_mk", "_ck"), "_ck", "_n", "_n")
    chunk = F.concat_ws("\x03", F.pmod(F.xxhash64("_mv"), F.col("_n")), "_mk")
    listed = listed.groupBy(chunk.alias("_lk2")).agg(F.collect_list("_mv").alias("_list"))
    x = lookup_join(big, key, lists, "_mk", "_n", "_n")
    x = x.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
    x = x.withColumn("_ck2", F.concat_ws("\x03", "_i", key))
    x = lookup_join(x, "_ck2", listed, "_lk2", "_list", "_list")
    return x.withColumn(out, F.explode("_list")).drop("_n", "_i", "_ck2", "_list")
