"""Top N items within every group, however large a group is.

Method: two-stage salted ranking. Each group is hashed into ``salts`` subgroups by item, every subgroup keeps its
N best, and the survivors (at most ``salts`` x N of a group) are ranked by score and identifier.

One exchange by (group, subgroup) serves both the removal of repeated items and the first ranking; a repeated item
always falls into the same subgroup. Only the survivors are shuffled again. No task sees more of a group of g rows
than about g / salts of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NO_RANK = 2**31 - 1


def top_n(df: DataFrame, group: str, item: str, score: str, rank: str | None, n: int, salts: int = 64, place: str = "place") -> DataFrame:
    """(group, item, place 1..n) of the best ``n`` items of each group.

    Order: score descending, ``rank`` ascending with null last, item ascending. A repeated (group, item) counts once,
    with its highest score and the smallest rank among the rows of that score. Rows with a null group, null item,
    null or NaN score don't count. An empty table gives no row; other columns are ignored, whatever their names.
    """
    if n < 1 or salts < 1:
        raise ValueError("n and salts must be positive")
    s = F.col(f"`{score}`").cast("double")
    r = F.coalesce(F.col(f"`{rank}`").cast("long"), F.lit(NO_RANK)) if rank else F.lit(NO_RANK)
    rows = (
        df.select(F.col(f"`{group}`").alias("_g"), F.col(f"`{item}`").alias("_i"), s.alias("_s"), r.alias("_r"))
        .where(F.col("_g").isNotNull() & F.col("_i").isNotNull() & F.col("_s").isNotNull() & ~F.isnan("_s"))
        .withColumn("_salt", F.pmod(F.xxhash64("_i"), F.lit(salts)))
        .repartition("_g", "_salt")
    )
    best = rows.groupBy("_g", "_salt", "_i").agg(F.max(F.struct("_s", (-F.col("_r")).alias("_r"))).alias("_b"))
    order = [F.desc("_s"), F.desc("_r"), F.asc("_i")]
    first = (
        best.select("_g", "_salt", "_i", "_b._s", "_b._r")
        .withColumn("_n", F.row_number().over(Window.partitionBy("_g", "_salt").orderBy(*order)))
        .where(F.col("_n") <= n).drop("_n", "_salt")
    )
    return (
        first.withColumn(place, F.row_number().over(Window.partitionBy("_g").orderBy(*order)))
        .where(F.col(place) <= n)
        .select(F.col("_g").alias(group), F.col("_i").alias(item), F.col(place).cast("int"))
    )
