"""Inverse document frequency of tokens, apart for every partition (country)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from knotwork.operators.skew import lookup_join

#: Shortest token, share of documents beyond which a token says nothing, weight of unknown tokens.
SHORTEST, COMMON, UNKNOWN = 3, 0.25, 1.0


def idf_table(docs: DataFrame, fields: dict[str, str], by: str = "country") -> DataFrame:
    """(by, field, token, df, n_docs, idf) of the distinct tokens of every document.

    ``fields`` maps a field's name to an array column. Tokens in more than a quarter of a partition's documents are
    left out; documents with a null partition don't count. idf is ln((n + 1) / (df + 1)) + 1.
    """
    docs = docs.where(F.col(by).isNotNull())
    n = docs.groupBy(by).agg(F.count("*").alias("n_docs"))

    def named(field: str, column: str):
        return F.transform(F.array_distinct(column), lambda t: F.struct(F.lit(field).alias("field"), t.alias("token")))

    tokens = F.array(*[named(f, c) for f, c in fields.items()])
    df = (
        docs.select(by, F.explode(F.flatten(tokens)).alias("t")).where(F.length("t.token") >= SHORTEST)
        .groupBy(by, F.col("t.field").alias("field"), F.col("t.token").alias("token")).agg(F.count("*").alias("df"))
    )
    # n has a row a partition
    out = df.join(F.broadcast(n), by).where(F.col("df") <= F.floor(F.col("n_docs") * COMMON))
    return out.withColumn("idf", F.log((F.col("n_docs") + 1) / (F.col("df") + 1)) + 1)


def rarest(entities: DataFrame, idf: DataFrame, field: str, column: str, top: int, id_column: str = "entity_id", by: str = "country") -> DataFrame:
    """(id, by, token, idf) of each entity's ``top`` tokens by idf, earlier ones first among equals; unknown ones weigh 1."""
    key = lambda *c: F.concat_ws("\x01", *c)
    t = entities.where(F.col(by).isNotNull()).select(id_column, by, F.posexplode(column).alias("at", "token")).where(F.length("token") >= SHORTEST)
    table = idf.where(F.col("field") == field).select(key(by, "token").alias("k"), "idf")
    t = lookup_join(t.withColumn("_k", key(by, "token")), "_k", table, "k", "idf", "idf", keep=True).drop("_k")
    t = t.withColumn("idf", F.coalesce("idf", F.lit(UNKNOWN)))
    w = Window.partitionBy(id_column, by).orderBy(F.desc("idf"), "at")
    return t.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= top).select(id_column, by, "token", "idf")
