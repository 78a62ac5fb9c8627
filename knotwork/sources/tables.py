"""Reading and writing of raw tables, lists and reports, locally or on any file system Spark knows."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RAW = "entity_id string, business_name string, business_address string, country string"


def read_tsv(spark: SparkSession, path: str, schema: str = RAW) -> DataFrame:
    """A tab-separated file with a header line; quotes are doubled inside quoted fields."""
    return spark.read.schema(schema).option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value) of every line as it stands."""
    return spark.read.text(path)


def read_country(spark: SparkSession, path: str, country: str) -> DataFrame:
    """The rows of one country: of a table partitioned by country only its files are read, of others the filter goes to the scan."""
    return spark.read.parquet(path).where(F.col("country") == country)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, value) of every line of a text file, from 1 in the order of the file.

    The lines of every part of the file are counted first, so no task sees more than its part.
    """
    rows = spark.read.text(path).select("value", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("id"))
    parts = rows.groupBy("part").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    before = F.sum("n").over(Window.orderBy("part")) - F.col("n")  # a row a part of the file
    return rows.join(F.broadcast(parts.withColumn("before", before)), "part").select((F.col("before") + F.col("id") - F.col("first") + 1).alias("line"), "value")


def in_file_order(df: DataFrame, out: str = "position") -> DataFrame:
    """``df``, just read, with a number that rises in the order of its files."""
    return df.withColumn(out, F.monotonically_increasing_id())


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def resolve(spark: SparkSession, *paths: str) -> DataFrame:
    """The first of several places that exists, read by its ending (.tsv, else Parquet)."""
    for p in paths:
        if exists(spark, p):
            return read_tsv(spark, p) if p.endswith(".tsv") else spark.read.parquet(p)
    raise FileNotFoundError(", ".join(paths))


def write_parquet(df: DataFrame, path: str, by: str | None = None, compression: str = "snappy") -> None:
    """Write over what is there; with ``by`` only the partitions that ``df`` has are replaced."""
    w = df.write.mode("overwrite").option("compression", compression)
    if by:
        w.option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    else:
        w.parquet(path)


def once(spark: SparkSession, path: str, make) -> DataFrame:
    """The table at ``path`` if it was written completely before, otherwise what ``make()`` gives, written there."""
    if not exists(spark, f"{path}/_SUCCESS"):
        write_parquet(make(), path)
    return spark.read.parquet(path)


def packed_lists(pairs: DataFrame, entities: DataFrame, order: str = "rank", out: str = "matched_entity_ids", position: str | None = None) -> DataFrame:
    """(source1_entity_id, out): every entity once with its targets joined by commas in ``order``, empty without any.

    ``position``, a column of ``entities``, is kept (the least of an entity), for ``write_tsv`` in the order of the entities.
    """
    lists = pairs.groupBy(F.col("s1").alias("source1_entity_id")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, "tgt"))), lambda x: x["tgt"]), ",").alias(out))
    ids = entities.select(F.col("entity_id").alias("source1_entity_id"), *([position] if position else [])).where("entity_id is not null")
    ids = ids.groupBy("source1_entity_id").agg(F.min(position).alias(position)) if position else ids.distinct()
    return ids.join(lists, "source1_entity_id", "left").withColumn(out, F.coalesce(out, F.lit("")))


def write_tsv(df: DataFrame, path: str, order: str | None = None, with_order: bool = True) -> None:
    """Tab-separated with a header. With ``order`` the files, read in order of their names, are in its order; ``with_order`` tells whether it is a column of them."""
    if order:
        df = df.orderBy(order)
        df = df if with_order else df.drop(order)
    df.write.mode("overwrite").option("sep", "\t").option("header", True).option("escape", "\"").option("emptyValue", "").option("nullValue", "").csv(path)


def to_report(df: DataFrame) -> str:
    """A small result of known few rows as JSON text."""
    return json.dumps([r.asDict(recursive=True) for r in df.collect()], ensure_ascii=False, sort_keys=True, default=str)
