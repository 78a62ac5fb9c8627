"""Session helpers: table access and lineage cuts that survive the loss of an executor."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the project's Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only where the session names none (tests, a local master) is a folder of this machine used, and it is
    remembered in the session; on a cluster a missing setting is an error, since a local folder would be lost
    with its machine.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("knotwork.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="knotwork-")
        spark.conf.set("knotwork.checkpoint.dir", found)
        atexit.register(_delete, spark, found)
    return found


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session may be gone at exit; the files are scratch
        pass


class Scratch:
    """Tables written to the shared folder to cut lineage.

    ``cut`` writes Parquet and reads it back: the plan after it starts at files that every executor can read,
    so a lost executor costs a re-read and no recomputation. ``drop`` removes a table that later steps don't
    read. What is left is removed when the application ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/tables-{uuid.uuid4().hex}"
        atexit.register(_delete, spark, self.root)

    def cut(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._knotwork_path = path
        return out

    def drop(self, *dfs: DataFrame | None) -> None:
        for df in dfs:
            if df is not None and getattr(df, "_knotwork_path", None):
                _delete(self.spark, df._knotwork_path)


def text_of(c) -> F.Column:
    """A column as trimmed text, null as the empty string."""
    return F.trim(F.coalesce(c.cast("string"), F.lit("")))
