import os

import pytest
from pyspark.sql import functions as F

from knotwork import pipeline
from knotwork.plans.text_queries import raw


def test_whole_linkage(spark, tmp_path):
    data = "/root/testdata/sf0.01"
    if not os.path.exists(data):
        pytest.skip("test tables aren't here")
    one = spark.read.parquet(f"{data}/top50_train_source1.parquet").where("country = 'France'")
    two = raw(spark, data, "top50_train_source2", "top50_train_source3").where("country = 'France'")
    ids = one.select("entity_id")
    labels = spark.read.parquet(f"{data}/train_matched_ids.parquet").join(ids, ids.entity_id == F.col("source1_entity_id"), "left_semi")
    out = pipeline.run(spark, one, two, labels, str(tmp_path / "run"))
    assert out["matches"].count() == one.count() == out["candidates"].count()
    assert out["violations"].count() == 0
    report = out["report"].collect()
    assert report[0].country == "France" and report[0].f05 > 0.6
    again = pipeline.run(spark, one, two, labels, str(tmp_path / "run"))
    assert again["matches"].exceptAll(out["matches"]).count() == 0
