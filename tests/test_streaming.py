from knotwork.operators import blocking as B
from knotwork.plans.blocking_queries import idf_of, queries_side, targets_side
from knotwork.streaming.linking import arrivals_by_window, link_stream


def test_stream_finds_what_the_batch_finds(spark, data, tmp_path):
    t = targets_side(spark, data)
    lists, idf = str(tmp_path / "postings"), str(tmp_path / "idf")
    B.postings(t).write.parquet(lists)
    idf_of(t).write.parquet(idf)
    source = spark.read.parquet(f"{data}/top50_train_source1.parquet")
    a, b = source.randomSplit([0.5, 0.5], 1)
    for i, part in enumerate((a, b)):
        part.write.parquet(str(tmp_path / "in" / str(i)))
    stream = spark.readStream.schema(source.schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 3).parquet(str(tmp_path / "in"))
    postings, weights = spark.read.parquet(lists), spark.read.parquet(idf)
    link_stream(stream, postings, weights, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).drop("batch")
    expected = B.candidates(queries_side(spark, data), t, idf_of(t))
    assert got.count() == expected.count() and got.exceptAll(expected).count() == 0


def test_windows(spark, data, tmp_path):
    s = spark.read.parquet(f"{data}/scored_pairs.parquet")
    s.write.parquet(str(tmp_path / "s"))
    stream = arrivals_by_window(spark.readStream.schema(s.schema).parquet(str(tmp_path / "s")))
    q = stream.writeStream.outputMode("complete").format("memory").queryName("by_window").start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("select sum(pairs) from by_window").collect()[0][0] == s.where("scored_at is not null").count()
