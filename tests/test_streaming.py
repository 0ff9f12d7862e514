import pytest
from pyspark.sql import functions as F

from seqsluice.streaming import ingest


def test_fan_out(spark, tmp_path):
    rows = [("s", i, f"r{i}", None, "ACGT" * (i % 3 + 1), "I") for i in range(30)]
    from seqsluice.schemas import SEQUENCE

    spark.createDataFrame(rows, SEQUENCE).write.parquet(str(tmp_path / "in"))
    stream = ingest.sequence_stream(spark, str(tmp_path / "in"))
    seen = {"a": 0, "b": 0}
    branch = lambda k: lambda df: seen.__setitem__(k, seen[k] + df.count())
    ingest.fan_out(stream, [branch("a"), branch("b")], str(tmp_path / "ck")).awaitTermination()
    assert seen == {"a": 30, "b": 30}
    with pytest.raises(ValueError, match="no branch"):
        ingest.fan_out(stream, [], "x")


def test_clusters_and_windows(spark, tmp_path):
    rows = [(f"2024-01-01 00:{m:02d}:00", "x", 1.0, i % 7) for i, m in enumerate(range(40))]
    spark.createDataFrame(rows, "t string, event_type string, value double, k int").select(F.to_timestamp("t").alias("ts"), "event_type", "value", "k").write.parquet(str(tmp_path / "ev"))
    events = spark.readStream.schema("ts timestamp, event_type string, value double, k int").parquet(str(tmp_path / "ev"))
    q = ingest.windowed_counts(events).writeStream.format("memory").queryName("w").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("w").where("n = 5").count() >= 4
