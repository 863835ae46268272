import datetime

from strandline.streaming import ingest


def test_stream_keeps_first_arrivals(spark, tmp_path):
    day = datetime.datetime(2024, 1, 1)
    data = [("EPI1|HA|n|I1|H1N1", "A", day), ("EPI2|HA|n|I1|H1N2", "C", day), ("EPI3|NA|n|I1|H1N2", "G", day), ("bad", "T", day), ("EPI4|HA|n|I2|mixed", "T", day)]
    spark.createDataFrame(data, "id string, seq string, ts timestamp").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id string, seq string, ts timestamp").parquet(str(tmp_path / "in"))
    q = ingest.first_arrivals(ingest.parse_stream(stream)).writeStream.format("memory").queryName("arrivals").option("checkpointLocation", str(tmp_path / "state")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r.segment, r.grp, r.epi_isl) for r in spark.table("arrivals").collect()) == [("HA", "H1", "I1"), ("NA", "N2", "I1")]
