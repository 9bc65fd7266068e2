"""The stream gives the summaries of the batch."""

from pyspark.sql import functions as F

from hertzmill.fixtures import Tables
from hertzmill.operators.lookup import summary
from hertzmill.streaming.summary import publish_segments, summaries_of, summary_stream


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    t = Tables(spark, sf_dir)
    rows = t.sightings_low.select("sighting_id", "hz")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    out = summary_stream(stream, t.channels, t.bands, t.services)
    run = out.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start(str(tmp_path / "out"))
    run.awaitTermination(120)
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).select("sighting_id", "summary").collect()))
    want = sorted(map(tuple, summary(rows, t.channels, t.bands, t.services, how="dyadic").collect()))
    assert got == want and len(got) == rows.count()


def test_a_running_stream_sees_edited_channels(spark, sf_dir, tmp_path):
    t, path = Tables(spark, sf_dir), str(tmp_path / "segments")
    rows = t.sightings_low.select("sighting_id", "hz")
    half = [rows.where("sighting_id % 2 = 0"), rows.where("sighting_id % 2 = 1")]
    edited = t.channels.withColumn("name", F.concat(F.lit("edited "), "name"))

    def sink(df, batch_id):
        df.write.mode("overwrite").parquet(str(tmp_path / f"out/batch={batch_id}"))

    half[0].write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    publish_segments(path, t.channels, t.bands, t.services)
    run = summaries_of(stream, path, sink).option("checkpointLocation", str(tmp_path / "ck")).trigger(processingTime="1 second").start()
    try:
        run.processAllAvailable()
        publish_segments(path, edited, t.bands, t.services)
        half[1].write.mode("append").parquet(str(tmp_path / "in"))
        run.processAllAvailable()
    finally:
        run.stop()
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).select("sighting_id", "summary").collect()))
    want = [summary(x, c, t.bands, t.services, how="dyadic") for x, c in zip(half, (t.channels, edited), strict=True)]
    assert got == sorted(tuple(r) for df in want for r in df.collect())
    assert any(text.startswith("edited ") for _, text in got)
