"""Streams give the intervals and windows that batch gives, once the watermark has closed them."""

from pyspark.sql import functions as F

from tachyline.streaming import scenes

SF = "/root/testdata/sf0.001"
SCHEMA = "recording_id long, ts timestamp, state string, value double"


def test_stream_closes_the_batch_intervals(spark, tmp_path):
    rows = spark.read.parquet(f"{SF}/events.parquet").selectExpr("user_id as recording_id", "cast(ts as timestamp) as ts", "event_type as state", "value")
    rows.repartitionByRange(4, "ts").sortWithinPartitions("ts").write.parquet(f"{tmp_path}/in")
    last = "(999999, timestamp'2100-01-01', 'end', 0.0), (999999, timestamp'2100-02-01', 'end', 0.0)"
    spark.sql(f"select cast(c1 as long) recording_id, c2 ts, c3 state, cast(c4 as double) value from values {last} t(c1, c2, c3, c4)").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    for name, make in (("intervals", scenes.state_intervals), ("means", scenes.window_means)):
        stream = make(scenes.read_samples(spark, f"{tmp_path}/in", SCHEMA))
        assert stream.isStreaming
        scenes.write_intervals(stream, f"{tmp_path}/{name}", f"{tmp_path}/{name}-state").awaitTermination(120)
        got = spark.read.parquet(f"{tmp_path}/{name}").where("recording_id <> 999999")
        want = make(rows)
        if name == "means":  # sums in another order differ in the last digit
            got, want = (x.withColumn("mean", F.round("mean", 9)) for x in (got, want))
        assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


def test_awkward_samples(spark):
    rows = spark.sql("select cast(c1 as long) recording_id, cast(c2 as timestamp) ts, c3 state, cast(c4 as double) value from values (1, '2024-01-01 00:00:00', null, null), (1, '2024-01-01 01:00:00', null, 2), (null, '2024-01-01', 'a', 1), (1, null, 'a', 1) t(c1, c2, c3, c4)")
    (one,) = scenes.state_intervals(rows).collect()
    assert (one.recording_id, one.state, one.n, one.peak) == (1, None, 2, 2.0)
    assert scenes.state_intervals(rows.limit(0)).count() == 0
    assert {(r.n, r["mean"]) for r in scenes.window_means(rows).collect()} == {(1, 2.0)}
