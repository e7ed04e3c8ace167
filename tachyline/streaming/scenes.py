"""Scenes over a stream of samples: intervals of one state, and means over sliding windows, with a watermark.

The same functions serve batch tables, where the watermark has no effect. State in a stream is one row for each open
interval or window; the watermark closes them, so it doesn't grow with the stream's length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_samples(spark: SparkSession, folder: str, schema: str, files_per_trigger: int = 100) -> DataFrame:
    """A stream of the Parquet files that appear in ``folder``."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def state_intervals(samples: DataFrame, gap: str = "12 hours", delay: str = "1 hour") -> DataFrame:
    """``samples`` (recording_id, ts, state, value) -> recording_id, state, first_ts, last_ts, n, peak.

    Samples of one recording and state belong to one interval while each follows the last within ``gap``. Samples
    more than ``delay`` behind the stream's latest time are dropped. Null states form intervals of their own; rows
    without recording or time are left out.
    """
    rows = samples.where("recording_id is not null and ts is not null").withWatermark("ts", delay)
    found = rows.groupBy("recording_id", "state", F.session_window("ts", gap)).agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count("*").alias("n"), F.max("value").alias("peak"))
    return found.drop("session_window")


def window_means(samples: DataFrame, width: str = "1 day", slide: str = "6 hours", delay: str = "1 hour") -> DataFrame:
    """``samples`` (recording_id, ts, value) -> recording_id, start_ts, n, mean over sliding windows; null values don't count."""
    rows = samples.where("recording_id is not null and ts is not null").withWatermark("ts", delay)
    found = rows.groupBy("recording_id", F.window("ts", width, slide)).agg(F.count("value").alias("n"), F.avg("value").alias("mean"))
    return found.select("recording_id", F.col("window.start").alias("start_ts"), "n", "mean")


def write_intervals(intervals: DataFrame, folder: str, checkpoint: str):
    """Append closed intervals or windows to a Parquet table; every file that is there now is read, then the query ends."""
    return intervals.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
