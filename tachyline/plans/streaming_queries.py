"""Queries of the streaming operators over the events table, in batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..streaming.scenes import state_intervals, window_means


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("user_id").alias("recording_id"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("state"), "value")


def session_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intervals of one event type per user, at most 12 hours between events."""
    found = state_intervals(_samples(spark, sf_dir))
    return found.select("recording_id", "state", F.unix_micros("first_ts").alias("first_us"), F.unix_micros("last_ts").alias("last_us"), "n", "peak")


def sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per user in windows of a day that begin every six hours."""
    found = window_means(_samples(spark, sf_dir))
    return found.select("recording_id", F.unix_micros("start_ts").alias("start_us"), "n", F.round("mean", 6).alias("mean"))


QUERIES = {"session_intervals": session_intervals, "sliding_counts": sliding_counts}
ORACLE = {
    "session_intervals": """
WITH e AS (SELECT user_id, event_type, ts, value, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts) > INTERVAL 12 HOUR THEN 1 ELSE 0 END AS later FROM events),
g AS (SELECT *, sum(later) OVER (PARTITION BY user_id, event_type ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM e)
SELECT user_id AS recording_id, event_type AS state, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us, count(*) AS n, max(value) AS peak
FROM g GROUP BY user_id, event_type, run
""",
    "sliding_counts": """
WITH w AS (SELECT user_id, value, epoch_us(ts) // 21600000000 * 21600000000 - k * 21600000000 AS start_us FROM events, range(4) t(k))
SELECT user_id AS recording_id, start_us, count(value) AS n, round(avg(value), 6) AS mean FROM w GROUP BY user_id, start_us
""",
}
