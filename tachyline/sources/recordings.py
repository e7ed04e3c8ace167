"""Catalogues of recordings: dates from paths, date ranges, software filter, primary files, manifests.

The canonical store is Parquet: ``signals`` (recording_id, field, t, value, ...) partitioned by date, one row per
sample, and ``recordings``. Column names and predicates reach the scan, so ``read_signals`` reads the partitions,
fields and times asked for only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import date_in, timestamp_in
from ..operators.alignment import priority_pick

SIGNALS = "recording_id string, field string, priority int, t double, value double, src_path string"


def with_dates(files: DataFrame, path: str = "path", dates: str | None = None) -> DataFrame:
    """``files`` with rec_ts, rec_date; with ``dates`` (``YYYYMMDD-YYYYMMDD``, both included) those in the range, undated ones dropped."""
    out = files.withColumn("rec_ts", timestamp_in(F.col(path))).withColumn("rec_date", date_in(F.col(path)))
    if dates is None:
        return out
    a, b = dates.split("-")
    return out.where(F.col("rec_date").between(F.to_date(F.lit(a), "yyyyMMdd"), F.to_date(F.lit(b), "yyyyMMdd")))


def chronological(path: str = "path") -> list[Column]:
    """Sort order: file time, else date, then path; undated first."""
    return [F.coalesce("rec_ts", F.col("rec_date").cast("timestamp")).asc_nulls_first(), F.col(path)]


def list_files(spark: SparkSession, folder: str, glob: str = "*.parquet") -> DataFrame:
    """path, size, modified of the files under a folder of any store, by Spark's own listing; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(folder)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def read_signals(spark: SparkSession, path: str, fields: Sequence[str] | None = None, end: float | None = None, recordings: DataFrame | None = None) -> DataFrame:
    """Long-form samples; ``fields`` and ``end`` are pushed into the scan."""
    rows = spark.read.parquet(path)
    if fields is not None:
        rows = rows.where(F.col("field").isin(list(fields)))
    if end is not None:
        rows = rows.where(F.col("t") <= end)
    return rows if recordings is None else rows.join(recordings.select("recording_id"), "recording_id", "left_semi")


def pick_paths(signals: DataFrame) -> DataFrame:
    """Of a field's physical paths the first that is there: the samples of the smallest ``priority`` per recording."""
    first = signals.groupBy("recording_id", "field").agg(F.min("priority").alias("priority"))
    return signals.join(first, ["recording_id", "field", "priority"], "left_semi")


def primary_files(files: DataFrame, folder: str = "folder", name: str = "name", has_all: str = "has_all", preferred: str = "_can_data.h5") -> DataFrame:
    """Per folder the file that has all signals, of those the preferred one, of those the first by name."""
    return priority_pick(files, [folder], [F.desc(has_all), F.desc(F.endswith(F.col(name), F.lit(preferred))), name])


def eligible_folders(folders: DataFrame, path: str = "path", suffix: str = "_done", software: str | None = None, info: str = "info") -> DataFrame:
    """Leaf folders that end in ``suffix`` and begin with a date, whose information text names the software."""
    leaf = F.substring_index(path, "/", -1)
    keep = F.endswith(leaf, F.lit(suffix)) & leaf.rlike(r"^(19|20)[0-9]{6}")
    return folders.where(keep if software is None else keep & F.contains(F.col(info), F.lit(software)))


def to_frame(signals: DataFrame, fields: Sequence[str], axis: str = "acceleration", tie: Sequence[str] = ()) -> DataFrame:
    """Long samples -> a wide frame on the sorted unique times of ``axis``: every field's nearest sample.

    All fields share one union and one sort: the last and next value of each is a window column, so aligning
    fifty signals costs the shuffle of one.
    """
    from pyspark.sql import Window

    keys = ["recording_id"]
    rows = signals.where(F.col("field").isin([*fields, axis]))
    ticks = rows.where(F.col("field") == axis).select("recording_id", "t").distinct().withColumn("__side", F.lit(1))
    both = rows.withColumn("__side", F.lit(0)).unionByName(ticks, allowMissingColumns=True)
    ahead = Window.partitionBy(*keys).orderBy("t", "__side", *tie)
    back = Window.partitionBy(*keys).orderBy(F.desc("t"), "__side", *(F.desc(c) for c in tie))
    sample = lambda f: F.when(F.col("field") == f, F.struct("t", "value"))
    both = both.select("*", *(F.last(sample(f), True).over(ahead).alias(f"__b_{f}") for f in fields)).select("*", *(F.last(sample(f), True).over(back).alias(f"__f_{f}") for f in fields))

    def nearest(f: str) -> Column:
        b, n = F.col(f"__b_{f}"), F.col(f"__f_{f}")
        near = n.isNull() | ((F.col("t") - b["t"] <= n["t"] - F.col("t")) & (b["t"] != F.col("t")))
        return F.when(b.isNotNull() & near, b["value"]).otherwise(F.coalesce(n["value"], b["value"])).alias(f)

    return both.where("__side = 1").select("recording_id", "t", *(nearest(f) for f in fields))


def missing_signals(required: DataFrame, signals: DataFrame) -> DataFrame:
    """(recording_id, metric, field) of required fields without samples. ``required`` (metric, field) is configuration."""
    have = signals.select("recording_id", "field").distinct()
    wanted = [F.struct(F.lit(r["metric"]).alias("metric"), F.lit(r["field"]).alias("field")) for r in required.select("metric", "field").distinct().collect()]
    if not wanted:
        return have.select("recording_id", F.lit(None).cast("string").alias("metric"), "field").limit(0)
    every = signals.select("recording_id").distinct().select("recording_id", F.explode(F.array(*wanted)).alias("w")).select("recording_id", "w.metric", "w.field")
    return every.join(have, ["recording_id", "field"], "left_anti")


def manifest(recordings: DataFrame) -> DataFrame:
    """One row: inputs, failures, complete."""
    return recordings.agg(F.count("*").alias("inputs"), F.count_if(~F.col("ok")).alias("failed"), F.bool_and("ok").alias("complete"))
