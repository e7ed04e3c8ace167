"""Recordings with the context of the next one, so that a scene across a seam is seen whole and counted once.

A drive is logged as a chain of recordings. Where one starts about when the one before ends, the samples of the second stand
behind those of the first, on the first one's time, as its context (``source_idx`` 1). Scenes are looked for in that longer
frame; a recording owns those that begin in its own samples, but not one that begins at its very first sample when
the recording before goes on into it: that one has counted it. Every recording is the context of one other at most, so the
frame at most doubles, and the join is by recording.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import scalars as S
from ..operators import alignment as A
from . import metrics as MT
from .scenes import KEYS, SECOND

#: Fields that a recording without any value of them has at infinity (no limit, nothing ahead) when it is a context.
UNBOUNDED = ("front_range", "curv_speed_limit", "front_ttc", "cutin_ttc", "curvature_radius")
SLACK = 5 * SECOND


def continuity(frame: DataFrame, recordings: DataFrame, slack: int = SLACK) -> DataFrame:
    """``recordings`` (recording_id, vehicle, started_us) with first_us, last_us and n of their samples, the next one in time
    (next_id, offset_us), ``continuous`` (it goes on into the next) and ``has_previous`` (one goes on into it).

    A recording goes on if it has two samples, the next one starts after it, within ``slack`` of its end, and has samples.
    Recordings that couldn't be read have no samples, so they end the chain on both sides; a null start does so too.
    """
    spans = frame.groupBy(*KEYS).agg(F.min("us").alias("first_us"), F.max("us").alias("last_us"), F.count("*").alias("n"))
    w = Window.partitionBy("vehicle").orderBy(F.asc_nulls_last("started_us"), "recording_id")
    rows = recordings.join(spans.hint("merge"), KEYS, "left")
    rows = rows.withColumn("next_id", F.lead("recording_id").over(w)).withColumn("offset_us", F.lead("started_us").over(w) - F.col("started_us"))
    near = F.abs(F.col("offset_us") - (F.col("last_us") - F.col("first_us"))) <= slack
    goes_on = S.holds((F.col("n") >= 2) & (F.col("offset_us") > 0) & near & F.lead("n").over(w).isNotNull())
    rows = rows.withColumn("continuous", goes_on)
    return rows.withColumn("has_previous", F.coalesce(F.lag("continuous").over(w), F.lit(False)))


def with_context(frame: DataFrame, recordings: DataFrame, slack: int = SLACK) -> tuple[DataFrame, DataFrame]:
    """(frame, owners): a prepared ``frame`` with each recording's context, and recording_id, first_us, last_us, has_previous.

    Fields that the context lacks altogether are null, or infinite if in ``UNBOUNDED``; boolean ones are false.
    """
    chain = continuity(frame, recordings, slack)
    after = chain.select(F.col("recording_id").alias("next_id"), F.col("first_us").alias("next_first"))
    pairs = chain.where("continuous").join(after.hint("merge"), "next_id").select("recording_id", "next_id", (F.col("first_us") + F.col("offset_us") - F.col("next_first")).alias("shift"))
    whole = A.stitch(frame, pairs, "recording_id", "next_id", "us", "shift", None)
    lacking = [c for c in UNBOUNDED if c in frame.columns]
    if lacking:
        known = frame.groupBy(F.col("recording_id").alias("next_id")).agg(*(F.count(c).alias(f"__{c}") for c in lacking))
        gaps = pairs.join(known.hint("merge"), "next_id").where(F.least(*(F.col(f"__{c}") for c in lacking), F.lit(2**62)) == 0).select("recording_id", *((F.col(f"__{c}") == 0).alias(f"__{c}") for c in lacking))
        whole = whole.join(gaps, KEYS, "left")
        for c in lacking:
            whole = whole.withColumn(c, F.when((F.col("source_idx") == 1) & S.holds(F.col(f"__{c}")), F.lit(S.INF)).otherwise(F.col(c)))
        whole = whole.drop(*(f"__{c}" for c in lacking))
    flags = [f.name for f in frame.schema if f.dataType.typeName() == "boolean"]
    whole = whole.withColumns({c: F.when(F.col("source_idx") == 1, F.coalesce(c, F.lit(False))).otherwise(F.col(c)) for c in flags})
    return whole, chain.select("recording_id", "first_us", "last_us", "has_previous")


def owned(segments: DataFrame, owners: DataFrame, begins: str = "start_us") -> DataFrame:
    """The ``segments`` that their recording owns, by where they begin."""
    placed = segments.join(owners.hint("merge"), KEYS).withColumn("start_source", (F.col(begins) > F.col("last_us")).cast("int")).withColumn("start_idx", F.col(begins) - F.col("first_us"))
    return A.owned(placed).select(segments.columns)


def cases(frame: DataFrame, recordings: DataFrame, powertrain: str = "PHEV", metrics: Iterable[str] | None = None) -> DataFrame:
    """``metrics.evaluate`` over recordings with their context: each case under the recording that owns it."""
    whole, owners = with_context(frame, recordings)
    return MT.evaluate(whole, powertrain, metrics, lambda segments, begins="start_us": owned(segments, owners, begins))


def scene(frame: DataFrame, recordings: DataFrame, name: str, powertrain: str = "PHEV") -> DataFrame:
    """One scene over recordings with their context."""
    whole, owners = with_context(frame, recordings)
    return MT.find_scene(whole, name, powertrain, lambda segments, begins="start_us": owned(segments, owners, begins))


def low_speed(frame: DataFrame, recordings: DataFrame, powertrain: str = "PHEV") -> DataFrame:
    """``metrics.low_speed`` over recordings with their context."""
    whole, owners = with_context(frame, recordings)
    return MT.low_speed(whole, powertrain, lambda segments, begins="start_us": owned(segments, owners, begins))
