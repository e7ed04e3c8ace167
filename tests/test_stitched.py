"""Recordings with their context: chains, ownership at both ends, and fields that the context lacks."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tachyline.plans import metrics as MT, scenes as SC, stitched as ST

SLOPE = dict(slope_deg=2.0, set_speed=36.0)


def chain(spark, starts, seconds=10.0, **signals):
    """Recordings a, b, c, ... of one vehicle that start at ``starts`` (s); signals are functions of drive time."""
    t, frames = np.round(np.arange(0, seconds, 0.1), 6), []
    for name, start in zip("abcdef", starts, strict=False):
        base = dict(acceleration=0.0, ego_speed=36.0, set_speed=100.0, acc_active=1.0, pedal_override=0.0, slope_deg=0.0, front_target_id=0.0, front_range=np.nan, front_velocity_abs=np.nan, flt1_cutin_flag=0.0, curv_enable=0.0, left_lane_c2=0.0, right_lane_c2=0.0, odometer=t * 0.01, curv_speed_limit=300.0)
        frames.append(pd.DataFrame({"recording_id": name, "t": t} | {k: v(t + start) if callable(v) else v for k, v in (base | signals).items()}))
    recordings = spark.createDataFrame([(n, "car", int(s * 1e6)) for n, s in zip("abcdef", starts, strict=False)], "recording_id string, vehicle string, started_us long")
    return SC.prepare(spark.createDataFrame(pd.concat(frames))), recordings


def spans(df):
    return sorted((r.recording_id, r.start_us / 1e6, r.end_us / 1e6) for r in df.collect())


def test_a_scene_across_seams_is_counted_once(spark):
    bent = dict(curv_enable=1.0, left_lane_c2=0.003, right_lane_c2=0.003)
    frame, recordings = chain(spark, [0, 10, 20], **bent)
    assert spans(SC.curvature(frame)) == [("a", 0.0, 9.9), ("b", 0.0, 9.9), ("c", 0.0, 9.9)]
    # One recording of context: the first owns what begins in it and sees up to the end of the second.
    assert spans(ST.scene(frame, recordings, "curvature")) == [("a", 0.0, 19.9)]
    late = dict(curv_enable=lambda t: (t >= 7).astype(float), left_lane_c2=0.003, right_lane_c2=0.003)
    frame, recordings = chain(spark, [0, 10], **late)
    assert spans(ST.scene(frame, recordings, "curvature")) == [("a", 7.0, 19.9)]


def test_chains_break_where_recordings_are_apart_or_unread(spark):
    bent = dict(curv_enable=1.0, left_lane_c2=0.003, right_lane_c2=0.003)
    frame, recordings = chain(spark, [0, 14.9, 30], **bent)
    got = {r.recording_id: (r.continuous, r.has_previous) for r in ST.continuity(frame, recordings).collect()}
    assert got == {"a": (True, False), "b": (False, True), "c": (False, False)}
    # What couldn't be read stays in the list without samples and ends the chain on both sides.
    frame, recordings = chain(spark, [0, 10, 20], **bent)
    assert spans(ST.scene(frame.where("recording_id <> 'b'"), recordings, "curvature")) == [("a", 0.0, 9.9), ("c", 0.0, 9.9)]
    unknown = recordings.withColumn("started_us", F.when(F.col("recording_id") != "a", F.col("started_us")))
    assert {r.recording_id: r.continuous for r in ST.continuity(frame, unknown).collect()}["a"] is False
    assert ST.continuity(frame.where("us = 0"), recordings).where("continuous").count() == 0


def test_overlapping_samples_of_the_context_are_dropped(spark):
    frame, recordings = chain(spark, [0, 8])
    whole, owners = ST.with_context(frame, recordings)
    times = [r.us for r in whole.where("recording_id = 'a'").orderBy("us").select("us").collect()]
    assert times == [100_000 * k for k in range(180)] and whole.where("recording_id = 'b'").count() == 100
    assert sorted(tuple(r) for r in owners.collect()) == [("a", 0, 9_900_000, False), ("b", 0, 9_900_000, True)]


def test_a_slope_scene_is_owned_by_its_candidate(spark):
    # The band is entered at 9.5 s in the first recording and confirmed at 10.5 s in the second: the first one's.
    near = lambda t: np.where(t < 9.5, 45.0, 36.0)
    frame, recordings = chain(spark, [0, 10], **(SLOPE | dict(ego_speed=near)))
    assert spans(ST.scene(frame, recordings, "slope_no_front", "ICE")) == [("a", 10.5, 19.9)]


def test_a_context_without_a_limit_has_none(spark):
    frame, recordings = chain(spark, [0, 10], **SLOPE)
    frame = frame.withColumn("curv_speed_limit", F.when(F.col("recording_id") == "a", F.col("curv_speed_limit")))
    assert spans(ST.scene(frame, recordings, "slope_no_front", "ICE")) == [("a", 1.0, 19.9)]


def test_low_speed_and_cases_over_a_seam(spark):
    frame, recordings = chain(spark, [0, 6], seconds=6.0)
    assert spans(MT.low_speed(frame)) == []
    assert spans(ST.low_speed(frame, recordings)) == [("a", 0.0, 11.9)]
    frame, recordings = chain(spark, [0, 10], **SLOPE)
    (case,) = ST.cases(frame, recordings, "ICE", ["slope_no_frnt_vel_fluct"]).collect()
    assert (case.recording_id, case.start_us, case.end_us, case.value) == ("a", 1_000_000, 19_900_000, 0.0)
