"""Scenes and metrics on synthetic drives."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tachyline.operators import alignment as A
from tachyline.plans import metrics as MT, scenes as SC


def drive(spark, seconds=20.0, step=0.1, **signals):
    t = np.round(np.arange(0, seconds, step), 6)
    base = dict(acceleration=0.0, ego_speed=36.0, set_speed=100.0, acc_active=1.0, pedal_override=0.0, slope_deg=0.0, front_target_id=0.0, front_range=np.nan, front_velocity_abs=np.nan, flt1_cutin_flag=0.0, curv_enable=0.0, left_lane_c2=0.0, right_lane_c2=0.0, odometer=t * 0.01)
    frame = pd.DataFrame({"recording_id": "a", "t": t} | {k: v(t) if callable(v) else v for k, v in (base | signals).items()})
    return SC.prepare(spark.createDataFrame(frame))


def spans(df):
    return sorted((r.start_us / 1e6, r.end_us / 1e6) for r in df.collect())


def test_curvature_needs_time_speed_and_bend(spark):
    bent = lambda t: np.where((t >= 5) & (t < 6), 0.003, 0.0)
    assert spans(SC.curvature(drive(spark, curv_enable=1.0, left_lane_c2=bent, right_lane_c2=bent))) == [(0.0, 19.9)]
    assert spans(SC.curvature(drive(spark, curv_enable=1.0))) == []
    assert spans(SC.curvature(drive(spark, curv_enable=1.0, left_lane_c2=0.01, ego_speed=9.0))) == []
    lead = dict(front_target_id=3.0, front_velocity_abs=10.0)
    assert spans(SC.curvature(drive(spark, curv_enable=1.0, left_lane_c2=0.01, front_range=30.0, **lead))) == []
    assert spans(SC.curvature(drive(spark, curv_enable=1.0, left_lane_c2=0.01, front_range=30.1, **lead))) == [(0.0, 19.9)]
    over = lambda t: (np.isclose(t, 10.0)).astype(float)
    assert spans(SC.curvature(drive(spark, curv_enable=1.0, left_lane_c2=0.01, pedal_override=over))) == [(0.0, 9.9), (10.1, 19.9)]


def test_slope_scene_starts_at_the_confirming_sample(spark):
    near = lambda t: 36.0 + np.where(t < 2, 9, 0)
    assert spans(SC.slope_no_front(drive(spark, slope_deg=2.0, set_speed=36.0, ego_speed=near), "ICE")) == [(3.0, 19.9)]
    away = lambda t: 36.0 + np.where((t >= 12) & (t < 15), 9, 0)
    assert spans(SC.slope_no_front(drive(spark, slope_deg=2.0, set_speed=36.0, ego_speed=away), "ICE")) == [(1.0, 11.9)]
    assert spans(SC.slope_no_front(drive(spark, slope_deg=0.1, set_speed=36.0), "ICE")) == []


def test_stop_and_go_scenes(spark):
    v = lambda t: 3.6 * (np.clip((t - 5) * 1.5, 0, 12) * (t < 25) + np.clip(12 - (t - 25) * 1.5, 0, 12) * (t >= 25))
    a = lambda t: np.gradient(v(t) / 3.6, t)
    lead = dict(front_target_id=lambda t: np.where(t > 20, 7.0, 0.0), front_range=lambda t: np.where(t > 20, np.maximum(60 - (t - 20) * 4, 3.5), np.nan), front_velocity_abs=lambda t: np.where(t > 20, 0.0, np.nan))
    frame = drive(spark, 40.0, ego_speed=v, acceleration=a, slope_deg=2.0, set_speed=60.0, **lead)
    assert spans(SC.stop2go(frame)) == [(5.1, 10.4)] and spans(SC.follow_stop(frame)) == [(20.1, 33.0)]
    got = {r.metric: r for r in MT.evaluate(frame, "ICE").collect()}
    assert got["stop2go_start_time"].value == pytest.approx(2.2) and not got["stop2go_start_time"].bad
    assert got["follow_stop_min_frntobj_dis"].value == 3.5 and not got["follow_stop_min_frntobj_dis"].bad
    assert got["follow_stop_ttc"].value == pytest.approx(10 / 3) and got["follow_stop_ttc"].bad
    rows = {r.metric: (r.total, r.bad) for r in MT.summary(frame, MT.evaluate(frame, "ICE"), MT.incidents(frame)).collect()}
    assert rows["follow_stop_ttc"] == (1, 1) and rows["stop2go_max_acc"] == (1, 0)


def test_follow_start_and_override(spark):
    front = lambda t: np.where(t < 5, 0.0, 1.0)
    ego = lambda t: np.where(t < 7, 0.0, 3.6)
    lead = dict(front_target_id=3.0, front_range=5.0, front_velocity_abs=front, ego_speed=ego)
    assert spans(SC.follow_start(drive(spark, **lead))) == [(5.0, 7.0)]
    over = lambda t: (t >= 6).astype(float)
    assert spans(SC.follow_start(drive(spark, pedal_override=over, **lead))) == [(5.0, 5.9)]
    assert spans(SC.follow_start(drive(spark, pedal_override=over, **lead), ego_must_start=True)) == []
    assert spans(SC.follow_start(drive(spark, pedal_override=over, **lead), least=3.5)) == []
    slow = lambda t: np.where(t < 5, 0.0, np.where(t < 6.5, 0.3, 1.0))
    assert spans(SC.follow_start(drive(spark, **(lead | {"front_velocity_abs": slow})))) == []


def test_incidents(spark):
    frame = drive(spark, acc_request_state=lambda t: np.where((t >= 3) & (t <= 9), 2.0, 0.0), tcs_active=lambda t: ((t >= 1) & (t < 2)).astype(float), vse_active=0.0)
    got = {(r.metric, r.start_us / 1e6, r.end_us / 1e6) for r in MT.incidents(frame, metrics=["acc_lost_arbitration", "tcs_activation_count", "vse_activation_count"]).collect()}
    assert got == {("acc_lost_arbitration", 3.0, 9.0), ("tcs_activation_count", 1.0, 1.9)}
    brake = lambda t: np.where((t >= 10) & (t < 11), -5.5, 0.0)
    hard = MT.incidents(drive(spark, acceleration=brake), metrics=["acc_heavy_braking_count"]).collect()
    assert len(hard) == 1 and 9.8 <= hard[0].start_us / 1e6 <= 10.2
    assert MT.incidents(drive(spark), metrics=["acc_heavy_braking_count"]).count() == 0


def test_samples_are_never_broadcast(spark):
    """Drives are made of a table that is much smaller than they are, so sizes told by files say nothing of them."""
    samples = spark.range(1000).selectExpr("1L AS recording_id", "id * 100000 AS us")
    segments = spark.createDataFrame([(1, 5_000_000, 25_000_000), (1, 90_000_000, 90_500_000)], "recording_id long, start_us long, end_us long")
    found = SC.samples_in(samples, segments)
    pairs = spark.createDataFrame([(1, 2, 0)], "recording_id long, next_id long, shift long")
    tail = A.stitch(samples.unionByName(samples.withColumn("recording_id", F.lit(2))), pairs, "recording_id", "next_id", "us", "shift", None)
    assert found.count() == 201 + 6
    for frame in (found, tail):
        assert "Broadcast" not in frame._jdf.queryExecution().executedPlan().toString()
