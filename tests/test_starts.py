"""Starts and slopes of the planner on hand-made frames."""

import pytest

from tachyline.plans import starts as P

from .test_planner import FRAME, frame, spans


def frames(spark, rows):
    return spark.createDataFrame(rows, FRAME)


def start(spark, n=70, **at):
    """Stands for 3 frames, then gains 0.2 m/s a frame at 2 m/s²; ``at`` changes single frames by k."""
    rows = []
    for k in range(n):
        own = dict(objects=[], still=k < 3, speed=max(0.0, 0.2 * (k - 2)), acceleration=0.0 if k < 3 else 2.0, slope_acc=0.1)
        rows.append(frame(k, **(own | at.get(f"k{k}", {}))))
    return frames(spark, rows)


@pytest.mark.parametrize(
    "changed, want",
    [
        ({}, [(3, 69)]),
        ({"k60": dict(acceleration=-0.1)}, [(3, 59)]),
        ({"k52": dict(acceleration=-0.1)}, []),  # 49 frames
        ({"k60": dict(acceleration=None)}, [(3, 59)]),
        ({"k60": dict(slope_acc=None)}, [(3, 59)]),
        ({"k60": dict(np_on=False)}, []),  # the function must be on behind
        ({"k60": dict(non_straight=True)}, [(3, 59)]),
        ({"k60": dict(red_light=True, stop_distance=49.0)}, [(3, 59)]),
        ({"k60": dict(red_light=True, stop_distance=50.0)}, [(3, 69)]),
        ({"k60": dict(set_speed=61.0)}, [(3, 59)]),
        ({"k3": dict(primary=False)}, []),
        ({"k3": dict(curve_limited=True)}, []),  # the frame behind it has no standing one before
        ({"k60": dict(objects=[(7, 15.0, 0.0, 50.0, 8.0, 0.0, 4.5)], speed=0.0)}, [(3, 59)]),  # not clear: the last frame's speed counts
        ({"k60": dict(acceleration=-0.1, speed=5.0)}, []),  # clear: the speed behind counts
    ],
)
def test_starts_on_a_free_road(spark, changed, want):
    assert spans(P.stop2go(start(spark, **changed))) == want


def test_figures_of_a_start(spark):
    rows = start(spark, k10=dict(acceleration=2.75), k20=dict(acceleration=2.75))
    got = {r.metric: r for r in P.stop2go_cases(rows).collect()}
    top = got["stop2go_max_acc"]
    assert (top.value, top.at_us, top.bad, top.severity) == (2.85, 1_100_000, True, pytest.approx(7.5))
    assert got["stop2go_max_acc_time"].value == pytest.approx(0.7) and not got["stop2go_max_acc_time"].bad
    # over 0.2 m/s from frame 4 on, over 3.33 from frame 19 on
    assert got["stop2go_start_time"].value == pytest.approx(1.5) and not got["stop2go_start_time"].bad
    assert got["stop2go_max_jerk"].value == pytest.approx(0.75 / 3 / 0.2 / 1, abs=0.8)
    assert P.stop2go_cases(frames(spark, [])).count() == 0


def steady(spark, n=90, **at):
    return frames(spark, [frame(k, **(dict(objects=[], speed=10.0, set_speed=10.0, slope_acc=-0.2, acceleration=0.1) | at.get(f"k{k}", {}))) for k in range(n)])


@pytest.mark.parametrize(
    "changed, want",
    [
        ({}, [(10, 89)]),
        ({"k70": dict(slope_acc=0.05)}, [(10, 69)]),
        ({"k70": dict(slope_acc=float("nan"))}, [(10, 69)]),
        ({"k70": dict(non_straight=True)}, [(10, 69)]),
        ({"k70": dict(red_light=True, stop_distance=39.0)}, [(10, 69)]),
        ({"k70": dict(curve_limited=True, curve_limit=9.0)}, [(10, 69)]),
        ({"k70": dict(curve_limit=9.0)}, [(10, 89)]),  # a limit that is off
        ({"k70": dict(us=7_000_000 + 0)}, [(10, 69)]),  # at the time of the frame before
        ({"k70": dict(speed=None)}, [(10, 69)]),
        ({"k0": dict(primary=False)}, []),  # the stretch begins elsewhere
        ({"k50": dict(speed=11.0)}, [(10, 89)]),
        ({f"k{k}": dict(speed=11.0) for k in range(64, 88)}, [(10, 63)]),
        ({f"k{k}": dict(set_speed=10.2) for k in range(40, 90)}, []),  # a new stretch, a second to settle, 4 s left
    ],
)
def test_steady_driving_on_a_slope(spark, changed, want):
    assert spans(P.slope(steady(spark, **changed))) == want


def test_figures_of_a_slope(spark):
    from pyspark.sql import functions as F

    rows = steady(spark, k30=dict(acceleration=-0.7), k40=dict(acceleration=1.05))
    got = {r.metric: r for r in P.slope_cases(rows).collect()}
    assert sorted(got) == ["slope_no_frnt_acc", "slope_no_frnt_jerk"]  # no speed on the dashboard
    far = got["slope_no_frnt_acc"]
    assert (far.value, far.at_us) == (pytest.approx(-0.9), 3_100_000) and far.bad and far.severity == pytest.approx(20)
    shown = rows.withColumn("shown_speed", F.when(F.col("us") == 4_000_000, 38.0).when(F.col("us") == 5_000_000, float("nan")).otherwise(36.0))
    swing = {r.metric: r for r in P.slope_cases(shown).collect()}["slope_no_frnt_vel_fluct"]
    assert swing.value == pytest.approx(2 / 3.6) and swing.at_us == 4_000_000 and swing.bad
    assert not {r.metric: r for r in P.slope_cases(shown, "ICE").collect()}["slope_no_frnt_vel_fluct"].bad


def behind(spark, n=40, **at):
    """The target drives off at frame 5; the vehicle moves from frame 12 on and gains 0.25 m/s a frame."""
    rows = []
    for k in range(n):
        ahead = 0.0 if k < 4 else 0.4 * (k - 3)
        own = dict(still=k < 12, speed=max(0.0, 0.25 * (k - 11)), acceleration=0.0 if k < 12 else 2.5, objects=[(7, 10.0, 0.0, 50.0, ahead, 0.5, 4.5)])
        rows.append(frame(k, **(own | at.get(f"k{k}", {}))))
    return frames(spark, rows)


@pytest.mark.parametrize(
    "changed, want",
    [
        ({}, [(11, 35)]),  # frame 11 is the last within the limits of a trigger; 6 m/s at frame 35
        ({"k25": dict(acceleration=-0.1)}, [(11, 24)]),
        ({"k17": dict(acceleration=-0.1)}, []),  # under 2 m/s before
        ({"k25": dict(acceleration=None)}, []),
        ({"k25": dict(non_straight=True)}, [(11, 24)]),
        ({"k25": dict(red_light=True, stop_distance=10.0)}, [(11, 24)]),
        ({"k25": dict(red_light=True, stop_distance=16.0)}, [(11, 35)]),
        ({"k11": dict(red_light=True, stop_distance=30.0)}, [(10, 35)]),
        ({"k11": dict(primary=False)}, [(10, 35)]),
        ({"k11": dict(non_straight=True)}, []),  # the last trigger isn't a good frame
        ({"k25": dict(set_speed=61.0)}, [(11, 24)]),
        ({"k8": dict(np_on=False)}, [(7, 7)][:0]),  # no trigger after it, and the scene before it never moved
    ],
)
def test_starts_behind_a_target(spark, changed, want):
    assert spans(P.follow_start(behind(spark, **changed))) == want


def test_figures_of_a_start_behind_a_target(spark):
    got = {r.metric: r for r in P.follow_start_cases(behind(spark)).collect()}
    late = got["follow_start_latency"]
    assert late.value == pytest.approx(0.3) and not late.bad  # frame 11 to frame 14
    assert got["follow_start_jerk"].value > 0
    gone = behind(spark, n=30)  # the data end at 4.5 m/s: counted
    assert spans(P.follow_start(gone)) == [(11, 29)]
    assert spans(P.follow_start(behind(spark, n=18))) == []
