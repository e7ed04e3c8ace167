"""Heavy braking against brute force on random signals."""

import math
import random

import pytest

from tachyline.plans import braking as B

SCHEMA = "recording_id string, us long, a double, jerk double, good boolean, run long"


def score(level, drop0, least, jerk, drop, seconds):
    return max(abs(least) - level, 0) * 30 + max(abs(jerk) - 2, 0) * 20 + max(drop - drop0, 0) * 30 + max(drop / seconds - 3, 0) * 20


def stay(rows, i, p, level):
    first = p
    while first - 1 > i and rows[first - 1][2] <= level:
        first -= 1
    return rows[p][1] - rows[first][1]


def brute(rows):
    """(us, end, kind, severity) of every sample that begins a fall."""
    out = {}
    for i, (_, t, a, _, good, run) in enumerate(rows):
        if not good:
            continue
        jumps, deep = [], []
        for p in range(i + 1, len(rows)):
            _, u, b, j, fine, other = rows[p]
            if not fine or other != run or u - t > 1_600_000:
                break
            fall, sec = a - b, (u - t) / 1e6
            least, jerk = min(r[2] for r in rows[i : p + 1]), min(r[3] for r in rows[i : p + 1])
            if b <= -2 and j <= -2 and fall >= 3 and fall / sec >= 3 and stay(rows, i, p, -2.0) >= 200_000:
                jumps.append((fall, stay(rows, i, p, -2.0), -u, score(2, 3, a - fall, jerk, fall, sec)))
            if b <= -2.7:
                kind = "deep_short_spike" if fall >= 2.6 and stay(rows, i, p, -1.8) <= 120_000 and jerk <= -10 else "deep_sustained_brake" if fall >= 1.3 and stay(rows, i, p, -1.8) >= 350_000 and jerk <= -5 else None
                if kind:
                    deep.append((round(score(2.7, 1.3, least, jerk, fall, sec), 3), -u, kind))
        if jumps:
            best = max(jumps)
            out[t] = (-best[2], "primary_decel_jump", best[3])
        elif deep:
            best = max(deep, key=lambda d: (d[0], d[1]))
            out[t] = (-best[1], best[2], best[0])
    return out


def signal(seed, n=160):
    r = random.Random(seed)
    t, a, run, rows = 0, 0.0, 0, []
    for _ in range(n):
        t += r.choice((20_000, 50_000, 100_000))
        a = r.choice((a, a - r.random() * 1.5, a + r.random(), -2.0, 0.5, -2.7)) if r.random() < 0.8 else 0.3
        a = max(-6.0, min(2.0, a))
        good = r.random() > 0.04
        run += not good
        rows.append(("a", t, a, r.choice((-12.0, -6.0, -3.0, -2.0, 0.0, 4.0)), good, run if good else None))
    return rows


@pytest.mark.parametrize("seed", range(6))
def test_falls_equal_brute_force(spark, seed):
    rows = signal(seed)
    want = brute(rows)
    got = {r.us: r for r in B.falls(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got.keys() == want.keys() and len(want) > 3
    for us, (end, kind, severity) in want.items():
        assert (got[us].end_us, got[us].kind) == (end, kind)
        assert got[us].severity == pytest.approx(severity, abs=2e-3)


def drive(spark, accelerations, step=50_000, off=()):
    rows = [("a", step * k, float(a) if a is not None else None, k not in off) for k, a in enumerate(accelerations)]
    return spark.createDataFrame(rows, "recording_id string, us long, acceleration double, in_control boolean")


def test_falls_near_to_each_other_are_one_event(spark):
    once = [0.5] * 10 + [-4.0] * 12 + [0.5] * 10
    one = B.heavy_braking(drive(spark, once)).collect()
    assert len(one) == 1 and one[0].n >= 1 and one[0].severity > 0
    twice = B.heavy_braking(drive(spark, once + [0.5] * 40 + once)).collect()
    assert len(twice) == 2
    near = B.heavy_braking(drive(spark, [0.5] * 10 + [-4.0] * 12 + [0.5] * 6 + [-4.0] * 12 + [0.5] * 10)).collect()
    assert len(near) == 1 and near[0].n >= 2
    assert near[0].start_us <= one[0].start_us < one[0].end_us < near[0].end_us


def test_only_control_counts(spark):
    fall = [0.5] * 10 + [-4.0] * 12
    assert B.heavy_braking(drive(spark, fall, off=range(22))).count() == 0
    assert B.heavy_braking(drive(spark, fall, off=range(12))).count() == 0  # control begins in the middle of the fall
    assert B.heavy_braking(drive(spark, [])).count() == 0
    assert B.heavy_braking(drive(spark, [None] * 30)).count() == 0
    assert B.heavy_braking(drive(spark, [0.5] * 40)).count() == 0


def test_planner_frames_of_one_time_and_of_the_next_recording(spark):
    columns = "recording_id string, us long, arrival long, acceleration double, slope_acc double, np_on boolean, override boolean, primary boolean"
    fall = [0.5] * 10 + [-4.0] * 12 + [0.5] * 10
    rows = [("a", 50_000 * k, 2 * k, x, None, True, None, True) for k, x in enumerate(fall)]
    doubled = [("a", 50_000 * k, 2 * k + 1, 3.0, None, True, False, True) for k in range(len(fall))]  # come later at the same times
    want = B.heavy_braking(drive(spark, fall)).collect()
    got = B.planner_heavy_braking(spark.createDataFrame(rows + doubled, columns)).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want] and len(got) == 1
    context = [r[:7] + (r[1] < want[0].start_us,) for r in rows]
    assert B.planner_heavy_braking(spark.createDataFrame(context, columns)).count() == 0
    sloped = [r[:3] + (r[3] + 0.3, -0.3) + r[5:] for r in rows]
    assert B.planner_heavy_braking(spark.createDataFrame(sloped, columns)).collect()[0].severity == pytest.approx(want[0].severity, abs=2e-3)


THING = "struct<id:bigint,x:double,y:double,ttc:double,velocity:double,acceleration:double,length:double>"


@pytest.mark.parametrize(
    "speed, near, late, want",
    [(60.0, None, 0, [(False, 0.0)]), (59.0, None, 0, [(True, 1.0)]), (55.0, None, 0, []), (59.0, 15.0, 0, []), (59.0, None, 400_000, [])],
)
def test_set_speed_needs_a_road_that_objects_of_the_moment_show_clear(spark, speed, near, late, want):
    from tachyline.plans import gated as X

    frame = spark.createDataFrame([("a", 100_000 * k, speed, 60.0, True) for k in range(90)], "recording_id string, us long, ego_speed double, set_speed double, in_control boolean")
    things = [(1, near, 0.0, 50.0, 5.0, 0.0, 4.5)] if near else []
    frames = spark.createDataFrame([("a", 100_000 * k, -1, 100_000 * k + late, things) for k in range(90)], f"recording_id string, us long, lead_id long, objects_us long, objects array<{THING}>")
    assert [(r.bad, r.severity) for r in X.set_speed_reach(frame, frames).collect()] == want
    assert X.set_speed_reach(frame, frames.limit(0)).count() == 0


@pytest.mark.parametrize("gap, raw, want", [(0, True, 1), (0, False, 1), (2, True, 0)])
def test_raw_braking_after_a_release_closes_no_gaps(spark, gap, raw, want):
    """0.15 s of braking, a gap of ``gap`` samples, and on: without closing the gap no stretch has 0.2 s."""
    from tachyline.plans import torque as T

    rows = []
    for k in range(120):
        braking = 60 <= k and not 63 <= k < 63 + gap and k < (63 + gap if gap else 80) + 3
        rows.append(("a", 50_000 * k, -5.0 if braking else 0.3, 100.0, 2000.0 if k >= 60 else 0.0, True, k < 58))
    frame = spark.createDataFrame(rows, "recording_id string, us long, acceleration double, actual_drive_torque double, actual_brake_torque double, acc_active_flag boolean, pedal_override_flag boolean")
    found = T.braking_after_release(frame, raw=raw).collect()
    assert len(found) == want
    if want and raw:
        assert found[0].start_us == 3_000_000 and found[0].severity > 3 * 60


def test_falls_come_from_arrays_whatever_the_batches(spark):
    """No arrays of windows: a window may lie across any number of batches, and each run on its own."""
    rng = random.Random(9)
    rows = [(r, i * 100_000 + rng.randrange(40_000), 3.0 * math.sin(i / 4 + r) - rng.random() * 3, 9 * math.cos(i / 4 + r) - 3, None if i % 150 > 140 else i // 150) for r in range(3) for i in range(900)]
    frame = spark.createDataFrame(rows, "recording_id long, us long, a double, jerk double, run long")
    before, found = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"), []
    try:
        for size in ("10000", "7"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            falls = B.falls(frame)
            found.append(sorted(map(tuple, falls.collect())))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert found[0] == found[1] and len({k for _, _, _, k, _, _ in found[0]}) == 3
    assert "collect_list" not in falls._jdf.queryExecution().optimizedPlan().toString()
