"""Planner scenes and metrics on hand-made frames."""

import pytest
from pyspark.sql import functions as F

from tachyline.plans import planner as P

THING = "struct<id:bigint,x:double,y:double,ttc:double,velocity:double,acceleration:double,length:double>"
FRAME = f"recording_id string, us long, arrival long, np_on boolean, override boolean, speed double, acceleration double, still boolean, set_speed double, red_light boolean, stop_distance double, non_straight boolean, max_curvature double, curve_limit double, curve_limited boolean, slope_acc double, lead_id long, objects_us long, primary boolean, objects array<{THING}>"


def frame(k, **own):
    base = dict(recording_id="a", us=100_000 * (k + 1), arrival=k, np_on=True, override=False, speed=10.0, acceleration=-1.0, still=False, set_speed=60.0, red_light=False, stop_distance=1000.0, non_straight=False, max_curvature=0.0, curve_limit=100.0, curve_limited=False, slope_acc=0.0, lead_id=-1, objects_us=100_000 * (k + 1), primary=True, objects=[(7, 20.0, 0.0, 5.0, 8.0, -0.6, 4.5)])
    return tuple((base | own).values())


def spans(df):
    return sorted((r.start_us // 100_000 - 1, r.end_us // 100_000 - 1) for r in df.collect())


def test_only_the_turn_decides_whether_a_target_is_followed_to_a_stop(spark):
    stop = lambda turns: spark.createDataFrame([frame(k, still=k == 12, speed=0.0 if k == 12 else 10.0, non_straight=k in turns) for k in range(13)], FRAME)
    assert spans(P.follow_stop(stop(()))) == [(0, 11)]
    assert spans(P.follow_stop(stop((3,)))) == [(4, 11)]
    assert spans(P.follow_stop(stop((8,)))) == []
    assert spans(P.follow_stop(stop((12,)))) == [(0, 11)]  # the standing frame may turn
    assert P.follow_stop_cases(stop((8,))).count() == 0


def test_only_the_turn_decides_whether_a_green_light_starts(spark):
    def start(turns):
        rows = [frame(k, objects=[], still=k < 4, speed=0.0 if k < 4 else 0.6 * k, red_light=k < 3, stop_distance=3.0 if k < 3 else 1000.0, non_straight=k in turns) for k in range(16)]
        return spark.createDataFrame(rows, FRAME)

    assert spans(P.green_light_start(start(()))) == spans(P.green_light_start(start((2, 4, 9)))) != []
    assert spans(P.green_light_start(start((3,)))) == []


@pytest.mark.parametrize("late", [-9.0, 5.0])
def test_of_samples_of_one_time_the_last_to_arrive_counts(spark, late):
    rows = [(k, 1 + k, float(a)) for k, a in enumerate((0.0, 0.1, 0.2, 0.3, 0.4))] + [(2, 99, late), (2, 100, float("nan")), (2, 101, None), (-1, 102, 50.0)]
    rows = spark.createDataFrame([("a", 0, 100_000 * (k + 1), arrival, v) for k, arrival, v in rows], "recording_id string, start_us long, us long, arrival long, acceleration double")
    got = P._with_jerk(rows, ["recording_id", "start_us"])
    assert got.count() == 9 and got.where("jerk is not null and us <= 0").count() == 0
    kept = [0.0, 0.1, late, 0.3, 0.4]
    smooth = [sum(kept[max(0, i - 1) : i + 2]) / len(kept[max(0, i - 1) : i + 2]) for i in range(5)]
    middle = got.where((F.col("us") == 300_000) & (F.col("acceleration") == late)).first().jerk
    assert middle == pytest.approx((smooth[3] - smooth[1]) / 0.2)
    assert got.where("us = 300000 and jerk is not null").count() == 1


def brute_trace(pulls):
    """(turning point, traced places), from 1; (None, none) without one."""
    low, turn = False, None
    for i, p in enumerate(pulls):
        low = low or p <= -0.5
        if low and p >= -0.1:
            turn = i
            break
    if turn is None:
        return None, set()
    least, missed, out, i = pulls[turn], 0, set(), turn
    while i >= 0 and missed < 3:
        least = min(least, pulls[i])
        if (i < 2 or pulls[i] >= pulls[i - 1] - 0.07 or pulls[i] >= pulls[i - 2] - 0.07) and pulls[i] < least + 0.5:
            missed = 0
            out.add(i + 1)
        else:
            missed += 1
        i -= 1
    return turn + 1, out


def test_braking_is_traced_back_as_by_brute_force(spark):
    import random

    rng, rows, want = random.Random(7), [], {}
    for k in range(150):
        p, pulls = 0.0, []
        for _ in range(rng.randint(1, 40)):
            p = max(-2.0, min(0.6, p + rng.choice([-0.3, -0.1, -0.05, 0.0, 0.06, 0.2, 0.45])))
            pulls.append(round(p, 2))
        want[k] = brute_trace(pulls)
        rows += [("a", k, 100 * i, p, 5.0) for i, p in enumerate(pulls)]
        rows.append(("a", k, 50, -9.0, None))  # a sample without speed isn't looked at
    got = {}
    for r in P.traced_back(spark.createDataFrame(rows, "recording_id string, start_us long, us long, pull double, speed double"), ["recording_id", "start_us"]).collect():
        turn, places = got.setdefault(r.start_us, (r.turn, set()))
        assert turn == r.turn
        places |= {r.place} if r.traced else set()
    assert got == want and sum(len(w[1]) > 4 for w in want.values()) > 20
