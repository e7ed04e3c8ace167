"""Folders of a run: tails, low speeds that go on in the next folder, and the windows that find them."""

import random
from collections import namedtuple

from pyspark.sql import functions as F

from tachyline.operators import automata as M
from tachyline.plans import folders as FD

BUS = "recording_id string, us long, ego_speed double, set_speed double, in_control boolean"
PLAN = "recording_id string, us long, red_light boolean, stop_distance double, curve_limited boolean, curve_limit double, lead_id long, objects_us long, objects array<struct<id:bigint,x:double,y:double,ttc:double,velocity:double,acceleration:double,length:double>>"


def run_of(spark, starts, seconds=20.0, speed=40.0, **own):
    """Folders a, b, ... of one run with bus samples and planner frames at 10 Hz from ``starts`` (s) on."""
    bus, plan, seen = [], [], dict(red_light=False, stop_distance=1000.0, curve_limited=False, curve_limit=100.0, objects=[]) | own
    for name, start in zip("abcdef", starts, strict=False):
        for k in range(int(seconds * 10)):
            us = int(start * 1_000_000) + 100_000 * k
            bus.append((name, us, speed(us) if callable(speed) else speed, 80.0, True))
            plan.append((name, us, *(seen[x](us) if callable(seen[x]) else seen[x] for x in ("red_light", "stop_distance", "curve_limited", "curve_limit")), -1, us, seen["objects"]))
    folders = spark.createDataFrame([(n, "run", k) for k, n in enumerate("abcdef"[: len(starts)])], "recording_id string, run string, place int")
    return spark.createDataFrame(bus, BUS), spark.createDataFrame(plan, PLAN), folders


def found(frame, plan, folders):
    return sorted((r.recording_id, r.start_us / 1e6, r.end_us / 1e6, r.goes_on) for r in FD.low_speed(frame, plan, folders).collect())


def test_a_low_speed_goes_on_from_folder_to_folder(spark):
    got = found(*run_of(spark, [100, 120, 140]))
    assert [(r[0], r[3]) for r in got] == [("a", False), ("b", True), ("c", True)]
    assert got[0][1] == 100.0 and 120 < got[0][2] <= 130 and got[2][2] <= 160
    totals = {r.recording_id: (r.total, r.bad, r.continued) for r in FD.totals(FD.low_speed(*run_of(spark, [100, 120, 140]))).collect()}
    assert totals == {"a": (1, 1, 0), "b": (0, 0, 1), "c": (0, 0, 1)}


def test_folders_apart_or_in_other_runs_count_on_their_own(spark):
    assert [(r[0], r[3]) for r in found(*run_of(spark, [100, 131]))] == [("a", False), ("b", False)]
    frame, plan, folders = run_of(spark, [100, 120])
    other = folders.withColumn("run", F.col("recording_id"))
    assert [(r[0], r[3]) for r in found(frame, plan, other)] == [("a", False), ("b", False)]
    slow_then_slower = run_of(spark, [100, 120], speed=lambda us: 40.0 if us < 118_000_000 else 50.0)
    assert [(r[0], r[3]) for r in found(*slow_then_slower)][0] == ("a", False)


def test_tails_are_ten_seconds_and_need_data_that_begin_near_the_end(spark):
    frame, _, folders = run_of(spark, [100, 118, 160])
    chained = FD.with_tail(frame, folders)
    tail = [r.us for r in chained.where("recording_id = 'a' and source_idx = 1").orderBy("us").collect()]
    assert tail == [120_000_000 + 100_000 * k for k in range(100)]
    assert chained.where("recording_id = 'b' and source_idx = 1").count() == 0


def test_what_hinders_a_vehicle_excuses_its_low_speed(spark):
    far = (7, 30.0, 0.0, 99.0, 10.0, 0.0, 4.5)
    for own in (dict(red_light=True, stop_distance=150.0), dict(red_light=True, stop_distance=None), dict(curve_limited=True, curve_limit=79.0), dict(objects=[far]), dict(speed=4.0), dict(speed=79.0)):
        assert found(*run_of(spark, [100], seconds=10, **own)) == []
    for own in (dict(red_light=True, stop_distance=151.0), dict(red_light=True, stop_distance=-1.0), dict(curve_limited=True, curve_limit=0.0), dict(objects=[(7, 60.0, 0.0, 99.0, 10.0, 0.0, 4.5)])):
        assert len(found(*run_of(spark, [100], seconds=10, **own))) == 1
    frame, plan, folders = run_of(spark, [100], seconds=10)
    assert found(frame, plan.where("us < 104000000"), folders) == []


def test_windows_are_found_in_linear_time_and_as_by_brute_force():
    sample = namedtuple("sample", "t on v label")
    rng, rows, t = random.Random(2), [], 0
    for _ in range(3000):
        t += rng.choice([1, 1, 1, 2])
        rows.append(sample(t, rng.random() > 0.01, rng.choice([20, 20, 20, 21, 30]), rng.choice([40] * 50 + [41])))
    looks = 0

    def test(label, least, most):
        nonlocal looks
        looks += 1
        return most - least < 1.5 and label - most >= 8

    machine = M.spans_of_length("on", "v", "label", 12, test, -1, 0.0)()
    next(machine)
    got = [x for r in [*rows, None] for x in machine.send(r)]
    want, i = [], 0
    while i < len(rows):
        j = i
        while j < len(rows) and rows[j].on and rows[j].label == rows[i].label and rows[j].t - rows[i].t < 12:
            j += 1
        whole = j < len(rows) and rows[j].on and rows[j].label == rows[i].label
        values = [r.v for r in rows[i : j + 1]]
        if whole and max(values) - min(values) < 1.5:
            want.append((rows[i].t, rows[j].t, rows[i].label, max(values), sum(values) / len(values), len(values)))
            i = j + 1
        else:
            i += 1
    assert len(got) == len(want) > 5 and all(a[:4] == b[:4] and abs(a[4] - b[4]) < 1e-9 and a[5] == b[5] for a, b in zip(got, want, strict=True))
    assert looks <= len(rows)
