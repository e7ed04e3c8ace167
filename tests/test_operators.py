"""Window operators against plain loops on generated samples, and the machines against naive searches."""

import math
import random
from collections import namedtuple

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tachyline.functions import scalars as S, text as T
from tachyline.operators import alignment as A, automata as M, compare as C, segments as G, windows as W
from tachyline.sources import recordings as R

K = ["r"]
Sample = namedtuple("Sample", "t x")
SLOW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def frame(spark, rows, schema="r string, t long, m boolean, b boolean, x double"):
    return spark.createDataFrame(rows, schema)


samples = st.lists(st.tuples(st.integers(1, 4), st.booleans(), st.booleans()), min_size=1, max_size=25)


@SLOW
@given(samples)
def test_islands_and_gaps(spark, rows):
    t, own = 0, []
    for dt, m, b in rows:
        t += dt
        own.append(("a", t, m, b, 0.0))
    df = frame(spark, own)
    runs, k = [], 0
    while k < len(own):
        if own[k][2]:
            j = k
            while j + 1 < len(own) and own[j + 1][2]:
                j += 1
            runs.append((own[k][1], own[j][1], j - k + 1))
            k = j
        k += 1
    assert sorted((r.start_t, r.end_t, r.n) for r in G.islands(df, "m", K, ["t"], "t").collect()) == runs
    want = [m for _, _, m, _, _ in own]
    for k in range(len(own)):
        if not own[k][2]:
            left, right = [i for i in range(k) if own[i][2]], [i for i in range(k, len(own)) if own[i][2]]
            if left and right:
                i, j = left[-1], right[0]
                want[k] = own[j][1] - own[i][1] <= 5 and all(own[x][3] for x in range(i + 1, j))
    got = G.fill_short_gaps(df, "m", 5, K, ["t"], "t", "b").orderBy("t").collect()
    assert [r.filled for r in got] == want


@SLOW
@given(st.lists(st.integers(0, 30), min_size=1, max_size=12, unique=True), st.lists(st.integers(0, 30), max_size=12))
def test_asof_rules(spark, axis, signal):
    left = spark.createDataFrame([("a", t) for t in axis], "r string, t long")
    right = spark.createDataFrame([("a", t, k) for k, t in enumerate(signal)], "r string, t long, v long")
    order = sorted((t, k) for k, t in enumerate(signal))
    for direction in ("nearest", "pad", "backfill"):
        got = {x.t: x.v for x in A.asof(left, right, K, "t", ["v"], direction, tie=["v"]).collect()}
        for t in axis:
            before, after, now = [x for x in order if x[0] < t], [x for x in order if x[0] > t], [x for x in order if x[0] == t]
            if now:
                want = now[0][1]
            elif direction == "pad" or (direction == "nearest" and before and (not after or t - before[-1][0] <= after[0][0] - t)):
                want = before[-1][1] if before else None
            else:
                want = after[0][1] if after else None
            assert got[t] == want


def test_slope_and_jerk_equal_least_squares(spark):
    rng = np.random.default_rng(1)
    t = np.cumsum(rng.choice([90_000, 100_000, 110_000], 120)) + 10**12
    x = np.where(rng.random(120) < 0.1, np.nan, rng.normal(size=120))
    df = spark.createDataFrame([("a", int(a), None if math.isnan(b) else float(b)) for a, b in zip(t, x)], "r string, t long, x double")
    got = [r.s for r in W.time_slope(df, "x", 600_000, K, "t", "s").orderBy("t").collect()]
    for k in range(120):
        inside = (np.abs(t - t[k]) <= 300_000) & ~np.isnan(x)
        if inside.sum() < 3 or np.ptp(t[inside]) < 300_000:
            assert got[k] is None
        else:
            assert got[k] == pytest.approx(np.polyfit((t[inside] - t[k]) / 1e6, x[inside], 1)[0], rel=1e-6, abs=1e-7)


def test_overlap_band_and_merge(spark):
    rng = random.Random(3)
    spans = [("a", a, a + rng.randint(0, 30)) for a in (rng.randint(0, 300) for _ in range(25))]
    marks = [("a", a, a + rng.randint(0, 9)) for a in (rng.randint(0, 300) for _ in range(10))]
    scenes, events = spark.createDataFrame(spans, "r string, start_t long, end_t long").distinct(), spark.createDataFrame(marks, "r string, event_start long, event_end long")
    hit = {s for s in spans if any(m[2] >= s[1] and m[1] <= s[2] for m in marks)}
    assert {tuple(r) for r in A.overlapping(scenes, events, K, 16).collect()} == hit
    assert {tuple(r) for r in A.overlapping(scenes, events, K, 16, "left_anti").collect()} == set(spans) - hit
    left, right = spark.createDataFrame([("a", k) for k in range(0, 200, 7)], "r string, p long"), spark.createDataFrame([("a", k) for k in range(0, 200, 5)], "r string, q long")
    assert {(r.p, r.q) for r in A.band_join(left, right, K, "p", "q", 6).collect()} == {(p, q) for p in range(0, 200, 7) for q in range(0, 200, 5) if abs(p - q) <= 6}
    merged, out = [], sorted((a, b) for _, a, b in spans)
    for a, b in out:
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], b))
        else:
            merged.append((a, b))
    assert sorted((r.start_t, r.end_t) for r in G.merge_overlapping(spark.createDataFrame(spans, "r string, start_t long, end_t long"), K, "start_t", "end_t").collect()) == merged


def test_stitching_and_ownership(spark):
    frames = spark.createDataFrame([("a", float(t)) for t in range(11)] + [("b", float(t)) for t in range(21)], "recording_id string, t double")
    recs = spark.createDataFrame([("g", "a", 100.0, 10.0), ("g", "b", 111.0, 20.0), ("g", "c", 300.0, 5.0)], "g string, recording_id string, start double, duration double")
    pairs = A.continuous_pairs(recs, ["g"], "start", "duration", 5)
    assert {r.recording_id: r.continuous for r in pairs.collect()} == {"a": True, "b": False, "c": False}
    link = spark.createDataFrame([("a", "b", 11.0)], "recording_id string, follower string, off double")
    got = A.stitch(frames, link, "recording_id", "follower", "t", "off", 4).where("recording_id = 'a' and source_idx = 1").orderBy("t")
    assert [r.t for r in got.collect()] == [11.0, 12.0, 13.0, 14.0]
    seg = spark.createDataFrame([(0, 0, True), (0, 0, False), (5, 0, True), (9, 1, False)], "start_idx int, start_source int, has_previous boolean")
    assert sorted((r.start_idx, r.has_previous) for r in A.owned(seg).collect()) == [(0, False), (5, True)]


def run(machine, rows, fields):
    kind, state, out = namedtuple("s", fields), machine(), []
    next(state)
    for r in rows:
        out += state.send(kind(*r)) or []
    return out + (state.send(None) or [])


def test_stable_ranges_cut_greedily():
    rows = [(t, x) for t, x in enumerate([0, 1, 2, 5, 5, 6, 9, 9, 9, 9])]
    assert run(M.stable_ranges({"x": 2.0}, 2), rows, ["t", "x"]) == [(0, 2, 3), (3, 5, 3), (6, 9, 4)]
    assert run(M.stable_ranges({"x": 2.0}, 3), rows, ["t", "x"]) == [(6, 9, 4)]
    assert run(M.stable_ranges({"x": 1.0}, 1), [(0, 1.0), (1, None), (2, 1.0), (3, 1.5)], ["t", "x"]) == [(2, 3, 2)]


def test_stable_or_slide_gives_up_one_sample():
    assert run(M.stable_or_slide("x", 2.0, 3), [(t, x) for t, x in enumerate([0, 1.5, 3, 3, 3, 3, 9])], ["t", "x"]) == [(1, 5, 5)]


def test_steady_band_rules():
    step = lambda v, n, on=True, target=10.0, t0=0: [(round(t0 + k * 0.5, 3), on, v, target) for k in range(n)]
    fields = ["t", "on", "v", "w"]
    machine = M.steady_band("on", "v", "w", 0.5)
    steady = step(10, 20)
    assert run(machine, steady, fields) == [(1.0, 9.5, 0.0)]
    away = step(10, 20) + step(12, 6, t0=10)
    assert run(machine, away, fields) == [(1.0, 9.5, 0.0)]
    brief = step(10, 20) + step(12, 3, t0=10) + step(10, 5, t0=11.5)
    assert run(machine, brief, fields) == [(1.0, 13.5, 0.0)]
    assert run(machine, step(10, 10) + step(11, 20, target=11.0, t0=5), fields) == [(6.0, 14.5, 5.0)]
    assert run(machine, step(10, 20, on=False), fields) == []


def test_bridge_flips_top_and_match(spark):
    rows = [("r", 0, 1, 1), ("r", 1, 0, 1), ("r", 2, 0, 1), ("r", 3, 1, 1), ("r", 4, 0, 1), ("r", 5, 0, 0), ("r", 6, 1, 0)]
    found = G.lookahead_bridge(spark.createDataFrame(rows, "id string, t long, core int, hold int"), "core = 1", "hold = 1", 2, ["id"], ["t"], "t")
    assert sorted((r.start_t, r.end_t, r.n) for r in found.collect()) == [(0, 3, 4), (6, 6, 1)]
    signs = spark.createDataFrame([("r", k, float(x)) for k, x in enumerate((1, 1, -1, 1, 0, -1, -1, -1, 1, 1))] + [("none", 0, 0.0)], "id string, t long, x double")
    assert {r.id: r.flips for r in G.debounced_flips(signs, "x", 2, ["id"], ["t"]).collect()} == {"r": 2, "none": 0}
    assert run(M.separated_top("s", "t", 2, 4), [(10, 9.0), (12, 8.0), (15, 7.0), (30, 6.0)], ["t", "s"]) == [(10, 9.0, 1), (15, 7.0, 2)]


@pytest.mark.parametrize("seed", range(20))
def test_greedy_match_equals_the_direct_search(seed):
    rng = random.Random(seed)
    edges = sorted((rng.randint(0, 100), rng.choice("ab"), rng.choice([0, 1])) for _ in range(30))
    free, want = [(t, s) for t, side, s in edges if side == "b"], []
    for t, side, s in edges:
        if side == "a":
            near = [x for x in free if x[1] == s and abs(x[0] - t) <= 10]
            best = min(near, key=lambda x: (abs(x[0] - t), x[0]), default=None)
            if best:
                free.remove(best)
            want.append((t, best[0] if best else None, best[0] - t if best else None))
    assert run(M.greedy_match("side", "s", 10), edges, ["t", "side", "s"]) == want


def test_samples_are_held_against_the_last_one_kept(spark):
    rows = spark.createDataFrame([("r", t, s, t + 0.5) for t, s in ((0, "a"), (0, "b"), (15, "b"), (30, "a"), (31, "a"), (100, "b"), (300, "a"))], "id string, t long, source string, v double")
    got = A.merge_samples(rows, ["id"], "t", "source", 20)
    assert got.columns == rows.columns and sorted((r.t, r.source) for r in got.collect()) == [(0, "a"), (30, "a"), (100, "b"), (300, "a")]


def test_drops_rebounds_and_cycles(spark):
    assert run(M.forward_drops("x", 3.0, 1.6, 3.0, -2.0, 0.2), [(round(k / 10, 1), x) for k, x in enumerate([0, 0, -1, -2, -3.2, -3, -3, 0, 0])], ["t", "x"]) == [(0.0, 0.4, 3.2)]
    assert run(M.rebounds("x"), [(0.0, 0.0), (0.1, 0.6), (0.2, 0.0), (0.5, 0.0), (3.0, 0.0)], ["t", "x"]) == [(0.0, 0.1, 0.2)]
    wave = [(round(k / 10, 1), math.sin(2 * math.pi * k / 40)) for k in range(161)]
    frame = spark.createDataFrame([("r", t, x) for t, x in wave], "id string, t double, x double")
    assert [r.phases for r in G.long_cycles(frame, "x", 1.5, 3.5, 0.3, 4, 0.6, ["id"], ["t"], "t").collect()] == [8]


def test_machines_keep_recordings_apart(spark):
    rows = [(r, t, float(t % 4)) for r in ("a", "b") for t in range(12)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "r string, t long, x double")
    got = M.scan(df.repartition(5), K, ["t"], ["t", "x"], M.stable_ranges({"x": 3.0}, 1), "a long, b long, n long").collect()
    assert sorted(map(tuple, got)) == [("a", 0, 11, 12), ("b", 0, 11, 12)]


# Scalars, cells, verdicts


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("text,want", [("12.5(250/20)", (12.5, False, 250.0, 20.0)), (">300(300/0)", (300.0, True, 300.0, 0.0)), ("12.5（250／20）", (12.5, False, 250.0, 20.0)), ("N/A", (None, False, None, None)), ("0.812 (n=7)", (0.812, False, None, None)), ("17", (17.0, False, None, None)), (">50", (50.0, True, None, None)), ("100.0(40/0)", (100.0, False, 40.0, 0.0))])
def test_cells(spark, text, want):
    assert tuple(one(spark, C.parse_cell(F.lit(text)))) == want


@pytest.mark.parametrize("total,bad,value,low,threshold,want", [(10, 2, None, False, 5.0, "pass"), (10, 2, None, False, 5.1, "fail"), (10, 0, None, False, 99.0, "pass"), (0, 0, None, False, 5.0, "insufficient"), (None, None, 6.0, False, 5.0, "pass"), (None, None, 4.0, False, 5.0, "fail"), (None, None, 4.0, True, 5.0, "invalid"), (None, None, None, False, 5.0, "invalid"), (10, 2, None, False, None, "no_threshold")])
def test_gate(spark, total, bad, value, low, threshold, want):
    lit = lambda x, t: F.lit(x).cast(t)
    assert one(spark, C.gate(lit(total, "long"), lit(bad, "long"), lit(value, "double"), F.lit(low), lit(threshold, "double"))) == want


@pytest.mark.parametrize("base,base_bad,target,target_bad,want", [(None, None, None, None, "missing"), (None, None, 1.0, 1, "base_missing"), (5.0, 2, 9.0, 0, "target"), (5.0, 0, 9.0, 3, "base"), (5.0, 0, 5.0, 0, "equal"), (5.0, 2, 6.0, 2, "target"), (5.0, 2, 5.0, 1, "target"), (5.0, 2, 5.0, 2, "equal")])
def test_verdict(spark, base, base_bad, target, target_bad, want):
    lit = lambda x, t: F.lit(x).cast(t)
    assert one(spark, C.verdict(lit(base, "double"), lit(base_bad, "long"), lit(target, "double"), lit(target_bad, "long"))) == want


@pytest.mark.parametrize("speed,want", [(0.0, 0.0), (-3.0, 0.0), (20.0, 21.0), (40.0, 43.0), (80.0, 84.0), (120.0, 125.0), (250.0, 260.0), (400.0, 414.0)])
def test_display_speed(spark, speed, want):
    assert one(spark, S.display_speed(F.lit(speed))) == want


def test_invalid_samples_and_infinity(spark):
    inf, nan = float("inf"), float("nan")
    assert one(spark, S.clean(F.lit(nan))) is None and one(spark, S.clean(F.lit(inf))) == inf
    assert not one(spark, S.front_clear(F.lit(True), F.lit(40.0), F.lit(nan))) and one(spark, S.front_clear(F.lit(True), F.lit(40.0), F.lit(inf)))
    assert not one(spark, S.front_clear(F.lit(True), F.lit(30.0), F.lit(99.0))) and one(spark, S.front_clear(F.lit(False), F.lit(None).cast("double"), F.lit(None).cast("double")))
    assert one(spark, S.effective_ttc(F.lit(nan), F.lit(inf))) == inf and one(spark, S.effective_ttc(F.lit(4.0), F.lit(inf))) == 4.0
    assert one(spark, S.nan_truthy(F.lit(nan))) and not one(spark, S.nan_truthy(F.lit(0.0))) and not one(spark, S.nan_truthy(F.lit(None).cast("double")))
    assert one(spark, S.enum_in(F.lit("Lost Arbitration"), [2], ["lost arbitration"])) and one(spark, S.enum_in(F.lit(2.0), [2])) and not one(spark, S.enum_in(F.lit("x"), [2]))


def test_distance(spark):
    rows = [("a", 1, 10.0), ("a", 2, None), ("a", 3, 12.5), ("b", 1, S.ODOMETER_ROLLOVER - 1), ("b", 2, 2.0), ("c", 1, 5.0), ("d", 1, None)]
    got = {r.r: (r.distance_km, r.distance_status) for r in S.distance_km(spark.createDataFrame(rows, "r string, t long, o double"), K, "t", "o").collect()}
    assert got == {"a": (2.5, "ok"), "b": (3.0, "ok"), "c": (None, "insufficient samples"), "d": (None, "insufficient samples")}


def test_names_and_spans(spark):
    path = "/x/20240501_trip_done/2024-05-02-10-11-12_can_parsed.h5"
    assert str(one(spark, T.timestamp_in(F.lit(path)))) == "2024-05-02 10:11:12" and str(one(spark, T.date_in(F.lit(path)))) == "2024-05-01"
    assert one(spark, T.timestamp_in(F.lit("/x/y.h5"))) is None and one(spark, T.date_in(F.lit("y"))) is None
    assert [tuple(x) for x in one(spark, T.event_spans(F.lit("[Event 3 bad start=1.5, end=2.25] [Event 4: start=-1, end=0]")))] == [(3, 1.5, 2.25), (4, -1.0, 0.0)]


def test_long_signals_become_a_frame(spark):
    rows = [("a", "acceleration", 1, t / 10, float(t)) for t in range(5)] + [("a", "speed", 1, 0.05, 1.0), ("a", "speed", 1, 0.31, 2.0), ("a", "other", 1, 0.0, 9.0)]
    df = R.to_frame(spark.createDataFrame(rows, "recording_id string, field string, priority int, t double, value double"), ["acceleration", "speed"])
    assert [(r.t, r.acceleration, r.speed) for r in df.orderBy("t").collect()] == [(0.0, 0.0, 1.0), (0.1, 1.0, 1.0), (0.2, 2.0, 2.0), (0.3, 3.0, 2.0), (0.4, 4.0, 2.0)]


def test_turning_points_equal_brute_force(spark):
    import random
    import statistics

    from tachyline.operators import reports as R

    def brute(values, prominence):
        n = len(values)
        if n < 8:
            return 0
        y = [sum(values[min(max(i + d, 0), n - 1)] for d in range(-3, 4)) / 7 for i in range(n)]
        signs, way = [], 0
        for a, b in zip(y, y[1:], strict=False):
            way = 1 if b - a > prominence / 12 else -1 if a - b > prominence / 12 else way
            signs.append(way)
        turns, mid = [], statistics.median(y)
        for i in range(1, len(signs)):
            if signs[i] and signs[i - 1] and signs[i] != signs[i - 1]:
                if not turns or abs(y[i] - turns[-1]) >= prominence:
                    turns.append(y[i])
                elif abs(y[i] - mid) > abs(turns[-1] - mid):
                    turns[-1] = y[i]
        return len(turns)

    rng = random.Random(11)
    signals = {k: [float(rng.randint(0, 40)) if rng.random() < 0.4 else float(k % 5 * 3) for _ in range(rng.choice([3, 7, 8, 60, 200]))] for k in range(40)}
    rows = spark.createDataFrame([(k, i, v) for k, values in signals.items() for i, v in enumerate(values)], "id long, t long, v double")
    got = {r.id: r.turns for r in R.turn_count(rows, "v", 4.0, ["id"], ["t"]).collect()}
    assert got == {k: brute(v, 4.0) for k, v in signals.items()} and sum(got.values()) > 100
    unknown = spark.createDataFrame([(1, i, None if i % 2 else float("nan")) for i in range(20)], "id long, t long, v double")
    assert [r.turns for r in R.turn_count(unknown, "v", 4.0, ["id"], ["t"]).collect()] == [0]


def test_forward_drops_equal_brute_force_in_linear_time():
    import random
    import time
    from collections import namedtuple

    from tachyline.operators import automata as M

    sample = namedtuple("sample", "t v")

    def run(rows, *args):
        machine = M.forward_drops("v", *args)()
        next(machine)
        return [x for r in [*rows, None] for x in machine.send(r)]

    def brute(rows, drop, within, slope, floor, dwell):
        out, i = [], 0
        while i < len(rows):
            t0, v0 = rows[i]
            near = [k for k in range(i, len(rows)) if rows[k].t - t0 <= within]
            k = min(near, key=lambda x: (rows[x].v, x))
            t1, v1 = rows[k]
            good = v0 - v1 >= drop and t1 > t0 and (v0 - v1) / (t1 - t0) >= slope
            if good and floor is not None:
                stop = k
                while stop < len(rows) and rows[stop].v <= floor:
                    stop += 1
                good = stop > k and rows[stop - 1].t - t1 >= dwell - 1e-9
            if good:
                out.append((t0, t1, v0 - v1))
                i = k + 1
            else:
                i += 1
        return out

    rng = random.Random(5)
    for _ in range(60):
        t, rows = 0, []
        for _ in range(rng.randint(0, 120)):
            t += rng.choice([1, 1, 2, 5])
            rows.append(sample(t, rng.choice([0, 1, 2, 5, 9, 10])))
        args = (rng.choice([3, 8]), rng.choice([4, 12, 40]), rng.choice([0.0, 0.5]), rng.choice([None, 1, 2]), rng.choice([0, 3]))
        assert run(rows, *args) == brute(rows, *args), args
    long = [sample(k, float(k % 97)) for k in range(60_000)]
    spent = []
    for within in (200, 6400):
        start = time.process_time()
        run(long, 1e9, within)
        spent.append(time.process_time() - start)
    assert spent[1] < 4 * spent[0] + 0.5


def test_qualified_windows_sum_afresh():
    machine = M.qualified_windows(lambda least, most: most - least <= 40, 12, 12, "x", 5.0)()
    next(machine)
    out = [r for s in [(0, 29.77), (21, 0.37), (22, 132.19), (24, 34.31), (36, 5.83)] for r in machine.send(Sample(*s))] + machine.send(None)
    assert [(a, b, n) for a, b, _, n in out] == [(0, 36, 4)]  # means of 15.07 and 20.07: 5 apart, unless the sum of the second has drifted by 132.19


def test_box_mean_sums_in_the_samples_order(spark):
    from functools import reduce
    from operator import add

    rng = random.Random(3)
    values = [round(rng.expovariate(0.02), 2) for _ in range(300)]
    rows = spark.createDataFrame(list(enumerate(values)), "t long, x double").withColumn("r", F.lit(1))
    got = [r.m for r in W.box_mean(rows, "x", 7, K, ["t"], "m").orderBy("t").collect()]
    at = lambda i: values[max(0, min(len(values) - 1, i))]
    assert got == [reduce(add, (at(i + d) for d in range(-3, 4))) / 7 for i in range(len(values))]


def test_time_slope_is_a_covariance_by_a_covariance(spark):
    """To the last bit, so that the first of equal slopes is the same here and in SQL."""
    rng = random.Random(5)
    values = [round(rng.uniform(-9, 9), 2) for _ in range(400)]
    rows = spark.createDataFrame([(1, k * 100_000, v) for k, v in enumerate(values)], "r int, us long, x double")

    def slope(points):
        n, mx, my, sxy, sxx = 0, 0.0, 0.0, 0.0, 0.0
        for x, y in points:
            n, dx, dy, old = n + 1, x - mx, y - my, mx
            mx, my = mx + dx / n, my + dy / n
            sxy, sxx = sxy + dx * (y - my), sxx + (x - old) * (x - mx)
        return (sxy / n) / (sxx / n)

    for origin in (None, "o"):
        got = [r.s for r in W.time_slope(rows.withColumn("o", F.lit(-700_000)), "x", 300_000, K, "us", "s", origin=origin).orderBy("us").collect()]
        at = [(k * 100_000 - (0 if origin is None else -700_000)) / 1e6 for k in range(len(values))]
        assert got[1:-1] == [slope([(at[j], values[j]) for j in range(k - 1, k + 2)]) for k in range(1, len(values) - 1)]
