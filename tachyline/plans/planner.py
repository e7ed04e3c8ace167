"""Scenes and case metrics on planner frames: one row per planning message with the objects seen at that moment.

A frame has recording_id, us, arrival (order in which messages came), np_on, override, speed (m/s), acceleration, still,
set_speed, red_light, stop_distance, non_straight (turns, changes lane or makes a U-turn), max_curvature, curve_limit,
curve_limited, slope_acc (by the control message), lead_id, objects_us, primary and ``objects`` (array of id, x, y, ttc, velocity, acceleration, length). Unlike the wide frames of ``scenes``, a frame may
follow several targets at once, so follow scenes are looked for target by target.
"""

from __future__ import annotations

from collections.abc import Generator

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import scalars as S
from ..operators import automata as M, segments as G, windows as W
from .scenes import KEYS, SECOND, samples_in

c = F.col
#: Milliseconds that a lead's object may be away from the message that names it.
LEAD_TOLERANCE = 300
BRIDGE, LEAST_STOP, LEAST_START = 19, 5, 10  # frames


def candidates(frames: DataFrame) -> DataFrame:
    """``frames`` with ``followed`` (the nearest object within 1 to 50 m in the lane, and the planner's lead), ``ahead`` (the nearest
    in the lane at any distance, and the lead), ``unmatched`` (a lead that is no object, or too old) and ``clear``."""
    in_lane = F.filter("objects", lambda o: (o["x"] > 0) & (F.abs(o["y"]) <= 1.5))
    nearest = lambda objects: F.get(F.array_sort(F.transform(objects, lambda o: F.struct(o["x"].alias("near"), o.alias("o")))), F.lit(0))["o"]
    named = S.holds(c("lead_id") >= 0)
    fresh = S.holds(F.abs(c("objects_us") - c("us")) <= LEAD_TOLERANCE * 1000)
    rows = frames.withColumn("__lead", F.when(named & fresh, F.get(F.filter("objects", lambda o: o["id"] == c("lead_id")), F.lit(0))))
    rows = rows.withColumn("unmatched", named & c("__lead").isNull())
    close = F.filter(in_lane, lambda o: o["x"].between(1, 50))
    both = lambda objects: F.filter(F.array(nearest(objects), F.when(~nearest(objects)["id"].eqNullSafe(c("__lead.id")), c("__lead"))), lambda o: o.isNotNull())
    rows = rows.withColumn("followed", both(close)).withColumn("ahead", both(in_lane)).drop("__lead")
    far = F.forall("ahead", lambda o: S.holds((o["x"] > 20) & (o["ttc"] > 8)))
    return rows.withColumn("clear", ~c("unmatched") & far)


def with_control(frames: DataFrame) -> DataFrame:
    """``frames`` with control (on and not overridden) and ``steady`` (the set speed of the frame before; the first is)."""
    before = F.lag("set_speed").over(Window.partitionBy(*KEYS).orderBy("us"))
    rows = frames.withColumn("control", c("np_on") & ~S.holds(c("override")))
    return rows.withColumn("steady", before.isNull() | S.holds(F.abs(c("set_speed") - before) <= 1e-6))


def target_frames(frames: DataFrame) -> DataFrame:
    """One row for each frame and target followed whose fields are all known: place (of the frame), target (a struct) and
    ``run``, the number of the run of successive frames that follow it."""
    o = c("target")
    known = S.finite(o["x"]) & S.finite(o["y"]) & S.finite(o["velocity"]) & S.finite(o["acceleration"]) & S.finite(o["length"]) & (o["x"] > 0) & (o["length"] > 0) & o["ttc"].isNotNull() & ~F.isnan(o["ttc"])
    rows = frames.withColumn("place", F.row_number().over(Window.partitionBy(*KEYS).orderBy("us"))).withColumn("target", F.explode("followed")).where(known)
    rows = rows.withColumn("target_id", o["id"])
    w = Window.partitionBy(*KEYS, "target_id").orderBy("place")
    return rows.withColumn("run", c("place") - F.row_number().over(w))


def follow_stop(frames: DataFrame) -> DataFrame:
    """Approaching one target until both stand: recording_id, target_id, start_us, end_us. From the first frame above 2 m/s, over
    more than five moving frames in control at a steady set speed and not before a red light within 10 m, to the frame before a
    standing one in control."""
    rows = target_frames(with_control(candidates(frames)))
    own = [*KEYS, "target_id", "run"]
    w = Window.partitionBy(*own).orderBy("place")
    steady = F.lag("set_speed").over(w).isNull() | S.holds(F.abs(c("set_speed") - F.lag("set_speed").over(w)) <= 1e-6)
    moving = c("control") & ~S.holds(c("non_straight")) & steady & ~c("still") & ~(c("red_light") & S.holds(c("stop_distance") < 10))
    rows = rows.withColumn("moving", moving).withColumn("stands", S.holds(F.lead("still").over(w) & F.lead("control").over(w)))
    runs = G.mark_islands(rows, "moving", own, ["place"], "part").where("part is not null")
    begins = F.min(F.when(c("primary") & (c("speed") > 2), c("place"))).over(Window.partitionBy(*own, "part"))
    inside = runs.withColumn("begins", begins).where("place >= begins")
    found = inside.groupBy(*own, "part").agg(F.min("us").alias("start_us"), F.max("us").alias("end_us"), F.count("*").alias("n"), F.max_by("stands", "place").alias("stands"))
    return found.where((c("n") > LEAST_STOP) & c("stands")).select(*KEYS, "target_id", "start_us", "end_us")


def red_light_stop(frames: DataFrame) -> DataFrame:
    """Braking for a red light within 150 m with a clear road: recording_id, start_us, end_us. The light may be lost for up to
    19 frames; the frame behind the last one stands before the red light in control."""
    rows = with_control(candidates(frames))
    rows = rows.withColumn("hold", c("clear") & c("control") & c("steady") & ~c("still")).withColumn("core", c("hold") & c("red_light") & S.holds(c("stop_distance") < 150))
    nxt = lambda x: F.lead(x).over(Window.partitionBy(*KEYS).orderBy("us"))
    rows = rows.withColumn("stands", S.holds(nxt("still") & nxt("clear") & nxt("red_light") & nxt("control")))
    runs = G.lookahead_bridge(rows, "core", "hold", BRIDGE, KEYS, ["us"], "us").withColumnsRenamed({"start_t": "start_us", "end_t": "end_us"}).drop("n")
    inside = samples_in(rows.select(*KEYS, "us", "core", "speed", "primary", "stands"), runs)
    first = F.min(F.when(c("core") & c("primary") & (c("speed") > 2), c("us"))).over(Window.partitionBy(*KEYS, "start_us"))
    found = inside.withColumn("first", first).where("us >= first").groupBy(*KEYS, "first", "end_us").agg(F.count("*").alias("n"), F.max_by("stands", "us").alias("stands"))
    return found.where((c("n") > LEAST_STOP) & c("stands")).select(*KEYS, c("first").alias("start_us"), "end_us")


def _green(least: int, top: float) -> M.Machine:
    """From a trigger while the function holds and the road is clear, until ``top`` speed or three falling speeds: (start, end).
    A frame with another set speed begins the count of frames and speeds anew."""

    def machine() -> Generator:
        out: list = []
        on, first, last, n = False, None, None, 0
        peak, before = 0.0, []
        while True:
            s = yield out
            out = []
            if s is None:
                if on and n > least:
                    out.append((first, last))
                continue
            if s.trigger and not on:
                on, first, last, n, peak, before = True, s.us, s.us, 1, s.speed or 0.0, [s.speed or 0.0]
            elif on and not s.holds:
                on, n, before = False, 0, []
            elif on and s.steady:
                if s.speed is not None:
                    before = [*before[-2:], s.speed]
                    peak = max(peak, s.speed)
                first, last, n = first if n else s.us, s.us, n + 1
                if peak >= top or (len(before) == 3 and before[2] < before[1] < before[0]):
                    if n > least:
                        out.append((first, last))
                    on, n, before = False, 0, []
            else:
                n, before = 0, []

    return machine


def green_light_start(frames: DataFrame) -> DataFrame:
    """Starts straight on after a red light that was under 5 m away turns: recording_id, start_us, end_us. A turn later on ends nothing."""
    rows = with_control(candidates(frames))
    w = Window.partitionBy(*KEYS).orderBy("us")
    turned = S.holds(F.lag("red_light").over(w)) & ~c("red_light") & S.holds(F.lag("stop_distance").over(w) < 5)
    rows = rows.select(*KEYS, "us", "speed", "steady", (turned & c("control") & ~S.holds(c("non_straight")) & c("steady") & c("still") & c("clear") & c("primary")).alias("trigger"), (c("control") & c("clear")).alias("holds"))
    return M.scan(rows, KEYS, ["us"], ["us", "speed", "steady", "trigger", "holds"], _green(LEAST_START, 10.0), "start_us long, end_us long")


def _judged(rows: DataFrame, metric: str, low: Column | float | None, high: Column | float | None, base: float) -> DataFrame:
    """Cases with a value: metric, recording_id, start_us, end_us, value, at_us, bad, severity."""
    from ..operators.kpi import severity_outside

    severity = severity_outside(c("value"), low, high, base)
    return rows.where("value is not null").select(F.lit(metric).alias("metric"), *KEYS, "start_us", "end_us", "value", "at_us", (severity > 0).alias("bad"), severity.alias("severity"))


def _with_jerk(inside: DataFrame, own: list[str]) -> DataFrame:
    """``inside`` with jerk over a scene's own samples: its windows end with the scene.

    Samples whose acceleration isn't known, and those at no time after 0, have none; of samples of one time the one that
    came last counts and the others have none.
    """
    good = S.finite(c("acceleration")) & (c("us") > 0)
    last = F.row_number().over(Window.partitionBy(*own, "us", "__good").orderBy(F.desc("arrival"))) == 1
    rows = inside.withColumn("__good", good).withColumn("__good", c("__good") & last)
    # The others have windows of their own, which tell nothing: one pass over the scenes, not one for each kind.
    return W.jerk(rows, "acceleration", [*own, "__good"], "us", origin="start_us").withColumn("jerk", F.when(c("__good"), c("jerk"))).drop("__good")


def follow_stop_cases(frames: DataFrame) -> DataFrame:
    """The four metrics of ``follow_stop``: time to collision as the vehicle begins to brake (at -0.5), strongest braking against a
    bound by the first speed, strongest jerk, and the least time to collision from the target's braking to the vehicle's stop."""
    scenes = follow_stop(frames)
    rows = target_frames(with_control(candidates(frames))).select(*KEYS, "target_id", "us", "arrival", "speed", "acceleration", c("target.ttc").alias("ttc"), c("target.acceleration").alias("target_acc"))
    own = [*KEYS, "target_id", "start_us", "end_us"]
    inside = _with_jerk(samples_in(rows.withColumnRenamed("target_id", "tid"), scenes).where("tid = target_id"), own)
    whole = Window.partitionBy(*own)
    inside = inside.withColumn("brakes", F.min(F.when(c("target_acc") <= -0.5, c("us"))).over(whole)).withColumn("stops", F.max(F.when(c("speed") >= 0.2, c("us"))).over(whole))
    least = lambda x, when=None: F.min(F.when(c(x).isNotNull() & ~F.isnan(x) & (F.lit(True) if when is None else when), F.struct(c(x).alias("v"), "us")))
    one = inside.groupBy(*own).agg(
        F.min(F.when(c("acceleration") <= -0.5, F.struct("us", "ttc"))).alias("first"), F.min_by("speed", "us").alias("v0"), least("acceleration").alias("acc"), least("jerk").alias("jerk"), least("ttc", c("us").between(c("brakes"), c("stops"))).alias("near"),
    )
    pick = lambda v, at: one.withColumn("value", c(v)).withColumn("at_us", c(at))
    bound = F.greatest(F.least(-c("v0") / 5.5, F.lit(-1.75)), F.lit(-4.0)) - 1
    return (
        _judged(pick("first.ttc", "first.us"), "follow_stop_ttc", 4.5, None, 2)
        .unionByName(_judged(pick("acc.v", "acc.us"), "follow_stop_max_acc", bound, None, 2))
        .unionByName(_judged(pick("jerk.v", "jerk.us"), "follow_stop_min_jerk", -2.0, None, 1))
        .unionByName(_judged(pick("near.v", "near.us"), "follow_stop_min_ttc_frntobj_dec", 1.5, None, 1))
    )


def red_light_cases(frames: DataFrame, powertrain: str = "PHEV") -> DataFrame:
    """The metrics of ``red_light_stop``: strongest jerk, and the least distance to the stop line (1.3 m from the sensor on)."""
    inside = _with_jerk(samples_in(frames.select(*KEYS, "us", "arrival", "acceleration", "stop_distance"), red_light_stop(frames)), [*KEYS, "start_us", "end_us"])
    least = lambda x: F.min(F.when(c(x).isNotNull() & ~F.isnan(x), F.struct(c(x).alias("v"), "us")))
    one = inside.groupBy(*KEYS, "start_us", "end_us").agg(least("jerk").alias("jerk"), least("stop_distance").alias("line"))
    jerk = _judged(one.withColumn("value", c("jerk.v")).withColumn("at_us", c("jerk.us")), "redlight_min_jerk", S.by_powertrain(powertrain, -2.3, -2.0), None, 1)
    return jerk.unionByName(_judged(one.withColumn("value", c("line.v") + 1.3).withColumn("at_us", c("line.us")), "redlight_stop_dis", 1.5, 3.5, 2))


def green_light_cases(frames: DataFrame, powertrain: str = "PHEV") -> DataFrame:
    """The metrics of ``green_light_start``: time to move (the second frame in a row above 0.2 m/s), strongest acceleration and
    jerk, and the time from 0.5 to 8 m/s. Times look beyond the scene."""
    scenes = green_light_start(frames)
    inside = _with_jerk(samples_in(frames.select(*KEYS, "us", "arrival", "acceleration"), scenes), [*KEYS, "start_us", "end_us"])
    most = lambda x: F.min(F.when(c(x).isNotNull() & ~F.isnan(x), F.struct((-c(x)).alias("v"), "us")))
    one = inside.groupBy(*KEYS, "start_us", "end_us").agg(most("acceleration").alias("acc"), most("jerk").alias("jerk"))
    back = Window.partitionBy(*KEYS).orderBy(F.desc("us"))
    w = Window.partitionBy(*KEYS).orderBy("us")
    both = S.holds((c("speed") > 0.2) & (F.lag("speed").over(w) > 0.2))
    after = lambda when: F.last(F.when(when, c("us")), True).over(back)
    # The frame before the start doesn't count towards two in a row; it stands, as the start does.
    times = frames.select(*KEYS, c("us").alias("start_us"), both.alias("both"), (c("speed") > 0.5).alias("goes"), (c("speed") > 8).alias("fast")).withColumn("us", c("start_us"))
    times = times.withColumns({"moved_us": after(c("both")), "goes_us": after(c("goes")), "fast_us": after(c("fast"))}).drop("us", "both", "goes", "fast")
    one = one.join(times.hint("merge"), [*KEYS, "start_us"], "left")
    pick = lambda v, at: one.withColumn("value", v).withColumn("at_us", c(at))
    return (
        _judged(pick((c("moved_us") - c("start_us")) / SECOND, "moved_us"), "traffic_light_stop2go_time", None, S.by_powertrain(powertrain, 1.7, 1.5), 3)
        .unionByName(_judged(pick(-c("acc.v"), "acc.us"), "traffic_light_stop2go_max_accel", 1.0, 2.3, 2))
        .unionByName(_judged(pick(-c("jerk.v"), "jerk.us"), "traffic_light_stop2go_max_jerk", None, 2.5, 1))
        .unionByName(_judged(pick((c("fast_us") - c("goes_us")) / SECOND, "fast_us"), "traffic_light_stop2go_accel_time", None, 6.0, 4))
    )


#: Frames of a curve scene and those bent over 0.004 in it, at least; distance of a red light that spoils it.
LEAST_CURVE, LEAST_BENT, CURVE_LIGHT = 50, 5, 50


def curve(frames: DataFrame) -> DataFrame:
    """Curves driven under a curve limit: recording_id, start_us, end_us. In control, straight on by signals and map, moving, the road
    clear and no red light within 50 m, for 50 frames from a primary one on, five of them bent over 0.004."""
    rows = with_control(candidates(frames))
    known = c("slope_acc").isNotNull() & c("acceleration").isNotNull()  # a frame without control or chassis ends a scene
    light = S.holds(c("red_light")) & S.holds(c("stop_distance") < CURVE_LIGHT)
    mask = known & S.holds(c("control") & ~S.holds(c("non_straight")) & c("curve_limited") & ~c("still") & c("clear") & ~light)
    runs = G.mark_islands(rows.withColumn("on", mask), "on", KEYS, ["us"], "run").where("run is not null")
    begun = F.max(c("primary").cast("int")).over(Window.partitionBy(*KEYS, "run").orderBy("us")) == 1
    found = runs.withColumn("begun", begun).where("begun").groupBy(*KEYS, "run")
    found = found.agg(F.min("us").alias("start_us"), F.max("us").alias("end_us"), F.count("*").alias("n"), F.count_if(c("max_curvature") > 0.004).alias("bent"))
    return found.where((c("n") >= LEAST_CURVE) & (c("bent") >= LEAST_BENT)).select(*KEYS, "start_us", "end_us")


def traced_back(inside: DataFrame, own: list[str]) -> DataFrame:
    """Samples of scenes (us, pull, speed; ``own`` tells the scene) with place, turn (place of the turning point) and ``traced``.

    The turning point is the first sample of -0.1 or more after one of -0.5 or less. From there back the braking that led to it is
    traced: a sample counts if it is the third of its scene at the latest, or isn't 0.07 below both samples before it, and if it is
    less than 0.5 above the least on the way. Three in a row that don't count end the trace; what lies before isn't looked at.
    """
    w = Window.partitionBy(*own).orderBy("us")
    rows = inside.where("speed is not null").withColumn("place", F.row_number().over(w))
    braked = F.max((c("pull") <= -0.5).cast("int")).over(w) == 1
    rows = rows.withColumn("turn", F.min(F.when(braked & (c("pull") >= -0.1), c("place"))).over(Window.partitionBy(*own)))
    back = Window.partitionBy(*own, "before").orderBy(F.desc("us"))
    rows = rows.withColumn("before", S.holds(c("place") <= c("turn")))
    one, two = F.lag("pull", 1).over(w), F.lag("pull", 2).over(w)
    falls = two.isNotNull() & (c("pull") < one - 0.07) & (c("pull") < two - 0.07)
    rows = rows.withColumn("least", F.min("pull").over(back)).withColumn("counts", c("before") & ~falls & (c("pull") < c("least") + 0.5))
    out = lambda k: F.coalesce(~F.lag("counts", k).over(back), F.lit(False))
    ends = c("before") & ~c("counts") & out(1) & out(2)
    ended = F.max(ends.cast("int")).over(back)
    return rows.withColumn("traced", c("counts") & (ended == 0)).drop("before", "least", "counts")


def curve_cases(frames: DataFrame) -> DataFrame:
    """The three metrics of ``curve``: the least speed of a settled sample (under 0.1 either way) after the turning point, against the
    speeds that suit the radius; strongest braking and jerk of the traced samples. Scenes without such samples are no cases."""
    rows = frames.select(*KEYS, "us", "arrival", "speed", "set_speed", "max_curvature", (c("acceleration") + c("slope_acc")).alias("pull"))
    own = [*KEYS, "start_us", "end_us"]
    inside = samples_in(rows, curve(frames))
    bend = inside.groupBy(*own).agg((1 / F.max(F.when(c("max_curvature") > 0, c("max_curvature")))).alias("radius")).withColumn("radius", F.coalesce("radius", F.lit(1000.0)))
    traced = traced_back(inside, own)
    settled = (c("place") > c("turn")) & (F.abs("pull") < 0.1)
    slow = traced.groupBy(*own).agg(F.min(F.when(settled, F.struct("speed", "place", "us", "set_speed"))).alias("slow")).where("slow is not null").join(bend, own)
    fitted = _with_jerk(traced.where("traced").withColumn("acceleration", c("pull")), own)
    pulls = fitted.groupBy(*own).agg(F.min(F.struct(c("pull"), (-c("place")).alias("p"), c("us"))).alias("pull"), F.min(F.when(c("jerk").isNotNull(), F.struct("jerk", "us"))).alias("jerk"))
    known = slow.join(pulls, own)
    pick = lambda v, at: known.withColumn("value", c(v)).withColumn("at_us", c(at))
    root = F.sqrt("radius")
    speed = _judged(slow.withColumn("value", c("slow.speed")).withColumn("at_us", c("slow.us")), "curvature_min_speed", root - 2, F.sqrt(2.9 * c("radius")) + 2, 5)
    free = slow.where(c("slow.set_speed") <= root).select(*own, F.lit(True).alias("free"))  # a set speed below what suits excuses
    speed = speed.join(free, own, "left").withColumn("bad", c("bad") & c("free").isNull()).withColumn("severity", F.when(c("free").isNull(), c("severity")).otherwise(0.0)).drop("free")
    columns = ["metric", *own, "value", "at_us", "bad", "severity"]
    return speed.select(columns).unionByName(_judged(pick("pull.pull", "pull.us"), "curvature_min_acc", -2.0, None, 2)).unionByName(_judged(pick("jerk.jerk", "jerk.us"), "curvature_min_jerk", -2.0, None, 1))
