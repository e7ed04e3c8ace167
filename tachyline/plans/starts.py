"""Starts from standing and steady driving on slopes, on planner frames: scenes and their case metrics.

Frames are those of ``plans.planner``; ``shown_speed`` (km/h on the dashboard, by the body message) is read where they have it.
All bounds are told for the two groups of powertrains. A scene without the samples that a metric needs is no case of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import scalars as S
from ..operators import automata as M, segments as G
from .planner import _judged, _with_jerk, candidates, target_frames, with_control
from .scenes import KEYS, SECOND, samples_in

c = F.col
OWN = [*KEYS, "start_us", "end_us"]
#: Frames of a start at least, speed at its end (m/s), distance of a red light that spoils it.
LEAST_GO, LEAST_GO_SPEED, GO_LIGHT = 50, 8.0, 50
#: Distance of a red light that spoils a slope, and the curve limit (m/s) where there is none.
SLOPE_LIGHT, NO_LIMIT = 40, 100.0
#: Frames of a start behind a target that are too few; speeds (m/s) that end it, or must be reached if something else does.
FEW_FOLLOW, FOLLOW_FAST, FOLLOW_MOVED = 5, 6.0, 2.0


def _red_light(nearest: float, farthest: float | None = None) -> Column:
    near = c("stop_distance") < nearest if farthest is None else c("stop_distance").between(nearest, farthest)
    return S.holds(c("red_light")) & S.holds(near)


def _known() -> Column:
    """The frame has a control and a chassis message."""
    return c("slope_acc").isNotNull() & c("acceleration").isNotNull()


def stop2go(frames: DataFrame) -> DataFrame:
    """Starts on a free road: recording_id, start_us, end_us. From the first moving frame, a primary one, on: in control, straight on, at a
    steady set speed and below it, without a curve limit or a red light within 50 m, never slowing, for 50 frames. The function must
    still be on in the frame behind, and the speed 8 m/s or more there (in the last frame, if the road is no longer clear behind it)."""
    w = Window.partitionBy(*KEYS).orderBy("us", "arrival")
    rows = with_control(candidates(frames))
    free = c("control") & ~S.holds(c("non_straight")) & c("clear") & ~_red_light(GO_LIGHT) & ~S.holds(c("curve_limited"))
    going = _known() & free & c("steady") & ~c("still") & S.holds(c("acceleration") >= 0) & S.holds(c("speed") <= c("set_speed"))
    rows = rows.withColumns({"going": going, "begins": S.holds(F.lag("still").over(w)) & S.holds(c("primary"))})
    behind = F.struct(c("control"), F.when(F.lead("clear").over(w), F.lead("speed").over(w)).otherwise(c("speed")).alias("speed"), F.lead("control").over(w).alias("on"), F.lead("us").over(w).isNull().alias("none"))
    runs = G.mark_islands(rows.withColumn("behind", behind), "going", KEYS, ["us", "arrival"], "run").where("run is not null")
    found = runs.groupBy(*KEYS, "run").agg(F.min("us").alias("start_us"), F.max("us").alias("end_us"), F.count("*").alias("n"), F.min_by("begins", F.struct("us", "arrival")).alias("begins"), F.max_by("behind", F.struct("us", "arrival")).alias("behind"))
    ends = (c("behind.none") | S.holds(c("behind.on"))) & S.holds(c("behind.speed") >= LEAST_GO_SPEED)
    return found.where(c("begins") & (c("n") >= LEAST_GO) & ends).select(*OWN)


def slope_samples(frames: DataFrame) -> DataFrame:
    """What the machine of the slope scene reads: recording_id, us, arrival, primary, on, speed and set_speed. A frame at the time of the one before is off."""
    rows = with_control(candidates(frames))
    limit = F.when(S.holds(c("curve_limited")), c("curve_limit")).otherwise(NO_LIMIT)
    later = ~S.holds(F.lag("us").over(Window.partitionBy(*KEYS).orderBy("us", "arrival")) >= c("us"))
    finite = S.finite(c("speed")) & S.finite(c("set_speed")) & S.finite(c("slope_acc")) & S.finite(limit)
    on = finite & _known() & later & c("control") & ~S.holds(c("non_straight")) & ~c("still") & c("clear") & (c("set_speed") > 0) & (F.abs("slope_acc") >= 0.1) & (limit >= c("speed")) & ~_red_light(SLOPE_LIGHT)
    return rows.select(*KEYS, "us", "arrival", "primary", S.holds(on).alias("on"), "speed", "set_speed")


def slope(frames: DataFrame, powertrain: str = "PHEV") -> DataFrame:
    """Steady driving on a slope of 0.1 m/s² or more, on a free road: recording_id, start_us, end_us. A stretch at one set speed must
    begin in a primary frame."""
    rows = slope_samples(frames)
    machine = M.steady_band("on", "speed", "set_speed", S.by_powertrain(powertrain, 0.6, 0.3), SECOND, 2 * SECOND, 5 * SECOND, "us", 0)
    found = M.scan(rows, KEYS, ["us", "arrival"], ["us", "on", "speed", "set_speed"], machine, "start_us long, end_us long, candidate_us long")
    foreign = rows.where(c("on") & ~S.holds(c("primary"))).select(*KEYS, c("us").alias("candidate_us"))
    return found.join(foreign.hint("merge"), [*KEYS, "candidate_us"], "left_anti").select(*OWN)


def follow_start(frames: DataFrame) -> DataFrame:
    """Starts behind one target: recording_id, target_id, start_us, end_us. The target goes from 0.2 or less to over 0.5 m/s within a second while
    the vehicle stands in control; the last such frame begins the scene, unless a red light is 0.1 to 30 m away. It goes on, in control, straight
    on and at a steady set speed, without a red light within 0.1 to 15 m, and never slowing once the vehicle moves; it ends with the first frame of 6 m/s,
    or before what spoils it if 2 m/s were reached. It has more than five frames. A frame without a chassis message discards it."""
    own = [*KEYS, "target_id", "run"]
    w = Window.partitionBy(*own).orderBy("place")
    rows = target_frames(with_control(candidates(frames)))
    ahead = c("target.velocity")
    waits = c("still") & S.holds(c("speed") <= 0.2) & c("control")
    steady = F.lag("set_speed").over(w).isNull() | S.holds(F.abs(c("set_speed") - F.lag("set_speed").over(w)) <= 1e-6)
    rows = rows.withColumns({"low": F.last(F.when(ahead <= 0.2, c("us")), True).over(w), "moves": F.last(F.when(~waits, c("us")), True).over(w), "void": c("acceleration").isNull(), "held": c("control") & ~S.holds(c("non_straight")) & steady})
    trigger = (ahead > 0.5) & S.holds(c("us") - c("low") <= SECOND) & (c("moves").isNull() | (c("moves") < c("low"))) & ~_red_light(0.1, 30) & S.holds(c("primary")) & ~c("void")
    rows = rows.withColumn("trigger", S.holds(trigger)).withColumn("session", F.count_if("trigger").over(w)).where("session > 0")
    slows = ~S.holds(F.lag("still").over(w)) & (c("still") | ~S.holds(c("acceleration") >= 0))
    goes_on = ~c("void") & F.when(c("trigger"), c("held")).otherwise(c("held") & ~_red_light(0.1, 15) & ~slows)
    rows = rows.withColumn("goes_on", goes_on)
    each = Window.partitionBy(*own, "session").orderBy("place")
    broken = F.max((~c("goes_on")).cast("int")).over(each)
    done = F.coalesce(F.max((c("goes_on") & ~c("trigger") & S.holds(c("speed") >= FOLLOW_FAST)).cast("int")).over(each.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumns({"inside": (broken == 0) & (done == 0), "spoilt": (broken == 1) & (done == 0), "final": F.max("session").over(Window.partitionBy(*own)) == c("session")})
    one = rows.groupBy(*own, "session", "final").agg(
        F.min(F.when(c("inside"), c("us"))).alias("start_us"), F.max(F.when(c("inside"), c("us"))).alias("end_us"), F.count_if("inside").alias("n"), F.max_by("speed", F.when(c("inside"), c("place"))).alias("speed"), F.max("spoilt").alias("spoilt"), F.min_by("void", F.when(c("spoilt"), c("place"))).alias("void"),
    )
    ends = S.holds(c("speed") >= FOLLOW_FAST) | (F.when(c("spoilt"), ~c("void")).otherwise(c("final")) & S.holds(c("speed") >= FOLLOW_MOVED))
    return one.where((c("n") > FEW_FOLLOW) & ends).select(*KEYS, "target_id", "start_us", "end_us")


def _pulls(frames: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    return frames.select(*KEYS, "us", "arrival", "speed", (c("acceleration") + c("slope_acc")).alias("acceleration"), *more)


def _most(value: Column) -> Column:
    """(v, us) of the largest value, the earliest of equals."""
    return F.max(F.when(S.finite(value), F.struct(value.alias("v"), (-c("us")).alias("before"))))


def stop2go_cases(frames: DataFrame, powertrain: str = "PHEV") -> DataFrame:
    """The four metrics of ``stop2go``, over the pull (acceleration with the slope's part): its strongest, the time from over 0.2 to there, the strongest jerk,
    and the time from over 0.2 to over 3.33 m/s. The strongest are judged to the third decimal."""
    inside = _with_jerk(samples_in(_pulls(frames), stop2go(frames)), OWN)
    pull, whole = c("acceleration"), S.finite(c("acceleration")) & c("speed").isNotNull()
    first = lambda when: F.min(F.when(S.finite(pull) & when, c("us")))
    one = inside.groupBy(*OWN).agg(
        _most(F.when(whole, pull)).alias("top"), _most(pull).alias("any_top"), _most(F.when(whole, c("jerk"))).alias("jerk"), first(pull > 0.2).alias("pulls"),
        first(pull > 0.1).alias("t0"), first(c("speed") > 0.2).alias("t1"), first(c("speed") > 3.33).alias("t2"),
    )
    pick = lambda v, at: one.withColumn("value", v).withColumn("at_us", at)
    built = F.greatest((-c("any_top.before") - F.coalesce("pulls", -c("any_top.before"))) / SECOND, F.lit(0.0))
    reached = F.when(c("t0").isNotNull() & c("t1").isNotNull(), F.greatest((c("t2") - c("t1")) / SECOND, F.lit(0.0)))
    return (
        _judged(pick(F.round("top.v", 3), -c("top.before")), "stop2go_max_acc", 1.0, 2.7, 2)
        .unionByName(_judged(pick(built, -c("any_top.before")), "stop2go_max_acc_time", None, S.by_powertrain(powertrain, 4.0, 3.5), 2))
        .unionByName(_judged(pick(F.round("jerk.v", 3), -c("jerk.before")), "stop2go_max_jerk", None, S.by_powertrain(powertrain, 4.0, 3.5), 1))
        .unionByName(_judged(pick(reached, c("t2")), "stop2go_start_time", 1.0, S.by_powertrain(powertrain, 3.2, 2.8), 2))
    )


def slope_cases(frames: DataFrame, powertrain: str = "PHEV") -> DataFrame:
    """The three metrics of ``slope``: the pull farthest from 0, the largest jerk (not the farthest from 0), and how far the speed on the dashboard
    swings (in m/s; no case without ``shown_speed``)."""
    shown = frames if "shown_speed" in frames.columns else frames.withColumn("shown_speed", F.lit(None).cast("double"))
    inside = _with_jerk(samples_in(_pulls(shown, ("shown_speed",)), slope(frames, powertrain)), OWN)
    seen = F.when(S.finite(c("shown_speed")), c("shown_speed"))
    far = F.max(F.when(S.finite(c("acceleration")), F.struct(F.abs("acceleration").alias("size"), (-c("us")).alias("before"), c("acceleration").alias("v"))))
    one = inside.groupBy(*OWN).agg(far.alias("far"), _most(c("jerk")).alias("jerk"), ((F.max(seen) - F.min(seen)) / 3.6).alias("swing"), _most(c("shown_speed")).alias("fast"))
    pick = lambda v, at: one.withColumn("value", v).withColumn("at_us", at)
    return (
        _judged(pick(c("far.v"), -c("far.before")), "slope_no_frnt_acc", -0.75, 0.75, 0.75)
        .unionByName(_judged(pick(c("jerk.v"), -c("jerk.before")), "slope_no_frnt_jerk", -1.0, 1.0, 1))
        .unionByName(_judged(pick(c("swing"), -c("fast.before")), "slope_no_frnt_vel_fluct", None, S.by_powertrain(powertrain, 0.6, 0.3), 2))
    )


def follow_start_cases(frames: DataFrame, powertrain: str = "PHEV") -> DataFrame:
    """The two metrics of ``follow_start``: the time from the first of three frames in a row in which the target drives over 0.5 m/s to the first in which the
    vehicle does (none if that is earlier), by the times of the object messages; and the strongest jerk of the acceleration."""
    own = [*KEYS, "target_id", "start_us", "end_us"]
    rows = target_frames(with_control(candidates(frames))).select(*KEYS, c("target_id").alias("tid"), "us", "arrival", "objects_us", "speed", "acceleration", c("target.velocity").alias("ahead"))
    inside = samples_in(rows, follow_start(frames)).where("tid = target_id")
    w = Window.partitionBy(*own).orderBy("objects_us", "us")
    three = (c("ahead") > 0.5) & (F.lead("ahead", 1).over(w) > 0.5) & (F.lead("ahead", 2).over(w) > 0.5)
    one = inside.withColumn("three", S.holds(three)).groupBy(*own).agg(F.min(F.when(c("three"), c("objects_us"))).alias("goes"), F.min(F.when(c("speed") > 0.5, c("objects_us"))).alias("moves"))
    late = one.withColumn("value", F.when(c("moves") >= c("goes"), (c("moves") - c("goes")) / SECOND)).withColumn("at_us", c("moves"))
    jerk = _with_jerk(inside, own).groupBy(*own).agg(_most(c("jerk")).alias("jerk")).withColumn("value", F.col("jerk.v")).withColumn("at_us", -c("jerk.before"))
    return _judged(late, "follow_start_latency", None, S.by_powertrain(powertrain, 2.8, 2.5), 3).unionByName(_judged(jerk, "follow_start_jerk", None, 1.5, 1))
