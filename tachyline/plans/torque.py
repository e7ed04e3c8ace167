"""Incidents that are told by acceleration and torque together: jerkiness, braking after an override, brake taps.

A candidate is a short stretch of a recording; what is asked about its surroundings is aggregated over the samples
within fixed margins of it, joined on cells of time, so no recording is ever gathered.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import scalars as S
from ..operators import automata as M, segments as G, windows as W
from .scenes import KEYS, SECOND, samples_in

c = F.col
#: Seconds in microseconds, torque in Nm, rates per second.
PAD, PEAK_GAP, TRANSIENT_PAD = 350_000, 180_000, 200_000
JERK_UP, JERK_DOWN, JERK_P95, HIGH_RMS, HIGH_PEAK = 9.0, 4.0, 3.5, 0.1, 0.4
DRIVE_RANGE, BRAKE_RANGE, DRIVE_RATE, BRAKE_RATE = 80.0, 120.0, 1500.0, 2500.0
SAMPLES = 6


def signals(frame: DataFrame) -> DataFrame:
    """``frame`` with smoothed acceleration, jerk, acceleration above its trend, torques and their rates."""
    rows = W.time_mean(frame, "acceleration", 300_000, KEYS, "us", "smooth")
    rows = W.time_slope(rows, "smooth", 300_000, KEYS, "us", "jerk")
    rows = W.time_mean(rows, "acceleration", 120_000, KEYS, "us", "short_mean")
    rows = W.time_mean(rows, "acceleration", 800_000, KEYS, "us", "trend").withColumn("high", c("short_mean") - c("trend"))
    for name in ("drive", "brake"):
        rows = W.time_mean(rows, f"actual_{name}_torque", 80_000, KEYS, "us", name)
        rows = W.derivative(rows, name, KEYS, ["us"], "us", f"{name}_rate")
    return rows


def jerky(rows: DataFrame, valid: Column, keys: list[str] = KEYS) -> DataFrame:
    """Stretches of ``valid`` samples with jerk over 0.8 either way: keys, start_us, end_us, base (severity); over 0.5 s and
    up to 4 s long, 0.75 of smoothed acceleration from least to most, one change of sign."""
    runs = G.mark_islands(rows, valid & S.holds(F.abs("jerk") > 0.8), keys, ["us"], "run").where("run is not null")
    flip = F.signum("jerk") != F.lag(F.signum("jerk")).over(Window.partitionBy(*keys, "run").orderBy("us"))
    one = runs.withColumn("flip", S.holds(flip).cast("int")).groupBy(*keys, "run").agg(F.min("us").alias("start_us"), F.max("us").alias("end_us"), F.sum("flip").alias("flips"), (F.max("smooth") - F.min("smooth")).alias("amplitude"))
    length = (c("end_us") - c("start_us")) / SECOND
    base = F.round(c("amplitude") / 0.75 * 50 + c("flips") * 30 + length * 20, 3)
    return one.where((length > 0.5) & (length <= 4) & (c("amplitude") >= 0.75) & (c("flips") >= 1)).select(*keys, "start_us", "end_us", base.alias("base"))


def _peaks(value: str, sign: int, least: float) -> Column:
    """The (value, time) of an event's local peaks of ``sign * value``, ``least`` high."""
    w = Window.partitionBy("recording_id", "e_start", "e_end", "known").orderBy("us")
    x = sign * c(value)
    near = [F.coalesce(x >= f(x).over(w), F.lit(True)) for f in (F.lag, F.lead)]
    return F.when(c("known") & (x >= least) & near[0] & near[1], F.struct(x.alias("v"), c("us")))


def _pair(jerk: str, rate: str) -> Column:
    """The best pair of a jerk peak and a torque rate peak close by: by jerk, rate, nearness, then the earliest."""
    gap = lambda j, r: F.abs(j["us"] - r["us"])
    near = F.transform(jerk, lambda j: F.transform(F.filter(rate, lambda r: gap(j, r) <= PEAK_GAP), lambda r: F.struct(j["v"].alias("jerk"), r["v"].alias("rate"), (-gap(j, r)).alias("near"), (-j["us"]).alias("ju"), (-r["us"]).alias("ru"))))
    return F.array_max(F.flatten(near))


def confirmed(rows: DataFrame, base: DataFrame) -> DataFrame:
    """The ``jerky`` stretches of up to 2 s whose drive torque rises with the acceleration and whose brake torque rises
    as it falls: recording_id, e_start, start_us, end_us (the transient), severity."""
    spans = base.where(c("end_us") - c("start_us") <= 2 * SECOND).select("recording_id", "base", c("start_us").alias("e_start"), c("end_us").alias("e_end"))
    margin = PAD + TRANSIENT_PAD
    inside = samples_in(rows.select("recording_id", "us", "smooth", "high", "jerk", "drive", "brake", "drive_rate", "brake_rate"), spans.select("*", (c("e_start") - margin).alias("start_us"), (c("e_end") + margin).alias("end_us")))
    near = c("us").between(c("e_start") - PAD, c("e_end") + PAD)
    known = reduce(lambda a, b: a & b, (S.finite(c(x)) for x in ("smooth", "high", "jerk", "drive", "brake", "drive_rate", "brake_rate")))
    inside = inside.withColumn("near", near).withColumn("known", near & S.holds(known))
    peaks = {"up": _peaks("jerk", 1, JERK_UP), "down": _peaks("jerk", -1, JERK_DOWN), "drives": _peaks("drive_rate", 1, DRIVE_RATE), "brakes": _peaks("brake_rate", 1, BRAKE_RATE)}
    if_known = lambda x: F.when(c("known"), x)
    span = lambda x: F.max(F.when(c("near"), c(x))) - F.min(F.when(c("near"), c(x)))
    one = inside.withColumns(peaks).groupBy("recording_id", "e_start", "e_end", "base").agg(
        F.count_if("known").alias("n"), span("drive").alias("drive_range"), span("brake").alias("brake_range"), F.percentile(if_known(F.abs("jerk")), F.lit(0.95)).alias("p95"),
        F.sqrt(F.avg(if_known(c("high") * c("high")))).alias("rms"), F.max(if_known(F.abs("high"))).alias("peak"), *(F.collect_list(x).alias(x) for x in peaks), F.collect_list("us").alias("times"),
    )
    one = one.where((c("n") >= SAMPLES) & (c("drive_range") >= DRIVE_RANGE) & (c("brake_range") >= BRAKE_RANGE) & (c("p95") >= JERK_P95) & (c("rms") >= HIGH_RMS) & (c("peak") >= HIGH_PEAK))
    one = one.withColumn("rise", _pair("up", "drives")).withColumn("fall", _pair("down", "brakes")).where("rise is not null and fall is not null")
    at = [-c("rise.ju"), -c("rise.ru"), -c("fall.ju"), -c("fall.ru")]
    one = one.withColumn("first", F.least(*at)).withColumn("last", F.greatest(*at))
    begin = F.array_min(F.filter("times", lambda x: x >= c("first") - TRANSIENT_PAD))
    end = F.array_max(F.filter("times", lambda x: x <= c("last") + TRANSIENT_PAD))
    severity = F.round(c("base") + c("p95") * 20 + c("peak") * 120 + c("rise.rate") / 200 + c("fall.rate") / 200, 3)
    return one.select("recording_id", "e_start", F.when(end > begin, begin).otherwise(c("first")).alias("start_us"), F.when(end > begin, end).otherwise(c("last")).alias("end_us"), severity.alias("severity"))


def _driving(frame: DataFrame) -> Column:
    return S.holds(c("ego_speed") > 0) if "ego_speed" in frame.columns else F.lit(True)


def marks(frame: DataFrame) -> DataFrame:
    """``frame`` with ``released`` and ``came_on`` (the first sample after an override, and with the function on), and whether a
    sample is within 2 s and 1 s after one: ``after_release``, ``after_start``."""
    w = Window.partitionBy(*KEYS).orderBy("us")
    rows = frame.withColumn("released", S.holds(F.lag("pedal_override_flag").over(w)) & ~c("pedal_override_flag"))
    rows = rows.withColumn("came_on", c("acc_active_flag") & ~F.coalesce(F.lag("acc_active_flag").over(w), F.lit(True)))
    rows = G.after_edge(rows, "released", 2 * SECOND, KEYS, ["us"], "us", "after_release")
    return G.after_edge(rows, "came_on", SECOND, KEYS, ["us"], "us", "after_start")


def _events(found: DataFrame) -> DataFrame:
    return found.select("recording_id", "start_us", "end_us", "severity")


def torque_jerkiness(frame: DataFrame, powertrain: str = "PHEV") -> DataFrame:
    """Confirmed jerkiness in control, away from overrides and the moments after releases and activations, which have counts
    of their own: neither its samples nor those of its transient lie there."""
    rows = signals(marks(frame)).withColumn("elsewhere", c("pedal_override_flag") | c("after_release") | c("after_start"))
    found = confirmed(rows, jerky(rows, c("in_control") & _driving(frame) & ~c("elsewhere")))
    met = samples_in(rows.where("elsewhere").select("recording_id", "us"), _events(found)).select("recording_id", "start_us", "end_us").distinct()
    return _events(found.join(met, ["recording_id", "start_us", "end_us"], "left_anti"))


def release_windows(frame: DataFrame) -> DataFrame:
    """recording_id, start_us, end_us of the 2 s after a release, where these are recorded whole, on, and without an override."""
    whole = G.full_windows(marks(frame), "released", c("acc_active_flag") & ~c("pedal_override_flag"), 2 * SECOND, KEYS, ["us"], "us").where("n > 1")
    spans = whole.select("recording_id", c("start_t").alias("start_us"), (c("start_t") + 2 * SECOND).alias("end_us"))
    return samples_in(frame.select("recording_id", "us"), spans).groupBy("recording_id", "start_us").agg(F.max("us").alias("end_us"))


def jerkiness_after_release(frame: DataFrame, powertrain: str = "PHEV") -> DataFrame:
    """Windows after a release (``release_windows`` has them all) with confirmed jerkiness, each once with its worst severity."""
    rows = signals(frame)
    windows = release_windows(frame).withColumnsRenamed({"start_us": "w_start", "end_us": "w_end"})
    inside = samples_in(rows.select("recording_id", "us", "jerk", "smooth", (c("in_control") & _driving(frame)).alias("on")), windows.select("*", c("w_start").alias("start_us"), c("w_end").alias("end_us"))).drop("start_us", "end_us")
    base = jerky(inside, c("on"), ["recording_id", "w_start", "w_end"])
    found = confirmed(rows, base).join(base.select("recording_id", "w_start", "w_end", c("start_us").alias("e_start")), ["recording_id", "e_start"])
    return found.groupBy("recording_id", "w_start", "w_end").agg(F.max("severity").alias("severity")).select("recording_id", c("w_start").alias("start_us"), c("w_end").alias("end_us"), "severity")


def jerkiness_after_activation(frame: DataFrame, powertrain: str = "PHEV") -> DataFrame:
    """Confirmed jerkiness within a second after the function comes on."""
    rows = signals(marks(frame))
    return _events(confirmed(rows, jerky(rows, c("in_control") & _driving(frame) & c("after_start"))))


def jerkiness_in_override(frame: DataFrame, powertrain: str = "PHEV") -> DataFrame:
    """Confirmed jerkiness while the driver presses the accelerator over the function."""
    rows = signals(frame)
    return _events(confirmed(rows, jerky(rows, c("acc_active_flag") & c("pedal_override_flag") & S.holds(c("accelerator_pedal_pos") > 0) & _driving(frame))))


def braking_after_release(frame: DataFrame, powertrain: str = "PHEV", raw: bool = False) -> DataFrame:
    """Braking under -2 with jerk under -3 that a change of torque brings on within 0.2 s of a release.

    An onset is the first sample at which the brake torque's trailing rate reaches 2,500, or the drive torque's -1,500. It
    counts if the torque then changes by 120 (80) within a second, while the function is on, and braking of 0.2 s, gaps of
    0.5 s closed, begins by 0.2 s after the release and lasts to the onset at least. The first onset of a release counts.
    What is seen of the acceleration ends with that second. ``raw`` goes by the acceleration itself and closes no gaps: a stretch counts
    if its jerk falls under -3 anywhere.
    """
    w = Window.partitionBy(*KEYS).orderBy("us")
    trail = w.rangeBetween(-80_000, 0)
    rows = frame.select("recording_id", "us", "acceleration", c("actual_drive_torque").alias("drive"), c("actual_brake_torque").alias("brake"), (c("acc_active_flag") & ~c("pedal_override_flag")).alias("on"), "pedal_override_flag")
    rows = rows.withColumn("ok", S.finite(c("drive")) & S.finite(c("brake")))
    for name in ("drive", "brake"):
        rows = rows.withColumn("m", F.when(F.count(name).over(trail) == F.count("*").over(trail), F.avg(name).over(trail)))
        rows = rows.withColumn(f"{name}_rate", (c("m") - F.lag("m").over(w)) / ((c("us") - F.lag("us").over(w)) / SECOND)).drop("m")
    fresh = lambda name, sign, least: S.holds(sign * c(name) >= least) & ~S.holds(sign * F.lag(name).over(w) >= least)
    rows = rows.withColumns({
        "released": S.holds(F.lag("pedal_override_flag").over(w)) & c("on"), "broken": F.sum((~(c("on") & c("ok"))).cast("long")).over(w), "brake_on": fresh("brake_rate", 1, BRAKE_RATE), "drive_on": fresh("drive_rate", -1, DRIVE_RATE),
        "before_ok": S.holds(F.lag("ok").over(w)), "brake_before": F.lag("brake").over(w), "drive_before": F.lag("drive").over(w),
    })
    releases = rows.where("released").select("recording_id", c("us").alias("release"), c("broken").alias("intact"), c("us").alias("start_us"), (c("us") + 200_000).alias("end_us"))
    onsets = samples_in(rows.where("on and ok and before_ok and (brake_on or drive_on)"), releases).where("broken = intact").select("recording_id", "release", "intact", c("us").alias("onset"), "brake_on", "drive_on", "brake_before", "drive_before")
    spans = onsets.select("*", (c("release") - SECOND).alias("start_us"), (c("onset") + SECOND).alias("end_us"))
    near = samples_in(rows.select("recording_id", "us", "acceleration", "brake", "drive", "broken"), spans).where("us < onset or broken = intact").drop("start_us", "end_us")
    # The sample before the earliest one that counts, too.
    own = ["recording_id", "release", "onset"]
    edge = F.max(F.when(c("us") < c("release") - 600_000, c("us"))).over(Window.partitionBy(*own))
    near = near.withColumn("edge", edge).where(c("us") >= F.coalesce("edge", c("us")))
    near = W.time_slope(W.time_mean(near, "acceleration", 300_000, own, "us", "smooth"), "smooth", 300_000, own, "us", "jerk")
    level = "acceleration" if raw else "smooth"
    near = near.withColumn("low", S.finite(c(level)) & S.holds((c(level) < -2) & (F.lit(raw) | (c("jerk") < -3))))
    already = F.max_by("low", F.when(c("us") < c("release"), c("us")))
    change = lambda name, sign: F.max(F.when(c("us") >= c("onset"), sign * (c(name) - c(f"{name}_before"))))
    turned = near.groupBy(*own).agg(already.alias("already"), F.first("brake_on").alias("brake_on"), F.first("drive_on").alias("drive_on"), change("brake", 1).alias("more"), change("drive", -1).alias("less"))
    turned = turned.where("not coalesce(already, false) and ((brake_on and more >= 120) or (drive_on and less >= 80))").select(*own)
    scene = near.where("us >= release").join(turned, own, "left_semi")
    scene = scene.withColumn("filled", c("low")) if raw else G.fill_short_gaps(scene, "low", SECOND // 2, own, ["us"], "us")
    runs = G.islands(scene, "filled", own, ["us"], "us", aggs=[F.min(level).alias("least"), F.min("jerk").alias("jerk")]).where(F.lit(not raw) | (c("jerk") < -3))
    runs = runs.where((c("start_t") <= c("release") + 200_000) & (c("end_t") >= c("onset")) & (c("duration") >= 200_000))
    best = runs.groupBy("recording_id", "release").agg(F.min_by(F.struct("start_t", "end_t", "least", "jerk"), F.struct("onset", "start_t")).alias("b")).select("recording_id", "b.*")
    by_level, by_jerk = (60, 40) if raw else (50, 25)
    severity = F.round(F.greatest(-c("least") - 2, F.lit(0.0)) * by_level + F.greatest(-c("jerk") - 3, F.lit(0.0)) * by_jerk, 3)
    return best.select("recording_id", c("start_t").alias("start_us"), c("end_t").alias("end_us"), severity.alias("severity"))


def stable_scenes(frame: DataFrame) -> DataFrame:
    """scene, recording_id, start_us, end_us: 8 s at a steady speed without a target, or behind one that is steady as well."""
    shown = S.display_speed(c("ego_speed"))
    wanted, limit = S.display_speed(c("set_speed")), c("curv_speed_limit")
    free = ~c("curv_enable_flag") | ~S.finite(limit) | S.holds(S.display_speed(limit) >= wanted)
    alone = c("in_control") & ~c("cutin_valid") & ~c("front_valid") & free & S.finite(c("ego_speed")) & S.finite(c("set_speed")) & S.holds(shown > 5) & S.holds(wanted >= 1)
    behind = c("in_control") & ~c("cutin_valid") & c("front_valid") & S.holds(c("ego_speed") >= 30) & S.holds(c("front_range").between(5, 100)) & S.finite(c("front_velocity_abs")) & S.holds(F.abs(c("ego_speed_mps") - c("front_velocity_abs")) <= 1.5)
    base = lambda mask, x: F.when(mask, x)
    rows = frame.select("recording_id", "us", base(alone, shown).alias("a_speed"), base(alone, wanted).alias("a_set"), base(behind, shown).alias("b_speed"), base(behind, c("front_range")).alias("b_range"), base(behind, c("front_velocity_abs")).alias("b_front"), F.when(c("front_valid"), c("front_velocity_abs")).alias("front"))
    give = "start_us long, end_us long, n long"
    one = M.scan(rows, KEYS, ["us"], ["us", "a_speed", "a_set"], M.stable_ranges({"a_speed": 2.0, "a_set": 0.1}, 8 * SECOND, "us"), give)
    two = M.scan(rows, KEYS, ["us"], ["us", "b_speed", "b_range", "b_front"], M.stable_ranges({"b_speed": 5.0, "b_range": 10.0, "b_front": 4 / 3.6}, 8 * SECOND, "us"), give)
    two = two.join(_calm_ends(rows, two), ["recording_id", "start_us", "end_us"], "left_semi")
    return one.select(F.lit("no_front_steady").alias("scene"), "recording_id", "start_us", "end_us").unionByName(two.select(F.lit("stable_follow").alias("scene"), "recording_id", "start_us", "end_us"))


def _calm_ends(rows: DataFrame, scenes: DataFrame) -> DataFrame:
    """The scenes at both of whose ends the target's speed is known and spans 0.5 at most from 1 s before to 1 s after."""
    w = Window.partitionBy(*KEYS).orderBy("us")
    own = rows.select("recording_id", "us", "front", F.lead("us").over(w).alias("next"), F.lag("us").over(w).alias("before"))
    ends = scenes.select("recording_id", "start_us", "end_us", F.explode(F.array("start_us", "end_us")).alias("at"))
    spans = ends.select("recording_id", "at", c("start_us").alias("s"), c("end_us").alias("e"), (c("at") - 2 * SECOND).alias("start_us"), (c("at") + 2 * SECOND).alias("end_us"))
    met = samples_in(own, spans)
    # From the last sample at or before the second ahead to the first at or after the second behind.
    inside = met.where((F.coalesce(c("next") > c("at") - SECOND, F.lit(True))) & (F.coalesce(c("before") < c("at") + SECOND, F.lit(True))))
    one = inside.groupBy("recording_id", "s", "e", "at").agg(F.min("us").alias("a"), F.max("us").alias("b"), F.count("*").alias("n"), F.count("front").alias("known"), (F.max("front") - F.min("front")).alias("span"))
    good = one.where((c("a") <= c("at") - SECOND) & (c("b") >= c("at") + SECOND) & (c("n") >= 2) & (c("known") == c("n")) & (c("span") <= 0.5 + 1e-9))
    return good.groupBy("recording_id", c("s").alias("start_us"), c("e").alias("end_us")).agg(F.count("*").alias("ends")).where(c("ends") == F.when(c("start_us") == c("end_us"), 1).otherwise(2)).drop("ends")


def brake_tap(frame: DataFrame, powertrain: str = "PHEV") -> DataFrame:
    """A pulse of brake torque (requested or actual) in a stable scene: 63 over the scene's 20th percentile for 0.08 to 1.5 s,
    gaps of 0.1 s closed, 180 over it at its peak, with acceleration falling by 0.2 from before."""
    torque = F.greatest(*(F.greatest(F.when(S.finite(c(x)), c(x)).otherwise(0.0), F.lit(0.0)) for x in ("control_brake_request_torque", "actual_brake_torque")))
    rows = W.box_mean(frame.withColumn("torque", torque), "acceleration", 5, KEYS, ["us"], "acc").select("recording_id", "us", "torque", "acc")
    scenes = stable_scenes(frame).withColumn("s", c("start_us")).withColumn("e", c("end_us"))
    own = ["recording_id", "scene", "s", "e"]
    inside = samples_in(rows, scenes).select(*own, "us", "torque", "acc")
    inside = inside.withColumn("floor", F.percentile("torque", F.lit(0.2)).over(Window.partitionBy(*own))).withColumn("over", c("torque") > c("floor") + 63)
    runs = G.islands(G.fill_short_gaps(inside, "over", SECOND // 10, own, ["us"], "us"), "filled", own, ["us"], "us", aggs=[(F.max("torque") - F.min("floor")).alias("height")])
    pulses = runs.where(c("duration").between(80_000, 1_500_000) & (c("height") >= 180)).select(*own, c("start_t").alias("p_start"), c("end_t").alias("p_end"), "height", F.greatest(c("s"), c("start_t") - 600_000).alias("start_us"), F.least(c("e"), c("end_t") + 600_000).alias("end_us"))
    around = samples_in(rows, pulses).groupBy("recording_id", "scene", "p_start", "p_end", "height").agg(F.median(F.when(c("us") <= c("p_start"), c("acc"))).alias("before"), F.min(F.when(c("us") >= c("p_start"), c("acc"))).alias("least"))
    drop = c("before") - c("least")
    return around.where(drop >= 0.2).select("recording_id", c("p_start").alias("start_us"), c("p_end").alias("end_us"), F.round(c("height") / 100 + drop * 10, 3).alias("severity"))
