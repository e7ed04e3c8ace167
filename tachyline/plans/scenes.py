"""Scenes: the stretches of a drive that a case metric looks at, as segments (recording_id, start_t, end_t, duration).

``frame`` has derived fields (``functions.scalars.derive``), recording_id, t in seconds and ``us`` in microseconds.
Masks are column expressions, runs are islands, and only the slope scene needs a machine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import scalars as S
from ..operators import alignment as A, automata as M, segments as G

KEYS = ["recording_id"]
SECOND = 1_000_000
#: Cells of time in which segments and samples meet.
CELL = 10 * SECOND


def prepare(frame: DataFrame) -> DataFrame:
    """A raw wide frame (recording_id, t, signals) -> derived fields and integer time."""
    return S.derive(frame).withColumn("us", F.round(F.col("t") * SECOND).cast("long"))


def clear(frame_far: float = 30.0, late: float = 20.0) -> Column:
    both = [S.front_clear(F.col(v), F.col("front_range"), F.col(t), frame_far, late) for v, t in (("front_valid", "front_ttc"), ("cutin_valid", "cutin_ttc"))]
    return both[0] & both[1]


def samples_in(frame: DataFrame, segments: DataFrame) -> DataFrame:
    """Samples with the segment that they lie in, ends included, joined on cells of time.

    Spark takes samples that are made of a small table for as small as that, and would send them all to the driver to broadcast them: it is told to shuffle.
    """
    spread = segments.withColumn("__c", F.explode(F.sequence(F.floor(F.col("start_us") / CELL), F.floor(F.col("end_us") / CELL))))
    rows = frame.withColumn("__c", F.floor(F.col("us") / CELL))
    return rows.join(spread.hint("shuffle_hash"), ["recording_id", "__c"]).where("us between start_us and end_us").drop("__c")


def _segments(rows: DataFrame) -> DataFrame:
    return rows.select("recording_id", "start_us", "end_us")


def merged(segments: DataFrame) -> DataFrame:
    return _segments(G.merge_overlapping(segments, KEYS, "start_us", "end_us"))


def _runs(frame: DataFrame, mask: Column, least: float | None = None, split_on: str | None = None, aggs=()) -> DataFrame:
    out = G.islands(frame, mask, KEYS, ["us"], "us", None if least is None else least * SECOND, split_on, aggs)
    return out.withColumnsRenamed({"start_t": "start_us", "end_t": "end_us"})


def curvature(frame: DataFrame, powertrain: str = "PHEV") -> DataFrame:
    """In control with curve speed control on, 10 km/h or more, road clear, for 3 s, five samples bent over 0.004."""
    c = F.col
    mask = c("in_control") & c("curv_enable_flag") & c("moving_flag") & S.holds(c("ego_speed_mps") >= 10 / S.KPH) & clear()
    return _segments(_runs(frame, mask, 3, aggs=[F.count_if(c("curvature") > 0.004).alias("bent")]).where("bent >= 5"))


def stop2go(frame: DataFrame, powertrain: str = "PHEV") -> DataFrame:
    """From the first moving sample in control until speed 8, loss of control or a limit by curves (that sample included), or
    until the conditions fail (excluded); 5 s, peak 10 km/h."""
    c = F.col
    w, back = Window.partitionBy(*KEYS).orderBy("us"), Window.partitionBy(*KEYS).orderBy(F.desc("us"))
    limited = S.curve_limited(c("curv_enable_flag"), c("curv_speed_limit"), c("ego_speed_mps"), 20)
    good = S.holds(c("acceleration_total") >= 0) & S.finite(c("acceleration_total")) & S.finite(c("set_speed")) & S.set_speed_stable(KEYS, "us", False) & S.holds(c("ego_speed_mps") <= c("set_speed") / S.KPH) & clear() & ~c("pedal_override_flag")
    rows = frame.select("recording_id", "us", "ego_speed_mps", "stationary_flag", "moving_flag", "in_control", good.alias("good"), limited.alias("limited"))
    rows = rows.withColumn("ends", ~S.holds(F.lead("good").over(w)) | S.holds(c("ego_speed_mps") >= 8) | ~c("in_control") | c("limited"))
    after = F.last(F.when(c("ends"), c("us")), True).over(back.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("next_good", S.holds(F.lead("good").over(w))).withColumn("was_still", S.holds(F.lag("stationary_flag").over(w))).withColumn("after", after)
    starts = rows.where("was_still and moving_flag and in_control and good and not limited").select("recording_id", c("us").alias("start_us"), F.when(c("next_good"), c("after")).otherwise(c("us")).alias("end_us"))
    long = starts.where(c("end_us") - c("start_us") >= 5 * SECOND)
    peak = samples_in(frame.select("recording_id", "us", "ego_speed_mps"), long).groupBy("recording_id", "start_us", "end_us").agg(F.max("ego_speed_mps").alias("peak"))
    return merged(peak.where(c("peak") >= 10 / S.KPH))


def follow_stop(frame: DataFrame, powertrain: str = "PHEV") -> DataFrame:
    """Approaching one target (under 30 s or 80 m) from over 2 m/s until both stand, 5 s or more."""
    c = F.col
    target = (c("front_valid") | c("cutin_valid")) & S.holds(c("front_target_id") != 0)
    near = S.holds(c("min_ttc") < 30) | S.holds(F.coalesce("front_range", F.lit(S.INF)) < 80)
    rows = G.mark_islands(frame, c("in_control") & target & near, KEYS, ["us"], "episode", "front_target_id")
    back = Window.partitionBy(*KEYS, "episode").orderBy(F.desc("us"))
    still = c("stationary_flag") & S.holds(F.abs("front_velocity_abs") <= 0.2)
    rows = rows.withColumn("stop", F.last(F.when(still, c("us")), True).over(back))
    mask = c("episode").isNotNull() & c("moving_flag")
    runs = _runs(rows, mask, None, "front_target_id", [F.min_by("ego_speed_mps", "us").alias("v0"), F.max_by("stop", "us").alias("stop")])
    return merged(runs.where((c("v0") > 2) & (c("stop") - c("start_us") >= 5 * SECOND)).select("recording_id", "start_us", c("stop").alias("end_us")))


def follow_start(frame: DataFrame, powertrain: str = "PHEV", least: float | None = None, ego_must_start: bool = False) -> DataFrame:
    """Standing behind a target that starts (0.2 to over 0.5 m/s within 1 s): from there until the vehicle moves, at most
    8 s; an override ends it before, or discards it (``least`` seconds unless the vehicle moved, or ``ego_must_start``)."""
    c = F.col
    rows = G.mark_islands(frame, c("stationary_flag") & c("in_control") & c("front_valid") & S.finite(c("front_velocity_abs")), KEYS, ["us"], "wait")
    w = Window.partitionBy(*KEYS, "wait").orderBy("us").rowsBetween(Window.unboundedPreceding, -1)
    low, high = F.when(c("front_velocity_abs") <= 0.2, c("us")), F.when(c("front_velocity_abs") > 0.5, c("us"))
    rows = rows.withColumn("low", F.last(low, True).over(w)).withColumn("high", F.last(high, True).over(w))
    fresh = c("wait").isNotNull() & (c("front_velocity_abs") > 0.5) & (c("us") - c("low") <= SECOND) & (c("high").isNull() | (c("high") < c("low")))
    starts = rows.where(fresh).select("recording_id", c("us").alias("start_us"), (c("us") + 8 * SECOND).alias("end_us"))
    samples = frame.select("recording_id", "us", "ego_speed_mps", "pedal_override_flag", F.lag("us").over(Window.partitionBy(*KEYS).orderBy("us")).alias("before"))
    seen = samples_in(samples, starts).groupBy("recording_id", "start_us").agg(F.min(F.when(c("ego_speed_mps") > 0.2, c("us"))).alias("go"), F.max("us").alias("last"), F.min(F.when(c("pedal_override_flag"), F.struct("us", "before"))).alias("over"))
    seen = seen.withColumn("end_us", F.coalesce("go", "last")).withColumn("cut", S.holds(c("over.us") <= c("end_us"))).withColumn("moved", S.holds(c("go") < c("over.us")))
    drop = F.lit(False)
    if ego_must_start:
        drop = c("cut") & ~c("moved")
    elif least is not None:
        drop = c("cut") & ~c("moved") & (c("over.us") - c("start_us") < least * SECOND)
    ended = seen.where(~drop).withColumn("end_us", F.when(c("cut"), c("over.before")).otherwise(c("end_us")))
    return merged(ended.where("end_us >= start_us").select("recording_id", "start_us", "end_us"))


def slope_samples(frame: DataFrame) -> DataFrame:
    """What the machine of the slope scene reads: recording_id, us, on, v and target (m/s)."""
    c = F.col
    mask = c("in_control") & c("moving_flag") & S.holds(F.abs("slope_acc") >= 0.1) & clear(50, 20) & S.holds(c("curv_speed_limit") >= c("ego_speed_mps")) & S.finite(c("ego_speed_mps")) & S.finite(c("set_speed")) & S.holds(c("set_speed") > 0)
    return frame.select("recording_id", "us", mask.alias("on"), c("ego_speed_mps").alias("v"), (c("set_speed") / S.KPH).alias("target"))


def slope_candidates(frame: DataFrame, powertrain: str = "PHEV") -> DataFrame:
    """``slope_no_front`` with candidate_us, the first sample of the stretch at this set speed in which it lies."""
    band = S.by_powertrain(powertrain, 0.6, 0.3)
    machine = M.steady_band("on", "v", "target", band, SECOND, 2 * SECOND, 5 * SECOND, "us", 0)
    return M.scan(slope_samples(frame), KEYS, ["us"], ["us", "on", "v", "target"], machine, "start_us long, end_us long, candidate_us long")


def slope_no_front(frame: DataFrame, powertrain: str = "PHEV") -> DataFrame:
    """On a slope at the set speed, no target within 50 m or 20 s."""
    return _segments(slope_candidates(frame, powertrain))


SCENES = {"curvature": curvature, "stop2go": stop2go, "follow_stop": follow_stop, "follow_start": follow_start, "slope_no_front": slope_no_front}
