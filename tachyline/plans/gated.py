"""Incidents on bus signals that count only where the planner says that its function is on.

The planner's state nearest to each sample, within 300 ms, switches the bus signal off where it is off. A recording with a
sample that no state is near to, or with contradicting states of one time, can't be judged and is left out whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import scalars as S
from ..operators import alignment as A, segments as G
from .scenes import KEYS, SECOND

c = F.col
TOLERANCE = 300_000


def gated(frame: DataFrame, states: DataFrame) -> DataFrame:
    """``frame`` with acc_active_flag and in_control held against ``states`` (recording_id, us, np_on)."""
    at = states.groupBy(*KEYS, "us").agg(F.min("np_on").alias("np_on"), (F.count_distinct("np_on") > 1).alias("torn"))
    torn = at.where("torn").select(*KEYS).distinct()
    rows = A.gate(frame, at.select(*KEYS, "us", "np_on"), KEYS, "us", "np_on", TOLERANCE).join(torn, KEYS, "left_anti")
    rows = rows.withColumn("acc_active_flag", c("acc_active_flag") & c("np_on"))
    return rows.withColumn("in_control", c("acc_active_flag") & ~c("pedal_override_flag"))


def lost_arbitration(frame: DataFrame) -> DataFrame:
    """Lost arbitration in control for 5 s: recording_id, start_us, end_us, severity (seconds)."""
    runs = G.islands(frame, c("in_control") & S.enum_in(c("acc_request_state"), [2], ["lost arbitration"]), KEYS, ["us"], "us", 5 * SECOND)
    return runs.select(*KEYS, c("start_t").alias("start_us"), c("end_t").alias("end_us"), F.round(c("duration") / SECOND, 3).alias("severity"))


def rollback(frame: DataFrame) -> DataFrame:
    """All wheels in reverse and turning, held, in gear, under 0.5 km/h, in control for 0.2 s: severity is the wheels' mean speed."""
    wheels = ("lf", "rf", "lr", "rr")
    mask = c("in_control") & S.enum_in(c("brake_request_type"), [5], ["hold"]) & S.enum_in(c("gear"), [12], ["cvt forward gear", "forward gear", "drive"]) & S.holds(c("ego_speed") < 0.5)
    for w in wheels:
        mask = mask & S.enum_in(c(f"wheel_dir_{w}"), [4], ["reverse"]) & S.holds(F.abs(f"wheel_speed_{w}") > 0.01)
    mean = F.avg(sum(F.abs(f"wheel_speed_{w}") for w in wheels) / 4)
    runs = G.islands(frame, mask, KEYS, ["us"], "us", SECOND // 5, aggs=[mean.alias("speed")])
    return runs.select(*KEYS, c("start_t").alias("start_us"), c("end_t").alias("end_us"), F.round("speed", 3).alias("severity"))


def set_speed_reach(frame: DataFrame, frames: DataFrame) -> DataFrame:
    """Near the set speed (1.5 km/h, both as displayed) on a road that the planner's frame nearest by, and its objects, within 300 ms, show clear: for 8 s, with a span
    of 2 km/h at most and one set speed. recording_id, start_us, end_us, bad (never reached), severity (km/h that are missing)."""
    from .planner import candidates

    seen = candidates(frames).select(*KEYS, "us", "clear", "objects_us")
    rows = A.asof(frame, seen, KEYS, "us", ["clear", "objects_us"], "nearest", TOLERANCE)
    shown, wanted = S.display_speed(c("ego_speed")), S.display_speed(c("set_speed"))
    fresh = S.holds(F.abs(c("objects_us") - c("us")) <= TOLERANCE)
    rows = rows.withColumns({"shown": shown, "wanted": wanted}).withColumn("near", c("in_control") & S.holds(c("set_speed") > 0) & S.holds(c("clear")) & fresh & S.holds(F.abs(c("shown") - c("wanted")) <= 1.5))
    of = lambda f, x: getattr(F, f)(x).alias(f"{f}_{x}")
    runs = G.islands(rows, "near", KEYS, ["us"], "us", 8 * SECOND, aggs=[of("max", "shown"), of("min", "shown"), of("max", "wanted"), of("min", "wanted")])
    runs = runs.where("max_shown - min_shown <= 2 and max_wanted - min_wanted <= 1e-6")
    missing = F.greatest(c("max_wanted") - c("max_shown"), F.lit(0.0))
    return runs.select(*KEYS, c("start_t").alias("start_us"), c("end_t").alias("end_us"), (missing > 0).alias("bad"), F.round(missing, 3).alias("severity"))
