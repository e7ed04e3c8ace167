"""Column expressions of the domain: validity, predicates, display speed, derived fields."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

INF = float("inf")
G = 9.80665
KPH = 3.6
#: Display speed: bias by speed, linear between these points, the end values beyond them.
DISPLAY_SPEED = (0.0, 40.0, 80.0, 120.0, 200.0, 300.0)
DISPLAY_BIAS = (1.0, 1.075, 1.052, 1.045, 1.039, 1.036)
ODOMETER_ROLLOVER = 67_108_864.0


def clean(value: Column) -> Column:
    """NaN is an invalid sample: null. Infinities stay; they say "no target" or "no limit"."""
    return F.when(~F.isnan(value), value)


def finite(value: Column) -> Column:
    return F.coalesce(~F.isnan(value) & (F.abs(value) < INF), F.lit(False))


def holds(condition: Column) -> Column:
    """A condition with unknown as false."""
    return F.coalesce(condition, F.lit(False))


def valid(value: Column, validity: Column | None) -> Column:
    """The value where its validity signal is 0; all of it without one."""
    return value if validity is None else F.when(F.abs(validity) <= 1e-8, value)


def close(a: Column, b: float) -> Column:
    return holds(F.abs(a - b) <= 1e-8 + 1e-5 * abs(b))


def truthy(value: Column) -> Column:
    """Numbers other than 0, NaN among them; texts other than ``""``, 0, false, none, nan."""
    text = F.lower(F.trim(value.cast("string")))
    number = value.try_cast("double")
    return F.when(number.isNotNull() & (text != "nan"), number != 0).otherwise(F.coalesce(~text.isin("", "0", "0.0", "false", "none", "nan"), F.lit(False)))


def nan_truthy(value: Column) -> Column:
    """Numeric truth: anything but 0; an invalid sample (NaN) counts as true, null as false."""
    return holds(F.isnan(value) | (value != 0))


def enum_in(value: Column, codes: list[int], labels: list[str] = ()) -> Column:
    """Membership by whole number, else by label, whatever its case."""
    text = F.lower(F.trim(value.cast("string")))
    return holds(text.try_cast("double").cast("int").isin(codes)) | holds(text.isin([x.lower() for x in labels] + [str(c) for c in codes]))


def either_flag(a: Column, b: Column) -> Column:
    """OR of two flags, each valid only as 0 or 1; null where neither is."""
    x, y = (F.when(v.isin(0.0, 1.0), v) for v in (a, b))
    return F.greatest(x, y)


def display_speed(speed: Column) -> Column:
    """The whole km/h that a dashboard shows, not below 0: speed times bias, the bias rounded half up to 3 places."""
    x = F.greatest(speed, F.lit(0.0))
    bias = F.lit(DISPLAY_BIAS[-1])
    for k in range(len(DISPLAY_SPEED) - 2, -1, -1):
        x0, x1, y0, y1 = DISPLAY_SPEED[k], DISPLAY_SPEED[k + 1], DISPLAY_BIAS[k], DISPLAY_BIAS[k + 1]
        bias = F.when(x <= x1, y0 + (x - x0) * (y1 - y0) / (x1 - x0)).otherwise(bias)
    return F.round(x * F.round(bias, 3), 0)


def front_clear(valid_target: Column, distance: Column, ttc: Column, far: float = 30.0, late: float = 20.0) -> Column:
    """No target, or one that is farther and later than the limits, both strictly."""
    return ~holds(valid_target) | (finite(distance) & holds(distance > far) & holds((ttc > late) & ~F.isnan(ttc)))


def effective_ttc(front: Column, cutin: Column) -> Column:
    """The smaller finite time to collision, else infinity."""
    return F.least(*(F.when(finite(x), x).otherwise(F.lit(INF)) for x in (front, cutin)))


def curve_limited(enabled: Column, limit: Column, speed: Column, margin_kph: float) -> Column:
    return holds(enabled) & finite(limit) & holds(limit < speed + margin_kph / KPH)


def non_straight(signal: Column, map_turn: Column, u_turn: Column) -> Column:
    """A turn signal, a turn on the map, or a U-turn; unknown sources say nothing."""
    return holds(signal.isin(1, 2)) | holds(map_turn.isin(1, 2)) | holds(u_turn)


def within(value: Column, low: float | None, high: float | None) -> Column:
    parts = ([value >= low] if low is not None else []) + ([value <= high] if high is not None else [])
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def by_powertrain(powertrain: str, ice: float, other: float) -> float:
    kind = {"PHEV/BEV": "PHEV"}.get(powertrain.upper(), powertrain.upper())
    if kind not in ("ICE", "PHEV", "BEV", "EREV"):
        raise ValueError(f"unknown powertrain {powertrain!r}")
    return ice if kind == "ICE" else other


def distance_km(samples: DataFrame, keys: list[str], time: str, odometer: str, scale: float = 1.0) -> DataFrame:
    """keys, distance_km, distance_status: last less first valid reading, over one roll-over; null under two readings."""
    good = samples.where(finite(F.col(odometer)))
    ends = good.groupBy(*keys).agg(F.min_by(odometer, time).alias("a"), F.max_by(odometer, time).alias("b"), F.count("*").alias("n"))
    d = F.when(F.col("b") >= F.col("a"), F.col("b") - F.col("a")).otherwise(F.col("b") - F.col("a") + ODOMETER_ROLLOVER)
    found = samples.select(*keys).distinct().join(ends, keys, "left").withColumn("d", F.when(F.col("n") >= 2, d))
    state = F.when(F.coalesce("n", F.lit(0)) < 2, "insufficient samples").when(F.col("d") < 0, "negative distance").otherwise("ok")
    return found.select(*keys, F.when(F.col("d") >= 0, F.col("d") * scale).alias("distance_km"), state.alias("distance_status"))


def derive(frame: DataFrame) -> DataFrame:
    """Derived fields of a wide frame. Raw fields that are absent are taken as never valid.

    Front targets without a signal become "none": id 0, infinite range, the speed of the vehicle itself.
    """
    have = set(frame.columns)
    for name in ("acceleration", "ego_speed", "stationary_state", "slope_deg", "front_target_id", "front_range", "front_velocity_abs", "flt1_cutin_flag", "acc_active", "pedal_override", "curv_enable", "curv_speed_limit", "left_lane_c2", "right_lane_c2", "set_speed"):
        frame = frame.withColumn(name, clean(F.col(name).cast("double")) if name in have else F.lit(None).cast("double"))
    c = F.col
    frame = frame.withColumns({"ego_speed_mps": c("ego_speed") / KPH, "slope_acc": G * F.sin(F.radians("slope_deg")), "acceleration_total": c("acceleration")})
    frame = frame.withColumn("stationary_flag", holds(c("ego_speed_mps") < 0.01) | close(c("stationary_state"), 1)).withColumn("moving_flag", ~c("stationary_flag"))
    frame = frame.withColumns({"acc_active_flag": nan_truthy(c("acc_active")), "pedal_override_flag": nan_truthy(c("pedal_override")), "curv_enable_flag": nan_truthy(c("curv_enable"))})
    target = holds(c("front_target_id") != 0) & finite(c("front_range")) & holds(c("front_range") > 0)
    frame = frame.withColumns({"front_valid": target & close(F.coalesce("flt1_cutin_flag", F.lit(0.0)), 0), "cutin_valid": target & close(c("flt1_cutin_flag"), 1)})
    closing = c("ego_speed_mps") - c("front_velocity_abs")
    ttc = lambda flag: F.when(c(flag) & holds(closing > 1e-6), c("front_range") / closing).otherwise(F.lit(INF))
    frame = frame.withColumns({"front_closing_speed": closing, "front_ttc": ttc("front_valid"), "cutin_ttc": ttc("cutin_valid")})
    bend = F.coalesce(F.abs(c("left_lane_c2") + c("right_lane_c2")), F.lit(0.0))
    frame = frame.withColumn("curvature", bend).withColumn("curvature_radius", F.when(bend > 1e-9, 1 / bend).otherwise(F.lit(INF)))
    return frame.withColumns({"curv_speed_limit": F.coalesce("curv_speed_limit", F.lit(INF)), "in_control": c("acc_active_flag") & ~c("pedal_override_flag"), "min_ttc": effective_ttc(c("front_ttc"), c("cutin_ttc"))})


def set_speed_stable(keys: list[str], time: str, first: bool) -> Column:
    """The set speed is that of the sample before (to 1e-6); what the first sample counts as differs by profile."""
    before = F.lag("set_speed").over(Window.partitionBy(*keys).orderBy(time))
    start = F.row_number().over(Window.partitionBy(*keys).orderBy(time)) == 1
    return F.when(start, F.lit(first)).otherwise(holds(F.abs(F.col("set_speed") - before) <= 1e-6))
