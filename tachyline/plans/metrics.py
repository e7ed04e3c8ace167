"""Case metrics (scene, measure, bounds) and incident metrics, as a registry of specifications.

``evaluate`` runs any number of metrics: each scene is found once, joined with its samples once, and all measures of
its metrics are aggregated in that one pass; their cases are then judged against the bounds of the powertrain.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import scalars as S
from ..operators import automata as M, segments as G, windows as W
from ..operators.kpi import rollup, severity_outside
from . import torque as T
from .scenes import CELL, KEYS, SCENES, SECOND, follow_start, samples_in, slope_candidates

c = F.col


@dataclass(frozen=True)
class CaseMetric:
    name: str
    scene: str
    measure: str
    low: tuple[float | None, float | None] = (None, None)  # ICE, other
    high: tuple[float | None, float | None] = (None, None)
    base: float = 1.0
    bad_when_missing: bool = False


def _both(x: float | None) -> tuple[float | None, float | None]:
    return (x, x)


CASES: dict[str, CaseMetric] = {
    m.name: m
    for m in (
        CaseMetric("curvature_min_acc", "curvature", "min_acc", _both(-2.5), base=2),
        CaseMetric("curvature_min_jerk", "curvature", "min_jerk", _both(-2.5)),
        CaseMetric("curvature_min_speed", "curvature", "curvature_min_speed", base=5),
        CaseMetric("follow_start_jerk", "follow_start_ego", "max_jerk", high=_both(2.0)),
        CaseMetric("follow_start_latency", "follow_start_latency", "start_latency", high=(3.5, 3.0), base=3, bad_when_missing=True),
        CaseMetric("follow_stop_max_acc", "follow_stop", "min_acc_dynamic", base=2),
        CaseMetric("follow_stop_min_frntobj_dis", "follow_stop", "stop_front_distance", (2.5, 3.0), (4.5, 4.0), 2),
        CaseMetric("follow_stop_min_jerk", "follow_stop", "min_jerk", (-2.6, -2.3)),
        CaseMetric("follow_stop_min_ttc_frntobj_dec", "follow_stop", "min_ttc", _both(1.5)),
        CaseMetric("follow_stop_ttc", "follow_stop", "ttc_at_ego_decel", _both(3.5), base=2),
        CaseMetric("slope_no_frnt_acc", "slope_no_front", "max_abs_acc", high=_both(1.0)),
        CaseMetric("slope_no_frnt_jerk", "slope_no_front", "max_abs_jerk", high=_both(1.5), base=1.5),
        CaseMetric("slope_no_frnt_vel_fluct", "slope_no_front", "velocity_fluct", high=(0.6, 0.3), base=2),
        CaseMetric("stop2go_max_acc", "stop2go", "max_acc", _both(1.0), _both(3.0), 2),
        CaseMetric("stop2go_max_acc_time", "stop2go", "max_acc_time", high=(4.5, 4.0), base=2),
        CaseMetric("stop2go_max_jerk", "stop2go", "max_jerk", high=(4.5, 4.0)),
        CaseMetric("stop2go_start_time", "stop2go", "start_time", _both(1.0), (3.5, 3.2), 2, True),
    )
}


def _extreme(value: Column, largest: bool, shown: Column | None = None) -> Column:
    """(value, us) of the first extreme sample, invalid ones left out."""
    key = F.when(value.isNotNull() & ~F.isnan(value), F.struct((-value if largest else value).alias("k"), c("us"), (value if shown is None else shown).alias("v")))
    return F.min(key)


#: Measures: aggregates over a segment's samples; each gives (k, us, v) or a number.
AGGREGATES: dict[str, Callable[[], Column]] = {
    "min_jerk": lambda: _extreme(c("jerk"), False),
    "max_jerk": lambda: _extreme(c("jerk"), True),
    "max_abs_jerk": lambda: _extreme(F.abs("jerk"), True),
    "min_acc": lambda: _extreme(c("acceleration_total"), False),
    "max_acc": lambda: _extreme(c("acceleration_total"), True),
    "max_abs_acc": lambda: _extreme(F.abs("acceleration_total"), True),
    "min_ttc": lambda: _extreme(c("min_ttc"), False),
    "min_front_distance": lambda: _extreme(c("front_range"), False),
    "first_build": lambda: F.min(F.when(c("acceleration_total") > 0.2, c("us"))),
    "first_speed": lambda: F.min(F.when(c("ego_speed_mps") >= 3.33, c("us"))),
    "first_move": lambda: F.min(F.when(c("ego_speed_mps") > 0.2, c("us"))),
    "first_decel": lambda: F.min(F.when(c("acceleration_total") <= -0.5, F.struct("us", "min_ttc"))),
    "start_speed": lambda: F.min_by("ego_speed_mps", "us"),
    "speed_span": lambda: F.max("ego_speed_mps") - F.min("ego_speed_mps"),
    "min_radius": lambda: F.min(F.when(c("curvature_radius") < S.INF, c("curvature_radius"))),
    "slowest": lambda: F.min(F.when(c("ego_speed_mps").isNotNull(), F.struct("ego_speed_mps", "us", "set_speed"))),
}
_NEEDS = {"min_acc_dynamic": ("min_acc", "start_speed"), "max_acc_time": ("first_build",), "start_time": ("first_speed",), "ttc_at_ego_decel": ("first_decel",), "velocity_fluct": ("speed_span",), "start_latency": ("first_move",), "curvature_min_speed": ("slowest", "min_radius"), "stop_front_distance": ()}
_SINCE_START = {"start_time": "first_speed", "start_latency": "first_move"}


def _value(measure: str) -> tuple[Column, Column]:
    """(value, time in us) from the aggregates of a segment."""
    none = F.lit(None).cast("long")
    if measure in _SINCE_START:
        at = c(_SINCE_START[measure])
        return (at - c("start_us")) / SECOND, at
    if measure == "min_acc_dynamic":
        return F.when(c("start_speed").isNotNull(), c("min_acc.v")), c("min_acc.us")
    if measure == "max_acc_time":
        return (c("build_peak") - c("first_build")) / SECOND, c("build_peak")
    if measure == "ttc_at_ego_decel":
        return c("first_decel.min_ttc"), c("first_decel.us")
    if measure == "velocity_fluct":
        return c("speed_span") / 2, none
    if measure == "curvature_min_speed":
        return c("slowest.ego_speed_mps"), c("slowest.us")
    if measure == "stop_front_distance":
        return c("stop_distance"), c("end_us") + 2 * SECOND
    return c(f"{measure}.v"), c(f"{measure}.us")


def stop_distance(frame: DataFrame, segments: DataFrame) -> DataFrame:
    """Per segment the median distance 1 to 2 s after its end, and why there is none: the first reason that holds."""
    spans = segments.select("recording_id", c("end_us").alias("start_us"), (c("end_us") + 2 * SECOND).alias("end_us"), c("start_us").alias("scene_us"))
    w = Window.partitionBy(*KEYS).orderBy("us")
    rows = frame.withColumn("gap", c("us") - F.lag("us").over(w)).withColumn("last_us", F.max("us").over(Window.partitionBy(*KEYS)))
    target = (c("front_valid") | c("cutin_valid")) & S.holds(c("front_target_id") != 0)
    found = samples_in(rows, spans).groupBy("recording_id", "scene_us", "start_us", "end_us").agg(
        F.max("last_us").alias("last_us"), F.max(F.when(c("us") > c("start_us"), c("gap"))).alias("gap"), F.bool_and("stationary_flag").alias("still"), F.bool_and("in_control").alias("control"), F.bool_and(target).alias("target"),
        F.count_distinct("front_target_id").alias("targets"), F.bool_and(S.finite(c("front_velocity_abs"))).alias("known"), F.max(F.abs("front_velocity_abs")).alias("fastest"), F.bool_and(S.finite(c("front_range")) & S.holds(c("front_range") > 0)).alias("distance_ok"),
        F.count_if(c("us") >= c("start_us") + SECOND).alias("n"), F.median(F.when(c("us") >= c("start_us") + SECOND, c("front_range"))).alias("median"),
    )
    reason = (
        F.when(c("last_us") < c("end_us"), "short").when(c("gap") > 200_000, "gap").when(~c("still"), "moved").when(~c("control"), "control lost").when(~c("target"), "target lost")
        .when(c("targets") > 1, "target changed").when(~c("known"), "target speed unknown").when(c("fastest") > 0.2, "target moves").when(~c("distance_ok"), "distance unknown").when(c("n") < 3, "few samples")
    )
    return found.select("recording_id", c("scene_us").alias("start_us"), c("start_us").alias("end_us"), F.when(reason.isNull(), c("median")).alias("stop_distance"), reason.alias("excluded"))


def with_jerk(frame: DataFrame) -> DataFrame:
    return W.jerk(frame, "acceleration_total", KEYS, "us")


def _all(segments: DataFrame, begins: str = "start_us") -> DataFrame:
    return segments


def find_scene(frame: DataFrame, scene: str, powertrain: str, owned: Callable[..., DataFrame] = _all) -> DataFrame:
    """Segments of a scene; ``owned`` picks those that count, by the time in column ``begins``."""
    if scene == "follow_start_ego":
        return owned(follow_start(frame, powertrain, ego_must_start=True))
    if scene == "follow_start_latency":
        return owned(follow_start(frame, powertrain, least=S.by_powertrain(powertrain, 3.5, 3.0)))
    if scene == "slope_no_front":
        return owned(slope_candidates(frame, powertrain), "candidate_us").drop("candidate_us")
    return owned(SCENES[scene](frame, powertrain))


def measure(frame: DataFrame, segments: DataFrame, measures: Iterable[str]) -> DataFrame:
    """``segments`` with the aggregates that ``measures`` need, in one pass over their samples."""
    measures = list(measures)
    names = list(dict.fromkeys(a for m in measures for a in _NEEDS.get(m, (m,))))
    inside = samples_in(frame, segments)
    if "max_acc_time" in measures:
        first = F.min(F.when(c("acceleration_total") > 0.2, c("us"))).over(Window.partitionBy("recording_id", "start_us", "end_us"))
        inside = inside.withColumn("__first", first)
    aggs = [AGGREGATES[n]().alias(n) for n in names]
    if "max_acc_time" in measures:
        late = F.when(c("us") >= c("__first"), c("acceleration_total"))
        aggs.append(_extreme(late, True)["us"].alias("build_peak"))
    out = inside.groupBy("recording_id", "start_us", "end_us").agg(F.count("*").alias("n_samples"), *aggs)
    if "stop_front_distance" in measures:
        out = out.join(stop_distance(frame, segments), ["recording_id", "start_us", "end_us"], "left")
    return out


def judge(spec: CaseMetric, measured: DataFrame, powertrain: str) -> DataFrame:
    """Cases of one metric: metric, recording_id, start_us, end_us, value, at_us, bad, severity."""
    k = 0 if powertrain.upper() == "ICE" else 1
    value, at = _value(spec.measure)
    low, high = spec.low[k], spec.high[k]
    if spec.measure == "min_acc_dynamic":
        low = F.greatest(F.least(-c("start_speed") / 5.5, F.lit(-1.75)), F.lit(-4.0)) - 1
    rows = measured.withColumn("value", value).withColumn("at_us", at)
    if spec.measure == "curvature_min_speed":
        root = F.sqrt("min_radius")
        upper = F.sqrt(2.9 * c("min_radius")) + 2
        severity = severity_outside(c("value"), root - 2, upper, spec.base)
        severity = F.when(S.holds(c("slowest.set_speed") / S.KPH > root), severity).otherwise(F.when(c("value").isNotNull(), 0.0))
    else:
        severity = severity_outside(c("value"), low, high, spec.base)
    missing = F.lit(100.0) if spec.bad_when_missing else F.lit(None).cast("double")
    rows = rows.withColumn("severity", F.coalesce(severity, missing))
    if spec.measure == "stop_front_distance":
        rows = rows.where("value is not null")
    return rows.select(F.lit(spec.name).alias("metric"), "recording_id", "start_us", "end_us", "value", "at_us", (F.coalesce("severity", F.lit(0.0)) > 0).alias("bad"), F.coalesce("severity", F.lit(0.0)).alias("severity"))


def evaluate(frame: DataFrame, powertrain: str = "PHEV", metrics: Iterable[str] | None = None, owned: Callable[..., DataFrame] = _all) -> DataFrame:
    """Cases of the case metrics asked for (all by default) over a prepared frame, in scenes that ``owned`` picks."""
    specs = [CASES[m] for m in (metrics or CASES)]
    rows, out = with_jerk(frame), []
    for scene in dict.fromkeys(s.scene for s in specs):
        own = [s for s in specs if s.scene == scene]
        measured = measure(rows, find_scene(rows, scene, powertrain, owned), [s.measure for s in own])
        out += [judge(s, measured, powertrain) for s in own]
    return reduce(DataFrame.unionByName, out)


# Incidents (counted by mileage). Each gives recording_id, start_us, end_us, severity.


def _events(runs: DataFrame, severity: Column | None = None) -> DataFrame:
    own = (c("end_us") - c("start_us")) / SECOND if severity is None else severity
    return runs.select("recording_id", "start_us", "end_us", F.round(own, 3).alias("severity"))


def _runs(frame: DataFrame, mask: Column, least: float = 0.0, aggs=()) -> DataFrame:
    return G.islands(frame, mask, KEYS, ["us"], "us", least * SECOND, aggs=aggs).withColumnsRenamed({"start_t": "start_us", "end_t": "end_us"})


def lost_arbitration(frame: DataFrame, powertrain: str = "PHEV") -> DataFrame:
    return _events(_runs(frame, c("in_control") & S.enum_in(c("acc_request_state"), [2], ["lost arbitration"]), 5))


def rollback(frame: DataFrame, powertrain: str = "PHEV", every_wheel: bool = False) -> DataFrame:
    """All wheels in reverse, one (or every) turning, held, in gear, at most 0.5 m/s, for 0.2 s."""
    wheels = ("lf", "rf", "lr", "rr")
    reverse = reduce(lambda a, b: a & b, (S.enum_in(c(f"wheel_dir_{w}"), [4], ["reverse"]) for w in wheels))
    turns = [S.holds(c(f"wheel_speed_{w}") >= 0.01) for w in wheels]
    moving = reduce((lambda a, b: a & b) if every_wheel else (lambda a, b: a | b), turns)
    mask = reverse & moving & S.enum_in(c("brake_request_type"), [5], ["hold"]) & S.enum_in(c("gear"), [12]) & S.holds(c("ego_speed_mps") <= 0.5)
    return _events(_runs(frame, mask, 0.2))


def activation(flag: str) -> Callable[..., DataFrame]:
    def find(frame: DataFrame, powertrain: str = "PHEV") -> DataFrame:
        return _events(_runs(frame, S.holds(c(flag) == 1)))

    return find


def set_speed_not_reached(frame: DataFrame, powertrain: str = "PHEV") -> DataFrame:
    """Near the set speed (1.5 km/h as displayed), no target, set speed constant, for 8 s with a span of 2 at most."""
    shown = S.display_speed(c("ego_speed"))
    rows = frame.withColumn("shown", shown).withColumn("near", c("in_control") & S.holds(F.abs(c("set_speed") - c("shown")) <= 1.5) & ~c("front_valid") & ~c("cutin_valid"))
    runs = G.islands(rows, "near", KEYS, ["us"], "us", 8 * SECOND, "set_speed", [F.max("shown").alias("most"), F.min("shown").alias("least"), F.max("set_speed").alias("wanted")])
    runs = runs.where("most - least <= 2").withColumnsRenamed({"start_t": "start_us", "end_t": "end_us"})
    return _events(runs, F.greatest(c("wanted") - c("most"), F.lit(0.0)))


def steady_speeds(frame: DataFrame, owned: Callable[..., DataFrame] = _all) -> DataFrame:
    """Stretches of 8 s in control with a clear road, a displayed speed that spans less than 1.5 from 5 up, and a constant set
    speed: recording_id, start_us, end_us, deficit (of the fastest sample to the set speed, as displayed)."""
    shown, wanted, limit = S.display_speed(c("ego_speed")), S.display_speed(c("set_speed")), c("curv_speed_limit")
    free = ~c("curv_enable_flag") | ~S.finite(limit) | S.holds(S.display_speed(limit) >= wanted)
    base = c("in_control") & ~c("front_valid") & ~c("cutin_valid") & free & S.finite(c("ego_speed")) & S.finite(c("set_speed")) & S.holds(wanted >= 1)
    rows = frame.select("recording_id", "us", F.when(base, shown).alias("v"), wanted.alias("wanted"))
    found = M.scan(rows, KEYS, ["us"], ["us", "v", "wanted"], M.stable_or_slide("v", 1.5, 8 * SECOND, "us", "wanted", 0.1), "start_us long, end_us long, n long")
    one = samples_in(rows, owned(found)).groupBy("recording_id", "start_us", "end_us").agg(F.min("v").alias("least"), F.max("v").alias("most"), F.median("wanted").alias("wanted"))
    return one.where("least >= 5").select("recording_id", "start_us", "end_us", (c("wanted") - c("most")).alias("deficit"))


def low_speed(frame: DataFrame, powertrain: str = "PHEV", owned: Callable[..., DataFrame] = _all) -> DataFrame:
    """Of the ``steady_speeds`` those 8 km/h or more under the set speed."""
    return _events(steady_speeds(frame, owned).where("deficit >= 8"), c("deficit"))


def heavy_braking(frame: DataFrame, powertrain: str = "PHEV") -> DataFrame:
    """Smoothed acceleration under -2 (gaps of 0.5 s in control filled) for 0.2 s, that from a second before to its end spans 3
    in control and has a jerk of -3."""
    rows = W.time_mean(with_jerk(frame), "acceleration_total", 300_000, KEYS, "us", "smooth")
    rows = G.fill_short_gaps(rows, c("in_control") & (c("smooth") < -2), SECOND // 2, KEYS, ["us"], "us", "in_control")
    runs = _runs(rows, c("filled"), 0.2, [F.min("smooth").alias("least")]).select("recording_id", c("start_us").alias("s"), c("end_us").alias("e"), "least", (c("start_us") - SECOND).alias("start_us"), c("end_us"))
    valid = F.when(c("in_control"), c("smooth"))
    one = samples_in(rows.select("recording_id", "us", "smooth", "jerk", "in_control"), runs).groupBy("recording_id", "s", "e", "least").agg((F.max(valid) - F.min(valid)).alias("fall"), F.min("jerk").alias("jerk"))
    found = one.where("fall >= 3 and -jerk >= 3").withColumnsRenamed({"s": "start_us", "e": "end_us"})
    return _events(found, 50 * F.greatest(-c("least") - 2, F.lit(0.0)) + 25 * F.greatest(c("fall") - 3, F.lit(0.0)) + 10 * F.greatest(-c("jerk") - 3, F.lit(0.0)))


INCIDENTS: dict[str, Callable[..., DataFrame]] = {
    "acc_lost_arbitration": lost_arbitration,
    "acc_rollback_count": rollback,
    "tcs_activation_count": activation("tcs_active"),
    "vse_activation_count": activation("vse_active"),
    "acc_set_speed_reach": set_speed_not_reached,
    "acc_unreasonable_low_speed_count": low_speed,
    "acc_heavy_braking_count": heavy_braking,
    "acc_torque_jerkiness_count": T.torque_jerkiness,
    "acc_jerkiness_after_override_release": T.jerkiness_after_release,
    "acc_start_no_override_jerkiness": T.jerkiness_after_activation,
    "acc_override_brake_request_jerkiness": T.jerkiness_in_override,
    "acc_brake_tap_count": T.brake_tap,
    "acc_heavy_braking_after_override_release_count": T.braking_after_release,
}
#: Fields that an incident metric reads besides the derived ones.
TORQUES = ["actual_drive_torque", "actual_brake_torque"]
INCIDENT_FIELDS = {"acc_lost_arbitration": ["acc_request_state"], "acc_rollback_count": ["brake_request_type", "gear", *(f"wheel_{k}_{w}" for k in ("dir", "speed") for w in ("lf", "rf", "lr", "rr"))], "tcs_activation_count": ["tcs_active"], "vse_activation_count": ["vse_active"], "acc_torque_jerkiness_count": TORQUES, "acc_jerkiness_after_override_release": TORQUES, "acc_start_no_override_jerkiness": TORQUES, "acc_override_brake_request_jerkiness": ["accelerator_pedal_pos", *TORQUES], "acc_heavy_braking_after_override_release_count": TORQUES, "acc_brake_tap_count": ["control_brake_request_torque", "actual_brake_torque"]}


def incidents(frame: DataFrame, powertrain: str = "PHEV", metrics: Iterable[str] | None = None) -> DataFrame:
    """metric, recording_id, start_us, end_us, severity of the metrics whose fields the frame has."""
    have = set(frame.columns)
    names = [m for m in (metrics or INCIDENTS) if set(INCIDENT_FIELDS.get(m, ())) <= have]
    return reduce(DataFrame.unionByName, (INCIDENTS[m](frame, powertrain).select(F.lit(m).alias("metric"), "*") for m in names))


def summary(frame: DataFrame, cases: DataFrame, found: DataFrame, odometer: str = "odometer") -> DataFrame:
    """Per metric total, bad, km and rate, from cases and incidents and each recording's distance."""
    km = S.distance_km(frame, KEYS, "us", odometer)
    one = cases.groupBy("metric", "recording_id").agg(F.count("*").alias("total"), F.count_if("bad").alias("bad")).unionByName(found.groupBy("metric", "recording_id").agg(F.count("*").alias("total"), F.count("*").alias("bad")))
    rows = one.join(km, "recording_id").select("metric", c("recording_id").alias("source_path"), "distance_km", "total", "bad", F.when(c("bad") > 0, "BAD").otherwise("OK").alias("status"))
    return rollup(rows)


__all__ = ["CASES", "CELL", "INCIDENTS", "evaluate", "incidents", "summary"]
