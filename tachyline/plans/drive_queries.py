"""Scenes, case metrics and incidents on drives that are made of the event table, with the SQL that gives the same rows.

Each user is a recording and each event a manoeuvre of 8 s at 10 Hz: its type says which speed the vehicle goes to, two
digits of its value which target, slope, override or disturbance there is. Both sides make the raw signals by the same
arithmetic; derived fields, scenes, measures and incidents are stated on each side in its own words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from . import folders as FD, gated as X, metrics as MT, planner as P, scenes as SC, stitched as ST, torque as T

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
POWERTRAIN = "PHEV"
#: Speed in km/h that a manoeuvre ends with.
GOAL = "CASE event_type WHEN 'view' THEN 6e1 WHEN 'click' THEN 0e0 WHEN 'error' THEN 9e1 WHEN 'purchase' THEN 3e1 ELSE 64e0 END"
DIGITS = {"q": "cast(floor(value * 10) AS bigint) % 10", "p": "cast(floor(value * 100) AS bigint) % 10", "v1": GOAL}
FIRST = {
    "acc": "CASE WHEN v0 = 0 AND k > 10 AND k <= 70 THEN v1 / 36e-1 / 6e0 WHEN v0 > 0 AND k > 38 AND k <= 78 THEN (v1 - v0) / 36e-1 / 4e0 ELSE 0e0 END"
    " + CASE WHEN (event_type = 'error' AND q >= 4 AND k BETWEEN 20 AND 36) OR (p = 0 AND q >= 6 AND k BETWEEN 12 AND 36) OR (q = 7 AND k <= 12) THEN CASE WHEN k % 8 < 4 THEN 3e-1 * q * (1 + k / 1e2) ELSE -3e-1 * q * (1 + k / 1e2) END ELSE 0e0 END"
    " + CASE WHEN p = 0 AND q < 6 AND k BETWEEN 30 AND 35 THEN -2e0 * (k - 29) - k / 1e2 ELSE 0e0 END + CASE WHEN q = 8 AND k BETWEEN 61 AND 66 THEN -8e-1 ELSE 0e0 END",
    "speed": "CASE WHEN v0 = 0 THEN v1 * (least(greatest(k - 10, 0), 60) / 6e1) ELSE v0 + (v1 - v0) * (least(greatest(k - 38, 0), 40) / 4e1) END",
}
SIGNALS = {
    "recording_id": "user_id", "us": "(j * 80 + k) * 100000", "acceleration": "acc", "ego_speed": "speed", "set_speed": "64e0 + 10 * (user_id % 4)",
    "slope_deg": "CASE WHEN user_id % 2 = 0 THEN 2e0 ELSE 0e0 END", "front_target_id": "CASE WHEN p >= 5 THEN 1 + q % 2 ELSE 0 END", "flt1_cutin_flag": "CASE WHEN p = 9 THEN 1 ELSE 0 END",
    "front_range": "CASE WHEN event_type = 'click' THEN 10 - 8e-2 * k ELSE 6e1 - 5e-1 * k END",
    "front_velocity_abs": "CASE WHEN v0 = 0 AND v1 > 0 THEN least(greatest(k - 3, 0) * 3e-1, 2e1) ELSE greatest(speed / 36e-1 - 5e-1, 0e0) END",
    "acc_active": "CASE WHEN q = 9 THEN 0 ELSE 1 END", "pedal_override": "CASE WHEN p = 0 AND k BETWEEN 10 AND 29 THEN 1 ELSE 0 END", "accelerator_pedal_pos": "CASE WHEN p = 0 AND k BETWEEN 10 AND 29 THEN 1e1 ELSE 0e0 END",
    "curv_enable": "CASE WHEN q BETWEEN 1 AND 2 THEN 1 ELSE 0 END", "curv_speed_limit": "CASE WHEN q = 2 THEN 5e0 ELSE 2e2 END", "left_lane_c2": "CASE WHEN q = 1 THEN 3e-3 + k / 1e5 ELSE 0e0 END", "right_lane_c2": "CASE WHEN q = 1 THEN 2e-3 ELSE 0e0 END",
    "acc_request_state": "CASE WHEN q = 3 AND k > 20 THEN 2 ELSE 1 END", "brake_request_type": "CASE WHEN k > 55 THEN 5 ELSE 0 END", "gear": "12", "tcs_active": "CASE WHEN q = 6 AND k BETWEEN 5 AND 9 THEN 1 ELSE 0 END", "vse_active": "CASE WHEN q = 7 AND k % 40 = 3 THEN 1 ELSE 0 END",
    **{f"wheel_dir_{w}": "CASE WHEN q = 4 AND k BETWEEN 60 AND 70 THEN 4 ELSE 1 END" for w in ("lf", "rf", "lr", "rr")}, **{f"wheel_speed_{w}": f"CASE WHEN k > {60 + i} THEN 2e-2 ELSE 0e0 END" for i, w in enumerate(("lf", "rf", "lr", "rr"))},
    "actual_drive_torque": "1e2 + 12e1 * greatest(acc, 0e0)", "actual_brake_torque": "15e1 * greatest(-acc, 0e0)", "red_light": "CASE WHEN event_type = 'click' AND p < 5 AND q <> 3 AND k NOT BETWEEN 50 AND 55 THEN 1 ELSE 0 END", "stop_distance": "1e0 + q * 5e-1 + greatest(78 - k, 0) * 15e-1", "lead_id": "CASE WHEN p = 9 THEN 99 WHEN p >= 7 THEN 1 + q % 2 ELSE -1 END", "digit": "q",
    "turning": "CASE WHEN q = 6 AND k BETWEEN 40 AND 60 THEN 1 WHEN q = 2 AND k BETWEEN 5 AND 25 THEN 1 WHEN q % 4 = 0 AND p % 3 = 0 AND k < 8 THEN 1 ELSE 0 END",
    "control_brake_request_torque": "CASE WHEN q = 8 AND k BETWEEN 60 AND 65 THEN 4e2 ELSE 0e0 END",
}


def drives(spark, sf_dir: str) -> DataFrame:
    """The frame of all users' drives, with derived fields."""
    order = "(PARTITION BY user_id ORDER BY ts, event_id)"
    # Each event becomes 80 samples, which the size of the shuffled events doesn't show: the number of parts is told, and all windows of a recording keep them.
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").repartition(parts, "user_id").selectExpr("user_id", "event_type", f"cast(row_number() OVER {order} - 1 AS bigint) AS j", *(f"{x} AS {n}" for n, x in DIGITS.items()))
    rows = rows.selectExpr("*", "coalesce(lag(v1) OVER (PARTITION BY user_id ORDER BY j), 0e0) AS v0").withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(79))))
    rows = rows.selectExpr("*", *(f"{x} AS {n}" for n, x in FIRST.items())).selectExpr(*(f"{x} AS {n}" for n, x in SIGNALS.items()))
    return SC.S.derive(rows.withColumn("us", F.col("us").cast("long")))


FRAME = f"""WITH RECURSIVE e AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS j, {', '.join(f'{x} AS {n}' for n, x in DIGITS.items())} FROM events),
s0 AS (SELECT *, coalesce(lag(v1) OVER (PARTITION BY user_id ORDER BY j), 0e0) AS v0 FROM e),
s1 AS (SELECT *, unnest(range(80)) AS k FROM s0),
s2 AS (SELECT *, {', '.join(f'{x} AS {n}' for n, x in FIRST.items())} FROM s1),
raw AS (SELECT {', '.join(f'{x} AS {n}' for n, x in SIGNALS.items())} FROM s2),
d0 AS (SELECT *, ego_speed / 3.6e0 AS mps, ego_speed / 3.6e0 < 0.01 AS still, acc_active <> 0 AND pedal_override = 0 AS ctl, pedal_override <> 0 AS ovr, acc_active <> 0 AS act, curv_enable <> 0 AS curv,
  front_target_id <> 0 AND front_range > 0 AS tgt, ego_speed / 3.6e0 - front_velocity_abs AS closing, abs(left_lane_c2 + right_lane_c2) AS bend FROM raw),
d1 AS (SELECT *, tgt AND flt1_cutin_flag = 0 AS front, tgt AND flt1_cutin_flag = 1 AS cutin, CASE WHEN tgt AND closing > 1e-6 THEN front_range / closing ELSE 'inf'::DOUBLE END AS ttc FROM d0),
f AS (SELECT *, (NOT front OR (front_range > 30 AND ttc > 20)) AND (NOT cutin OR (front_range > 30 AND ttc > 20)) AS clear, floor(greatest(ego_speed, 0) * (floor(1000 * {{bias_ego}} + 0.5) / 1000) + 0.5) AS shown FROM d1)"""


def _bias(x: str) -> str:
    points, bias = (0, 40, 80, 120, 200, 300), (1.0, 1.075, 1.052, 1.045, 1.039, 1.036)
    arms = " ".join(f"WHEN {x} <= {b} THEN {ya}e0 + ({x} - {a}) * {yb - ya:.4f}e0 / {b - a}" for a, b, ya, yb in zip(points, points[1:], bias, bias[1:]))
    return f"(CASE {arms} ELSE 1.036e0 END)"


FRAME = FRAME.replace("{bias_ego}", _bias("ego_speed"))


def runs(source: str, mask: str, aggs: str = "", keys: str = "recording_id", split: str = "") -> str:
    """SQL of the runs of ``mask``: keys, a, b and ``aggs``."""
    other = f" OR {split} IS DISTINCT FROM lag({split}) OVER w" if split else ""
    marked = f"SELECT *, coalesce({mask}, false) AS m FROM {source}"
    begun = f"SELECT *, m AND (NOT coalesce(lag(m) OVER w, false){other}) AS fresh FROM ({marked}) WINDOW w AS (PARTITION BY {keys} ORDER BY us)"
    placed = f"SELECT *, sum(CASE WHEN fresh THEN 1 ELSE 0 END) OVER (PARTITION BY {keys} ORDER BY us) AS g FROM ({begun})"
    return f"SELECT {keys}, min(us) AS a, max(us) AS b{', ' + aggs if aggs else ''} FROM ({placed}) WHERE m GROUP BY {keys}, g"


def unions(source: str) -> str:
    """SQL of the unions of segments (recording_id, a, b) that touch."""
    return f"""SELECT recording_id, min(a) AS start_us, max(b) AS end_us FROM (SELECT *, sum(CASE WHEN a <= before THEN 0 ELSE 1 END) OVER (PARTITION BY recording_id ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS u
FROM (SELECT *, max(b) OVER (PARTITION BY recording_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM {source})) GROUP BY recording_id, u"""


def _follow_start(drop: str) -> str:
    return f""", w AS (SELECT *, CASE WHEN m THEN sum(CASE WHEN m AND NOT coalesce(pm, false) THEN 1 ELSE 0 END) OVER (PARTITION BY recording_id ORDER BY us) END AS wait FROM (SELECT *, still AND ctl AND front AS m, lag(still AND ctl AND front) OVER (PARTITION BY recording_id ORDER BY us) AS pm FROM f)),
x AS (SELECT *, max(CASE WHEN front_velocity_abs <= 0.2 THEN us END) OVER h AS low, max(CASE WHEN front_velocity_abs > 0.5 THEN us END) OVER h AS high FROM w WHERE wait IS NOT NULL WINDOW h AS (PARTITION BY recording_id, wait ORDER BY us ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
y AS (SELECT recording_id, us AS a FROM x WHERE front_velocity_abs > 0.5 AND us - low <= 1000000 AND (high IS NULL OR high < low)),
n AS (SELECT recording_id, us, mps, ovr, lag(us) OVER (PARTITION BY recording_id ORDER BY us) AS before FROM f),
z AS (SELECT y.recording_id, a, min(CASE WHEN mps > 0.2 THEN us END) AS go, max(us) AS last, min(CASE WHEN ovr THEN us END) AS over_us, min_by(before, us) FILTER (ovr) AS over_before FROM y JOIN n ON n.recording_id = y.recording_id AND us BETWEEN a AND a + 8000000 GROUP BY ALL),
t AS (SELECT recording_id, a, CASE WHEN cut THEN over_before ELSE coalesce(go, last) END AS b FROM (SELECT *, coalesce(over_us <= coalesce(go, last), false) AS cut, coalesce(go < over_us, false) AS moved FROM z) WHERE NOT ({drop})),
g AS ({unions("(SELECT * FROM t WHERE b >= a)")})"""


#: SQL of the scenes after FRAME, as table g (recording_id, start_us, end_us).
SCENE_SQL = {
    "curvature": f""", g AS (SELECT recording_id, a AS start_us, b AS end_us FROM ({runs("f", "ctl AND curv AND NOT still AND mps >= 10 / 3.6e0 AND clear", "count(*) FILTER (bend > 0.004) AS bent")}) WHERE b - a >= 3000000 AND bent >= 5)""",
    "stop2go": f""", h AS (SELECT *, coalesce(acceleration >= 0 AND abs(set_speed - lag(set_speed) OVER o) <= 1e-6 AND mps <= set_speed / 3.6e0 AND clear AND NOT ovr, false) AS good, curv AND curv_speed_limit < mps + 20 / 3.6e0 AS limited, lag(still) OVER o AS was FROM f WINDOW o AS (PARTITION BY recording_id ORDER BY us)),
i AS (SELECT *, coalesce(lead(good) OVER (PARTITION BY recording_id ORDER BY us), false) AS next_good FROM h),
l AS (SELECT *, min(CASE WHEN NOT next_good OR mps >= 8 OR NOT ctl OR limited THEN us END) OVER (PARTITION BY recording_id ORDER BY us ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS after FROM i),
m AS (SELECT recording_id, us AS a, CASE WHEN next_good THEN after ELSE us END AS b FROM l WHERE was AND NOT still AND ctl AND good AND NOT limited),
n AS (SELECT m.recording_id, a, b FROM m JOIN f ON f.recording_id = m.recording_id AND us BETWEEN a AND b WHERE b - a >= 5000000 GROUP BY ALL HAVING max(mps) >= 10 / 3.6e0),
g AS ({unions("n")})""",
    "follow_stop": f""", h AS (SELECT *, sum(CASE WHEN m AND (NOT coalesce(pm, false) OR pid IS DISTINCT FROM front_target_id) THEN 1 ELSE 0 END) OVER (PARTITION BY recording_id ORDER BY us) AS ep FROM (SELECT *, lag(m) OVER o AS pm, lag(front_target_id) OVER o AS pid FROM (SELECT *, ctl AND tgt AND (ttc < 30 OR front_range < 80) AS m FROM f) WINDOW o AS (PARTITION BY recording_id ORDER BY us))),
i AS (SELECT *, CASE WHEN m THEN min(CASE WHEN still AND abs(front_velocity_abs) <= 0.2 THEN us END) OVER (PARTITION BY recording_id, CASE WHEN m THEN ep END ORDER BY us ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) END AS stop FROM h),
k AS ({runs("(SELECT recording_id, us, mps, still, front_target_id, stop, m AS inside FROM i)", "inside AND NOT still", "min_by(mps, us) AS v0, max_by(stop, us) AS stop", split="front_target_id")}),
g AS ({unions("(SELECT recording_id, a, stop AS b FROM k WHERE v0 > 2 AND stop - a >= 5000000)")})""",
    "follow_start": _follow_start("false"),
    "follow_start_ego": _follow_start("cut AND NOT moved"),
    "follow_start_latency": _follow_start("cut AND NOT moved AND over_us - a < 3000000"),
}


def _chains(source: str, mask: str, split: str = "") -> str:
    """SQL of the rows of ``mask`` with the number g of their run and their place i in it."""
    other = f" OR {split} IS DISTINCT FROM lag({split}) OVER w" if split else ""
    return f"""SELECT *, row_number() OVER (PARTITION BY recording_id, g ORDER BY us) AS i FROM (SELECT *, sum(CASE WHEN m AND (NOT coalesce(pm, false){' OR fresh' if split else ''}) THEN 1 ELSE 0 END) OVER (PARTITION BY recording_id ORDER BY us) AS g
FROM (SELECT *, lag(m) OVER w AS pm{', ' + other[4:] + ' AS fresh' if split else ''} FROM (SELECT *, coalesce({mask}, false) AS m FROM {source}) WINDOW w AS (PARTITION BY recording_id ORDER BY us))) WHERE m"""


SCENE_SQL["slope_no_front"] = f""", on0 AS ({_chains("f", "ctl AND NOT still AND abs(9.80665e0 * sin(radians(slope_deg))) >= 0.1 AND (NOT front OR (front_range > 50 AND ttc > 20)) AND (NOT cutin OR (front_range > 50 AND ttc > 20)) AND curv_speed_limit >= mps AND set_speed > 0", "set_speed")}),
on1 AS (SELECT recording_id, g, i, us, abs(mps - set_speed / 3.6e0) <= 0.3 + 1e-9 AS inside, count(*) OVER (PARTITION BY recording_id, g) AS size FROM on0),
st AS (SELECT recording_id, g, 0::BIGINT AS i, NULL::BIGINT AS since, NULL::BIGINT AS start_, NULL::BIGINT AS away, NULL::BIGINT AS before_, NULL::BIGINT AS last, NULL::BIGINT AS oa, NULL::BIGINT AS ob, NULL::BIGINT AS cand, true AS was_cut FROM on1 WHERE i = 1
UNION ALL SELECT recording_id, g, i + 1, CASE WHEN cut THEN NULL WHEN start_ IS NULL THEN CASE WHEN inside THEN coalesce(since, us) END ELSE since END, CASE WHEN cut THEN NULL WHEN start_ IS NULL AND inside AND us - coalesce(since, us) >= 1000000 THEN us ELSE start_ END,
  CASE WHEN cut OR inside OR start_ IS NULL THEN NULL ELSE coalesce(away, us) END, CASE WHEN start_ IS NOT NULL AND NOT inside AND away IS NULL THEN last ELSE before_ END, us, CASE WHEN cut AND before_ - start_ >= 5000000 THEN start_ END, CASE WHEN cut THEN before_ END,
  CASE WHEN was_cut THEN us ELSE cand END, cut
  FROM (SELECT st.*, n.us, n.inside, start_ IS NOT NULL AND NOT n.inside AND away IS NOT NULL AND n.us - away >= 2000000 AS cut FROM st JOIN on1 n ON n.recording_id = st.recording_id AND n.g = st.g AND n.i = st.i + 1)),
g AS (SELECT recording_id, oa AS start_us, ob AS end_us, cand FROM st WHERE oa IS NOT NULL UNION ALL SELECT recording_id, start_, CASE WHEN away IS NULL THEN last ELSE before_ END, cand FROM st JOIN (SELECT recording_id, g, max(i) AS i FROM on1 GROUP BY ALL) USING (recording_id, g, i) WHERE start_ IS NOT NULL AND CASE WHEN away IS NULL THEN last ELSE before_ END - start_ >= 5000000)"""


def _register(name: str, run, sql: str | None) -> None:
    QUERIES[name] = run
    if sql:
        ORACLE[name] = sql


for _scene in ("curvature", "stop2go", "follow_stop", "follow_start", "slope_no_front"):
    _register(f"scene_{_scene}", lambda spark, sf_dir, scene=_scene: SC.SCENES[scene](drives(spark, sf_dir), POWERTRAIN).select("recording_id", "start_us", "end_us"), FRAME + SCENE_SQL[_scene] + " SELECT recording_id, start_us, end_us FROM g" if _scene in SCENE_SQL else None)

MEAN = "avg({}) OVER (PARTITION BY recording_id ORDER BY us RANGE BETWEEN {h} PRECEDING AND {h} FOLLOWING)"
JERK = f""", sm AS (SELECT *, min(us) OVER (PARTITION BY recording_id) AS o, {MEAN.format("acceleration", h=150000)} AS smooth FROM f),
jf AS (SELECT *, CASE WHEN count(*) OVER w >= 3 AND max(us) OVER w - min(us) OVER w >= 150000 THEN regr_slope(smooth, (us - o) / 1e6) OVER w END AS jerk FROM sm WINDOW w AS (PARTITION BY recording_id ORDER BY us RANGE BETWEEN 150000 PRECEDING AND 150000 FOLLOWING))"""
#: Measure -> (value, time) over the samples of a segment; z is the segment's sample.
VALUE_SQL = {
    "min_jerk": ("min(jerk)", "min(us) FILTER (jerk = mn)", "min(jerk)"),
    "max_jerk": ("max(jerk)", "min(us) FILTER (jerk = mn)", "max(jerk)"),
    "min_acc": ("min(acceleration)", "min(us) FILTER (acceleration = mn)", "min(acceleration)"),
    "max_acc": ("max(acceleration)", "min(us) FILTER (acceleration = mn)", "max(acceleration)"),
    "max_abs_acc": ("max(abs(acceleration))", "min(us) FILTER (abs(acceleration) = mn)", "max(abs(acceleration))"),
    "max_abs_jerk": ("max(abs(jerk))", "min(us) FILTER (abs(jerk) = mn)", "max(abs(jerk))"),
    "velocity_fluct": ("(max(mps) - min(mps)) / 2", "NULL::BIGINT", "1"),
    "min_ttc": ("min(ttc)", "min(us) FILTER (ttc = mn)", "min(ttc)"),
    "min_acc_dynamic": ("min(acceleration)", "min(us) FILTER (acceleration = mn)", "min(acceleration)"),
    "max_acc_time": ("(min(us) FILTER (acceleration = mn AND us >= bu) - min(bu)) / 1e6", "min(us) FILTER (acceleration = mn AND us >= bu)", "max(CASE WHEN us >= bu THEN acceleration END)"),
    "start_time": ("(min(us) FILTER (mps >= 3.33) - start_us) / 1e6", "min(us) FILTER (mps >= 3.33)", "1"),
    "start_latency": ("(min(us) FILTER (mps > 0.2) - start_us) / 1e6", "min(us) FILTER (mps > 0.2)", "1"),
    "ttc_at_ego_decel": ("min_by(ttc, us) FILTER (acceleration <= -0.5)", "min(us) FILTER (acceleration <= -0.5)", "1"),
    "curvature_min_speed": ("min(mps)", "min(us) FILTER (mps = mn)", "min(mps)"),
}


def _out(value: str, low: str | None, high: str | None, base: float) -> str:
    parts = [f"greatest(0, ({low}) - {value})" if low else "0", f"greatest(0, {value} - ({high}))" if high else "0"]
    return f"round(greatest({parts[0]}, {parts[1]}) / {base} * 100, 3)"


def _case_sql(spec: MT.CaseMetric, frame: str = FRAME, scenes: str = "g") -> str | None:
    """SQL of a case metric over the scenes in table ``scenes``."""
    if spec.scene not in SCENE_SQL or spec.measure not in VALUE_SQL:
        return None
    value, at, mark = VALUE_SQL[spec.measure]
    low, high = (None if x[1] is None else str(x[1]) for x in (spec.low, spec.high))
    severity = _out("value", low, high, spec.base)
    if spec.measure == "min_acc_dynamic":
        severity = _out("value", "greatest(least(-v0 / 5.5, -1.75), -4.0) - 1", None, spec.base)
    if spec.measure == "curvature_min_speed":
        severity = f"CASE WHEN wanted / 3.6e0 > sqrt(radius) THEN {_out('value', 'sqrt(radius) - 2', 'sqrt(2.9 * radius) + 2', spec.base)} ELSE 0 END"
    missing = 100 if spec.bad_when_missing else 0
    return frame + JERK + SCENE_SQL[spec.scene] + (OWN_SQL.format(begins=_BEGINS.get(spec.scene, "start_us")) if scenes == "own" else "") + f""",
z0 AS (SELECT jf.*, start_us, end_us, min(CASE WHEN acceleration > 0.2 THEN us END) OVER (PARTITION BY g.recording_id, start_us) AS bu FROM {scenes} g JOIN jf ON jf.recording_id = g.recording_id AND us BETWEEN start_us AND end_us),
z1 AS (SELECT z0.*, mn FROM z0 JOIN (SELECT recording_id, start_us, {mark} AS mn FROM z0 GROUP BY ALL) USING (recording_id, start_us)),
z2 AS (SELECT recording_id, start_us, end_us, {value} AS value, {at} AS at_us, min_by(mps, us) AS v0, min(1 / bend) FILTER (bend > 1e-9) AS radius, min_by(set_speed, us) FILTER (mps = mn) AS wanted FROM z1 GROUP BY recording_id, start_us, end_us),
z3 AS (SELECT *, coalesce({severity}, {missing}) AS severity FROM z2)
SELECT '{spec.name}' AS metric, recording_id, start_us, end_us, round(value, 6) AS value, at_us, severity > 0 AS bad, severity FROM z3"""


#: The scenes that a recording owns, in the SQL of stitched recordings.
_BEGINS = {"slope_no_front": "cand"}
OWN_SQL = """,
own AS (
  SELECT g.*
  FROM g
  JOIN owners ON owners.recording_id = g.recording_id
  WHERE {begins} <= last_us
    AND NOT (has_previous AND {begins} = first_us))"""


def _case(name: str):
    def run(spark, sf_dir):
        return MT.evaluate(drives(spark, sf_dir), POWERTRAIN, [name]).withColumn("value", F.round("value", 6))

    return run


for _spec in MT.CASES.values():
    _register(f"case_{_spec.name}", _case(_spec.name), _case_sql(_spec))

STOP_SQL = (
    FRAME
    + SCENE_SQL["follow_stop"]
    + """, q AS (SELECT *, us - lag(us) OVER (PARTITION BY recording_id ORDER BY us) AS gap, max(us) OVER (PARTITION BY recording_id) AS last_us FROM f),
z AS (SELECT g.recording_id, start_us, end_us, max(last_us) AS last_us, max(gap) FILTER (us > end_us) AS gap, bool_and(still) AS still, bool_and(ctl) AS ctl, bool_and(tgt) AS tgt, count(DISTINCT front_target_id) AS ids, max(abs(front_velocity_abs)) AS fast, bool_and(front_range > 0) AS known,
  count(*) FILTER (us >= end_us + 1000000) AS n, median(front_range) FILTER (us >= end_us + 1000000) AS value FROM g JOIN q ON q.recording_id = g.recording_id AND us BETWEEN end_us AND end_us + 2000000 GROUP BY ALL)
SELECT 'follow_stop_min_frntobj_dis' AS metric, recording_id, start_us, end_us, round(value, 6) AS value, end_us + 2000000 AS at_us, severity > 0 AS bad, severity
FROM (SELECT *, """
    + _out("value", "3.0", "4.0", 2)
    + """ AS severity FROM z WHERE last_us >= end_us + 2000000 AND coalesce(gap, 0) <= 200000 AND still AND ctl AND tgt AND ids <= 1 AND fast <= 0.2 AND known AND n >= 3)"""
)
ORACLE["case_follow_stop_min_frntobj_dis"] = STOP_SQL
_SPAN = "recording_id, a AS start_us, b AS end_us, round((b - a) / 1e6, 3) AS severity"
INCIDENT_SQL = {
    "acc_lost_arbitration": FRAME + f" SELECT {_SPAN} FROM ({runs('f', 'ctl AND acc_request_state = 2')}) WHERE b - a >= 5000000",
    "acc_rollback_count": FRAME + f" SELECT {_SPAN} FROM ({runs('f', 'least(wheel_dir_lf, wheel_dir_rf, wheel_dir_lr, wheel_dir_rr) = 4 AND greatest(wheel_dir_lf, wheel_dir_rf, wheel_dir_lr, wheel_dir_rr) = 4 AND greatest(wheel_speed_lf, wheel_speed_rf, wheel_speed_lr, wheel_speed_rr) >= 0.01 AND brake_request_type = 5 AND gear = 12 AND mps <= 0.5')}) WHERE b - a >= 200000",
    "tcs_activation_count": FRAME + f" SELECT {_SPAN} FROM ({runs('f', 'tcs_active = 1')})",
    "vse_activation_count": FRAME + f" SELECT {_SPAN} FROM ({runs('f', 'vse_active = 1')})",
    "acc_set_speed_reach": FRAME + f" SELECT recording_id, a AS start_us, b AS end_us, round(greatest(wanted - most, 0), 3) AS severity FROM ({runs('f', 'ctl AND abs(set_speed - shown) <= 1.5 AND NOT front AND NOT cutin', 'max(shown) AS most, min(shown) AS least_, max(set_speed) AS wanted', split='set_speed')}) WHERE b - a >= 8000000 AND most - least_ <= 2",
    "acc_heavy_braking_count": FRAME
    + JERK
    + f""", fl AS (SELECT *, ctl AND smooth < -2 AS m, last_value(CASE WHEN ctl AND smooth < -2 THEN us END IGNORE NULLS) OVER (PARTITION BY recording_id ORDER BY us) AS l, sum(CASE WHEN ctl AND smooth < -2 THEN 1 ELSE 0 END) OVER (PARTITION BY recording_id ORDER BY us) AS n,
  first_value(CASE WHEN ctl AND smooth < -2 THEN us END IGNORE NULLS) OVER (PARTITION BY recording_id ORDER BY us ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS r FROM jf),
fi AS (SELECT recording_id, us, smooth, jerk, ctl, m OR coalesce(r - l <= 500000 AND sum(CASE WHEN NOT m AND NOT ctl THEN 1 ELSE 0 END) OVER (PARTITION BY recording_id, n) = 0, false) AS filled FROM fl),
ru AS (SELECT * FROM ({runs('fi', 'filled', 'min(smooth) AS low')}) WHERE b - a >= 200000),
z AS (SELECT ru.recording_id, a, b, low, max(smooth) FILTER (ctl) - min(smooth) FILTER (ctl) AS fall, min(jerk) AS jerk FROM ru JOIN fi ON fi.recording_id = ru.recording_id AND us BETWEEN a - 1000000 AND b GROUP BY ru.recording_id, a, b, low)
SELECT recording_id, a AS start_us, b AS end_us, round(50 * greatest(-low - 2, 0) + 25 * greatest(fall - 3, 0) + 10 * greatest(-jerk - 3, 0), 3) AS severity FROM z WHERE fall >= 3 AND -jerk >= 3""",
}
TORQUE = (
    FRAME
    + JERK
    + f""", t0 AS (SELECT *, {MEAN.format("acceleration", h=60000)} - {MEAN.format("acceleration", h=400000)} AS high, {MEAN.format("actual_drive_torque", h=40000)} AS drive, {MEAN.format("actual_brake_torque", h=40000)} AS brake, lag(ovr) OVER o AS was_ovr, lag(act) OVER o AS was_act, lag(us) OVER o AS pus FROM jf WINDOW o AS (PARTITION BY recording_id ORDER BY us)),
t1 AS (SELECT *, coalesce((drive - lag(drive) OVER o) / ((us - pus) / 1e6), (lead(drive) OVER o - drive) / ((lead(us) OVER o - us) / 1e6)) AS drate, coalesce((brake - lag(brake) OVER o) / ((us - pus) / 1e6), (lead(brake) OVER o - brake) / ((lead(us) OVER o - us) / 1e6)) AS brate,
  coalesce(us - last_value(CASE WHEN was_ovr AND NOT ovr THEN us END IGNORE NULLS) OVER o <= 2000000, false) AS after_release, coalesce(us - last_value(CASE WHEN act AND NOT coalesce(was_act, true) THEN us END IGNORE NULLS) OVER o <= 1000000, false) AS after_start FROM t0 WINDOW o AS (PARTITION BY recording_id ORDER BY us)),
tj AS ({{base}}),
jb AS (SELECT *, round(amp / 0.75 * 50 + flips * 30 + (b - a) / 1e6 * 20, 3) AS base FROM tj WHERE b - a > 500000 AND b - a <= 2000000 AND amp >= 0.75 AND flips >= 1),
near0 AS (SELECT jb.recording_id, a, b, base, w, us, high, jerk, drive, brake, drate, brate, us BETWEEN a - 350000 AND b + 350000 AS inside FROM jb JOIN t1 ON t1.recording_id = jb.recording_id AND us BETWEEN a - 550000 AND b + 550000),
near1 AS (SELECT *, jerk >= coalesce(lag(jerk) OVER p, jerk) AND jerk >= coalesce(lead(jerk) OVER p, jerk) AS top, jerk <= coalesce(lag(jerk) OVER p, jerk) AND jerk <= coalesce(lead(jerk) OVER p, jerk) AS low, drate >= coalesce(lag(drate) OVER p, drate) AND drate >= coalesce(lead(drate) OVER p, drate) AS dtop, brate >= coalesce(lag(brate) OVER p, brate) AND brate >= coalesce(lead(brate) OVER p, brate) AS btop
  FROM near0 WHERE inside AND jerk IS NOT NULL WINDOW p AS (PARTITION BY recording_id, w, a ORDER BY us)),
st AS (SELECT recording_id, w, a, b, base, quantile_cont(abs(jerk), 0.95) AS p95, sqrt(avg(high * high)) AS rms, max(abs(high)) AS peak, count(*) AS n FROM near1 GROUP BY ALL),
sr AS (SELECT recording_id, w, a, max(drive) - min(drive) AS dr, max(brake) - min(brake) AS br FROM near0 WHERE inside GROUP BY ALL),
up AS (SELECT * FROM (SELECT x.recording_id, x.w, x.a, x.us AS ju, y.us AS ru, y.drate AS rate, row_number() OVER (PARTITION BY x.recording_id, x.w, x.a ORDER BY x.jerk DESC, y.drate DESC, abs(x.us - y.us), x.us, y.us) AS k FROM near1 x JOIN near1 y ON x.recording_id = y.recording_id AND x.w = y.w AND x.a = y.a AND abs(x.us - y.us) <= 180000 WHERE x.top AND x.jerk >= 9 AND y.dtop AND y.drate >= 1500) WHERE k = 1),
dn AS (SELECT * FROM (SELECT x.recording_id, x.w, x.a, x.us AS ju, y.us AS ru, y.brate AS rate, row_number() OVER (PARTITION BY x.recording_id, x.w, x.a ORDER BY x.jerk, y.brate DESC, abs(x.us - y.us), x.us, y.us) AS k FROM near1 x JOIN near1 y ON x.recording_id = y.recording_id AND x.w = y.w AND x.a = y.a AND abs(x.us - y.us) <= 180000 WHERE x.low AND x.jerk <= -4 AND y.btop AND y.brate >= 2500) WHERE k = 1),
ok AS (SELECT st.recording_id, st.w, st.a, least(up.ju, up.ru, dn.ju, dn.ru) - 200000 AS lo, greatest(up.ju, up.ru, dn.ju, dn.ru) + 200000 AS hi, round(base + p95 * 20 + peak * 120 + up.rate / 200 + dn.rate / 200, 3) AS severity
  FROM st JOIN sr USING (recording_id, w, a) JOIN up USING (recording_id, w, a) JOIN dn USING (recording_id, w, a) WHERE n >= 6 AND dr >= 80 AND br >= 120 AND p95 >= 3.5 AND rms >= 0.1 AND peak >= 0.4),
ev AS (SELECT ok.recording_id, ok.w, min(us) AS start_us, max(us) AS end_us, severity FROM ok JOIN near0 n ON n.recording_id = ok.recording_id AND n.w = ok.w AND n.a = ok.a AND us BETWEEN lo AND hi GROUP BY ok.recording_id, ok.w, ok.a, severity)
"""
)
_FLIPS = "max(smooth) - min(smooth) AS amp, count(*) FILTER (flip) AS flips"


def _base(mask: str, source: str = "t1") -> str:
    """Runs of jerk over 0.8 either way; a change of sign counts between neighbours, which are of one run then."""
    flips = f"(SELECT *, coalesce(({mask}) AND abs(jerk) > 0.8 AND abs(pj) > 0.8 AND pm AND sign(jerk) <> sign(pj), false) AS flip FROM (SELECT *, lag(jerk) OVER o AS pj, lag({mask}) OVER o AS pm FROM {source} WINDOW o AS (PARTITION BY recording_id, w ORDER BY us)))"
    return runs(flips, f"({mask}) AND abs(jerk) > 0.8", _FLIPS, "recording_id, w")


_ALL = "(SELECT *, 0 AS w FROM t1)"
INCIDENT_SQL["acc_torque_jerkiness_count"] = TORQUE.replace("{base}", _base("ctl AND ego_speed > 0 AND NOT after_release AND NOT after_start", _ALL)) + " SELECT recording_id, start_us, end_us, severity FROM ev WHERE NOT EXISTS (SELECT 1 FROM t1 WHERE t1.recording_id = ev.recording_id AND us BETWEEN start_us AND end_us AND (ovr OR after_release OR after_start))"
INCIDENT_SQL["acc_start_no_override_jerkiness"] = TORQUE.replace("{base}", _base("ctl AND ego_speed > 0 AND after_start", _ALL)) + " SELECT recording_id, start_us, end_us, severity FROM ev"
INCIDENT_SQL["acc_override_brake_request_jerkiness"] = TORQUE.replace("{base}", _base("act AND ovr AND accelerator_pedal_pos > 0 AND ego_speed > 0", _ALL)) + " SELECT recording_id, start_us, end_us, severity FROM ev"
WINDOWS = """(SELECT r.recording_id, r.us AS w, max(x.us) AS stop FROM t1 r JOIN t1 x ON x.recording_id = r.recording_id AND x.us BETWEEN r.us AND r.us + 2000000
  WHERE r.was_ovr AND NOT r.ovr AND r.us + 2000000 <= (SELECT max(us) FROM t1 y WHERE y.recording_id = r.recording_id) GROUP BY r.recording_id, r.us HAVING bool_and(x.act AND NOT x.ovr) AND count(*) > 1)"""
INCIDENT_SQL["acc_jerkiness_after_override_release"] = TORQUE.replace("{base}", _base("ctl AND ego_speed > 0", f"(SELECT t1.*, v.w FROM t1 JOIN {WINDOWS} v ON v.recording_id = t1.recording_id AND us BETWEEN v.w AND v.stop)")) + f" SELECT ev.recording_id, ev.w AS start_us, v.stop AS end_us, max(severity) AS severity FROM ev JOIN {WINDOWS} v ON v.recording_id = ev.recording_id AND v.w = ev.w GROUP BY ev.recording_id, ev.w, v.stop"
INCIDENT_SQL["acc_heavy_braking_after_override_release_count"] = (
    FRAME
    + """, b0 AS (SELECT recording_id, us, acceleration, ctl, actual_drive_torque AS drive, actual_brake_torque AS brake, lag(ovr) OVER o AS was, lag(us) OVER o AS pus, avg(actual_drive_torque) OVER t AS md, avg(actual_brake_torque) OVER t AS mb, sum(CASE WHEN ctl THEN 0 ELSE 1 END) OVER o AS broken
  FROM f WINDOW o AS (PARTITION BY recording_id ORDER BY us), t AS (PARTITION BY recording_id ORDER BY us RANGE BETWEEN 80000 PRECEDING AND CURRENT ROW)),
b1 AS (SELECT *, (md - lag(md) OVER o) / ((us - pus) / 1e6) AS drate, (mb - lag(mb) OVER o) / ((us - pus) / 1e6) AS brate, lag(drive) OVER o AS d0, lag(brake) OVER o AS k0 FROM b0 WINDOW o AS (PARTITION BY recording_id ORDER BY us)),
b2 AS (SELECT *, coalesce(brate >= 2500, false) AND NOT coalesce(lag(brate) OVER o >= 2500, false) AS bo, coalesce(drate <= -1500, false) AND NOT coalesce(lag(drate) OVER o <= -1500, false) AS dn FROM b1 WINDOW o AS (PARTITION BY recording_id ORDER BY us)),
re AS (SELECT recording_id, us AS release, broken AS intact FROM b2 WHERE was AND ctl),
os AS (SELECT re.*, us AS onset, bo, dn, d0, k0 FROM re JOIN b2 USING (recording_id) WHERE us BETWEEN release AND release + 200000 AND broken = intact AND ctl AND (bo OR dn) AND d0 IS NOT NULL),
n0 AS (SELECT os.*, us, acceleration, drive, brake, max(CASE WHEN us < release - 600000 THEN us END) OVER (PARTITION BY recording_id, release, onset) AS edge FROM os JOIN b2 USING (recording_id) WHERE us BETWEEN release - 1000000 AND onset + 1000000 AND (us < onset OR broken = intact)),
n1 AS (SELECT *, min(us) OVER (PARTITION BY recording_id, release, onset) AS o, avg(acceleration) OVER (PARTITION BY recording_id, release, onset ORDER BY us RANGE BETWEEN 150000 PRECEDING AND 150000 FOLLOWING) AS smooth FROM n0 WHERE us >= coalesce(edge, us)),
n2 AS (SELECT *, CASE WHEN count(*) OVER w >= 3 AND max(us) OVER w - min(us) OVER w >= 150000 THEN regr_slope(smooth, (us - o) / 1e6) OVER w END AS jerk FROM n1 WINDOW w AS (PARTITION BY recording_id, release, onset ORDER BY us RANGE BETWEEN 150000 PRECEDING AND 150000 FOLLOWING)),
n3 AS (SELECT *, coalesce(smooth < -2 AND jerk < -3, false) AS low FROM n2),
go AS (SELECT recording_id, release, onset FROM n3 GROUP BY ALL HAVING NOT coalesce(max_by(low, us) FILTER (us < release), false) AND ((bool_or(bo) AND max(brake - k0) FILTER (us >= onset) >= 120) OR (bool_or(dn) AND max(d0 - drive) FILTER (us >= onset) >= 80))),
sc AS (SELECT *, last_value(CASE WHEN low THEN us END IGNORE NULLS) OVER x AS l, first_value(CASE WHEN low THEN us END IGNORE NULLS) OVER y AS r FROM n3 JOIN go USING (recording_id, release, onset) WHERE us >= release WINDOW x AS (PARTITION BY recording_id, release, onset ORDER BY us), y AS (PARTITION BY recording_id, release, onset ORDER BY us ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
"""
    + f"""rs AS ({runs('sc', 'low OR r - l <= 500000', 'min(smooth) AS least_, min(jerk) AS jerk', 'recording_id, release, onset')})
SELECT recording_id, a AS start_us, b AS end_us, round(greatest(-least_ - 2, 0) * 50 + greatest(-jerk - 3, 0) * 25, 3) AS severity FROM (SELECT *, row_number() OVER (PARTITION BY recording_id, release ORDER BY onset, a) AS k FROM rs WHERE a <= release + 200000 AND b >= onset AND b - a >= 200000) WHERE k = 1"""
)
_FREE = f"(NOT curv OR floor(curv_speed_limit * (floor(1000 * {_bias('curv_speed_limit')} + 0.5) / 1000) + 0.5) >= wanted)"
SHOWN = f""", sh AS (SELECT *, floor(set_speed * (floor(1000 * {_bias('set_speed')} + 0.5) / 1000) + 0.5) AS wanted FROM f)"""
INCIDENT_SQL["acc_unreasonable_low_speed_count"] = (
    FRAME
    + SHOWN
    + f""", n AS ({_chains("sh", f"ctl AND NOT front AND NOT cutin AND {_FREE} AND wanted >= 1")}),
m AS (SELECT b.recording_id, b.g, b.i, max(a.i) AS far FROM n a JOIN n b ON a.recording_id = b.recording_id AND a.g = b.g AND a.i < b.i AND (abs(a.shown - b.shown) >= 1.5 OR abs(a.wanted - b.wanted) > 0.1) GROUP BY ALL),
l AS (SELECT n.*, 1 + coalesce(max(far) OVER (PARTITION BY recording_id, g ORDER BY i), 0) AS reach, lag(us) OVER (PARTITION BY recording_id, g ORDER BY i) AS pus FROM n LEFT JOIN m USING (recording_id, g, i)),
r AS (SELECT recording_id, g, i, i AS first, us AS at, NULL::BIGINT AS ended FROM l WHERE i = 1
UNION ALL SELECT recording_id, g, x.i, x.nf, y.us, x.ended FROM (SELECT l.recording_id, l.g, l.i, CASE WHEN l.reach <= r.first THEN r.first WHEN l.pus - r.at >= 8000000 THEN l.i ELSE l.reach END AS nf, CASE WHEN l.reach > r.first AND l.pus - r.at >= 8000000 THEN r.first END AS ended FROM r JOIN l ON l.recording_id = r.recording_id AND l.g = r.g AND l.i = r.i + 1) x JOIN l y USING (recording_id, g) WHERE y.i = x.nf),
o AS (SELECT recording_id, g, ended AS a, i - 1 AS b FROM r WHERE ended IS NOT NULL UNION ALL SELECT recording_id, g, max_by(first, i), max(i) FROM r GROUP BY recording_id, g)
SELECT recording_id, min(us) AS start_us, max(us) AS end_us, round(median(wanted) - max(shown), 3) AS severity FROM o JOIN n USING (recording_id, g) WHERE n.i BETWEEN a AND b GROUP BY recording_id, g, a HAVING max(us) - min(us) >= 8000000 AND min(shown) >= 5 AND median(wanted) - max(shown) >= 8"""
)


def _greedy(name: str, source: str, spans: dict[str, float]) -> str:
    """SQL of the greedy stretches of 8 s within a run in which each column spans its limit at most, as table ``name``."""
    cols = ", ".join(f"{x} AS lo{k}, {x} AS hi{k}" for k, x in enumerate(spans))
    ok = " AND ".join(f"greatest(hi{k}, n.{x}) - least(lo{k}, n.{x}) <= {limit} + 1e-9" for k, (x, limit) in enumerate(spans.items()))
    kept = ", ".join(f"CASE WHEN ok THEN least(lo{k}, {x}) ELSE {x} END, CASE WHEN ok THEN greatest(hi{k}, {x}) ELSE {x} END" for k, x in enumerate(spans))
    return f"""{name}r AS (SELECT recording_id, g, i, i AS first, {cols} FROM {source} WHERE i = 1
UNION ALL SELECT recording_id, g, ni, CASE WHEN ok THEN first ELSE ni END, {kept} FROM (SELECT r.*, n.i AS ni, {', '.join(f'n.{x}' for x in spans)}, {ok} AS ok FROM {name}r r JOIN {source} n ON n.recording_id = r.recording_id AND n.g = r.g AND n.i = r.i + 1)),
{name} AS (SELECT r.recording_id, min(us) AS a, max(us) AS b FROM {name}r r JOIN {source} n ON n.recording_id = r.recording_id AND n.g = r.g AND n.i = r.i GROUP BY r.recording_id, r.g, first HAVING max(us) - min(us) >= 8000000)"""


INCIDENT_SQL["acc_brake_tap_count"] = (
    FRAME
    + SHOWN
    + f""", na AS ({_chains("sh", f"ctl AND NOT front AND NOT cutin AND {_FREE} AND shown > 5 AND wanted >= 1")}),
nb AS ({_chains("sh", "ctl AND NOT cutin AND front AND ego_speed >= 30 AND front_range BETWEEN 5 AND 100 AND abs(mps - front_velocity_abs) <= 1.5")}),
{_greedy("sa", "na", {"shown": 2.0, "wanted": 0.1})},
{_greedy("sb", "nb", {"shown": 5.0, "front_range": 10.0, "front_velocity_abs": 4 / 3.6})},
fr AS (SELECT recording_id, us, CASE WHEN front THEN front_velocity_abs END AS fv, lead(us) OVER o AS nus, lag(us) OVER o AS pus FROM f WINDOW o AS (PARTITION BY recording_id ORDER BY us)),
ends AS (SELECT recording_id, a, b, unnest([a, b]) AS edge_ FROM sb),
calm AS (SELECT e.recording_id, a, b FROM ends e JOIN fr ON fr.recording_id = e.recording_id AND (nus > edge_ - 1000000 OR nus IS NULL) AND (pus < edge_ + 1000000 OR pus IS NULL) GROUP BY e.recording_id, a, b, edge_ HAVING min(us) <= edge_ - 1000000 AND max(us) >= edge_ + 1000000 AND count(*) >= 2 AND count(fv) = count(*) AND max(fv) - min(fv) <= 0.5 + 1e-9),
sc AS (SELECT 1 AS kind, recording_id, a AS s, b AS e FROM sa UNION ALL SELECT 2, recording_id, a, b FROM calm GROUP BY recording_id, a, b HAVING count(*) = 2),
bm AS (SELECT recording_id, us, greatest(control_brake_request_torque, actual_brake_torque, 0) AS torque, (acceleration + coalesce(lag(acceleration) OVER o, first_value(acceleration) OVER z) + coalesce(lag(acceleration, 2) OVER o, first_value(acceleration) OVER z) + coalesce(lead(acceleration) OVER o, last_value(acceleration) OVER z) + coalesce(lead(acceleration, 2) OVER o, last_value(acceleration) OVER z)) / 5 AS acc
  FROM f WINDOW o AS (PARTITION BY recording_id ORDER BY us), z AS (PARTITION BY recording_id ORDER BY us ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
b0 AS (SELECT kind, sc.recording_id, s, e, us, torque, quantile_cont(torque, 0.2) OVER (PARTITION BY kind, sc.recording_id, s) AS floor_ FROM sc JOIN bm ON bm.recording_id = sc.recording_id AND us BETWEEN s AND e),
b1 AS (SELECT *, torque > floor_ + 63 AS m, last_value(CASE WHEN torque > floor_ + 63 THEN us END IGNORE NULLS) OVER x AS l, first_value(CASE WHEN torque > floor_ + 63 THEN us END IGNORE NULLS) OVER y AS r FROM b0 WINDOW x AS (PARTITION BY kind, recording_id, s ORDER BY us), y AS (PARTITION BY kind, recording_id, s ORDER BY us ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
pu AS (SELECT * FROM ({runs('b1', 'm OR r - l <= 100000', 'max(torque) - min(floor_) AS height, min(e) AS e', 'kind, recording_id, s')}) WHERE b - a BETWEEN 80000 AND 1500000 AND height >= 180),
ar AS (SELECT pu.kind, pu.recording_id, a, b, height, median(acc) FILTER (us <= a) - min(acc) FILTER (us >= a) AS fall FROM pu JOIN bm ON bm.recording_id = pu.recording_id AND us BETWEEN greatest(s, a - 600000) AND least(e, b + 600000) GROUP BY ALL)
SELECT recording_id, a AS start_us, b AS end_us, round(height / 100 + fall * 10, 3) AS severity FROM ar WHERE fall >= 0.2"""
)


def _incident(name: str):
    def run(spark, sf_dir):
        return MT.INCIDENTS[name](drives(spark, sf_dir), POWERTRAIN).select("recording_id", "start_us", "end_us", "severity")

    return run


for _name in MT.INCIDENTS:
    _register(f"incident_{_name}", _incident(_name), INCIDENT_SQL.get(_name))


def release_windows(spark, sf_dir):
    return T.release_windows(drives(spark, sf_dir))


_register("override_release_windows", release_windows, TORQUE[: TORQUE.index("tj AS (")].rstrip().rstrip(",") + f" SELECT recording_id, w AS start_us, stop AS end_us FROM {WINDOWS}")


# Planner frames: the same drives with up to three objects in each frame.


def planner_frames(spark, sf_dir: str) -> DataFrame:
    return _as_planner(drives(spark, sf_dir))


def _as_planner(rows: DataFrame, *more) -> DataFrame:
    c = F.col
    thing = lambda i, x, y, ttc, v, a: F.struct(i.cast("long").alias("id"), x.cast("double").alias("x"), F.lit(float(y)).alias("y"), ttc.cast("double").alias("ttc"), v.cast("double").alias("velocity"), a.cast("double").alias("acceleration"), F.lit(4.5).alias("length"))
    closing = c("ego_speed_mps") - c("front_velocity_abs")
    ttc = F.when(closing > 1e-6, F.least(c("front_range") / closing, F.lit(999.0))).otherwise(999.0)
    front = F.when(c("front_target_id") != 0, thing(c("front_target_id"), c("front_range"), 0.5, ttc, c("front_velocity_abs"), F.when(c("front_range") <= 10, -0.6).otherwise(0.1)))
    second = F.when(c("digit") % 2 == 0, thing(F.lit(9), F.lit(45.0), 1.0, F.lit(50.0), F.lit(10.0), F.lit(0.0)))
    beside = thing(F.lit(8), F.lit(3.0), 3.0, F.lit(2.0), F.lit(5.0), F.lit(0.0))
    return rows.select(
        "recording_id", "us", c("us").alias("arrival"), (c("turning") == 1).alias("non_straight"), c("curvature").alias("max_curvature"), c("curv_speed_limit").alias("curve_limit"), (c("curv_enable") == 1).alias("curve_limited"), "slope_acc", c("acc_active_flag").alias("np_on"), c("pedal_override_flag").alias("override"), c("ego_speed_mps").alias("speed"), "acceleration", c("stationary_flag").alias("still"), "set_speed", (c("red_light") == 1).alias("red_light"), "stop_distance",
        c("lead_id").cast("long").alias("lead_id"), c("us").alias("objects_us"), F.lit(True).alias("primary"), F.filter(F.array(front, second, beside), lambda o: o.isNotNull()).alias("objects"), *more,
    )


PLANNER = (
    FRAME
    + JERK
    + """, ob AS (SELECT recording_id, us, front_target_id AS id, front_range AS x, 0.5 AS y, least(ttc, 999) AS ottc, CASE WHEN front_range <= 10 THEN -0.6 ELSE 0.1 END AS oacc FROM jf WHERE front_target_id <> 0
  UNION ALL SELECT recording_id, us, 9, 45, 1.0, 50, 0 FROM jf WHERE digit % 2 = 0 UNION ALL SELECT recording_id, us, 8, 3, 3.0, 2, 0 FROM jf),
lane AS (SELECT *, row_number() OVER (PARTITION BY recording_id, us ORDER BY x, id) AS k FROM ob WHERE abs(y) <= 1.5 AND x > 0),
fol AS (SELECT *, row_number() OVER (PARTITION BY recording_id, us ORDER BY x, id) AS kf FROM lane WHERE x BETWEEN 1 AND 50),
ld AS (SELECT ob.* FROM ob JOIN jf ON jf.recording_id = ob.recording_id AND jf.us = ob.us AND lead_id >= 0 AND ob.id = lead_id),
ahead AS (SELECT recording_id, us, id, x, ottc FROM lane WHERE k = 1 UNION SELECT recording_id, us, id, x, ottc FROM ld),
tg AS (SELECT recording_id, us, id, x, ottc, oacc FROM fol WHERE kf = 1 UNION SELECT recording_id, us, id, x, ottc, oacc FROM ld),
bad AS (SELECT DISTINCT recording_id, us FROM ahead WHERE NOT (x > 20 AND ottc > 8) UNION SELECT recording_id, us FROM jf WHERE lead_id >= 0 AND (recording_id, us) NOT IN (SELECT (recording_id, us) FROM ld)),
pf AS (SELECT jf.*, bad.us IS NULL AS road, row_number() OVER o AS place, coalesce(abs(set_speed - lag(set_speed) OVER o) <= 1e-6, true) AS steady FROM jf LEFT JOIN bad ON bad.recording_id = jf.recording_id AND bad.us = jf.us WINDOW o AS (PARTITION BY jf.recording_id ORDER BY jf.us))"""
)
FOLLOW = PLANNER + """, tf AS (SELECT pf.*, id, ottc, oacc, place - row_number() OVER (PARTITION BY pf.recording_id, id ORDER BY place) AS run FROM tg JOIN pf ON pf.recording_id = tg.recording_id AND pf.us = tg.us),
tm AS (SELECT *, ctl AND turning = 0 AND NOT still AND NOT (red_light = 1 AND stop_distance < 10) AS mv, coalesce(lead(still AND ctl) OVER w, false) AS stands FROM tf WINDOW w AS (PARTITION BY recording_id, id, run ORDER BY place)),
tp AS (SELECT *, sum(CASE WHEN mv AND NOT coalesce(pm, false) THEN 1 ELSE 0 END) OVER (PARTITION BY recording_id, id, run ORDER BY place) AS part FROM (SELECT *, lag(mv) OVER (PARTITION BY recording_id, id, run ORDER BY place) AS pm FROM tm)),
tb AS (SELECT *, min(CASE WHEN mps > 2 THEN place END) OVER (PARTITION BY recording_id, id, run, part) AS first FROM tp WHERE mv),
g AS (SELECT recording_id, id AS target_id, min(us) AS start_us, max(us) AS end_us FROM tb WHERE place >= first GROUP BY recording_id, id, run, part HAVING count(*) > 5 AND max_by(stands, place))"""
RED = PLANNER + """, rc AS (SELECT *, road AND ctl AND steady AND NOT still AS hold, road AND ctl AND steady AND NOT still AND red_light = 1 AND stop_distance < 150 AS core, coalesce(lead(still AND road AND red_light = 1 AND ctl) OVER (PARTITION BY recording_id ORDER BY us), false) AS stands FROM pf),
rl AS (SELECT *, sum(CASE WHEN hold THEN 0 ELSE 1 END) OVER (PARTITION BY recording_id ORDER BY us) AS loose FROM rc),
rr AS (SELECT *, sum(CASE WHEN place - pp <= 20 AND loose = pl THEN 0 ELSE 1 END) OVER (PARTITION BY recording_id ORDER BY us) AS g FROM (SELECT *, lag(place) OVER w AS pp, lag(loose) OVER w AS pl FROM rl WHERE core WINDOW w AS (PARTITION BY recording_id ORDER BY us))),
rs AS (SELECT recording_id, min(us) FILTER (mps > 2) AS start_us, max(us) AS end_us, max_by(stands, us) AS stands FROM rr GROUP BY recording_id, g),
g AS (SELECT rs.recording_id, start_us, end_us FROM rs JOIN pf ON pf.recording_id = rs.recording_id AND us BETWEEN start_us AND end_us WHERE stands GROUP BY ALL HAVING count(*) > 5)"""
GREEN = PLANNER + """, gt AS (SELECT *, lag(red_light) OVER w = 1 AND red_light = 0 AND lag(stop_distance) OVER w < 5 AND ctl AND turning = 0 AND steady AND still AND road AS trig, ctl AND road AS holds FROM pf WINDOW w AS (PARTITION BY recording_id ORDER BY us)),
gs AS (SELECT recording_id, us AS start_us, place AS p0, mps AS m0 FROM gt WHERE trig),
gr AS (SELECT gs.recording_id, start_us, p0, p0 AS place, m0 AS peak, m0 AS v, NULL::DOUBLE AS v1, NULL::DOUBLE AS v2, start_us AS us, 1 AS n, false AS over, false AS gone FROM gs
UNION ALL SELECT gr.recording_id, start_us, p0, gt.place, CASE WHEN holds THEN greatest(peak, mps) ELSE peak END, mps, v, v1, gt.us, n + 1, holds AND (greatest(peak, mps) >= 10 OR coalesce(mps < v AND v < v1, false)), NOT holds FROM gr JOIN gt ON gt.recording_id = gr.recording_id AND gt.place = gr.place + 1 WHERE NOT over AND NOT gone),
ge AS (SELECT recording_id, start_us, max(us) AS end_us, max(n) AS n, bool_or(gone) AS gone, bool_or(over) AS over FROM gr GROUP BY recording_id, start_us),
gw AS (SELECT *, max(end_us) OVER (PARTITION BY recording_id ORDER BY start_us ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS busy FROM ge),
g AS (SELECT recording_id, start_us, end_us FROM gw WHERE NOT gone AND n > 10 AND (busy IS NULL OR start_us > busy))"""


def planner_candidates(spark, sf_dir):
    """How many frames of a recording follow and see ahead which objects."""
    ids = lambda x: F.array_join(F.transform(x, lambda o: o["id"]), ",").alias(x)
    return P.candidates(planner_frames(spark, sf_dir)).groupBy("recording_id", "unmatched", "clear", ids("followed"), ids("ahead")).agg(F.count("*").alias("n"), F.sum("us").alias("sum_us"))


_register("planner_candidates", planner_candidates, PLANNER + """ SELECT pf.recording_id, lead_id >= 0 AND l.id IS NULL AS unmatched, road AS clear, concat_ws(',', f.id, CASE WHEN l.id IS DISTINCT FROM f.id THEN l.id END) AS followed, concat_ws(',', a.id, CASE WHEN l.id IS DISTINCT FROM a.id THEN l.id END) AS ahead, count(*) AS n, sum(pf.us)::BIGINT AS sum_us
FROM pf LEFT JOIN (SELECT * FROM fol WHERE kf = 1) f ON f.recording_id = pf.recording_id AND f.us = pf.us LEFT JOIN (SELECT * FROM lane WHERE k = 1) a ON a.recording_id = pf.recording_id AND a.us = pf.us LEFT JOIN ld l ON l.recording_id = pf.recording_id AND l.us = pf.us GROUP BY ALL""")
_register("planner_follow_stop", lambda spark, sf_dir: P.follow_stop(planner_frames(spark, sf_dir)), FOLLOW + " SELECT recording_id, target_id, start_us, end_us FROM g")
_register("planner_red_light_stop", lambda spark, sf_dir: P.red_light_stop(planner_frames(spark, sf_dir)), RED + " SELECT recording_id, start_us, end_us FROM g")
_register("planner_green_light_start", lambda spark, sf_dir: P.green_light_start(planner_frames(spark, sf_dir)), GREEN + " SELECT recording_id, start_us, end_us FROM g")


def _planner_case(metric: str, keys: str, inside: str, value: str, at: str, low: str | None, high: str | None, base: float) -> str:
    severity = _out("value", low, high, base)
    return f""", z1 AS ({inside}), z2 AS (SELECT {keys}, start_us, end_us, {value} AS value, {at} AS at_us, min_by(mps, us) AS v0 FROM z1 GROUP BY {keys}, start_us, end_us)
SELECT '{metric}' AS metric, recording_id, start_us, end_us, round(value, 6) AS value, at_us, {severity} > 0 AS bad, {severity} AS severity FROM z2 WHERE value IS NOT NULL"""


_TARGET = "SELECT tf.*, start_us, end_us, id AS target_id, {} AS mn FROM g JOIN tf ON tf.recording_id = g.recording_id AND id = target_id AND us BETWEEN start_us AND end_us"
_PLAIN = "SELECT pf.*, start_us, end_us, {} AS mn FROM g JOIN pf ON pf.recording_id = g.recording_id AND us BETWEEN start_us AND end_us"
_OWN, _ONE = "OVER (PARTITION BY g.recording_id, target_id, start_us)", "OVER (PARTITION BY g.recording_id, start_us)"


def _scene_jerk(base: str, part: str, pick: str) -> str:
    """SQL of ``base`` with the jerk over each scene's own samples and its extreme mn."""
    near = f"(PARTITION BY {part} ORDER BY us RANGE BETWEEN 150000 PRECEDING AND 150000 FOLLOWING)"
    mean = f"SELECT * EXCLUDE (jerk, smooth, mn), avg(acceleration) OVER {near} AS own_mean FROM ({base}) WHERE us > 0"
    slope = f"SELECT *, CASE WHEN count(*) OVER w >= 3 AND max(us) OVER w - min(us) OVER w >= 150000 THEN regr_slope(own_mean, (us - start_us) / 1e6) OVER w END AS jerk FROM ({mean}) WINDOW w AS {near}"
    return f"SELECT *, {pick}(jerk) OVER (PARTITION BY {part}) AS mn FROM ({slope})"


_NEAR = f"SELECT *, min(ottc) FILTER (us BETWEEN brakes AND stops) OVER (PARTITION BY recording_id, target_id, start_us) AS mn FROM (SELECT tf.*, start_us, end_us, id AS target_id, min(CASE WHEN oacc <= -0.5 THEN us END) {_OWN} AS brakes, max(CASE WHEN mps >= 0.2 THEN us END) {_OWN} AS stops FROM g JOIN tf ON tf.recording_id = g.recording_id AND id = target_id AND us BETWEEN start_us AND end_us)"
_AFTER = "SELECT gx.recording_id, gx.start_us, gx.end_us, pf.us, pf.mps, lag(pf.mps) OVER (PARTITION BY gx.recording_id, gx.start_us ORDER BY pf.us) AS pm, 0 AS mn FROM g gx JOIN pf ON pf.recording_id = gx.recording_id AND pf.us >= gx.start_us"
_TWO = "recording_id, target_id"
PLANNER_CASES = {
    "follow_stop_ttc": (P.follow_stop_cases, FOLLOW + _planner_case("follow_stop_ttc", _TWO, _TARGET.format("0"), "min_by(ottc, us) FILTER (acceleration <= -0.5)", "min(us) FILTER (acceleration <= -0.5)", "4.5", None, 2)),
    "follow_stop_max_acc": (P.follow_stop_cases, FOLLOW + _planner_case("follow_stop_max_acc", _TWO, _TARGET.format(f"min(acceleration) {_OWN}"), "min(acceleration)", "min(us) FILTER (acceleration = mn)", "greatest(least(-v0 / 5.5, -1.75), -4.0) - 1", None, 2)),
    "follow_stop_min_jerk": (P.follow_stop_cases, FOLLOW + _planner_case("follow_stop_min_jerk", _TWO, _scene_jerk(_TARGET.format("0"), "recording_id, target_id, start_us", "min"), "min(jerk)", "min(us) FILTER (jerk = mn)", "-2.0", None, 1)),
    "follow_stop_min_ttc_frntobj_dec": (P.follow_stop_cases, FOLLOW + _planner_case("follow_stop_min_ttc_frntobj_dec", _TWO, _NEAR, "min(mn)", "min(us) FILTER (ottc = mn AND us BETWEEN brakes AND stops)", "1.5", None, 1)),
    "redlight_min_jerk": (P.red_light_cases, RED + _planner_case("redlight_min_jerk", "recording_id", _scene_jerk(_PLAIN.format("0"), "recording_id, start_us", "min"), "min(jerk)", "min(us) FILTER (jerk = mn)", "-2.0", None, 1)),
    "redlight_stop_dis": (P.red_light_cases, RED + _planner_case("redlight_stop_dis", "recording_id", _PLAIN.format(f"min(stop_distance) {_ONE}"), "min(stop_distance) + 1.3", "min(us) FILTER (stop_distance = mn)", "1.5", "3.5", 2)),
    "traffic_light_stop2go_time": (P.green_light_cases, GREEN + _planner_case("traffic_light_stop2go_time", "recording_id", _AFTER, "(min(us) FILTER (mps > 0.2 AND pm > 0.2) - start_us) / 1e6", "min(us) FILTER (mps > 0.2 AND pm > 0.2)", None, "1.5", 3)),
    "traffic_light_stop2go_max_accel": (P.green_light_cases, GREEN + _planner_case("traffic_light_stop2go_max_accel", "recording_id", _PLAIN.format(f"max(acceleration) {_ONE}"), "max(acceleration)", "min(us) FILTER (acceleration = mn)", "1.0", "2.3", 2)),
    "traffic_light_stop2go_max_jerk": (P.green_light_cases, GREEN + _planner_case("traffic_light_stop2go_max_jerk", "recording_id", _scene_jerk(_PLAIN.format("0"), "recording_id, start_us", "max"), "max(jerk)", "min(us) FILTER (jerk = mn)", None, "2.5", 1)),
    "traffic_light_stop2go_accel_time": (P.green_light_cases, GREEN + _planner_case("traffic_light_stop2go_accel_time", "recording_id", _AFTER, "(min(us) FILTER (mps > 8) - min(us) FILTER (mps > 0.5)) / 1e6", "min(us) FILTER (mps > 8)", None, "6.0", 4)),
}


def _planner(metric: str):
    def run(spark, sf_dir):
        return PLANNER_CASES[metric][0](planner_frames(spark, sf_dir)).where(F.col("metric") == metric).withColumn("value", F.round("value", 6))

    return run


for _name, (_, _sql) in PLANNER_CASES.items():
    _register(f"planner_case_{_name}", _planner(_name), _sql)


# Bus signals held against the planner's state, which is told at every fourth sample.


def _gated(find):
    def run(spark, sf_dir):
        frame = drives(spark, sf_dir)
        states = frame.where("(us div 100000) % 4 = 0").select("recording_id", "us", (F.col("digit") != 5).alias("np_on"))
        return find(X.gated(frame, states))

    return run


GATED = FRAME + """, sg AS (SELECT recording_id, us, digit <> 5 AS np FROM f WHERE us // 100000 % 4 = 0),
h1 AS (SELECT f.*, b.us AS bu, b.np AS bn FROM f ASOF LEFT JOIN sg b ON f.recording_id = b.recording_id AND f.us >= b.us), h2 AS (SELECT h1.*, n.us AS nu, n.np AS nn FROM h1 ASOF LEFT JOIN sg n ON h1.recording_id = n.recording_id AND h1.us <= n.us),
gf AS (SELECT *, ctl AND CASE WHEN nu IS NULL OR us - bu <= nu - us THEN bn ELSE nn END AS gctl FROM h2 WHERE recording_id NOT IN (SELECT recording_id FROM h2 WHERE coalesce(least(us - bu, nu - us), us - bu, nu - us) > 300000))"""
_WHEELS = " AND ".join(f"wheel_dir_{w} = 4 AND abs(wheel_speed_{w}) > 0.01" for w in ("lf", "rf", "lr", "rr"))
_register("gated_lost_arbitration", _gated(X.lost_arbitration), GATED + f" SELECT {_SPAN} FROM ({runs('gf', 'gctl AND acc_request_state = 2')}) WHERE b - a >= 5000000")
_register("gated_rollback", _gated(X.rollback), GATED + f" SELECT recording_id, a AS start_us, b AS end_us, round(speed, 3) AS severity FROM ({runs('gf', f'gctl AND brake_request_type = 5 AND gear = 12 AND ego_speed < 0.5 AND {_WHEELS}', 'avg((abs(wheel_speed_lf) + abs(wheel_speed_rf) + abs(wheel_speed_lr) + abs(wheel_speed_rr)) / 4) AS speed')}) WHERE b - a >= 200000")


# The same drives, logged as recordings of 24 s that start 1.5 s late or early in turn; after every fourth the logger rests.
PART = 24_000_000


def cut_drives(spark, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(frame, recordings): each recording on its own time from 0."""
    c = F.col
    rows = drives(spark, sf_dir).withColumn("vehicle", c("recording_id")).withColumn("part", F.expr(f"us div {PART}"))
    rows = rows.withColumn("recording_id", c("vehicle") * 100_000 + c("part"))
    started = c("part") * PART + (F.expr("part div 4") * 20_000_000) + c("part") % 2 * 1_500_000
    recordings = rows.select("recording_id", "vehicle", started.alias("started_us")).distinct()
    return rows.withColumn("us", c("us") % PART).drop("vehicle", "part"), recordings


_HEAD, _DERIVED = FRAME.split("\nraw AS (")
_WHOLE, _DERIVED = _DERIVED.split("),\nd0 AS", 1)
STITCHED = f"""{_HEAD}
whole AS ({_WHOLE}),
logged AS (
  SELECT * REPLACE (recording_id * 100000 + us // {PART} AS recording_id, us % {PART} AS us),
    recording_id AS vehicle,
    us // {PART} AS part
  FROM whole),
files AS (
  SELECT vehicle, recording_id, part,
    part * {PART} + part // 4 * 20000000 + part % 2 * 1500000 AS started,
    min(us) AS first_us, max(us) AS last_us, count(*) AS n
  FROM logged
  GROUP BY vehicle, recording_id, part),
follows AS (
  SELECT a.recording_id, b.recording_id AS next_id, a.last_us, a.first_us + (b.started - a.started) - b.first_us AS shift
  FROM files a
  JOIN files b ON b.vehicle = a.vehicle AND b.part = a.part + 1
  WHERE a.n >= 2
    AND abs((b.started - a.started) - (a.last_us - a.first_us)) <= 5000000),
owners AS (
  SELECT recording_id, first_us, last_us, recording_id IN (SELECT next_id FROM follows) AS has_previous
  FROM files),
raw AS (
  SELECT * EXCLUDE (vehicle, part) FROM logged
  UNION ALL
  SELECT l.* EXCLUDE (vehicle, part) REPLACE (f.recording_id AS recording_id, l.us + f.shift AS us)
  FROM follows f
  JOIN logged l ON l.recording_id = f.next_id
  WHERE l.us + f.shift > f.last_us),
d0 AS{_DERIVED}"""


def _stitched_scene(name: str):
    return lambda spark, sf_dir: ST.scene(*cut_drives(spark, sf_dir), name, POWERTRAIN).select("recording_id", "start_us", "end_us")


def _stitched_case(name: str):
    return lambda spark, sf_dir: ST.cases(*cut_drives(spark, sf_dir), POWERTRAIN, [name]).withColumn("value", F.round("value", 6))


for _name in SC.SCENES:
    _own = OWN_SQL.format(begins=_BEGINS.get(_name, "start_us"))
    _register(f"stitched_scene_{_name}", _stitched_scene(_name), STITCHED + SCENE_SQL[_name] + _own + "\nSELECT recording_id, start_us, end_us FROM own")
for _name in ("curvature_min_jerk", "follow_stop_ttc", "follow_start_latency", "stop2go_start_time", "slope_no_frnt_vel_fluct"):
    _register(f"stitched_case_{_name}", _stitched_case(_name), _case_sql(MT.CASES[_name], STITCHED, "own"))
_register(
    "stitched_incident_acc_unreasonable_low_speed_count",
    lambda spark, sf_dir: ST.low_speed(*cut_drives(spark, sf_dir), POWERTRAIN),
    INCIDENT_SQL["acc_unreasonable_low_speed_count"].replace(FRAME, STITCHED).replace("\nSELECT recording_id, min(us) AS start_us", ",\ng AS (SELECT recording_id, min(us) AS start_us")
    + ")" + OWN_SQL.format(begins="start_us") + "\nSELECT recording_id, start_us, end_us, severity FROM own",
)


# The recordings as folders of a run, in absolute time; the planner tells its state at every fourth sample.


def folder_run(spark, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(bus frame, planner frames, folders)."""
    c = F.col
    frame, recordings = cut_drives(spark, sf_dir)
    start = recordings.select("recording_id", "started_us")
    frame = frame.join(start, "recording_id").withColumn("at", c("us")).withColumn("us", c("us") + c("started_us")).drop("started_us")
    folders = recordings.select("recording_id", c("vehicle").alias("run"), c("started_us").alias("place"))
    return frame.drop("at"), _as_planner(frame.where("(at div 100000) % 4 = 0").drop("at")), folders


LOW = (
    _HEAD
    + f"""
whole AS ({_WHOLE}),
logged AS (
  SELECT * REPLACE (recording_id * 100000 + us // {PART} AS recording_id, us % {PART} + us // {PART} * {PART} + us // {PART} // 4 * 20000000 + us // {PART} % 2 * 1500000 AS us),
    recording_id AS vehicle,
    us // {PART} AS part,
    us % {PART} // 100000 AS i
  FROM whole),
told AS (
  SELECT recording_id, i,
    curv_enable = 1 AND NOT (curv_speed_limit <= 0 OR curv_speed_limit >= floor(set_speed * (floor(1000 * {_bias("set_speed")} + 0.5) / 1000) + 0.5)) AS curve_bars,
    red_light = 1 AND stop_distance BETWEEN 0 AND 150 AS light_bars,
    digit % 2 = 0 OR (front_target_id <> 0 AND front_range BETWEEN 1 AND 50) OR (lead_id >= 0 AND lead_id <> 9) AS target_bars
  FROM logged
  WHERE i % 4 = 0),
spans AS (
  SELECT vehicle, part, recording_id, min(us) AS first_us, max(us) AS last_us, max(i) AS last_i
  FROM logged
  GROUP BY vehicle, part, recording_id),
bus AS (
  SELECT l.recording_id, l.us,
    floor(greatest(ego_speed, 0) * (floor(1000 * {_bias("ego_speed")} + 0.5) / 1000) + 0.5) AS shown,
    floor(set_speed * (floor(1000 * {_bias("set_speed")} + 0.5) / 1000) + 0.5) AS wanted,
    acc_active <> 0 AND pedal_override = 0 AND set_speed > 0 AND NOT curve_bars AND NOT light_bars AND NOT target_bars AS free
  FROM logged l
  JOIN spans s ON s.recording_id = l.recording_id
  JOIN told t ON t.recording_id = l.recording_id
    AND t.i = CASE WHEN l.i % 4 = 3 AND l.i + 1 <= last_i THEN l.i + 1 ELSE l.i - l.i % 4 END),
tails AS (
  SELECT a.recording_id, b.recording_id AS next_id, a.last_us
  FROM spans a
  JOIN spans b ON b.vehicle = a.vehicle AND b.part = a.part + 1
  WHERE b.last_us > a.first_us AND abs(b.first_us - a.last_us) <= 10000000),
chained AS (
  SELECT * FROM bus
  UNION ALL
  SELECT t.recording_id, b.us, b.shown, b.wanted, b.free
  FROM tails t
  JOIN bus b ON b.recording_id = t.next_id
  WHERE b.us > t.last_us AND b.us <= t.last_us + 10000000),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY recording_id ORDER BY us) AS k
  FROM chained),
marked AS (
  SELECT *, sum(CASE WHEN free AND coalesce(lag_free, false) AND wanted = lag_wanted THEN 0 ELSE 1 END) OVER (PARTITION BY recording_id ORDER BY k) AS run
  FROM (
    SELECT *, lag(free) OVER w AS lag_free, lag(wanted) OVER w AS lag_wanted
    FROM ordered
    WINDOW w AS (PARTITION BY recording_id ORDER BY k))),
windows AS (
  SELECT a.recording_id, a.run, a.k, a.us, a.wanted, min(b.k) AS stop
  FROM marked a
  JOIN marked b ON b.recording_id = a.recording_id AND b.run = a.run AND b.us - a.us >= 8000000
  WHERE a.free
  GROUP BY ALL),
judged AS (
  SELECT w.recording_id, w.run, w.k, w.stop, w.us AS start_us, max(m.us) AS end_us, any_value(w.wanted) AS wanted, max(shown) AS most,
    min(shown) > 5 AND max(shown) - min(shown) < 1.5 AND any_value(w.wanted) - max(shown) >= 8 AS good
  FROM windows w
  JOIN marked m ON m.recording_id = w.recording_id AND m.k BETWEEN w.k AND w.stop
  GROUP BY w.recording_id, w.run, w.k, w.stop, w.us),
picked AS (
  SELECT * FROM (SELECT * FROM judged WHERE good QUALIFY row_number() OVER (PARTITION BY recording_id, run ORDER BY k) = 1)
  UNION ALL
  SELECT * FROM (
    SELECT j.*
    FROM picked p
    JOIN judged j ON j.recording_id = p.recording_id AND j.run = p.run AND j.k > p.stop AND j.good
    QUALIFY row_number() OVER (PARTITION BY j.recording_id, j.run, p.k ORDER BY j.k) = 1)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY recording_id ORDER BY start_us) AS n FROM picked),
merged AS (
  SELECT recording_id, n, n AS first, start_us, end_us, wanted, wanted - most AS deficit FROM numbered WHERE n = 1
  UNION ALL
  SELECT recording_id, n, CASE WHEN same THEN first ELSE n END, CASE WHEN same THEN m_start ELSE start_us END, end_us,
    CASE WHEN same THEN m_wanted ELSE wanted END, CASE WHEN same THEN greatest(m_deficit, wanted - most) ELSE wanted - most END
  FROM (
    SELECT x.*, m.first, m.start_us AS m_start, m.wanted AS m_wanted, m.deficit AS m_deficit,
      x.start_us - m.end_us <= 1000000 AND abs(x.wanted - m.wanted) <= 1 AS same
    FROM merged m
    JOIN numbered x ON x.recording_id = m.recording_id AND x.n = m.n + 1)),
scenes AS (
  SELECT s.vehicle, s.part, s.first_us, m.*, row_number() OVER (PARTITION BY s.vehicle ORDER BY s.part, m.start_us) AS place
  FROM (SELECT recording_id, min(start_us) AS start_us, max(end_us) AS end_us, max_by(wanted, n) AS wanted, round(max_by(deficit, n), 3) AS severity FROM merged GROUP BY recording_id, first) m
  JOIN spans s ON s.recording_id = m.recording_id),
walk AS (
  SELECT *, false AS goes_on, end_us AS ends FROM scenes WHERE place = 1
  UNION ALL
  SELECT vehicle, part, first_us, recording_id, start_us, end_us, wanted, severity, place, on_, CASE WHEN on_ THEN greatest(w_ends, end_us) ELSE end_us END
  FROM (
    SELECT s.*, w.ends AS w_ends,
      NOT (s.part <> w.part AND s.first_us < w.first_us - 1000000) AND abs(w.wanted - s.wanted) <= 1 AND s.start_us <= w.ends + 1000000 AS on_
    FROM walk w
    JOIN scenes s ON s.vehicle = w.vehicle AND s.place = w.place + 1))
"""
)
_register("folder_low_speed_scenes", lambda spark, sf_dir: FD.low_speed(*folder_run(spark, sf_dir)), LOW + "SELECT recording_id, start_us, end_us, severity, goes_on FROM walk")
_register(
    "folder_low_speed_totals",
    lambda spark, sf_dir: FD.totals(FD.low_speed(*folder_run(spark, sf_dir))),
    LOW
    + """SELECT recording_id, count(*) FILTER (NOT goes_on) AS total, count(*) FILTER (NOT goes_on AND severity >= 8) AS bad, count(*) FILTER (goes_on) AS continued,
  coalesce(max(severity) FILTER (NOT goes_on), 0) AS severity
FROM walk
GROUP BY recording_id""",
)


# Curves: every manoeuvre but those of digit 0 has a curve limit, tighter by digit.


def curve_frames(spark, sf_dir: str) -> DataFrame:
    rows, c = drives(spark, sf_dir), F.col
    limited = rows.withColumn("curv_enable", F.when(c("digit") > 0, 1).otherwise(0)).withColumn("curvature", 2e-3 + c("digit") * 1e-3)
    return _as_planner(limited)


CURVE = (
    PLANNER
    + f""",
cs AS (
  SELECT recording_id, a AS start_us, b AS end_us
  FROM ({runs("pf", "road AND ctl AND turning = 0 AND digit > 0 AND NOT still AND NOT (red_light = 1 AND stop_distance < 50)", "count(*) AS n, count(*) FILTER (2e-3 + digit * 1e-3 > 0.004) AS bent")})
  WHERE n >= 50 AND bent >= 5),
ci AS (
  SELECT s.start_us, s.end_us, p.recording_id, p.us, p.mps, p.set_speed, 2e-3 + digit * 1e-3 AS bend_,
    acceleration + 9.80665e0 * sin(radians(slope_deg)) AS pull,
    row_number() OVER (PARTITION BY p.recording_id, s.start_us ORDER BY p.us) AS i
  FROM cs s
  JOIN pf p ON p.recording_id = s.recording_id AND p.us BETWEEN s.start_us AND s.end_us),
low_at AS (SELECT recording_id, start_us, min(i) AS i FROM ci WHERE pull <= -0.5 GROUP BY ALL),
turn_at AS (
  SELECT ci.recording_id, ci.start_us, min(ci.i) AS t
  FROM ci JOIN low_at l ON l.recording_id = ci.recording_id AND l.start_us = ci.start_us AND ci.i >= l.i
  WHERE pull >= -0.1
  GROUP BY ALL),
ct AS (
  SELECT ci.*, t, lag(pull, 1) OVER w AS p1, lag(pull, 2) OVER w AS p2
  FROM ci JOIN turn_at USING (recording_id, start_us)
  WINDOW w AS (PARTITION BY recording_id, start_us ORDER BY i)),
walk AS (
  SELECT recording_id, start_us, i, pull AS least, CASE WHEN i <= 2 OR pull >= p1 - 0.07 OR pull >= p2 - 0.07 THEN 0 ELSE 1 END AS missed,
    i <= 2 OR pull >= p1 - 0.07 OR pull >= p2 - 0.07 AS ok
  FROM ct WHERE i = t
  UNION ALL
  SELECT recording_id, start_us, i, least, CASE WHEN ok THEN 0 ELSE missed + 1 END, ok
  FROM (
    SELECT c.recording_id, c.start_us, c.i, least(w.least, c.pull) AS least,
      w.missed,
      (c.i <= 2 OR c.pull >= c.p1 - 0.07 OR c.pull >= c.p2 - 0.07) AND c.pull < least(w.least, c.pull) + 0.5 AS ok
    FROM walk w
    JOIN ct c ON c.recording_id = w.recording_id AND c.start_us = w.start_us AND c.i = w.i - 1
    WHERE w.missed < 3)),
tr AS (
  SELECT c.* FROM ct c
  JOIN walk w ON w.recording_id = c.recording_id AND w.start_us = c.start_us AND w.i = c.i AND w.ok),
sl AS (
  SELECT recording_id, start_us, any_value(end_us) AS end_us, min(mps) AS v, min_by(us, (mps, i)) AS at_, min_by(set_speed, (mps, i)) AS wanted
  FROM ct
  WHERE i > t AND abs(pull) < 0.1
  GROUP BY recording_id, start_us),
rd AS (SELECT recording_id, start_us, 1 / max(bend_) AS radius FROM ci GROUP BY ALL),
jm AS (
  SELECT *, avg(pull) OVER (PARTITION BY recording_id, start_us ORDER BY us RANGE BETWEEN 150000 PRECEDING AND 150000 FOLLOWING) AS mean_
  FROM tr WHERE us > 0),
jk AS (
  SELECT *, CASE WHEN count(*) OVER w >= 3 AND max(us) OVER w - min(us) OVER w >= 150000 THEN regr_slope(mean_, (us - start_us) / 1e6) OVER w END AS jerk_
  FROM jm
  WINDOW w AS (PARTITION BY recording_id, start_us ORDER BY us RANGE BETWEEN 150000 PRECEDING AND 150000 FOLLOWING)),
"""
)
CURVE_SQL = {
    "curvature_min_speed": """z AS (SELECT recording_id, start_us, end_us, v AS value, at_ AS at_us, radius, wanted FROM sl JOIN rd USING (recording_id, start_us)),
y AS (SELECT *, CASE WHEN wanted <= sqrt(radius) THEN 0 ELSE round(greatest(0, sqrt(radius) - 2 - value, value - sqrt(2.9 * radius) - 2) / 5 * 100, 3) END AS severity FROM z)""",
    "curvature_min_acc": """z AS (SELECT recording_id, start_us, min(pull) AS value, min_by(us, (pull, -i)) AS at_us FROM tr GROUP BY ALL),
y AS (SELECT z.*, end_us, round(greatest(0, -2 - value) / 2 * 100, 3) AS severity FROM z JOIN sl USING (recording_id, start_us))""",
    "curvature_min_jerk": """z AS (SELECT recording_id, start_us, min(jerk_) AS value, min_by(us, (jerk_, us)) AS at_us FROM jk WHERE jerk_ IS NOT NULL GROUP BY ALL),
y AS (SELECT z.*, end_us, round(greatest(0, -2 - value) * 100, 3) AS severity FROM z JOIN sl USING (recording_id, start_us))""",
}


def _curve(metric: str):
    return lambda spark, sf_dir: P.curve_cases(curve_frames(spark, sf_dir)).where(F.col("metric") == metric).withColumn("value", F.round("value", 6))


_register("planner_curve", lambda spark, sf_dir: P.curve(curve_frames(spark, sf_dir)), CURVE.rstrip().rstrip(",") + "\nSELECT recording_id, start_us, end_us FROM cs")
for _name, _sql in CURVE_SQL.items():
    _register(f"planner_case_{_name}", _curve(_name), CURVE + _sql + f"\nSELECT '{_name}' AS metric, recording_id, start_us, end_us, round(value, 6) AS value, at_us, severity > 0 AS bad, severity FROM y")
