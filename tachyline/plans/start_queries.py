"""Starts and slopes of the planner's frames as queries over the drives of ``drive_queries``, with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from . import starts as P
from .drive_queries import PLANNER, SCENE_SQL, _as_planner, _bias, _chains, _out, drives

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def start_frames(spark, sf_dir: str) -> DataFrame:
    """The planner's frames with the set speed in m/s and the speed on the dashboard."""
    rows, c = drives(spark, sf_dir), F.col
    shown = F.expr(f"cast(floor(greatest(ego_speed, 0) * (floor(1000 * {_bias('ego_speed')} + 0.5) / 1000) + 0.5) as double)")
    return _as_planner(rows.withColumn("set_speed", c("set_speed") / 3.6), shown.alias("shown_speed"))


GO = (
    PLANNER
    + """,
ga AS (
  SELECT *, acceleration + 9.80665e0 * sin(radians(slope_deg)) AS pull,
    ctl AND turning = 0 AND road
      AND NOT (red_light = 1 AND stop_distance < 50)
      AND NOT curv AND steady AND NOT still
      AND acceleration >= 0
      AND mps <= set_speed / 3.6e0 AS going
  FROM pf),
gb AS (
  SELECT *, place - row_number() OVER (PARTITION BY recording_id ORDER BY us) AS part
  FROM ga
  WHERE going),
gc AS (
  SELECT recording_id, min(place) AS p0, max(place) AS p1, min(us) AS start_us, max(us) AS end_us, count(*) AS n, max_by(mps, us) AS v
  FROM gb
  GROUP BY recording_id, part),
g AS (
  SELECT gc.recording_id, start_us, end_us
  FROM gc
  JOIN pf b ON b.recording_id = gc.recording_id AND b.place = p0 - 1 AND b.still
  LEFT JOIN pf a ON a.recording_id = gc.recording_id AND a.place = p1 + 1
  WHERE n >= 50
    AND (a.us IS NULL OR a.ctl)
    AND CASE WHEN a.road THEN a.mps ELSE v END >= 8)"""
)
SLOPE = (
    PLANNER
    + ", on0 AS ("
    + _chains(
        "pf",
        """ctl AND turning = 0 AND NOT still AND road
    AND abs(9.80665e0 * sin(radians(slope_deg))) >= 0.1
    AND (NOT curv OR curv_speed_limit >= mps)
    AND set_speed > 0
    AND NOT (red_light = 1 AND stop_distance < 40)""",
        "set_speed",
    )
    + "),\non1 AS "
    + SCENE_SQL["slope_no_front"].split("\non1 AS ", 1)[1]
)
FOLLOW = (
    PLANNER
    + """,
ta AS (
  SELECT pf.*, tg.id,
    CASE tg.id WHEN 9 THEN 10 WHEN 8 THEN 5 ELSE front_velocity_abs END AS ahead_v,
    place - row_number() OVER (PARTITION BY pf.recording_id, tg.id ORDER BY place) AS run
  FROM tg
  JOIN pf ON pf.recording_id = tg.recording_id AND pf.us = tg.us),
tb AS (
  SELECT *,
    still AND mps <= 0.2 AND ctl AS waits,
    count(*) FILTER (NOT (still AND mps <= 0.2 AND ctl)) OVER w AS left_,
    ctl AND turning = 0 AS held,
    red_light = 1 AND stop_distance BETWEEN 0.1 AND 15 AS close_,
    lag(still) OVER w AS stood
  FROM ta
  WINDOW w AS (PARTITION BY recording_id, id, run ORDER BY place)),
tt AS (
  SELECT DISTINCT t.recording_id, t.id, t.run, t.place
  FROM tb t
  JOIN tb l ON l.recording_id = t.recording_id AND l.id = t.id AND l.run = t.run AND l.us BETWEEN t.us - 1000000 AND t.us
  WHERE t.ahead_v > 0.5
    AND l.ahead_v <= 0.2
    AND l.waits
    AND l.left_ = t.left_
    AND NOT (t.red_light = 1 AND t.stop_distance BETWEEN 0.1 AND 30)),
tc AS (
  SELECT tb.*, tt.place IS NOT NULL AS fresh,
    held AND NOT close_ AND (stood OR (NOT still AND acceleration >= 0)) AS ok
  FROM tb
  LEFT JOIN tt ON tt.recording_id = tb.recording_id AND tt.id = tb.id AND tt.run = tb.run AND tt.place = tb.place),
fw AS (
  SELECT recording_id, id, run, place AS p0, place, us, mps, 'on' AS state
  FROM tc
  WHERE fresh AND held
  UNION ALL
  SELECT fw.recording_id, fw.id, fw.run, p0, tc.place, tc.us, tc.mps,
    CASE WHEN tc.fresh THEN 'lost' WHEN NOT tc.ok THEN 'spoilt' WHEN tc.mps >= 6 THEN 'fast' ELSE 'on' END
  FROM fw
  JOIN tc ON tc.recording_id = fw.recording_id AND tc.id = fw.id AND tc.run = fw.run AND tc.place = fw.place + 1
  WHERE state = 'on'),
g AS (
  SELECT recording_id, id AS target_id, min(us) AS start_us, max(us) FILTER (state IN ('on', 'fast')) AS end_us
  FROM fw
  GROUP BY recording_id, id, run, p0
  HAVING count(*) FILTER (state IN ('on', 'fast')) > 5
    AND max_by(state, place) <> 'lost'
    AND (max_by(state, place) = 'fast' OR max_by(mps, place) FILTER (state = 'on') >= 2))"""
)
_AT = "sc.recording_id = g.recording_id AND sc.us BETWEEN g.start_us AND g.end_us"
_PULLS = f""",
gi AS (
  SELECT sc.recording_id, g.start_us, g.end_us, sc.us, sc.mps, sc.shown, sc.acceleration + 9.80665e0 * sin(radians(slope_deg)) AS pull
  FROM g
  JOIN pf sc ON {_AT})"""
_FOLLOWED = f""",
gi AS (
  SELECT sc.recording_id, g.start_us, g.end_us, g.target_id, sc.us, sc.mps, sc.ahead_v, sc.acceleration AS pull
  FROM g
  JOIN tb sc ON {_AT} AND sc.id = g.target_id)"""


def _fit(part: str) -> str:
    near = f"PARTITION BY {part} ORDER BY us RANGE BETWEEN 150000 PRECEDING AND 150000 FOLLOWING"
    return f""",
gm AS (
  SELECT *, avg(pull) OVER ({near}) AS mean_
  FROM gi
  WHERE us > 0),
gj AS (
  SELECT *, CASE WHEN count(*) OVER w >= 3 AND max(us) OVER w - min(us) OVER w >= 150000 THEN regr_slope(mean_, (us - start_us) / 1e6) OVER w END AS fitted
  FROM gm
  WINDOW w AS ({near}))"""


_SCENE, _TARGET = "recording_id, start_us, end_us", "recording_id, target_id, start_us, end_us"
_FIRST_TOP = "min_by(us, (-{0}, us)) FILTER ({0} IS NOT NULL)"
#: Metric -> (cases, scenes' SQL with samples, source, part, value, time, bounds, base).
CASES = {
    "stop2go_max_acc": (P.stop2go_cases, GO + _PULLS, "gi", _SCENE, "round(max(pull), 3)", _FIRST_TOP.format("pull"), "1.0", "2.7", 2),
    "stop2go_max_acc_time": (
        P.stop2go_cases, GO + _PULLS, "gi", _SCENE,
        f"greatest(({_FIRST_TOP.format('pull')} - coalesce(min(us) FILTER (pull > 0.2), {_FIRST_TOP.format('pull')})) / 1e6, 0)",
        _FIRST_TOP.format("pull"), None, "3.5", 2,
    ),
    "stop2go_max_jerk": (P.stop2go_cases, GO + _PULLS + _fit(_SCENE), "gj", _SCENE, "round(max(fitted), 3)", _FIRST_TOP.format("fitted"), None, "3.5", 1),
    "stop2go_start_time": (
        P.stop2go_cases, GO + _PULLS, "gi", _SCENE,
        "CASE WHEN max(pull) > 0.1 THEN (min(us) FILTER (mps > 3.33) - min(us) FILTER (mps > 0.2)) / 1e6 END",
        "min(us) FILTER (mps > 3.33)", "1.0", "2.8", 2,
    ),
    "slope_no_frnt_acc": (P.slope_cases, SLOPE + _PULLS, "gi", _SCENE, "min_by(pull, (-abs(pull), us))", "min_by(us, (-abs(pull), us))", "-0.75", "0.75", 0.75),
    "slope_no_frnt_jerk": (P.slope_cases, SLOPE + _PULLS + _fit(_SCENE), "gj", _SCENE, "max(fitted)", _FIRST_TOP.format("fitted"), "-1.0", "1.0", 1),
    "slope_no_frnt_vel_fluct": (P.slope_cases, SLOPE + _PULLS, "gi", _SCENE, "(max(shown) - min(shown)) / 3.6", _FIRST_TOP.format("shown"), None, "0.3", 2),
    "follow_start_latency": (P.follow_start_cases, FOLLOW + _FOLLOWED + """,
gn AS (
  SELECT *, ahead_v > 0.5 AND lead(ahead_v, 1) OVER w > 0.5 AND lead(ahead_v, 2) OVER w > 0.5 AS three
  FROM gi
  WINDOW w AS (PARTITION BY recording_id, target_id, start_us ORDER BY us)),
gt AS (
  SELECT recording_id, target_id, start_us, end_us, min(us) FILTER (three) AS goes, min(us) FILTER (mps > 0.5) AS us
  FROM gn
  GROUP BY ALL)""", "gt", _TARGET, "max(CASE WHEN us >= goes THEN (us - goes) / 1e6 END)", "max(us)", None, "2.5", 3),
    "follow_start_jerk": (P.follow_start_cases, FOLLOW + _FOLLOWED + _fit(_TARGET), "gj", _TARGET, "max(fitted)", _FIRST_TOP.format("fitted"), None, "1.5", 1),
}


def _case(metric: str):
    return lambda spark, sf_dir: CASES[metric][0](start_frames(spark, sf_dir)).where(F.col("metric") == metric).withColumn("value", F.round("value", 6))


def _case_sql(metric: str) -> str:
    _, text, source, part, value, at, low, high, base = CASES[metric]
    severity = _out("value", low, high, base)
    return f"""{text},
z AS (
  SELECT {part}, {value} AS value, {at} AS at_us
  FROM {source}
  GROUP BY {part})
SELECT '{metric}' AS metric, recording_id, start_us, end_us, round(value, 6) AS value, at_us, {severity} > 0 AS bad, {severity} AS severity
FROM z
WHERE value IS NOT NULL"""


QUERIES["planner_stop2go"] = lambda spark, sf_dir: P.stop2go(start_frames(spark, sf_dir))
ORACLE["planner_stop2go"] = GO + "\nSELECT recording_id, start_us, end_us FROM g"
QUERIES["planner_slope"] = lambda spark, sf_dir: P.slope(start_frames(spark, sf_dir))
ORACLE["planner_slope"] = SLOPE + "\nSELECT recording_id, start_us, end_us FROM g"
QUERIES["planner_follow_start"] = lambda spark, sf_dir: P.follow_start(start_frames(spark, sf_dir))
ORACLE["planner_follow_start"] = FOLLOW + "\nSELECT recording_id, target_id, start_us, end_us FROM g"
for _name in CASES:
    QUERIES[f"planner_case_{_name}"] = _case(_name)
    ORACLE[f"planner_case_{_name}"] = _case_sql(_name)
