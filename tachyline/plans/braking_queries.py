"""Heavy braking of the drives where the planner's function is on, with SQL."""

from __future__ import annotations

from . import braking as B
from . import gated as X, torque as T
from .drive_queries import FRAME, GATED, INCIDENT_SQL, JERK, PLANNER, _as_planner, _bias, _gated, drives, planner_frames, runs

HEAVY = (
    JERK.replace("FROM f)", "FROM gf)")
    + """,
hv AS (
  SELECT recording_id, us, smooth, jerk,
    gctl AND coalesce(lag(gctl) OVER w, false) AND jerk IS NOT NULL AS ok,
    row_number() OVER w AS i
  FROM jf
  WINDOW w AS (PARTITION BY recording_id ORDER BY us)),
hr AS (
  SELECT *, i - row_number() OVER (PARTITION BY recording_id ORDER BY us) AS run
  FROM hv
  WHERE ok),
ha AS (
  SELECT *,
    lead(us) OVER w AS nxt,
    max(i) FILTER (smooth > -2) OVER w AS over2,
    max(i) FILTER (smooth > -1.8) OVER w AS over18,
    min(smooth) OVER (PARTITION BY recording_id, run ORDER BY us RANGE BETWEEN CURRENT ROW AND 1600000 FOLLOWING) AS ahead
  FROM hr
  WINDOW w AS (PARTITION BY recording_id, run ORDER BY us)),
hz AS (
  SELECT *,
    min(us) FILTER (smooth <= -2) OVER (PARTITION BY recording_id, run, over2) AS z2,
    min(us) FILTER (smooth <= -1.8) OVER (PARTITION BY recording_id, run, over18) AS z18
  FROM ha
  WHERE ahead <= -2),
pr AS (
  SELECT s.recording_id, s.i, s.us, s.smooth AS a0, p.i AS pi, p.us AS pus, p.smooth AS a1, p.jerk AS j1,
    s.smooth - p.smooth AS fall,
    (p.us - s.us) / 1e6 AS secs,
    p.us - greatest(p.z2, s.nxt) AS d2,
    p.us - greatest(p.z18, s.nxt) AS d18,
    least(s.jerk, min(p.jerk) OVER w) AS jm,
    least(s.smooth, min(p.smooth) OVER w) AS am
  FROM hz s
  JOIN hz p ON p.recording_id = s.recording_id AND p.run = s.run AND p.us > s.us AND p.us <= s.us + 1600000
  WINDOW w AS (PARTITION BY s.recording_id, s.i ORDER BY p.us)),
ju AS (
  SELECT *, 'primary_decel_jump' AS kind,
    round(greatest(abs(a1) - 2, 0) * 30 + greatest(abs(jm) - 2, 0) * 20 + greatest(fall - 3, 0) * 30 + greatest(fall / secs - 3, 0) * 20, 3) AS sev
  FROM pr
  WHERE a1 <= -2 AND j1 <= -2 AND fall >= 3 AND d2 >= 200000 AND fall / secs >= 3
  QUALIFY row_number() OVER (PARTITION BY recording_id, i ORDER BY fall DESC, d2 DESC, pus) = 1),
de AS (
  SELECT *,
    CASE WHEN fall >= 2.6 AND d18 <= 120000 AND jm <= -10 THEN 'deep_short_spike'
      WHEN fall >= 1.3 AND d18 >= 350000 AND jm <= -5 THEN 'deep_sustained_brake' END AS kind,
    round(greatest(abs(am) - 2.7, 0) * 30 + greatest(abs(jm) - 2, 0) * 20 + greatest(fall - 1.3, 0) * 30 + greatest(fall / secs - 3, 0) * 20, 3) AS sev
  FROM pr
  WHERE a1 <= -2.7
    AND (recording_id, i) NOT IN (SELECT (recording_id, i) FROM ju)),
ca AS (
  SELECT recording_id, i, us, pi, pus, a0, kind, sev FROM ju
  UNION ALL
  SELECT recording_id, i, us, pi, pus, a0, kind, sev FROM de
  WHERE kind IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY recording_id, i ORDER BY sev DESC, pus) = 1),
cn AS (
  SELECT ca.*, n.i AS ni
  FROM ca
  ASOF LEFT JOIN ca n ON ca.recording_id = n.recording_id AND ca.pi < n.i),
ch AS (
  SELECT * FROM cn
  WHERE (recording_id, i) IN (SELECT (recording_id, min(i)) FROM cn GROUP BY recording_id)
  UNION ALL
  SELECT cn.*
  FROM ch
  JOIN cn ON cn.recording_id = ch.recording_id AND cn.i = ch.ni),
cl AS (
  SELECT *, lag(pus) OVER (PARTITION BY recording_id ORDER BY us) AS last_
  FROM ch),
cg AS (
  SELECT *, count(*) FILTER (last_ IS NULL OR us - last_ > 500000) OVER (PARTITION BY recording_id ORDER BY us) AS part
  FROM cl),
me AS (
  SELECT recording_id, min(us) AS start_us, max(pus) AS end_us, count(*) AS n, min_by(a0, us) AS a0, max(sev) AS sev,
    list_reduce(list(kind ORDER BY us), lambda x, y: CASE WHEN x = y THEN x WHEN x = 'primary_decel_jump' OR y = 'primary_decel_jump' THEN 'mixed_primary_and_supplemental' ELSE 'mixed_supplemental' END) AS kind
  FROM cg
  GROUP BY recording_id, part),
mw AS (
  SELECT me.recording_id, start_us, min(smooth) AS am, min(jerk) AS jm
  FROM me
  JOIN hv ON hv.recording_id = me.recording_id AND us BETWEEN start_us AND end_us
  WHERE n > 1
  GROUP BY ALL)
SELECT recording_id, start_us, end_us, kind, n,
  CASE WHEN n = 1 THEN sev
    ELSE round(greatest(abs(am) - 2, 0) * 30 + greatest(abs(jm) - 2, 0) * 20 + greatest(a0 - am - 3, 0) * 30 + greatest((a0 - am) / ((end_us - start_us) / 1e6) - 3, 0) * 20, 3) END AS severity
FROM me
LEFT JOIN mw USING (recording_id, start_us)"""
)
_PULLED = """,
gf AS (SELECT * REPLACE (acceleration + 9.80665e0 * sin(radians(slope_deg)) AS acceleration), ctl AS gctl FROM f)"""
_AFTER = INCIDENT_SQL["acc_heavy_braking_after_override_release_count"]
_AFTER = GATED + _AFTER[len(FRAME) : _AFTER.index("n3 AS (")].replace("acceleration, ctl,", "acceleration, gctl AS ctl,").replace("WHEN ctl THEN", "WHEN gctl THEN").replace("FROM f WINDOW", "FROM gf WINDOW")
AFTER_RELEASE = f"""{_AFTER}n3 AS (
  SELECT *, coalesce(acceleration < -2, false) AS low
  FROM n2),
go AS (
  SELECT recording_id, release, onset
  FROM n3
  GROUP BY ALL
  HAVING NOT coalesce(max_by(low, us) FILTER (us < release), false)
    AND ((bool_or(bo) AND max(brake - k0) FILTER (us >= onset) >= 120) OR (bool_or(dn) AND max(d0 - drive) FILTER (us >= onset) >= 80))),
sc AS (
  SELECT n3.*
  FROM n3
  JOIN go USING (recording_id, release, onset)
  WHERE us >= release),
rs AS ({runs('sc', 'low', 'min(acceleration) AS least_, min(jerk) AS jerk', 'recording_id, release, onset')})
SELECT recording_id, a AS start_us, b AS end_us, round(greatest(-least_ - 2, 0) * 60 + greatest(-jerk - 3, 0) * 40, 3) AS severity
FROM rs
WHERE a <= release + 200000 AND b >= onset AND b - a >= 200000 AND jerk < -3
QUALIFY row_number() OVER (PARTITION BY recording_id, release ORDER BY onset, a) = 1"""
REACH = (
    PLANNER
    + GATED[len(FRAME) :]
    + f""",
pk AS (
  SELECT recording_id, us, road
  FROM pf
  WHERE us // 100000 % 4 = 0),
k1 AS (
  SELECT gf.*, b.us AS kb, b.road AS rb
  FROM gf
  ASOF LEFT JOIN pk b ON gf.recording_id = b.recording_id AND gf.us >= b.us),
k2 AS (
  SELECT k1.*, n.us AS kn, n.road AS rn,
    floor(set_speed * (floor(1000 * {_bias("set_speed")} + 0.5) / 1000) + 0.5) AS wanted
  FROM k1
  ASOF LEFT JOIN pk n ON k1.recording_id = n.recording_id AND k1.us <= n.us),
k3 AS (
  SELECT *, CASE WHEN kn IS NULL OR us - kb <= kn - us THEN us - kb <= 300000 AND rb ELSE kn - us <= 300000 AND rn END AS open_
  FROM k2)
SELECT recording_id, a AS start_us, b AS end_us, most < wmax AS bad, round(greatest(wmax - most, 0), 3) AS severity
FROM ({runs("k3", "gctl AND set_speed > 0 AND open_ AND abs(shown - wanted) <= 1.5", "max(shown) AS most, min(shown) AS least_, max(wanted) AS wmax, min(wanted) AS wmin")})
WHERE b - a >= 8000000 AND most - least_ <= 2 AND wmax - wmin <= 1e-6"""
)


def gated_set_speed_reach(spark, sf_dir):
    told = drives(spark, sf_dir).where("(us div 100000) % 4 = 0")
    return _gated(lambda frame: X.set_speed_reach(frame, _as_planner(told)))(spark, sf_dir)


QUERIES: dict = {
    "gated_heavy_braking": _gated(B.heavy_braking),
    "planner_heavy_braking": lambda spark, sf_dir: B.planner_heavy_braking(planner_frames(spark, sf_dir)),
    "gated_braking_after_release": _gated(lambda frame: T.braking_after_release(frame, raw=True)),
    "gated_set_speed_reach": gated_set_speed_reach,
}
ORACLE: dict[str, str] = {"gated_heavy_braking": GATED + HEAVY, "planner_heavy_braking": FRAME + _PULLED + HEAVY, "gated_braking_after_release": AFTER_RELEASE, "gated_set_speed_reach": REACH}
