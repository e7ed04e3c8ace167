"""Report figures over the event, lineitem and order tables, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import reports as R, windows as W
from .signal_queries import EVENTS, HOUR, K, ORDER, events

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE[f.__name__] = f, sql
        return f

    return add


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("SELECT l_returnflag, l_linestatus, round(avg(l_extendedprice), 4) AS mean_value, count(l_extendedprice) AS n FROM lineitem GROUP BY ALL")
def measurement_mean(spark, sf_dir):
    out = R.measurement_mean(_table(spark, sf_dir, "lineitem").withColumn("v", F.col("l_extendedprice").cast("double")), "v", ["l_returnflag", "l_linestatus"])
    return out.withColumn("mean_value", F.round("mean_value", 4))


@query("SELECT user_id, round(coalesce(max(CASE WHEN value > 60 THEN value END), 0), 3) AS severity FROM events GROUP BY user_id")
def max_severity(spark, sf_dir):
    return R.max_severity(_table(spark, sf_dir, "events").withColumn("severity", F.when(F.col("value") > 60, F.col("value"))), K)


@query("""WITH r AS (SELECT o_custkey, CASE o_orderstatus WHEN 'P' THEN 'SKIPPED' WHEN 'F' THEN 'ERROR' ELSE 'OK' END AS s FROM orders)
SELECT o_custkey, CASE WHEN bool_and(s IN ('SKIPPED', 'ERROR')) THEN 'none' WHEN bool_or(s IN ('SKIPPED', 'ERROR')) THEN 'partly' ELSE 'all' END AS counting FROM r GROUP BY o_custkey""")
def counting_status(spark, sf_dir):
    state = F.when(F.col("o_orderstatus") == "P", "SKIPPED").when(F.col("o_orderstatus") == "F", "ERROR").otherwise("OK")
    return R.counted(_table(spark, sf_dir, "orders").withColumn("status", state), ["o_custkey"])


@query(f"""WITH {EVENTS}, p AS (SELECT user_id, t, lead(CASE WHEN event_type <> 'view' THEN t END) OVER (PARTITION BY user_id ORDER BY t, event_id) AS b FROM e)
SELECT user_id, count(b) AS matched, count(*) FILTER (abs(t - b)::DOUBLE > {12 * HOUR} + greatest(1e-9, 4 * 2.220446049250313e-16 * greatest(abs(t), abs(b)))) AS exceeded, max(abs(t - b))::DOUBLE AS max_lag FROM p GROUP BY user_id""")
def sync_summary(spark, sf_dir):
    from pyspark.sql import Window

    follow = F.lead(F.when(F.col("event_type") != "view", F.col("t"))).over(Window.partitionBy("user_id").orderBy(*ORDER))
    return R.sync_summary(events(spark, sf_dir).withColumn("b", follow), K, "t", "b", 12 * HOUR)


@query(f"WITH {EVENTS}, f AS (SELECT user_id, event_type, min(t) AS at FROM e GROUP BY ALL) SELECT user_id, string_agg(event_type, ',' ORDER BY at, event_type) AS kinds FROM f GROUP BY user_id".replace(" AS at", " AS first_").replace("BY at,", "BY first_,"))
def ordered_distinct(spark, sf_dir):
    return R.ordered_distinct(events(spark, sf_dir), K, "event_type", "t").select("user_id", F.array_join("values", ",").alias("kinds"))


@query("""WITH m AS (SELECT event_type, max(value) + 1 AS upper FROM events WHERE value >= 0 GROUP BY event_type), w AS (SELECT event_type, CASE WHEN upper <= 12 THEN 0.5 WHEN upper <= 35 THEN 1.0 WHEN upper <= 80 THEN 2.0 ELSE 5.0 END AS width FROM m)
SELECT event_type, (floor(value / width) * width)::DOUBLE AS bin, count(*) AS n FROM events JOIN w USING (event_type) WHERE value >= 0 GROUP BY ALL""")
def adaptive_histogram(spark, sf_dir):
    return R.adaptive_histogram(_table(spark, sf_dir, "events"), "value", ["event_type"])


@query("SELECT user_id, round(max(value) - min(value), 6) AS span, round(sqrt(avg(value * value)), 6) AS rms, max(abs(value)) AS abs_peak, min(value) AS low, max(value) AS high, round(quantile_cont(value, 0.95), 6) AS p95 FROM events GROUP BY user_id")
def finite_statistics(spark, sf_dir):
    out = R.finite_stats(_table(spark, sf_dir, "events"), "value", K)
    return out.withColumns({c: F.round(c, 6) for c in ("span", "rms", "p95")})


@query(f"""WITH {EVENTS}, n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) - 1 AS x FROM e), r AS (SELECT user_id, regr_slope(value, x) AS a, regr_intercept(value, x) AS b FROM n GROUP BY user_id)
SELECT event_id, user_id, round(value - (a * x + b), 6) AS rest FROM n JOIN r USING (user_id)""")
def detrended(spark, sf_dir):
    return R.detrend(events(spark, sf_dir), "value", K, ORDER, "rest").select("event_id", "user_id", F.round("rest", 6).alias("rest"))


@query(f"""WITH {EVENTS}, s AS (SELECT user_id, sign(value - 15) AS s, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS k FROM e WHERE abs(value - 15) > 0.04), f AS (SELECT user_id, s <> lag(s) OVER (PARTITION BY user_id ORDER BY k) AS f FROM s)
SELECT user_id, coalesce(count(*) FILTER (f), 0) AS crossings FROM (SELECT DISTINCT user_id FROM e) LEFT JOIN f USING (user_id) GROUP BY user_id""")
def zero_crossings(spark, sf_dir):
    return R.zero_crossings(events(spark, sf_dir).withColumn("x", F.col("value") - 15), "x", K, ORDER)


@query(f"""WITH {EVENTS}, p AS (SELECT *, quantile_cont(value, 0.1) OVER (PARTITION BY user_id) AS lo, quantile_cont(value, 0.9) OVER (PARTITION BY user_id) AS hi FROM e), o AS (SELECT *, value > lo + greatest((hi - lo) * 0.35, 5) AS above FROM p),
c AS (SELECT *, above OR coalesce(lag(above) OVER w AND lead(above) OVER w, false) AS m FROM o WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)), g AS (SELECT *, sum(CASE WHEN m AND NOT coalesce(pm, false) THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY t, event_id) AS run FROM (SELECT *, lag(m) OVER (PARTITION BY user_id ORDER BY t, event_id) AS pm FROM c)),
r AS (SELECT user_id, run, max(value) - min(lo) AS rise FROM g WHERE m GROUP BY ALL) SELECT user_id, count(*) FILTER (rise >= 20) AS pulses FROM (SELECT DISTINCT user_id FROM e) LEFT JOIN r USING (user_id) GROUP BY user_id""")
def pulse_count(spark, sf_dir):
    return R.pulse_count(events(spark, sf_dir), "value", 20.0, K, ORDER)


@query(
    f"""WITH RECURSIVE {EVENTS},
n AS (
  SELECT user_id, value,
    row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS k,
    count(*) OVER (PARTITION BY user_id) AS c
  FROM e),
y AS (
  SELECT a.user_id, a.k, sum(b.value) / 7 AS y
  FROM n a
  JOIN (SELECT unnest(range(-3, 4)) AS d) ON true
  JOIN n b ON b.user_id = a.user_id AND b.k = greatest(1, least(a.c, a.k + d))
  WHERE a.c >= 8
  GROUP BY a.user_id, a.k),
s AS (
  SELECT *, median(y) OVER (PARTITION BY user_id) AS mid,
    CASE WHEN abs(lead(y) OVER w - y) > 12e0 / 12 THEN sign(lead(y) OVER w - y) END AS step
  FROM y
  WINDOW w AS (PARTITION BY user_id ORDER BY k)),
f AS (SELECT *, last_value(step IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY k) AS way FROM s),
x AS (
  SELECT user_id, y, mid, row_number() OVER (PARTITION BY user_id ORDER BY k) AS i
  FROM (SELECT *, lag(way) OVER (PARTITION BY user_id ORDER BY k) AS before FROM f)
  WHERE way <> before),
r AS (
  SELECT user_id, i, y AS last, 1 AS turns FROM x WHERE i = 1
  UNION ALL
  SELECT x.user_id, x.i,
    CASE WHEN abs(y - last) >= 12 OR abs(y - mid) > abs(last - mid) THEN y ELSE last END,
    turns + CASE WHEN abs(y - last) >= 12 THEN 1 ELSE 0 END
  FROM r
  JOIN x ON x.user_id = r.user_id AND x.i = r.i + 1)
SELECT u.user_id, coalesce(max(turns), 0)::BIGINT AS turns
FROM (SELECT DISTINCT user_id FROM e) u
LEFT JOIN r ON r.user_id = u.user_id
GROUP BY u.user_id"""
)
def turn_count(spark, sf_dir):
    return R.turn_count(events(spark, sf_dir), "value", 12.0, K, ORDER)


@query(f"""WITH {EVENTS}, n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS k, count(*) OVER (PARTITION BY user_id) AS m FROM e),
b AS (SELECT n.event_id, n.user_id, sum(x.value) / 5 AS mean FROM n JOIN (SELECT unnest([-2, -1, 0, 1, 2]) AS d) o ON true JOIN n x ON x.user_id = n.user_id AND x.k = greatest(1, least(n.m, n.k + d)) GROUP BY ALL) SELECT event_id, user_id, round(mean, 6) AS mean_value FROM b""")
def box_mean(spark, sf_dir):
    return W.box_mean(events(spark, sf_dir), "value", 5, K, ORDER, "m").select("event_id", "user_id", F.round("m", 6).alias("mean_value"))


@query("SELECT event_id, event_type, CASE event_type WHEN 'click' THEN 'Click' WHEN 'view' THEN 'Page view' ELSE event_type END AS display_name FROM events WHERE event_type <> 'error'")
def display_names(spark, sf_dir):
    return R.display_names(_table(spark, sf_dir, "events").select("event_id", "event_type"), {"click": "Click", "view": "Page view"}, ["error"], "event_type")
