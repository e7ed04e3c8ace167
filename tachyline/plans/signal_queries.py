"""Operators on the event table taken as signals: user = recording, ts = time axis, value = sample, type = state.

Samples are hours apart there, so windows are hours wide. Each query stands with the SQL that gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators import alignment as A, segments as G, windows as W

HOUR = 3_600_000_000
K = ["user_id"]
ORDER = ["t", "event_id"]
QUERIES: dict = {}
ORACLE: dict[str, str] = {}
EVENTS = "e AS (SELECT event_id, user_id, event_type, value, epoch_us(ts) AS t FROM events)"


def query(name: str, sql: str):
    def add(f):
        QUERIES[name], ORACLE[name] = f, sql.replace("{events}", EVENTS)
        return f

    return add


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    micros = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', cast(ts as timestamp_ntz))")
    return rows.select("event_id", "user_id", "event_type", "value", micros.alias("t"))


ISLANDS = """WITH {events},
m AS (SELECT *, event_type IN ('error', 'view') AS m, lag(event_type IN ('error', 'view')) OVER w AS p FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)),
s AS (SELECT *, sum(CASE WHEN m AND NOT coalesce(p, false) THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY t, event_id) AS island FROM m)
SELECT user_id, island::BIGINT AS island, min(t) AS start_t, max(t) AS end_t, max(t) - min(t) AS duration, count(*) AS n FROM s WHERE m GROUP BY user_id, island"""
IN_STATE = "event_type in ('error', 'view')"


@query("islands_by_state", ISLANDS)
def islands_by_state(spark, sf_dir):
    return G.islands(events(spark, sf_dir), IN_STATE, K, ORDER, "t")


@query("islands_min_duration", ISLANDS + f" HAVING max(t) - min(t) >= {10 * HOUR}")
def islands_min_duration(spark, sf_dir):
    return G.islands(events(spark, sf_dir), IN_STATE, K, ORDER, "t", 10 * HOUR)


@query(
    "islands_split_on_key",
    """WITH {events},
m AS (SELECT *, value < 25 AS m, lag(value < 25) OVER w AS p, lag(event_type) OVER w AS q FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)),
s AS (SELECT *, sum(CASE WHEN m AND (NOT coalesce(p, false) OR q IS DISTINCT FROM event_type) THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY t, event_id) AS island FROM m)
SELECT user_id, island::BIGINT AS island, min(t) AS start_t, max(t) AS end_t, max(t) - min(t) AS duration, count(*) AS n, min(event_type) AS event_type FROM s WHERE m GROUP BY user_id, island""",
)
def islands_split_on_key(spark, sf_dir):
    return G.islands(events(spark, sf_dir), "value < 25", K, ORDER, "t", split_on="event_type", aggs=[F.min("event_type").alias("event_type")])


def _gaps(barrier: str) -> str:
    return f"""WITH {{events}},
a AS (SELECT *, value > 10 AS m, {barrier} AS ok, last_value(CASE WHEN value > 10 THEN t END IGNORE NULLS) OVER w AS l, sum(CASE WHEN value > 10 THEN 1 ELSE 0 END) OVER w AS run,
  first_value(CASE WHEN value > 10 THEN t END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS r
  FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)),
b AS (SELECT *, sum(CASE WHEN NOT m AND NOT ok THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, run) AS bad FROM a)
SELECT event_id, user_id, t, m OR coalesce(r - l <= {30 * HOUR} AND bad = 0, false) AS filled FROM b"""


@query("merge_short_gaps", _gaps("true"))
def merge_short_gaps(spark, sf_dir):
    return G.fill_short_gaps(events(spark, sf_dir), "value > 10", 30 * HOUR, K, ORDER, "t").select("event_id", "user_id", "t", "filled")


@query("merge_gaps_barrier", _gaps("event_type <> 'error'"))
def merge_gaps_barrier(spark, sf_dir):
    return G.fill_short_gaps(events(spark, sf_dir), "value > 10", 30 * HOUR, K, ORDER, "t", "event_type <> 'error'").select("event_id", "user_id", "t", "filled")


@query(
    "state_edges",
    """WITH {events}, a AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY t, event_id) AS previous FROM e)
SELECT event_id, user_id, t, event_type, previous FROM a WHERE previous IS NOT NULL AND previous <> event_type""",
)
def state_edges(spark, sf_dir):
    return G.edges(events(spark, sf_dir), "event_type", K, ORDER).select("event_id", "user_id", "t", "event_type", "previous")


@query(
    "post_edge_window",
    f"""WITH {{events}}, a AS (SELECT *, last_value(CASE WHEN event_type = 'signup' THEN t END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY t, event_id) AS l FROM e)
SELECT event_id, user_id, coalesce(t - l <= {12 * HOUR}, false) AS after_edge FROM a""",
)
def post_edge_window(spark, sf_dir):
    return G.after_edge(events(spark, sf_dir), "event_type = 'signup'", 12 * HOUR, K, ORDER, "t").select("event_id", "user_id", "after_edge")


@query(
    "full_coverage_window",
    f"""WITH {{events}}, s AS (SELECT *, sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY t, event_id) AS g, max(t) OVER (PARTITION BY user_id) AS stop FROM e),
b AS (SELECT *, min(t) OVER (PARTITION BY user_id, g) AS start_t FROM s)
SELECT user_id, start_t, count(*) AS n FROM b WHERE g > 0 AND t - start_t <= {24 * HOUR} GROUP BY user_id, g, start_t HAVING bool_and(value < 60) AND max(stop) >= start_t + {24 * HOUR}""",
)
def full_coverage_window(spark, sf_dir):
    return G.full_windows(events(spark, sf_dir), "event_type = 'click'", "value < 60", 24 * HOUR, K, ORDER, "t")


SIDES = """WITH {events}, x AS (SELECT * FROM e WHERE event_type = 'error'), y AS (SELECT user_id, t, min_by(value, event_id) AS first_v, max_by(value, event_id) AS last_v FROM e WHERE event_type = 'purchase' GROUP BY user_id, t),
p AS (SELECT x.*, b.t AS bt, CASE WHEN b.t = x.t THEN b.first_v ELSE b.last_v END AS bv FROM x ASOF LEFT JOIN y b ON x.user_id = b.user_id AND x.t >= b.t),
q AS (SELECT p.*, f.t AS ft, f.first_v AS fv FROM p ASOF LEFT JOIN y f ON p.user_id = f.user_id AND p.t <= f.t) """


def _asof(spark, sf_dir, direction, tolerance=None):
    rows = events(spark, sf_dir)
    axis, signal = rows.where("event_type = 'error'").select("event_id", "user_id", "t"), rows.where("event_type = 'purchase'")
    return A.asof(axis, signal, K, "t", ["value"], direction, tolerance, ["event_id"])


@query("asof_nearest", SIDES + "SELECT event_id, user_id, t, CASE WHEN ft IS NULL OR t - bt <= ft - t THEN bv ELSE fv END AS value, CASE WHEN ft IS NULL OR t - bt <= ft - t THEN bt ELSE ft END AS match_t, least(t - bt, ft - t) AS gap FROM q")
def asof_nearest(spark, sf_dir):
    return _asof(spark, sf_dir, "nearest")


@query(
    "asof_tolerance",
    SIDES + f"SELECT event_id, user_id, t, CASE WHEN least(t - bt, ft - t) <= {20 * HOUR} THEN CASE WHEN ft IS NULL OR t - bt <= ft - t THEN bv ELSE fv END END AS value, CASE WHEN least(t - bt, ft - t) <= {20 * HOUR} THEN CASE WHEN ft IS NULL OR t - bt <= ft - t THEN bt ELSE ft END END AS match_t, least(t - bt, ft - t) AS gap FROM q",
)
def asof_tolerance(spark, sf_dir):
    return _asof(spark, sf_dir, "nearest", 20 * HOUR)


@query("asof_pad", SIDES + "SELECT event_id, user_id, t, bv AS value, bt AS match_t, t - bt AS gap FROM q")
def asof_pad(spark, sf_dir):
    return _asof(spark, sf_dir, "pad")


@query("asof_backfill", SIDES + "SELECT event_id, user_id, t, fv AS value, ft AS match_t, ft - t AS gap FROM q")
def asof_backfill(spark, sf_dir):
    return _asof(spark, sf_dir, "backfill")


@query(
    "gate_join",
    SIDES + f", g AS (SELECT event_id, user_id, t, CASE WHEN least(t - bt, ft - t) <= {150 * HOUR} THEN CASE WHEN ft IS NULL OR t - bt <= ft - t THEN bv ELSE fv END END AS value FROM q) SELECT event_id, user_id, t, value FROM (SELECT *, bool_and(value IS NOT NULL) OVER (PARTITION BY user_id) AS covered FROM g) WHERE covered",
)
def gate_join(spark, sf_dir):
    rows = events(spark, sf_dir)
    axis, signal = rows.where("event_type = 'error'").select("event_id", "user_id", "t"), rows.where("event_type = 'purchase'")
    return A.gate(axis, signal, K, "t", "value", 150 * HOUR, ["event_id"]).select("event_id", "user_id", "t", "value")


STEP = 24 * HOUR
TICKS = f"""WITH {{events}}, g AS (SELECT user_id, unnest(range((ceil(min(t) / {STEP}))::BIGINT, (floor(max(t) / {STEP}))::BIGINT + 1)) * {STEP} AS t FROM e GROUP BY user_id),
y AS (SELECT user_id, t, min_by(value, event_id) AS f, max_by(value, event_id) AS l FROM e GROUP BY user_id, t),
p AS (SELECT g.user_id, g.t, b.t AS bt, CASE WHEN b.t = g.t THEN b.f ELSE b.l END AS bv FROM g ASOF LEFT JOIN y b ON g.user_id = b.user_id AND g.t >= b.t),
q AS (SELECT p.*, c.t AS ft, c.f AS fv FROM p ASOF LEFT JOIN y c ON p.user_id = c.user_id AND p.t <= c.t) """


@query("grid_resample_hold", TICKS + "SELECT user_id, t, bv AS value FROM q")
def grid_resample_hold(spark, sf_dir):
    return A.resample(events(spark, sf_dir).select("user_id", "t", "value", "event_id"), K, "t", "value", STEP, "hold", ["event_id"])


@query("grid_resample_linear", TICKS + "SELECT user_id, t, round(CASE WHEN bt = ft THEN bv ELSE bv + (fv - bv) * ((t - bt)::DOUBLE / (ft - bt)) END, 6) AS value FROM q")
def grid_resample_linear(spark, sf_dir):
    out = A.resample(events(spark, sf_dir).select("user_id", "t", "value", "event_id"), K, "t", "value", STEP, "linear", ["event_id"])
    return out.withColumn("value", F.round("value", 6))


@query(
    "common_range",
    """WITH {events}, r AS (SELECT user_id, event_type, min(t) AS a, max(t) AS b FROM e GROUP BY ALL)
SELECT user_id, max(a) AS start_t, min(b) AS end_t FROM r GROUP BY user_id HAVING max(a) <= min(b)""",
)
def common_range(spark, sf_dir):
    return A.common_range(events(spark, sf_dir), K, "event_type", "t")


AT = 1_705_000_000_000_000


@query("point_lookup", f"WITH {{events}}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY abs(t - {AT}), t, event_id) AS k FROM e) SELECT user_id, t, value FROM r WHERE k = 1")
def point_lookup(spark, sf_dir):
    return A.point_lookup(events(spark, sf_dir), K, "t", AT, ["value"], ["event_id"]).select("user_id", "t", "value")


@query("range_slice", f"WITH {{events}} SELECT event_id, user_id, t, value FROM e WHERE t BETWEEN {AT} AND {AT + 48 * HOUR}")
def range_slice(spark, sf_dir):
    return events(spark, sf_dir).where(F.col("t").between(AT, AT + 48 * HOUR)).select("event_id", "user_id", "t", "value")


@query(
    "union_recordings",
    f"""WITH {{events}}, r AS (SELECT user_id, min(t) AS start_t, max(t) - min(t) AS duration, event_type FROM e GROUP BY user_id, event_type),
n AS (SELECT *, lead(start_t) OVER (PARTITION BY user_id ORDER BY start_t) AS next_start FROM r)
SELECT user_id, event_type, start_t, duration, next_start, coalesce(abs(next_start - start_t - duration) <= {400 * HOUR}, false) AS continuous FROM n""",
)
def union_recordings(spark, sf_dir):
    rows = events(spark, sf_dir).groupBy("user_id", "event_type").agg(F.min("t").alias("start_t"), (F.max("t") - F.min("t")).alias("duration"))
    return A.continuous_pairs(rows, K, "start_t", "duration", 400 * HOUR).select("user_id", "event_type", "start_t", "duration", "next_start", "continuous")


@query(
    "dedup_first_wins",
    f"""WITH RECURSIVE {{events}}, n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t, event_type, event_id) AS k FROM e),
r AS (SELECT event_id, user_id, t, k, t AS kept FROM n WHERE k = 1 UNION ALL SELECT n.event_id, n.user_id, n.t, n.k, CASE WHEN n.t - r.kept > {20 * HOUR} THEN n.t ELSE r.kept END FROM r JOIN n ON n.user_id = r.user_id AND n.k = r.k + 1),
f AS (SELECT *, kept = t AND (k = 1 OR kept <> lag(kept) OVER (PARTITION BY user_id ORDER BY k)) AS stays FROM r) SELECT event_id, user_id, t FROM f WHERE stays""",
)
def dedup_first_wins(spark, sf_dir):
    return A.merge_samples(events(spark, sf_dir), K, "t", "event_type", 20 * HOUR, ["event_id"]).select("event_id", "user_id", "t")


@query("priority_fallback", "WITH {events}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY CASE event_type WHEN 'purchase' THEN 0 WHEN 'error' THEN 1 ELSE 2 END, t, event_id) AS k FROM e) SELECT user_id, event_type, event_id, value FROM r WHERE k = 1")
def priority_fallback(spark, sf_dir):
    rank = F.when(F.col("event_type") == "purchase", 0).when(F.col("event_type") == "error", 1).otherwise(2)
    return A.priority_pick(events(spark, sf_dir), K, [rank, "t", "event_id"]).select("user_id", "event_type", "event_id", "value")


def _frame(h: int) -> str:
    return f"(PARTITION BY user_id ORDER BY t RANGE BETWEEN {h * HOUR} PRECEDING AND {h * HOUR} FOLLOWING)"


@query("time_window_mean", f"WITH {{events}} SELECT event_id, user_id, round(avg(value) OVER {_frame(24)}, 6) AS mean_value FROM e")
def time_window_mean(spark, sf_dir):
    return W.time_mean(events(spark, sf_dir), "value", 48 * HOUR, K, "t", "m").select("event_id", "user_id", F.round("m", 6).alias("mean_value"))


SLOPE = f"CASE WHEN count(value) OVER w >= 3 AND max(t) OVER w - min(t) OVER w >= {24 * HOUR} THEN regr_slope(value, (t - o)::DOUBLE / {HOUR}) OVER w END"


@query("time_window_slope", f"WITH {{events}}, b AS (SELECT *, min(t) OVER (PARTITION BY user_id) AS o FROM e) SELECT event_id, user_id, round({SLOPE}, 6) AS slope FROM b WINDOW w AS {_frame(24)}")
def time_window_slope(spark, sf_dir):
    return W.time_slope(events(spark, sf_dir), "value", 48 * HOUR, K, "t", "s", HOUR).select("event_id", "user_id", F.round("s", 6).alias("slope"))


@query(
    "sustained_rate",
    f"""WITH {{events}}, a AS (SELECT event_id, user_id, t, avg(value) OVER {_frame(24)} AS value, min(t) OVER (PARTITION BY user_id) AS o FROM e)
SELECT event_id, user_id, round({SLOPE}, 6) AS rate FROM a WINDOW w AS {_frame(24)}""",
)
def sustained_rate(spark, sf_dir):
    rows = W.time_mean(events(spark, sf_dir), "value", 48 * HOUR, K, "t", "m")
    return W.time_slope(rows, "m", 48 * HOUR, K, "t", "rate", HOUR).select("event_id", "user_id", F.round("rate", 6).alias("rate"))


@query("highpass", f"WITH {{events}} SELECT event_id, user_id, round(avg(value) OVER {_frame(12)} - avg(value) OVER {_frame(72)}, 6) AS high FROM e")
def highpass(spark, sf_dir):
    return W.highpass(events(spark, sf_dir), "value", 24 * HOUR, 144 * HOUR, K, "t", "h").select("event_id", "user_id", F.round("h", 6).alias("high"))


@query(
    "backward_derivative",
    f"""WITH {{events}}, a AS (SELECT *, (t - lag(t) OVER w)::DOUBLE / {HOUR} AS dt, value - lag(value) OVER w AS dv FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)),
b AS (SELECT *, CASE WHEN dt <= 1e-9 THEN 0.0 ELSE dv / dt END AS d FROM a)
SELECT event_id, user_id, round(coalesce(d, lead(d) OVER (PARTITION BY user_id ORDER BY t, event_id)), 6) AS rate FROM b""",
)
def backward_derivative(spark, sf_dir):
    return W.derivative(events(spark, sf_dir), "value", K, ORDER, "t", "d", HOUR).select("event_id", "user_id", F.round("d", 6).alias("rate"))


@query(
    "sign_flips",
    """WITH {events}, d AS (SELECT user_id, t, event_id, value - lag(value) OVER (PARTITION BY user_id ORDER BY t, event_id) AS d FROM e),
s AS (SELECT user_id, sign(d) <> lag(sign(d)) OVER (PARTITION BY user_id ORDER BY t, event_id) AS f FROM d WHERE d <> 0)
SELECT user_id, coalesce(count(*) FILTER (f), 0) AS flips FROM s GROUP BY user_id""",
)
def sign_flips(spark, sf_dir):
    d = F.col("value") - F.lag("value").over(Window.partitionBy("user_id").orderBy(*ORDER))
    return W.sign_flips(events(spark, sf_dir).withColumn("d", d), "d", K, ORDER)


@query("forward_amplitude", f"WITH {{events}}, a AS (SELECT user_id, max(value) OVER w - min(value) OVER w AS a FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t RANGE BETWEEN CURRENT ROW AND {48 * HOUR} FOLLOWING)) SELECT user_id, max(a) AS amplitude FROM a GROUP BY user_id")
def forward_amplitude(spark, sf_dir):
    return W.forward_amplitude(events(spark, sf_dir), "value", 48 * HOUR, K, "t")


@query(
    "segment_argmin_time",
    """WITH {events} SELECT user_id, event_type, min(value) AS min_value, (min(row(value, t))).t AS min_t, max(value) AS max_value, min(t) FILTER (value = m) AS max_t
FROM (SELECT *, max(value) OVER (PARTITION BY user_id, event_type) AS m FROM e) GROUP BY user_id, event_type""".replace("(min(row(value, t))).t", "min(t) FILTER (value = l)").replace("max(value) OVER (PARTITION BY user_id, event_type) AS m", "max(value) OVER (PARTITION BY user_id, event_type) AS m, min(value) OVER (PARTITION BY user_id, event_type) AS l"),
)
def segment_argmin_time(spark, sf_dir):
    return W.extremes(events(spark, sf_dir), "value", ["user_id", "event_type"], "t")


@query("segment_median", "WITH {events} SELECT user_id, round(median(value), 6) AS median_value, count(*) AS n FROM e WHERE event_type = 'view' GROUP BY user_id")
def segment_median(spark, sf_dir):
    return events(spark, sf_dir).where("event_type = 'view'").groupBy("user_id").agg(F.round(F.median("value"), 6).alias("median_value"), F.count("*").alias("n"))


@query(
    "segment_dynamic_bound",
    """WITH {events}, s AS (SELECT user_id, min(value) AS low, min_by(value, t) AS start_v FROM e GROUP BY user_id)
SELECT user_id, low, round(greatest(least(-start_v / 5.5, -1.75), -4.0) - 1, 6) AS bound, round(greatest(0.0, (greatest(least(-start_v / 5.5, -1.75), -4.0) - 1) - (low - 10)) / 2 * 100, 3) AS severity FROM s""",
)
def segment_dynamic_bound(spark, sf_dir):
    from ..operators.kpi import severity_outside

    s = events(spark, sf_dir).groupBy("user_id").agg(F.min("value").alias("low"), F.min_by("value", "t").alias("v"))
    bound = F.greatest(F.least(-F.col("v") / 5.5, F.lit(-1.75)), F.lit(-4.0)) - 1
    return s.select("user_id", "low", F.round(bound, 6).alias("bound"), severity_outside(F.col("low") - 10, bound, None, 2).alias("severity"))


@query(
    "stable_value_window",
    f"""WITH {{events}}, a AS (SELECT event_id, user_id, t FROM e WHERE event_type = 'signup'),
j AS (SELECT a.event_id, a.user_id, a.t, b.value, b.t AS bt FROM a JOIN e b ON a.user_id = b.user_id AND b.t BETWEEN a.t + {HOUR} AND a.t + {72 * HOUR})
SELECT event_id, user_id, round(median(value), 6) AS median_value, count(*) AS n, max(value) - min(value) AS span FROM j GROUP BY event_id, user_id HAVING count(*) >= 3""",
)
def stable_value_window(spark, sf_dir):
    rows = events(spark, sf_dir)
    stops = rows.where("event_type = 'signup'").select("event_id", "user_id", F.col("t").alias("t0"))
    near = A.band_join(stops, rows.select("user_id", "t", "value"), K, "t0", "t", 72 * HOUR).where(F.col("t") >= F.col("t0") + HOUR)
    return near.groupBy("event_id", "user_id").agg(F.round(F.median("value"), 6).alias("median_value"), F.count("*").alias("n"), (F.max("value") - F.min("value")).alias("span")).where("n >= 3")


@query(
    "band_join_peak_pairs",
    f"""WITH {{events}}, a AS (SELECT * FROM e WHERE event_type = 'error' AND value > 15), b AS (SELECT * FROM e WHERE event_type = 'purchase' AND value > 15),
j AS (SELECT a.event_id, a.user_id, a.value AS peak, b.event_id AS pair_id, b.value AS pair_value, abs(a.t - b.t) AS lag FROM a JOIN b ON a.user_id = b.user_id AND abs(a.t - b.t) <= {48 * HOUR})
SELECT event_id, user_id, peak, pair_id, pair_value, lag FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY pair_value DESC, lag, pair_id) AS k FROM j) WHERE k = 1""",
)
def band_join_peak_pairs(spark, sf_dir):
    rows = events(spark, sf_dir).where("value > 15")
    left = rows.where("event_type = 'error'").select("event_id", "user_id", "t", F.col("value").alias("peak"))
    right = rows.where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("pair_id"), F.col("value").alias("pair_value"), F.col("t").alias("pair_t"))
    pairs = A.band_join(left, right, K, "t", "pair_t", 48 * HOUR).withColumn("lag", F.abs(F.col("t") - F.col("pair_t")))
    best = pairs.groupBy("event_id", "user_id", "peak").agg(F.max_by(F.struct("pair_id", "pair_value", "lag"), F.struct("pair_value", -F.col("lag"), -F.col("pair_id"))).alias("b"))
    return best.select("event_id", "user_id", "peak", "b.*")


SCENES = """WITH {events}, m AS (SELECT *, event_type IN ('error', 'view') AS m, lag(event_type IN ('error', 'view')) OVER (PARTITION BY user_id ORDER BY t, event_id) AS p FROM e),
s AS (SELECT *, sum(CASE WHEN m AND NOT coalesce(p, false) THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY t, event_id) AS g FROM m),
i AS (SELECT user_id, min(t) AS start_t, max(t) AS end_t FROM s WHERE m GROUP BY user_id, g),
v AS (SELECT user_id, t AS event_start, t + 21600000000 AS event_end FROM e WHERE value > 30) """


def _scenes(spark, sf_dir, how):
    rows = events(spark, sf_dir)
    scenes = G.islands(rows, IN_STATE, K, ORDER, "t").select("user_id", "start_t", "end_t")
    marks = rows.where("value > 30").select("user_id", F.col("t").alias("event_start"), (F.col("t") + 6 * HOUR).alias("event_end"))
    return A.overlapping(scenes, marks, K, 24 * HOUR, how)


@query("event_overlap_join", SCENES + "SELECT user_id, start_t, end_t FROM i WHERE EXISTS (SELECT 1 FROM v WHERE v.user_id = i.user_id AND event_end >= start_t AND event_start <= end_t)")
def event_overlap_join(spark, sf_dir):
    return _scenes(spark, sf_dir, "left_semi")


@query("event_exclusion_join", SCENES + "SELECT user_id, start_t, end_t FROM i WHERE NOT EXISTS (SELECT 1 FROM v WHERE v.user_id = i.user_id AND event_end >= start_t AND event_start <= end_t)")
def event_exclusion_join(spark, sf_dir):
    return _scenes(spark, sf_dir, "left_anti")


@query("props_json", "SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def props_json(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    return rows.select("event_id", "user_id", F.from_json("props", "k long")["k"].alias("k"))


@query("distribution_events", "WITH {events} SELECT event_type, count(value) AS n, min(value) AS min_value, round(quantile_cont(value, 0.1), 6) AS p10, round(median(value), 6) AS median_value, round(avg(value), 6) AS mean_value, round(quantile_cont(value, 0.9), 6) AS p90, max(value) AS max_value, count(*) FILTER (value BETWEEN 3.5 AND 5) AS in_band, round(count(*) FILTER (value BETWEEN 3.5 AND 5) / count(value), 9) AS band_share FROM e GROUP BY event_type")
def distribution_events(spark, sf_dir):
    out = W.distribution(events(spark, sf_dir), "value", ["event_type"], 3.5, 5)
    return out.select("event_type", "n", "min_value", *(F.round(c, 6).alias(c) for c in ("p10", "median_value", "mean_value", "p90")), "max_value", "in_band", F.round("band_share", 9).alias("band_share"))


@query(
    "pad_mismatch_count",
    SIDES + "SELECT user_id, count(bv) AS compared, count(*) FILTER (bv IS NOT NULL AND (bv > 10) <> (value > 10)) AS mismatches FROM q GROUP BY user_id",
)
def pad_mismatch_count(spark, sf_dir):
    rows = events(spark, sf_dir)
    axis = rows.where("event_type = 'error'").select("event_id", "user_id", "t", F.col("value").alias("own"))
    joined = A.asof(axis, rows.where("event_type = 'purchase'"), K, "t", ["value"], "pad", tie=["event_id"])
    return joined.groupBy("user_id").agg(F.count("value").alias("compared"), F.count_if(F.col("value").isNotNull() & ((F.col("value") > 10) != (F.col("own") > 10))).alias("mismatches"))


@query(
    "continuation_suppression",
    """WITH {events}, m AS (SELECT *, value > 12 AS m, lag(value > 12) OVER (PARTITION BY user_id ORDER BY t, event_id) AS p, t // 86400000000 AS day FROM e),
s AS (SELECT *, sum(CASE WHEN m AND NOT coalesce(p, false) THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY t, event_id) AS g FROM m)
SELECT user_id, first_day AS day, count(*) AS scenes FROM (SELECT user_id, g, min(day) AS first_day FROM s WHERE m GROUP BY user_id, g) GROUP BY user_id, first_day""",
)
def continuation_suppression(spark, sf_dir):
    """Scenes that go on from one day's recording into the next count on the day they begin."""
    rows = events(spark, sf_dir).withColumn("day", F.expr("t div 86400000000"))
    runs = G.islands(rows, "value > 12", K, ORDER, "t", aggs=[F.min("day").alias("day")])
    return runs.groupBy("user_id", "day").agg(F.count("*").alias("scenes"))


PATHS = """CASE event_type
    WHEN 'view' THEN 'ch5/net/db/Req_0x1A0/signals/Active'
    WHEN 'click' THEN CASE WHEN user_id % 3 = 0 THEN 'root/ch1/net/db/Req_0x1A0/signals/Active' ELSE 'ch4/net/db/Req_0x1A0/signals/Active' END
    WHEN 'error' THEN CASE WHEN user_id % 4 = 0 THEN 'ch2/net/db/Ext_0x2B0/signals/Active_B' ELSE 'ch3/net/db/Ext_0x9/signals/Active_B' END
    ELSE 'ch3/net/db/Other/signals/Level' END"""


@query(
    "signal_discovery",
    f"""WITH {{events}},
p AS (
  SELECT user_id, {PATHS} AS field, event_type,
    CASE WHEN event_type = 'view' AND user_id % 2 = 0 THEN 1 WHEN user_id % 5 = 0 THEN 4 ELSE floor(value)::BIGINT END AS v
  FROM e),
s AS (
  SELECT user_id, field,
    CASE WHEN bool_and(v IN (0, 1)) THEN 0 WHEN bool_and(v IN (4, 5)) THEN 1 ELSE 2 END AS score
  FROM p
  GROUP BY user_id, field),
c AS (
  SELECT *,
    CASE field WHEN 'root/ch1/net/db/Req_0x1A0/signals/Active' THEN 0 WHEN 'ch2/net/db/Ext_0x2B0/signals/Active_B' THEN 1 END AS known,
    CASE WHEN field LIKE 'ch3%' THEN 0 WHEN field LIKE 'ch4%' THEN 1 ELSE 2 END AS channel
  FROM s
  WHERE field LIKE '%0x1A0/signals/Active' OR field LIKE '%0x2B0/signals/Active_B')
SELECT user_id AS recording_id, 'active' AS signal, field, score::INT AS score
FROM c
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY known IS NULL, score, coalesce(known, channel), field) = 1""",
)
def signal_discovery(spark, sf_dir):
    """The path of one signal for each user, with a path for each event type."""
    from ..sources.discovery import Wanted, discover

    wanted = Wanted("active", ("ch1/net/db/Req_0x1A0/signals/Active", "ch2/net/db/Ext_0x2B0/signals/Active_B"), (("Active", ("0x1A0", "Req")), ("Active_B", ("0x2B0",))), ((0, 1), (4, 5)))
    value = "CASE WHEN event_type = 'view' AND user_id % 2 = 0 THEN 1 WHEN user_id % 5 = 0 THEN 4 ELSE floor(value) END"
    rows = events(spark, sf_dir).selectExpr("user_id AS recording_id", f"{PATHS} AS field", "t", f"cast({value} AS double) AS value")
    return discover(rows, [wanted], None)


FLAGSHIP = """WITH {events}, m AS (SELECT *, event_type = 'error' AS m, lag(event_type = 'error') OVER (PARTITION BY user_id ORDER BY t, event_id) AS p FROM e),
s AS (SELECT *, sum(CASE WHEN m AND NOT coalesce(p, false) THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY t, event_id) AS g FROM m),
i AS (SELECT user_id, min(t) AS a, max(t) AS b FROM s WHERE m GROUP BY user_id, g),
k AS (SELECT user_id, count(*) AS total, count(*) FILTER (b - a >= 18000000000) AS bad, coalesce(max(b - a), 0) AS worst FROM i GROUP BY user_id),
d AS (SELECT user_id, round(max(value) - min(value), 6) AS km FROM e GROUP BY user_id)
SELECT user_id, coalesce(total, 0) AS total, coalesce(bad, 0) AS bad, coalesce(worst, 0) AS worst, km, round(CASE WHEN coalesce(bad, 0) > 0 THEN km / bad END, 6) AS km_per_bad FROM d LEFT JOIN k USING (user_id)"""


@query("lost_arbitration_kpi", FLAGSHIP)
def lost_arbitration_kpi(spark, sf_dir):
    """State runs, their duration, the long ones as incidents, and distance per incident."""
    from ..operators.kpi import mpi

    rows = events(spark, sf_dir)
    runs = G.islands(rows, "event_type = 'error'", K, ORDER, "t")
    counts = runs.groupBy("user_id").agg(F.count("*").alias("total"), F.count_if(F.col("duration") >= 5 * HOUR).alias("bad"), F.max("duration").alias("worst"))
    km = rows.groupBy("user_id").agg(F.round(F.max("value") - F.min("value"), 6).alias("km"))
    filled = km.join(counts, "user_id", "left").na.fill(0, ["total", "bad", "worst"])
    return filled.select("user_id", "total", "bad", "worst", "km", F.round(mpi(F.col("km"), F.col("bad")), 6).alias("km_per_bad"))
