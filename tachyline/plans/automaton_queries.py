"""Order-dependent detectors over the event table, with SQL that walks from row to row by recursion."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import automata as M, segments as G
from .signal_queries import EVENTS, HOUR, K, ORDER, events

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
H = HOUR
ROWS = f"WITH RECURSIVE {EVENTS}, n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS k FROM e)"


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE[f.__name__] = f, sql
        return f

    return add


def _scan(rows: DataFrame, fields, machine, result, order=("t", "event_id")) -> DataFrame:
    return M.scan(rows, K, list(order), list(fields), machine, result)


@query(
    ROWS + f""", r AS (SELECT user_id, k, k AS first, value AS lo, value AS hi FROM n WHERE k = 1
UNION ALL SELECT user_id, nk, CASE WHEN ok THEN first ELSE nk END, CASE WHEN ok THEN least(lo, value) ELSE value END, CASE WHEN ok THEN greatest(hi, value) ELSE value END
  FROM (SELECT r.*, n.value, n.k AS nk, greatest(hi, n.value) - least(lo, n.value) <= 15 + 1e-9 AS ok FROM r JOIN n ON n.user_id = r.user_id AND n.k = r.k + 1))
SELECT r.user_id, min(t) AS start_t, max(t) AS end_t, count(*) AS n FROM r JOIN n ON n.user_id = r.user_id AND n.k = r.k GROUP BY r.user_id, first HAVING max(t) - min(t) >= {6 * H}"""
)
def stable_range_greedy(spark, sf_dir):
    return _scan(events(spark, sf_dir), ["t", "value"], M.stable_ranges({"value": 15.0}, 6 * HOUR), "start_t long, end_t long, n long")


@query(
    ROWS + f""", m AS (SELECT b.user_id, b.k, max(a.k) AS far FROM n a JOIN n b ON a.user_id = b.user_id AND a.k < b.k AND abs(a.value - b.value) >= 15 GROUP BY ALL),
l AS (SELECT n.*, 1 + coalesce(max(far) OVER (PARTITION BY n.user_id ORDER BY n.k), 0) AS reach, lag(t) OVER (PARTITION BY n.user_id ORDER BY n.k) AS pt FROM n LEFT JOIN m USING (user_id, k)),
r AS (SELECT user_id, k, k AS first, NULL::BIGINT AS ended FROM l WHERE k = 1
UNION ALL SELECT l.user_id, l.k, CASE WHEN l.reach <= r.first THEN r.first WHEN l.pt - s.t >= {6 * H} THEN l.k ELSE l.reach END, CASE WHEN l.reach > r.first AND l.pt - s.t >= {6 * H} THEN r.first END FROM r JOIN l ON l.user_id = r.user_id AND l.k = r.k + 1 JOIN n s ON s.user_id = r.user_id AND s.k = r.first),
o AS (SELECT user_id, ended AS a, k - 1 AS b FROM r WHERE ended IS NOT NULL UNION ALL SELECT user_id, max_by(first, k), max(k) FROM r GROUP BY user_id)
SELECT o.user_id, x.t AS start_t, y.t AS end_t, b - a + 1 AS n FROM o JOIN n x ON x.user_id = o.user_id AND x.k = a JOIN n y ON y.user_id = o.user_id AND y.k = b WHERE y.t - x.t >= {6 * H}"""
)
def stable_or_slide(spark, sf_dir):
    return _scan(events(spark, sf_dir), ["t", "value"], M.stable_or_slide("value", 15.0, 6 * HOUR), "start_t long, end_t long, n long")


@query(
    ROWS + f""", w AS (SELECT a.user_id, a.k AS s, min(b.k) AS z FROM n a JOIN n b ON a.user_id = b.user_id AND b.k >= a.k AND b.t - a.t >= {12 * H} GROUP BY ALL),
q AS (SELECT w.user_id, s, z, max(value) - min(value) <= 40 AS good, min(t) AS a, max(t) AS b, sum(value) AS total, count(*) AS c FROM w JOIN n ON n.user_id = w.user_id AND n.k BETWEEN s AND z GROUP BY ALL),
p AS (SELECT * FROM q WHERE s = 1 UNION ALL SELECT q.* FROM p JOIN q ON q.user_id = p.user_id AND q.s = CASE WHEN p.good THEN p.z + 1 ELSE p.s + 1 END),
g AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY s) AS i FROM p WHERE good),
m AS (SELECT user_id, i, i AS first, a, b, total, c FROM g WHERE i = 1
UNION ALL SELECT user_id, i, CASE WHEN ok THEN first ELSE i END, CASE WHEN ok THEN pa ELSE a END, b, CASE WHEN ok THEN ptotal + total ELSE total END, CASE WHEN ok THEN pc + c ELSE c END
  FROM (SELECT g.*, m.first, m.a AS pa, m.total AS ptotal, m.c AS pc, g.a - m.b <= {12 * H} AND abs(g.total / g.c - m.total / m.c) <= 5 AS ok FROM m JOIN g ON g.user_id = m.user_id AND g.i = m.i + 1))
SELECT user_id, max(a) AS start_t, max(b) AS end_t, round(max_by(total / c, i), 6) AS mean_value, max_by(c, i)::BIGINT AS n FROM m GROUP BY user_id, first"""
)
def qualified_windows(spark, sf_dir):
    test = lambda least, most: most - least <= 40
    return _scan(events(spark, sf_dir), ["t", "value"], M.qualified_windows(test, 12 * HOUR, 12 * HOUR, "value", 5.0), "start_t long, end_t long, mean_value double, n long").withColumn("mean_value", F.round("mean_value", 6))


@query(
    ROWS + f""", st AS (SELECT user_id, 0::BIGINT AS k, false AS live, NULL::BIGINT AS cand, NULL::BIGINT AS since, NULL::BIGINT AS start_, NULL::BIGINT AS away, NULL::BIGINT AS before_, NULL::BIGINT AS last, NULL::BIGINT AS oa, NULL::BIGINT AS ob, NULL::BIGINT AS oc FROM n WHERE k = 1
UNION ALL SELECT user_id, nk, good AND NOT cut, c2, CASE WHEN NOT good OR cut THEN NULL ELSE s2 END, CASE WHEN NOT good OR cut THEN NULL ELSE g2 END, CASE WHEN NOT good OR cut OR inside OR g1 IS NULL THEN NULL ELSE coalesce(away, t) END,
  CASE WHEN good AND g1 IS NOT NULL AND NOT inside AND away IS NULL THEN last ELSE before_ END, CASE WHEN good THEN t ELSE last END,
  CASE WHEN ended AND stop - start_ >= {12 * H} OR cut AND before_ - g1 >= {12 * H} THEN start_ END, CASE WHEN ended THEN stop WHEN cut THEN before_ END, cand
  FROM (SELECT *, live AND NOT good AS ended, CASE WHEN away IS NULL THEN last ELSE before_ END AS stop, CASE WHEN live THEN cand ELSE t END AS c2, start_ AS g1,
    CASE WHEN start_ IS NULL THEN CASE WHEN inside THEN coalesce(since, t) END ELSE since END AS s2, CASE WHEN start_ IS NULL AND inside AND t - coalesce(since, t) >= {4 * H} THEN t ELSE start_ END AS g2,
    good AND start_ IS NOT NULL AND NOT inside AND away IS NOT NULL AND t - away >= {24 * H} AS cut
    FROM (SELECT st.*, n.k AS nk, n.t, n.event_type <> 'signup' AS good, abs(n.value - 15) <= 14 + 1e-9 AS inside FROM st JOIN n ON n.user_id = st.user_id AND n.k = st.k + 1))),
o AS (SELECT user_id, oa AS start_t, ob AS end_t, oc AS candidate_t FROM st WHERE oa IS NOT NULL UNION ALL
  SELECT user_id, start_, CASE WHEN away IS NULL THEN last ELSE before_ END, cand FROM st WHERE (user_id, k) IN (SELECT user_id, max(k) FROM n GROUP BY user_id) AND live AND start_ IS NOT NULL AND CASE WHEN away IS NULL THEN last ELSE before_ END - start_ >= {12 * H})
SELECT * FROM o"""
)
def steady_band_automaton(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("on", F.col("event_type") != "signup").withColumn("target", F.lit(15.0))
    return _scan(rows, ["t", "on", "value", "target"], M.steady_band("on", "value", "target", 14.0, 4 * HOUR, 24 * HOUR, 12 * HOUR), "start_t long, end_t long, candidate_t long")


@query(
    ROWS + """, r AS (SELECT user_id, 0::BIGINT AS k, NULL::BIGINT AS first, 0 AS waiting FROM n WHERE k = 1
UNION ALL SELECT n.user_id, n.k, CASE WHEN n.event_type IN ('view', 'click') THEN coalesce(r.first, n.k) WHEN r.first IS NOT NULL AND n.value < 30 AND r.waiting < 2 THEN r.first END, CASE WHEN n.event_type IN ('view', 'click') OR r.first IS NULL THEN 0 ELSE r.waiting + 1 END FROM r JOIN n ON n.user_id = r.user_id AND n.k = r.k + 1)
SELECT r.user_id, min(t) AS start_t, max(t) FILTER (event_type IN ('view', 'click')) AS end_t, max(n.k) FILTER (event_type IN ('view', 'click')) - first + 1 AS n FROM r JOIN n ON n.user_id = r.user_id AND n.k = r.k WHERE first IS NOT NULL GROUP BY r.user_id, first"""
)
def lookahead_bridge(spark, sf_dir):
    return G.lookahead_bridge(events(spark, sf_dir), F.col("event_type").isin("view", "click"), F.col("value") < 30, 2, K, ORDER, "t")


@query(
    ROWS + """, z AS (SELECT user_id, value > 15 AS up, row_number() OVER (PARTITION BY user_id ORDER BY k) AS k FROM n WHERE value <> 15),
r AS (SELECT user_id, k, up, 1 AS run, NULL::BOOLEAN AS sign_, 0 AS flips FROM z WHERE k = 1
UNION ALL SELECT user_id, k, up, run, CASE WHEN run >= 2 THEN up ELSE sign_ END, flips + CASE WHEN run >= 2 AND sign_ IS NOT NULL AND sign_ <> up THEN 1 ELSE 0 END FROM (SELECT z.user_id, z.k, z.up, CASE WHEN z.up = r.up THEN r.run + 1 ELSE 1 END AS run, r.sign_, r.flips FROM r JOIN z ON z.user_id = r.user_id AND z.k = r.k + 1))
SELECT user_id, coalesce(max(flips), 0)::BIGINT AS flips FROM (SELECT DISTINCT user_id FROM n) LEFT JOIN r USING (user_id) GROUP BY user_id"""
)
def debounced_flips(spark, sf_dir):
    return G.debounced_flips(events(spark, sf_dir).withColumn("x", F.col("value") - 15), "x", 2, K, ORDER)


@query(
    f"""WITH RECURSIVE {EVENTS}, h AS (SELECT user_id, (t // {6 * H} - unnest(range(4))) * {6 * H} AS start_t, value FROM e), s AS (SELECT user_id, start_t, round(sum(value), 6) AS score FROM h GROUP BY ALL),
n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, start_t) AS k FROM s),
r AS (SELECT user_id, k, [start_t] AS taken FROM n WHERE k = 1 UNION ALL SELECT n.user_id, n.k, CASE WHEN len(taken) < 3 AND len(list_filter(taken, lambda x: abs(start_t - x) < {48 * H})) = 0 THEN list_append(taken, start_t) ELSE taken END FROM r JOIN n ON n.user_id = r.user_id AND n.k = r.k + 1),
p AS (SELECT user_id, max_by(taken, k) AS taken FROM r GROUP BY user_id), u AS (SELECT user_id, unnest(range(1, len(taken) + 1)) AS rank, taken FROM p)
SELECT u.user_id, taken[rank] AS start_t, score, rank FROM u JOIN n ON n.user_id = u.user_id AND n.start_t = taken[rank]"""
)
def nms_windows(spark, sf_dir):
    """Hopping windows scored by their sum; the best three of a user that begin two days apart."""
    hop, width = 6 * HOUR, 24 * HOUR
    starts = F.transform(F.sequence(F.lit(0), F.lit(width // hop - 1)), lambda k: ((F.floor(F.col("t") / hop) - k) * hop).cast("long"))
    scored = events(spark, sf_dir).select("user_id", "value", F.explode(starts).alias("start_t")).groupBy("user_id", "start_t").agg(F.round(F.sum("value"), 6).alias("score"))
    return M.scan(scored.withColumn("fall", -F.col("score")), K, ["fall", "start_t"], ["start_t", "score"], M.separated_top("score", "start_t", 3, 48 * HOUR), "start_t long, score double, rank long")


@query(
    f"""WITH RECURSIVE {EVENTS}, a AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS k FROM e WHERE event_type = 'error'),
c AS (SELECT a.user_id, a.k, list({{'t': b.t, 'id': b.event_id}} ORDER BY abs(b.t - a.t), b.t, b.event_id) AS near FROM a JOIN e b ON b.user_id = a.user_id AND b.event_type = 'purchase' AND abs(b.t - a.t) <= {30 * H} AND (b.value > 10) = (a.value > 10) GROUP BY ALL),
n AS (SELECT a.user_id, a.k, a.t, coalesce(near, []) AS near FROM a LEFT JOIN c USING (user_id, k)),
r AS (SELECT user_id, k, t, near[1] AS got, list_filter([near[1].id], lambda x: x IS NOT NULL) AS taken FROM n WHERE k = 1
UNION ALL SELECT user_id, k, t, left_[1], CASE WHEN len(left_) > 0 THEN list_append(taken, left_[1].id) ELSE taken END FROM (SELECT n.user_id, n.k, n.t, r.taken, list_filter(n.near, lambda x: NOT list_contains(r.taken, x.id)) AS left_ FROM r JOIN n ON n.user_id = r.user_id AND n.k = r.k + 1))
SELECT user_id, t AS a_t, got.t AS b_t, got.t - t AS lag FROM r"""
)
def greedy_edge_match(spark, sf_dir):
    rows = events(spark, sf_dir).where("event_type in ('error', 'purchase')").withColumn("side", F.when(F.col("event_type") == "error", "a").otherwise("b")).withColumn("state", F.col("value") > 10)
    return _scan(rows, ["t", "side", "state"], M.greedy_match("side", "state", 30 * HOUR), "a_t long, b_t long, lag long")


@query(
    ROWS + f""", d AS (SELECT a.user_id, a.k, a.t, a.value, min(b.value) AS v1, min_by(b.t, row(b.value, b.t)) AS t1 FROM n a JOIN n b ON a.user_id = b.user_id AND b.k >= a.k AND b.t - a.t <= {24 * H} GROUP BY ALL),
f AS (SELECT d.*, (SELECT min(x.k) FROM n x WHERE x.user_id = d.user_id AND x.k >= d.k AND x.t >= d.t1 + {H}) AS far, (SELECT min(x.k) FROM n x WHERE x.user_id = d.user_id AND x.k >= d.k AND x.t >= d.t1 AND x.value > 12) AS over, (SELECT min(x.k) FROM n x WHERE x.user_id = d.user_id AND x.t > d.t1) AS behind FROM d),
g AS (SELECT *, value - v1 >= 20 AND t1 > t AND v1 <= 12 AND far IS NOT NULL AND (over IS NULL OR over > far) AS good FROM f),
r AS (SELECT * FROM g WHERE k = 1 UNION ALL SELECT g.* FROM r JOIN g ON g.user_id = r.user_id AND g.k = CASE WHEN r.good THEN r.behind ELSE r.k + 1 END)
SELECT user_id, t AS start_t, t1 AS end_t, value - v1 AS fall FROM r WHERE good"""
)
def forward_drop_search(spark, sf_dir):
    return _scan(events(spark, sf_dir), ["t", "value"], M.forward_drops("value", 20.0, 24 * HOUR, 0.0, 12.0, HOUR), "start_t long, end_t long, fall double")


@query(
    ROWS + f""", j AS (SELECT a.user_id, a.k, a.t, b.k AS bk, b.t AS t1, c.k AS ck, c.t AS t2 FROM n a JOIN n b ON b.user_id = a.user_id AND b.k > a.k AND b.t - a.t <= {36 * H} AND abs(b.value - a.value) >= 15
  JOIN n c ON c.user_id = a.user_id AND c.k > b.k AND c.t - b.t <= {24 * H} AND CASE WHEN b.value > a.value THEN b.value - c.value ELSE c.value - b.value END >= 12),
b AS (SELECT user_id, k, t1, t2 FROM (SELECT *, row_number() OVER (PARTITION BY user_id, k ORDER BY bk, ck) AS i FROM j) WHERE i = 1),
g AS (SELECT n.user_id, n.k, n.t, t1, t2, (SELECT min(x.k) FROM n x WHERE x.user_id = b.user_id AND x.t > b.t2) AS behind FROM n LEFT JOIN b USING (user_id, k)),
r AS (SELECT * FROM g WHERE k = 1 UNION ALL SELECT g.* FROM r JOIN g ON g.user_id = r.user_id AND g.k = CASE WHEN r.t2 IS NOT NULL THEN r.behind ELSE r.k + 1 END)
SELECT user_id, t AS start_t, t1 AS peak_t, t2 AS end_t FROM r WHERE t2 IS NOT NULL"""
)
def rebound_pattern(spark, sf_dir):
    return _scan(events(spark, sf_dir), ["t", "value"], M.rebounds("value", 15.0, 36 * HOUR, 0.0, 12.0, 24 * HOUR, 0.0), "start_t long, peak_t long, end_t long")


@query(
    ROWS + f""", s AS (SELECT *, sign(value - 15) AS s, lag(sign(value - 15)) OVER (PARTITION BY user_id ORDER BY k) AS p FROM n), i AS (SELECT *, sum(CASE WHEN p IS DISTINCT FROM s THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY k) AS run FROM s),
ph AS (SELECT user_id, max(s) AS s, min(t) AS a, max(t) AS b, max(abs(value - 15)) AS peak FROM i WHERE s <> 0 GROUP BY user_id, run), q AS (SELECT *, b - a BETWEEN 0 AND {90 * H} AND peak >= 3 AS good, row_number() OVER (PARTITION BY user_id ORDER BY a) AS k FROM ph),
r AS (SELECT user_id, k, CASE WHEN good THEN s END AS ls, CASE WHEN good THEN b END AS lb, CASE WHEN good THEN k END AS chain, a, b, good FROM q WHERE k = 1
UNION ALL SELECT q.user_id, q.k, CASE WHEN q.good THEN q.s WHEN q.b - q.a > {12 * H} THEN NULL ELSE r.ls END, CASE WHEN q.good THEN q.b WHEN q.b - q.a > {12 * H} THEN NULL ELSE r.lb END,
  CASE WHEN q.good THEN CASE WHEN r.ls IS NULL OR r.ls = q.s OR q.a - r.lb > {12 * H} THEN q.k ELSE r.chain END WHEN q.b - q.a > {12 * H} THEN NULL ELSE r.chain END, q.a, q.b, q.good FROM r JOIN q ON q.user_id = r.user_id AND q.k = r.k + 1)
SELECT user_id, min(a) AS start_t, max(b) AS end_t, count(*) AS phases FROM r WHERE good GROUP BY user_id, chain HAVING count(*) >= 4"""
)
def long_cycle_phases(spark, sf_dir):
    return G.long_cycles(events(spark, sf_dir).withColumn("x", F.col("value") - 15), "x", 0, 90 * HOUR, 3.0, 4, 12 * HOUR, K, ORDER, "t")
