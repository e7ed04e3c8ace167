"""Roll-ups, rankings, comparisons and text cells over the sales tables, each with the SQL that gives the same rows.

A line item is a case, bad if it came back (``R``), with its price as severity; its supplier is the source and the
priority of its order the metric. Years of orders are releases that are compared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import compare as C, kpi as R, segments as G, windows as W

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str):
    def add(f):
        QUERIES[name], ORACLE[name] = f, sql
        return f

    return add


def _table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cases(spark, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice", "l_partkey")


@query(
    "merge_overlapping_intervals",
    """WITH i AS (SELECT DISTINCT o_custkey, epoch_us(o_orderdate) // 86400000000 AS a, epoch_us(l_shipdate) // 86400000000 AS b FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_shipdate >= o_orderdate),
n AS (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY o_custkey ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM i),
g AS (SELECT *, sum(new) OVER (PARTITION BY o_custkey ORDER BY a, b) AS g FROM n)
SELECT o_custkey, min(a) AS a, max(b) AS b, count(*) AS n FROM g GROUP BY o_custkey, g""",
)
def merge_overlapping_intervals(spark, sf_dir):
    day = lambda c: F.expr(f"timestampdiff(DAY, timestamp_ntz'1970-01-01 00:00:00', cast({c} as timestamp_ntz))")
    o, li = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    spans = o.join(li, F.col("o_orderkey") == F.col("l_orderkey")).where("l_shipdate >= o_orderdate").select("o_custkey", day("o_orderdate").alias("a"), day("l_shipdate").alias("b")).distinct()
    return G.merge_overlapping(spans, ["o_custkey"], "a", "b")


@query(
    "cpi_rollup",
    """SELECT l_linestatus, l_suppkey, count(*) AS total, count(*) FILTER (l_returnflag = 'R') AS bad,
  round(CASE WHEN count(*) FILTER (l_returnflag = 'R') = 0 THEN 100.0 ELSE count(*) / count(*) FILTER (l_returnflag = 'R') END, 6) AS cpi,
  CASE WHEN count(*) FILTER (l_returnflag = 'R') = 0 THEN '>' || count(*) || '(' || count(*) || '/0)' ELSE '(' || count(*) || '/' || count(*) FILTER (l_returnflag = 'R') || ')' END AS cell
FROM lineitem GROUP BY ALL""",
)
def cpi_rollup(spark, sf_dir):
    out = _cases(spark, sf_dir).groupBy("l_linestatus", "l_suppkey").agg(F.count("*").alias("total"), F.count_if(F.col("l_returnflag") == "R").alias("bad"))
    cell = R.cpi_text(F.col("total"), F.col("bad"))
    return out.select("l_linestatus", "l_suppkey", "total", "bad", F.round(R.cpi(F.col("total"), F.col("bad")), 6).alias("cpi"), F.when(F.col("bad") == 0, cell).otherwise(F.regexp_replace(cell, r"^[0-9.]+", "")).alias("cell"))


@query(
    "mpi_rollup",
    """WITH r AS (SELECT l_suppkey, l_returnflag AS metric, max(l_quantity) AS km, count(*) FILTER (l_discount > 0.08) AS bad, count(*) AS total FROM lineitem GROUP BY ALL)
SELECT metric, sum(total)::BIGINT AS total, sum(bad)::BIGINT AS bad, sum(km) AS km, round(CASE WHEN sum(bad) > 0 THEN sum(km) / sum(bad) END, 6) AS km_per_bad FROM r GROUP BY metric""",
)
def mpi_rollup(spark, sf_dir):
    li = _table(spark, sf_dir, "lineitem")
    results = li.select(F.col("l_returnflag").alias("metric"), F.col("l_suppkey").alias("source_path"), F.col("l_quantity").alias("distance_km"), F.lit(1).alias("total"), (F.col("l_discount") > 0.08).cast("int").alias("bad"), F.lit("OK").alias("status"))
    out = R.rollup(results)
    return out.select("metric", "total", "bad", "km", F.round(R.mpi(F.col("km"), F.col("bad")), 6).alias("km_per_bad"))


@query(
    "status_rollup",
    """WITH r AS (SELECT user_id, event_type AS metric, count(*) FILTER (value > 40) AS bad, bool_or(value > 120) AS failed FROM events GROUP BY ALL),
s AS (SELECT metric, CASE WHEN failed THEN 'ERROR' WHEN bad > 0 THEN 'BAD' ELSE 'OK' END AS status FROM r)
SELECT metric, status, count(*) AS n FROM s GROUP BY ALL""",
)
def status_rollup(spark, sf_dir):
    r = _table(spark, sf_dir, "events").groupBy("user_id", F.col("event_type").alias("metric")).agg(F.count_if(F.col("value") > 40).alias("bad"), F.bool_or(F.col("value") > 120).alias("failed"))
    state = R.status(F.lit(None).cast("string"), F.when(F.col("failed"), "failed"), F.col("bad"))
    return r.select("metric", state.alias("status")).groupBy("metric", "status").agg(F.count("*").alias("n"))


TOP = """WITH r AS (SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice {}, l_orderkey, l_linenumber, l_partkey, l_quantity) AS rank FROM lineitem WHERE l_returnflag = 'R' AND l_extendedprice >= 20000)
SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice, rank FROM r WHERE rank <= 5"""
TIE = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]
SHOWN = ["l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "rank"]


@query("bad_case_topn", TOP.format("DESC"))
def bad_case_topn(spark, sf_dir):
    return R.worst_cases(_cases(spark, sf_dir).where("l_returnflag = 'R'"), ["l_suppkey"], "l_extendedprice", TIE, 5, 20000).select(*SHOWN)


@query("bad_case_topn_ascending", TOP.format("ASC"))
def bad_case_topn_ascending(spark, sf_dir):
    return R.worst_cases(_cases(spark, sf_dir).where("l_returnflag = 'R'"), ["l_suppkey"], "l_extendedprice", TIE, 5, 20000, ascending=True).select(*SHOWN)


@query(
    "rule_layering",
    """SELECT s_suppkey, CASE WHEN s_suppkey = 3 THEN 1 WHEN s_nationkey IN (1, 2) THEN 5 ELSE 20 END AS top, CASE WHEN s_suppkey = 3 THEN 0.0 WHEN s_nationkey IN (1, 2) THEN 50.0 ELSE 10.0 END AS least FROM supplier""",
)
def rule_layering(spark, sf_dir):
    rules = spark.createDataFrame([("global", "*", (20, 10.0)), ("nation", "1", (5, 50.0)), ("nation", "2", (5, 50.0)), ("supplier", "3", (1, 0.0))], "scope string, key string, fields struct<top:int,least:double>")
    targets = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    out = R.layered_rules(rules, targets, [("global", F.lit("*")), ("nation", F.col("s_nationkey").cast("string")), ("supplier", F.col("s_suppkey").cast("string"))])
    return out.select("s_suppkey", "fields.top", "fields.least")


@query(
    "distribution_summary",
    """SELECT l_returnflag, count(l_extendedprice) AS n, min(l_extendedprice) AS min_value, round(quantile_cont(l_extendedprice, 0.1), 4) AS p10, round(median(l_extendedprice), 4) AS median_value,
  round(avg(l_extendedprice), 4) AS mean_value, round(quantile_cont(l_extendedprice, 0.9), 4) AS p90, max(l_extendedprice) AS max_value, count(*) FILTER (l_extendedprice BETWEEN 3500 AND 50000) AS in_band,
  round(count(*) FILTER (l_extendedprice BETWEEN 3500 AND 50000) / count(l_extendedprice), 9) AS band_share FROM lineitem GROUP BY l_returnflag""",
)
def distribution_summary(spark, sf_dir):
    out = W.distribution(_cases(spark, sf_dir), "l_extendedprice", ["l_returnflag"], 3500, 50000)
    return out.select("l_returnflag", "n", "min_value", *(F.round(c, 4).alias(c) for c in ("p10", "median_value", "mean_value", "p90")), "max_value", "in_band", F.round("band_share", 9).alias("band_share"))


@query("histogram", "SELECT (floor(l_extendedprice / 5000) * 5000)::BIGINT AS bin, count(*) AS n FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY ALL")
def histogram(spark, sf_dir):
    return W.histogram(_cases(spark, sf_dir), "l_extendedprice", 5000).select(F.col("bin").cast("long").alias("bin"), "n")


@query(
    "run_state_summary",
    """WITH x AS (SELECT n_nationkey, s FROM nation, (VALUES ('F'), ('O'), ('P')) v(s)), d AS (SELECT c_nationkey AS n_nationkey, o_orderstatus AS s, 'done' AS status FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 250000 GROUP BY ALL)
SELECT coalesce(status, 'missing') AS status, count(*) AS n FROM x LEFT JOIN d USING (n_nationkey, s) GROUP BY ALL""",
)
def run_state_summary(spark, sf_dir):
    states = spark.createDataFrame([("F",), ("O",), ("P",)], "s string")
    expected = _table(spark, sf_dir, "nation").select("n_nationkey").withColumn("s", F.explode(F.array(F.lit("F"), F.lit("O"), F.lit("P"))))
    o = _table(spark, sf_dir, "orders").where("o_totalprice > 250000").join(_table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    done = o.select(F.col("c_nationkey").alias("n_nationkey"), F.col("o_orderstatus").alias("s")).distinct().join(F.broadcast(states), "s").withColumn("status", F.lit("done"))
    return R.run_state(expected, done, ["n_nationkey", "s"])


@query("missing_fields_antijoin", "SELECT DISTINCT c.c_custkey, p.prio FROM customer c, (SELECT DISTINCT o_orderpriority AS prio FROM orders) p WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = p.prio)")
def missing_fields_antijoin(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("prio"))
    fields = sorted(r["prio"] for r in orders.select("prio").distinct().collect())  # the few fields that there are
    required = _table(spark, sf_dir, "customer").select("c_custkey", F.explode(F.array(*map(F.lit, fields))).alias("prio"))
    return R.missing_fields(required, orders, ["c_custkey", "prio"])


@query(
    "upsert_latest",
    """WITH t AS (SELECT o_custkey AS k, count(*) AS n, 'old' AS source FROM orders GROUP BY ALL), r AS (SELECT o_custkey AS k, count(*) AS n, 'new' AS source FROM orders WHERE o_orderstatus = 'P' GROUP BY ALL)
SELECT * FROM r UNION ALL SELECT * FROM t WHERE k NOT IN (SELECT k FROM r)""",
)
def upsert_latest(spark, sf_dir):
    o = _table(spark, sf_dir, "orders")
    count = lambda rows, name: rows.groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n")).withColumn("source", F.lit(name))
    return R.upsert(count(o, "old"), count(o.where("o_orderstatus = 'P'"), "new"), ["k"])


SIDES = """WITH y AS (SELECT o_orderpriority || '-' || (o_custkey % 40) AS metric, year(o_orderdate) AS side, count(*) AS total, count(*) FILTER (o_totalprice > 430000) AS bad FROM orders WHERE year(o_orderdate) IN (1996, 1997) GROUP BY ALL),
k AS (SELECT *, CASE WHEN bad = 0 THEN NULL ELSE total / bad END AS value FROM y),
j AS (SELECT metric, b.total AS base_total, b.bad AS base_bad, b.value AS base_value, t.total AS target_total, t.bad AS target_bad, t.value AS target_value
  FROM (SELECT * FROM k WHERE side = 1996) b FULL JOIN (SELECT * FROM k WHERE side = 1997) t USING (metric)) """


def _sides(spark, sf_dir):
    o = _table(spark, sf_dir, "orders").withColumn("side", F.year("o_orderdate")).where("side in (1996, 1997)")
    metric = F.concat("o_orderpriority", F.lit("-"), (F.col("o_custkey") % 40).cast("string"))
    k = o.groupBy(metric.alias("metric"), "side").agg(F.count("*").alias("total"), F.count_if(F.col("o_totalprice") > 430000).alias("bad"))
    k = k.withColumn("value", F.when(F.col("bad") > 0, F.col("total") / F.col("bad")))
    return C.join_sides(k.where("side = 1996"), k.where("side = 1997"), ["metric"], ["total", "bad", "value"])


@query(
    "base_target_compare",
    SIDES
    + """SELECT metric, base_total, base_bad, target_total, target_bad, CASE WHEN base_total IS NULL THEN 'base_missing' WHEN target_total IS NULL THEN 'target_missing'
  WHEN base_bad = 0 AND target_bad = 0 THEN 'equal' WHEN target_bad = 0 THEN 'target' WHEN base_bad = 0 THEN 'base'
  WHEN target_value > base_value THEN 'target' WHEN target_value < base_value THEN 'base' WHEN target_bad < base_bad THEN 'target' WHEN target_bad > base_bad THEN 'base' ELSE 'equal' END AS verdict FROM j""",
)
def base_target_compare(spark, sf_dir):
    j = _sides(spark, sf_dir)
    value = lambda side: F.when(F.col(f"{side}_bad") == 0, float("inf")).otherwise(F.col(f"{side}_value"))
    return j.select("metric", "base_total", "base_bad", "target_total", "target_bad", C.verdict(value("base"), F.col("base_bad"), value("target"), F.col("target_bad")).alias("verdict"))


@query(
    "release_gate",
    SIDES
    + """SELECT metric, target_total, target_bad, CASE WHEN metric LIKE '5-%' THEN 'no_threshold' WHEN target_total IS NULL THEN 'invalid' WHEN target_total = 0 THEN 'insufficient' WHEN target_bad = 0 THEN 'pass' WHEN target_total / target_bad >= 8 THEN 'pass' ELSE 'fail' END AS gate FROM j""",
)
def release_gate(spark, sf_dir):
    threshold = F.when(~F.startswith(F.col("metric"), F.lit("5-")), 8.0)
    j = _sides(spark, sf_dir)
    return j.select("metric", "target_total", "target_bad", C.gate(F.col("target_total"), F.col("target_bad"), F.col("target_value"), F.lit(False), threshold).alias("gate"))


@query(
    "highlight",
    SIDES
    + """, v AS (SELECT metric, base_bad, target_bad, coalesce(base_value, base_total) AS b, coalesce(target_value, target_total) AS t, base_bad = 0 OR base_value >= 8 AS bo, target_bad = 0 OR target_value >= 8 AS po FROM j)
SELECT metric, CASE WHEN coalesce(NOT bo AND ((t >= 4 * b AND t - b >= 5) OR t - b >= 10 OR (target_bad = 0 AND base_bad > 0)), false) THEN 'up'
  WHEN coalesce(NOT po AND ((b >= 4 * t AND b - t >= 5) OR b - t >= 10 OR (base_bad = 0 AND target_bad > 0)), false) THEN 'down' ELSE '' END AS mark FROM v""",
)
def highlight(spark, sf_dir):
    j = _sides(spark, sf_dir)
    value = lambda side: F.coalesce(f"{side}_value", F.col(f"{side}_total").cast("double"))
    ok = lambda side: (F.col(f"{side}_bad") == 0) | (F.col(f"{side}_value") >= 8)
    return j.select("metric", C.highlight(value("base"), F.col("base_bad"), value("target"), F.col("target_bad"), ok("base"), ok("target")).alias("mark"))


@query("latest_comparison_group", "SELECT o_orderkey, o_custkey FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)")
def latest_comparison_group(spark, sf_dir):
    o = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("y"))
    return C.latest_group(o, "y").select("o_orderkey", "o_custkey")


@query(
    "kpi_text_parse",
    r"""WITH c AS (SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN round(s_acctbal, 1) || '(' || (s_suppkey + 1) || '/' || s_nationkey || ')' WHEN 1 THEN '>' || s_suppkey || '(' || s_suppkey || '/0)' WHEN 2 THEN 'N/A' WHEN 3 THEN s_suppkey || '（' || (s_suppkey * 2) || '／' || 2 || '）' ELSE s_suppkey::VARCHAR END AS cell FROM supplier),
p AS (SELECT s_suppkey, regexp_replace(translate(trim(cell), '（）／＞，', '()/>,'), '[,\s]', '', 'g') AS x FROM c)
SELECT s_suppkey, try_cast(nullif(regexp_extract(x, '^>?(-?[0-9]+(?:\.[0-9]+)?)', 1), '') AS DOUBLE) AS number, x LIKE '>%' AS lower_bound,
  try_cast(nullif(regexp_extract(x, '\(([0-9]+(?:\.[0-9]+)?)/([0-9]+(?:\.[0-9]+)?)\)', 1), '') AS DOUBLE) AS total, try_cast(nullif(regexp_extract(x, '\(([0-9]+(?:\.[0-9]+)?)/([0-9]+(?:\.[0-9]+)?)\)', 2), '') AS DOUBLE) AS bad FROM p""",
)
def kpi_text_parse(spark, sf_dir):
    s, k = _table(spark, sf_dir, "supplier"), F.col("s_suppkey")
    forms = F.when(k % 5 == 0, F.concat(F.round("s_acctbal", 1), F.lit("("), k + 1, F.lit("/"), "s_nationkey", F.lit(")"))).when(k % 5 == 1, F.concat(F.lit(">"), k, F.lit("("), k, F.lit("/0)"))).when(k % 5 == 2, "N/A").when(k % 5 == 3, F.concat(k, F.lit("（"), k * 2, F.lit("／2）"))).otherwise(k.cast("string"))
    return s.select("s_suppkey", C.parse_cell(forms).alias("c")).select("s_suppkey", "c.*")


SPAN = r"\[Event ([0-9]+): start=(-?[0-9.]+), end=(-?[0-9.]+)\]"


@query(
    "regex_event_spans",
    r"""WITH d AS (SELECT event_id, '[Event ' || event_id || ': start=' || user_id || '.5, end=' || (user_id + 3) || '.25] x [Event 7: start=1.0, end=' || user_id || '.0]' AS s FROM events)
SELECT event_id, generate_subscripts(regexp_extract_all(s, 'start=(-?[0-9.]+)', 1), 1)::INTEGER AS pos, unnest(regexp_extract_all(s, 'start=(-?[0-9.]+)', 1))::DOUBLE AS start_s, unnest(regexp_extract_all(s, 'end=(-?[0-9.]+)', 1))::DOUBLE AS end_s FROM d""",
)
def regex_event_spans(spark, sf_dir):
    from ..functions.text import event_spans

    e = _table(spark, sf_dir, "events")
    text = F.concat(F.lit("[Event "), "event_id", F.lit(": start="), "user_id", F.lit(".5, end="), F.col("user_id") + 3, F.lit(".25] x [Event 7: start=1.0, end="), "user_id", F.lit(".0]"))
    return e.select("event_id", F.posexplode(event_spans(text)).alias("pos", "s")).select("event_id", (F.col("pos") + 1).alias("pos"), "s.start_s", "s.end_s")


@query(
    "date_from_path",
    r"""WITH p AS (SELECT o_orderkey, '/data/' || strftime(o_orderdate, '%Y%m%d') || '_done/' || strftime(o_orderdate, '%Y-%m-%d-%H-%M-%S') || '_can_parsed.h5' AS path FROM orders)
SELECT o_orderkey, try_cast(regexp_extract(path, '([0-9]{4}-[0-9]{2}-[0-9]{2})-[0-9]{2}-[0-9]{2}-[0-9]{2}', 1) AS DATE)::VARCHAR AS rec_date FROM p WHERE regexp_extract(path, '([0-9]{4}-[0-9]{2}-[0-9]{2})', 1) BETWEEN '1996-03-01' AND '1996-06-30'""",
)
def date_from_path(spark, sf_dir):
    from ..sources.recordings import with_dates

    o = _table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("/data/"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_done/"), F.date_format("o_orderdate", "yyyy-MM-dd-HH-mm-ss"), F.lit("_can_parsed.h5")).alias("path"))
    return with_dates(o, "path", "19960301-19960630").select("o_orderkey", F.col("rec_date").cast("string").alias("rec_date"))


@query(
    "rollup_grouping_sets",
    "SELECT l_returnflag, l_linestatus, count(*) AS total, count(*) FILTER (l_discount > 0.08) AS bad FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)",
)
def rollup_grouping_sets(spark, sf_dir):
    return _table(spark, sf_dir, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("total"), F.count_if(F.col("l_discount") > 0.08).alias("bad"))


@query(
    "display_speed",
    """WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity * 6 AS v FROM lineitem),
b AS (SELECT *, CASE WHEN v <= 40 THEN 1.0 + (v - 0) * (1.075 - 1.0) / (40 - 0) WHEN v <= 80 THEN 1.075 + (v - 40) * (1.052 - 1.075) / (80 - 40) WHEN v <= 120 THEN 1.052 + (v - 80) * (1.045 - 1.052) / (120 - 80)
  WHEN v <= 200 THEN 1.045 + (v - 120) * (1.039 - 1.045) / (200 - 120) WHEN v <= 300 THEN 1.039 + (v - 200) * (1.036 - 1.039) / (300 - 200) ELSE 1.036 END AS bias FROM s)
SELECT l_partkey, v AS speed, round(v * round(bias, 3), 0) AS shown, count(*) AS n FROM b GROUP BY ALL""",
)
def display_speed(spark, sf_dir):
    from ..functions.scalars import display_speed as shown

    s = _table(spark, sf_dir, "lineitem").select("l_partkey", (F.col("l_quantity") * 6).alias("speed"))
    return s.withColumn("shown", shown(F.col("speed"))).groupBy("l_partkey", "speed", "shown").agg(F.count("*").alias("n"))
