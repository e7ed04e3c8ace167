"""Text dumps made of the event table and read back; the SQL states what they were made of."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources import topics as T

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE[f.__name__] = f, sql
        return f

    return add


def dumps(spark, sf_dir: str, marker: str, body: str) -> DataFrame:
    """user_id, text: one dump for each user, of a paragraph for each event. ``body`` is SQL over the event's columns."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("user_id", "event_id", "event_type", "value", "cast(floor(value * 10) as bigint) % 10 AS q")
    piece = F.concat(F.expr("cast(1000000000000000000 + event_id as string)"), F.lit(f" {marker}: "), F.expr(body), F.lit("\n"))
    return rows.select("user_id", piece.alias("p")).groupBy("user_id").agg(F.array_join(F.sort_array(F.collect_list("p")), "").alias("text"))


PLAN = """concat(event_id, '\\nstamp:\\n  secs: ', 1700000000 + event_id, '\\n  nsecs: ', q * 100000000, '\\njson: "FrameInfo": {"x": 1, "function": "', if(event_type = 'click', 'UNP', 'NP'), '"}, "traffic_light_decider_info": {"stop_flag": ', if(q > 4, 'true', 'false'),
 if(q = 3, '', concat(', "stop_distance": ', q * 5, '.5')), '}, "acc_info": {"cruise_velocity": ', 60 + q, '}, "turn_signal_info": {"signal_direction": ', q % 4, '}, \\\\"leadone_info\\\\": {\\\\"object_id\\\\": ', event_id % 50, '}')"""


@query("""SELECT user_id, count(*) AS n, round(sum((1700000000.0 + event_id) * 1000 + q * 100), 3)::DOUBLE AS at, count(*) FILTER (event_type = 'click') AS np, count(*) FILTER (q > 4) AS red, sum(CASE WHEN q = 3 THEN 1000 ELSE q * 5 + 0.5 END)::DOUBLE AS stop, sum(60 + q)::DOUBLE AS speed, count(*) FILTER (q % 4 IN (1, 2)) AS turns, sum(event_id % 50)::BIGINT AS leads
FROM (SELECT *, floor(value * 10)::BIGINT % 10 AS q FROM events) GROUP BY user_id""")
def topic_planning(spark, sf_dir):
    rows = T.planning(dumps(spark, sf_dir, "seq", PLAN))
    return rows.groupBy("user_id").agg(F.count("*").alias("n"), F.round(F.sum("at_ms"), 3).alias("at"), F.count_if("np_on").alias("np"), F.count_if("red_light").alias("red"), F.sum("stop_distance").alias("stop"), F.sum("set_speed").alias("speed"), F.count_if("non_straight").alias("turns"), F.sum("lead_id").alias("leads"))


OBJECTS = """concat('\\nmeta:\\n  sensor_timestamp_us: ', event_id * 1000, '\\nperception_fusion_objects_data:\\n', array_join(transform(sequence(1, 1 + q % 3), k -> concat('  - track_id: ', k, '\\n    available: ', if((k + q) % 4 = 0, 'False', 'True'), '\\n    crash_risk_ttc: ', k + q, '.25\\n    relative_position:\\n      x: ', k * 10, '\\n      y: -', q, '.5\\n    extra_json: "{}"\\n')), ''), 'reserved_infos: []')"""


@query("""WITH o AS (SELECT user_id, event_id, q, unnest(range(1, 2 + q % 3)) AS k FROM (SELECT *, floor(value * 10)::BIGINT % 10 AS q FROM events)), g AS (SELECT * FROM o WHERE (k + q) % 4 <> 0), m AS (SELECT user_id, event_id, min(k + q + 0.25) AS ttc FROM g GROUP BY ALL)
SELECT user_id, count(*) AS n, sum(k * 10)::DOUBLE AS x, sum(-(q + 0.5))::DOUBLE AS y, (SELECT sum(ttc)::DOUBLE FROM m WHERE m.user_id = g.user_id) AS ttc FROM g GROUP BY user_id""")
def topic_objects(spark, sf_dir):
    rows = T.objects(dumps(spark, sf_dir, "header", OBJECTS)).select("user_id", "at_ms", "min_ttc", F.posexplode("objects").alias("k", "o"))
    return rows.groupBy("user_id").agg(F.count("*").alias("n"), F.sum("o.x").alias("x"), F.sum("o.y").alias("y"), F.sum(F.when(F.col("k") == 0, F.col("min_ttc"))).alias("ttc"))


CHASSIS = """concat('\\nmeta:\\n  timestamp_us: ', event_id * 1000, '\\nbrake_info_report_data:\\n  accleration_on_wheel: -', q, '.5\\n  stationary: ', if(q = 0, 'True', 'False'), '\\nthrottle_info_report_data:\\n  vehicle_speed_average: ', q * 3, '\\n  throttle_pedal_percent: ', q, '\\nthrottle_report:\\n  throttle_report_data:\\n    override: ', if(q > 7, 'True', 'False'), '\\nextra:\\n  json: "{\\\\"slope_acc\\\\": ', q, '.75, \\\\"acc_ref\\\\"\\\\\\n: -.5}"')"""


@query("""SELECT user_id, count(*) AS n, sum(event_id)::DOUBLE AS at, sum(-(q + 0.5))::DOUBLE AS acc, sum(q * 3)::DOUBLE AS speed, count(*) FILTER (q = 0) AS still, count(*) FILTER (q > 7) AS override, sum(q + 0.75)::DOUBLE AS slope, (sum(-0.5))::DOUBLE AS ref
FROM (SELECT *, floor(value * 10)::BIGINT % 10 AS q FROM events) GROUP BY user_id""")
def topic_chassis_and_control(spark, sf_dir):
    text = dumps(spark, sf_dir, "header", CHASSIS)
    a = T.chassis(text).groupBy("user_id").agg(F.count("*").alias("n"), F.sum("at_ms").alias("at"), F.sum("acceleration").alias("acc"), F.sum("speed").alias("speed"), F.count_if("still").alias("still"), F.count_if("override").alias("override"))
    b = T.control(text).groupBy("user_id").agg(F.sum("slope_acc").alias("slope"), F.sum("acc_ref").alias("ref"))
    return a.join(b, "user_id")
