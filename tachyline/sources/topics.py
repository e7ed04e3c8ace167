"""Text dumps of messages: paragraphs, and the fields of planning, object, chassis and control messages, by native text functions.

A dump is one text: paragraphs that begin with a time of 19 digits and a marker. A paragraph is an outline of ``name: value``
lines, some of whose values are JSON, with quotes escaped and lines continued. Lines are joined and quotes freed once;
then a block is cut out by its indentation, a JSON object by its braces, and a field is looked for in its own block
only, so one that isn't there is null and is never taken from a later block. A paragraph without a time is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Names in the dumps (fixed values of the format).
SOURCES = {"objects_ms": "/perception/fusion/object_auto", "chassis_ms": "/vehicle/chassis_report", "control_ms": "/msd/prediction/prediction_result_auto", "body_ms": "/vehicle/body_report"}
JSON_NAMES = {
    "function": ("FrameInfo", "function"),
    "red_light": ("traffic_light_decider_info", "stop_flag"),
    "stop_distance": ("traffic_light_decider_info", "stop_distance"),
    "set_speed": ("acc_info", "cruise_velocity"),
    "max_curvature": ("curvature_info", "max_curvature"),
    "curve_limit": ("curvature_info", "curv_velocity_limit"),
    "curve_limited": ("curvature_info", "is_curv_v_limit_enable"),
    "signal": ("turn_signal_info", "signal_direction"),
    "map_turn": ("intersection_info", "map_turn_signal"),
    "u_turn": ("uturn_info", "is_in_uturn"),
    "lead_id": ("leadone_info", "object_id"),
}
CHASSIS_NAMES = {
    "acceleration": ("brake_info_report_data", "accleration_on_wheel"),
    "still": ("brake_info_report_data", "stationary"),
    "speed": ("throttle_info_report_data", "vehicle_speed_average"),
    "pedal": ("throttle_info_report_data", "throttle_pedal_percent"),
    "override": ("throttle_report", "throttle_report_data", "override"),
    "driver_work_type": ("brake_report", "brake_report_data", "driver_work_type", "value"),
}
OBJECT_NAMES = {
    "id": ("track_id",),
    "x": ("relative_position", "x"),
    "y": ("relative_position", "y"),
    "ttc": ("crash_risk_ttc",),
    "velocity": ("velocity_relative_to_ground", "x"),
    "acceleration": ("acceleration_relative_to_ground", "x"),
    "length": ("shape", "length"),
}
BODY_NAMES = ("auxiliary_report", "auxiliary_report_data", "vehicle_speed_on_dashboard")
CRUISE_NAME = "cruise_speed_limit"
CONTROL_NAMES = ("slope_acc", "acc_ref", "acc_wheel", "acc_ego_real")
#: The value that an absent field has.
ABSENT = {"stop_distance": 1000.0, "set_speed": 0.0, "max_curvature": 0.0, "curve_limit": 100.0, "red_light": False, "curve_limited": False}


def read_dumps(spark, paths: list[str]) -> DataFrame:
    """path, text: one row for each file."""
    return spark.read.text(paths, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def paragraphs(dumps: DataFrame, marker: str) -> DataFrame:
    """The other columns of ``dumps`` (text, ...), position, stamp (19 digits) and paragraph. Messages (``files.read_messages``)
    have these already."""
    if "paragraph" in dumps.columns:
        return dumps
    head = r"([0-9]{19})\s+" + marker + r":\s*"
    stamps = F.regexp_extract_all("text", F.lit(head), 1)
    bodies = F.slice(F.split("text", head, -1), 2, 2**31 - 1)
    rows = dumps.select(*(c for c in dumps.columns if c != "text"), F.posexplode(F.arrays_zip(stamps.alias("stamp"), bodies.alias("body"))).alias("position", "p"))
    return rows.select(*(c for c in rows.columns if c != "p"), F.col("p.stamp").alias("stamp"), F.rtrim("p.body").alias("paragraph"))


def joined(text: Column) -> Column:
    """``text`` with lines that end in a backslash joined to the next, and escaped quotes freed."""
    return F.replace(F.regexp_replace(text, r"\\\r?\n\s*", ""), F.lit('\\"'), F.lit('"'))


def block(text: Column, *names: str) -> Column:
    """The lines that belong to an outline's entry, innermost of ``names``: those indented deeper, list items level with it
    included. Empty where it isn't there. Repetitions are possessive, so blocks of any length are matched without a deep stack."""
    for name in names:
        text = F.regexp_extract(text, rf"(?m)^( *){name}:[^\n]*((?:\n\1(?: |- )[^\n]*|\n(?=\n))*+)", 2)
    return text


def field(text: Column, *names: str) -> Column:
    """The value of an outline's line, inside of the blocks named first; null where there is none."""
    found = F.trim(F.regexp_extract(block(text, *names[:-1]), rf"(?m)^ *(?:- )?{names[-1]}:([^\n]*)", 1))
    return F.when(found != "", found)


def json_object(text: Column, name: str) -> Column:
    """The text of a named JSON object of ``joined`` text, up to three deep; its bare decimals get their 0."""
    inner = r"\{[^{}]*+\}"
    for _ in range(2):
        inner = rf"\{{(?:[^{{}}]++|{inner})*+\}}"
    return F.regexp_replace(F.regexp_extract(text, rf'"{name}"\s*:\s*({inner})', 1), r"([:,\[]\s*-?)\.([0-9])", "$10.$2")


def json_value(text: Column, name: str, member: str) -> Column:
    """The text of a member of a named JSON object; null where either isn't there."""
    return F.get_json_object(json_object(text, name), f"$.{member}")


def number(text: Column) -> Column:
    return text.try_cast("double")


def flag(text: Column) -> Column:
    return F.when(F.lower(text) == "true", True).when(F.lower(text) == "false", False)


def _others(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c not in ("stamp", "paragraph", "__p")]


def _headed(dumps: DataFrame, clock: str) -> DataFrame:
    """Paragraphs with a header, ``joined`` as __p, and at_ms by the microseconds of their meta entry."""
    rows = paragraphs(dumps, "header").withColumn("__p", joined(F.col("paragraph")))
    return rows.withColumn("at_ms", number(field(F.col("__p"), "meta", clock)) / 1000).where("at_ms is not null")


def _stamped(text: Column) -> Column:
    """Milliseconds by the stamp entry, else the number that heads the paragraph."""
    return F.coalesce(number(field(text, "stamp", "secs")) * 1000 + number(field(text, "stamp", "nsecs")) / 1e6, F.col("stamp").cast("double"))


def planning(dumps: DataFrame) -> DataFrame:
    """Planning messages: at_ms, function and np_on, red_light, stop_distance, set_speed, curve limits, non_straight with what it is
    known by, lead_id, and the times of the messages that it was made from."""
    rows = paragraphs(dumps, "seq").withColumn("__p", joined(F.col("paragraph")))
    p = F.col("__p")
    value = {name: json_value(p, *where) for name, where in JSON_NAMES.items()}
    made = {name: number(json_value(p, topic, "metaTimeMs")).alias(name) for name, topic in SOURCES.items()}
    known = lambda name, read: F.coalesce(read(value[name]), F.lit(ABSENT[name])).alias(name)
    signal, turn, around = number(value["signal"]).cast("int"), number(value["map_turn"]).cast("int"), flag(value["u_turn"])
    no = F.lit(False)
    return rows.select(
        *_others(rows),
        _stamped(p).alias("at_ms"),
        value["function"].alias("function"),
        F.coalesce(value["function"] == "UNP", no).alias("np_on"),
        known("red_light", flag),
        known("stop_distance", number),
        known("set_speed", number),
        known("max_curvature", number),
        known("curve_limit", number),
        known("curve_limited", flag),
        (F.coalesce(signal.isin(1, 2), no) | F.coalesce(turn.isin(1, 2), no) | F.coalesce(around, no)).alias("non_straight"),
        (signal.isNotNull() | turn.isNotNull() | around.isNotNull()).alias("knows_turns"),
        value["lead_id"].try_cast("long").alias("lead_id"),
        *made.values(),
    )


OBJECT = "id long, x double, y double, ttc double, velocity double, acceleration double, length double"


def objects(dumps: DataFrame) -> DataFrame:
    """Object messages: at_ms, ``objects`` (those available) and min_ttc over them; null where a message has no object data.
    A time to collision below 0 is unknown."""
    rows = _headed(dumps, "sensor_timestamp_us")
    data = "perception_fusion_objects_data"
    items = F.filter(F.split(block(F.col("__p"), data), r"(?:^|\n) *- ", -1), lambda o: flag(field(o, "available")) & o.startswith("track_id:"))

    def thing(o: Column) -> Column:
        read = {name: number(field(o, *where)) for name, where in OBJECT_NAMES.items()}
        read |= {"id": field(o, *OBJECT_NAMES["id"]).try_cast("long"), "ttc": F.when(read["ttc"] >= 0, read["ttc"])}
        return F.struct(*(v.alias(name) for name, v in read.items()))

    found = rows.withColumn("objects", F.when(F.col("__p").rlike(rf"(?m)^ *{data}:"), F.transform(items, thing)))
    return found.select(*_others(rows), "objects", F.array_min(F.transform("objects", lambda o: o["ttc"])).alias("min_ttc"))


def chassis(dumps: DataFrame) -> DataFrame:
    """Chassis messages: at_ms, acceleration, speed, pedal (per cent), override, still, driver_work_type."""
    rows = _headed(dumps, "timestamp_us")
    text = {name: field(F.col("__p"), *where) for name, where in CHASSIS_NAMES.items()}
    numbers = [number(text[name]).alias(name) for name in ("acceleration", "speed", "pedal")]
    flags = [flag(text[name]).alias(name) for name in ("override", "still")]
    return rows.select(*_others(rows), *numbers, *flags, text["driver_work_type"].try_cast("int").alias("driver_work_type"))


def control(dumps: DataFrame) -> DataFrame:
    """Control messages: at_ms and the accelerations in the JSON of their extra entry."""
    rows = _headed(dumps, "timestamp_us")
    named = F.concat(F.lit('"json": '), F.regexp_extract(field(F.col("__p"), "extra", "json"), r"(\{.*\})", 1))
    return rows.select(*_others(rows), *(number(json_value(named, "json", n)).alias(n) for n in CONTROL_NAMES))


def body(dumps: DataFrame) -> DataFrame:
    """Body messages: at_ms, shown_speed (km/h on the dashboard)."""
    rows = _headed(dumps, "timestamp_us")
    return rows.select(*_others(rows), number(field(F.col("__p"), *BODY_NAMES)).alias("shown_speed"))


def cruise(dumps: DataFrame) -> DataFrame:
    """Cruise messages: at_ms, cruise_limit (km/h; a member of the message's JSON at any depth, the first of that name)."""
    rows = paragraphs(dumps, "seq").withColumn("__p", joined(F.col("paragraph")))
    told = F.regexp_extract("__p", rf'"{CRUISE_NAME}"\s*:\s*([-+.0-9eE]+)', 1)
    return rows.select(*_others(rows), _stamped(F.col("__p")).alias("at_ms"), number(told).alias("cruise_limit"))


def _matched(rows: DataFrame, messages: DataFrame, keys: list[str], ref: str, values: list[str]) -> DataFrame:
    """``rows`` with the values of the message nearest to the time ``ref`` that each names, the earlier if as near; null without one."""
    from ..operators.alignment import asof

    named = asof(rows.where(F.col(ref).isNotNull()).withColumn("at_ms__", F.col(ref)), messages.select(*keys, F.col("at_ms").alias("at_ms__"), *values), keys, "at_ms__", values).drop("at_ms__", "match_t", "gap")
    none = rows.where(F.col(ref).isNull()).select("*", *(F.lit(None).cast(messages.schema[v].dataType).alias(v) for v in values))
    return named.select(*none.columns).unionByName(none)


def frames(plans: DataFrame, things: DataFrame, vehicle: DataFrame, keys: list[str], steering: DataFrame | None = None, body: DataFrame | None = None, cruise: DataFrame | None = None) -> DataFrame:
    """Planning messages with the object, chassis and (``steering``) control messages that they were made from, as planner frames (``plans.planner``);
    with shown_speed by the ``body`` message that they name, and cruise_limit by the ``cruise`` message nearest to them, if these are given.

    ``position`` is the message's place in its dump: of messages of one time the later counts where only one can.
    A message that names no time borrows that of the message before, if the one behind names one as well. The pedal tells an
    override where its own field is missing.
    """
    from pyspark.sql import Window

    w = Window.partitionBy(*keys).orderBy("at_ms")
    rows = plans.withColumns({ref: F.lit(None).cast("double") for ref in SOURCES if ref not in plans.columns})
    for ref in SOURCES:
        rows = rows.withColumn(ref, F.coalesce(ref, F.when(F.lead(ref).over(w).isNotNull(), F.lag(ref).over(w))))
    seen = things.withColumn("objects_at", F.col("at_ms"))
    rows = _matched(rows, seen, keys, "objects_ms", ["objects", "objects_at"])
    rows = _matched(rows, vehicle.withColumn("over", F.coalesce("override", F.col("pedal") > 0, F.lit(False))), keys, "chassis_ms", ["acceleration", "speed", "over", "still"])
    if steering is None:
        rows = rows.withColumn("slope_acc", F.lit(None).cast("double"))
    else:
        rows = _matched(rows, steering, keys, "control_ms", ["slope_acc"])
    more = []
    if body is not None:
        rows, more = _matched(rows, body, keys, "body_ms", ["shown_speed"]), ["shown_speed"]
    if cruise is not None:
        rows = _matched(rows.withColumn("own_ms", F.col("at_ms")), cruise, keys, "own_ms", ["cruise_limit"]).drop("own_ms")
        more = [*more, "cruise_limit"]
    us = lambda x: (F.col(x) * 1000).cast("long")
    return rows.select(*keys, us("at_ms").alias("us"), F.col("position").cast("long").alias("arrival"), "np_on", F.col("over").alias("override"), "speed", "acceleration", F.coalesce("still", F.lit(False)).alias("still"), "set_speed", "red_light", "stop_distance", "non_straight", "max_curvature", "curve_limit", "curve_limited", "slope_acc", "lead_id", us("objects_at").alias("objects_us"), F.lit(True).alias("primary"), F.coalesce("objects", F.from_json(F.lit("[]"), f"array<struct<{OBJECT.replace(' ', ':')}>>".replace(",:", ","))).alias("objects"), *more)
