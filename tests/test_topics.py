"""Text dumps of messages."""

from tachyline.sources import topics as T

PLAN = """1700000000000000001 seq: 1
header:
  stamp:
    secs: 1700000000
    nsecs: 500000000
json: '{"InputMessageInfo": {"messageInfos": {"/perception/fusion/object_auto": {"metaTimeMs": 1700000000400.5}, "/vehicle/chassis_report": {"metaTimeMs": 1700000000410}}},
"FrameInfo": {"id": 3, "function": "UNP"}, "traffic_light_decider_info": {"stop_flag": true, "stop_distance": 12.5}, "acc_info": {"a": 1, "cruise_velocity": 60},
"curvature_info": {"max_curvature": 0.01, "curv_velocity_limit": 40.5, "is_curv_v_limit_enable": false}, "turn_signal_info": {"signal_direction": 2}, \\"leadone_info\\": {\\"object_id\\": 7, \\"x\\": 1}}'

1700000000000000002 seq: 2
nothing of use
1700000000000000003 header: not of this kind
"""
OBJECTS = """1700000000000000001 header:
meta:
  a: 1
  sensor_timestamp_us: 1700000000400500
perception_fusion_objects_data:
  - track_id: 7
    available: True
    crash_risk_ttc: 9.5
    relative_position:
      x: 20.5
      y: -0.25
    velocity_relative_to_ground:
      x: 8
    acceleration_relative_to_ground:
      x: -0.75
    shape:
      length: 4.5
    extra_json: "{}"
  - track_id: 8
    available: False
    crash_risk_ttc: 1
    extra_json: ""
  - track_id: 9
    available: True
    extra_json: "x"
reserved_infos: []
1700000000000000002 header:
no meta
"""
CHASSIS = """1700000000000000001 header:
meta:
  timestamp_us: 1700000000410000
brake_info_report_data:
  accleration_on_wheel: -1.5
  stationary: False
throttle_info_report_data:
  vehicle_speed_average: 10.25
  throttle_pedal_percent: 3
throttle_report:
  throttle_report_data:
    override: True
brake_report:
  brake_report_data:
    driver_work_type:
      value: 2
"""
CONTROL = '1700000000000000001 header:\nmeta:\n  timestamp_us: 1700000000420000\nextra:\n  json: "{\\"slope_acc\\"\\\n:-0.1, \\"acc_ref\\": .5, \\"acc_wheel\\": 2}"\n'


def dump(spark, text):
    return spark.createDataFrame([("a", text), ("b", ""), ("c", None)], "path string, text string")


def test_planning_messages(spark):
    one, two = T.planning(dump(spark, PLAN)).orderBy("position").collect()
    assert (one.at_ms, one.function, one.np_on, one.red_light, one.stop_distance, one.set_speed) == (1700000000500.0, "UNP", True, True, 12.5, 60.0)
    assert (one.max_curvature, one.curve_limit, one.curve_limited, one.non_straight, one.knows_turns, one.lead_id, one.objects_ms, one.chassis_ms) == (0.01, 40.5, False, True, True, 7, 1700000000400.5, 1700000000410.0)
    assert (two.at_ms, two.np_on, two.red_light, two.stop_distance, two.set_speed, two.curve_limit, two.knows_turns, two.lead_id) == (1.700000000000000002e18, False, False, 1000.0, 0.0, 100.0, False, None)


def test_object_messages(spark):
    (row,) = T.objects(dump(spark, OBJECTS)).collect()
    assert row.at_ms == 1700000000400.5 and row.min_ttc == 9.5
    assert [tuple(o) for o in row.objects] == [(7, 20.5, -0.25, 9.5, 8.0, -0.75, 4.5), (9, None, None, None, None, None, None)]


def test_chassis_and_control_messages(spark):
    (row,) = T.chassis(dump(spark, CHASSIS)).collect()
    assert (row.at_ms, row.acceleration, row.speed, row.pedal, row.override, row.still, row.driver_work_type) == (1700000000410.0, -1.5, 10.25, 3.0, True, False, 2)
    (row,) = T.control(dump(spark, CONTROL)).collect()
    assert (row.at_ms, row.slope_acc, row.acc_ref, row.acc_wheel, row.acc_ego_real) == (1700000000420.0, -0.1, 0.5, 2.0, None)


def test_dumps_are_read_whole(spark, tmp_path):
    (tmp_path / "x_chassis.txt").write_text(CHASSIS)
    assert T.chassis(T.read_dumps(spark, [str(tmp_path / "x_chassis.txt")])).count() == 1


def test_frames_take_the_messages_that_they_name(spark):
    from tachyline.plans import planner as P

    plans = spark.createDataFrame([("a", 0, 1000.0, True, False, 9.0, 60.0, False, 0.0, 100.0, False, 7, 990.0, 995.0), ("a", 1, 1100.0, True, False, 9.0, 60.0, True, 0.0, 100.0, False, 7, None, 1095.0), ("a", 2, 1200.0, True, True, 9.0, 60.0, False, 0.0, 100.0, False, None, 1190.0, None)], "path string, position int, at_ms double, np_on boolean, red_light boolean, stop_distance double, set_speed double, non_straight boolean, max_curvature double, curve_limit double, curve_limited boolean, lead_id long, objects_ms double, chassis_ms double")
    things = spark.createDataFrame([("a", 980.0, [(7, 30.0, 0.0, 9.5, 8.0, 0.0, 4.5)]), ("a", 1190.0, [])], f"path string, at_ms double, objects array<struct<{T.OBJECT.replace(', ', ',').replace(' ', ':')}>>")
    vehicle = spark.createDataFrame([("a", 990.0, -1.0, 10.0, 5.0, None, False), ("a", 1000.0, -2.0, 9.0, 5.0, False, False)], "path string, at_ms double, acceleration double, speed double, pedal double, override boolean, still boolean")
    one, two, three = T.frames(plans, things, vehicle, ["path"]).orderBy("us").collect()
    assert (one.acceleration, one.override, one.objects_us, len(one.objects)) == (-1.0, True, 980000, 1)
    assert (two.acceleration, two.override, two.objects_us, len(two.objects)) == (-2.0, False, 980000, 1)
    assert [r.non_straight for r in (one, two, three)] == [False, True, False] and [r.arrival for r in (one, two, three)] == [0, 1, 2]
    assert (three.acceleration, three.speed, three.objects_us, three.objects) == (None, None, 1190000, [])
    seen = P.candidates(T.frames(plans, things, vehicle, ["path"])).orderBy("us").select("unmatched", "clear").collect()
    assert [tuple(r) for r in seen] == [(False, True), (False, True), (False, True)]


def test_fields_come_from_their_own_block(spark):
    later = """1700000000000000001 header:
meta:
  sensor_timestamp_us: 1700000000400500
perception_fusion_objects_data:
- track_id: 7
  available: True
  relative_position:
    y: 1.5
  shape:
    width: 2
  velocity_relative_to_ground:
    x: 3
    length: 99
  extra_json: "{\\"relative_position\\": {\\"x\\": 4}}"
- track_id: 8
  relative_position:
    x: 55
  available: True
other:
  x: 1
"""
    (row,) = T.objects(dump(spark, later)).collect()
    assert [tuple(o) for o in row.objects] == [(7, None, 1.5, None, 3.0, None, None), (8, 55.0, None, None, None, None, None)]
    plan = '1700000000000000001 seq: 1\njson: "{\\"curvature_info\\": {\\"deep\\": {\\"max_curvature\\": 9}}, \\"acc_info\\": {\\"cruise_velocity\\": -.5}, \\"max_curvature\\": 7, \\"FrameInfo\\": {\\"in\\": {\\"a\\": {}}, \\"function\\": \\\n \\"UNP\\"}}"\n'
    (row,) = T.planning(dump(spark, plan)).collect()
    assert (row.max_curvature, row.set_speed, row.function, row.np_on, row.stop_distance, row.control_ms) == (0.0, -0.5, "UNP", True, 1000.0, None)
    chassis = CHASSIS.replace("    override: True\n", "").replace("  stationary: False\n", "")
    (row,) = T.chassis(dump(spark, chassis + "other:\n  override: True\n  stationary: True\n")).collect()
    assert (row.override, row.still, row.driver_work_type) == (None, None, 2)


def test_very_long_blocks(spark):
    items = "".join(f"  - track_id: {k}\n    available: True\n    crash_risk_ttc: {k}\n" for k in range(20_000))
    (row,) = T.objects(dump(spark, f"1700000000000000001 header:\nmeta:\n  sensor_timestamp_us: 1\nperception_fusion_objects_data:\n{items}")).collect()
    assert len(row.objects) == 20_000 and row.min_ttc == 0.0


BODY = "1700000000000000001 header:\nmeta:\n  timestamp_us: 1700000000430000\nauxiliary_report:\n  auxiliary_report_data:\n    vehicle_speed_on_dashboard: 41.5\nother:\n  vehicle_speed_on_dashboard: 9\n"
CRUISE = '1700000000000000001 seq: 1\nstamp:\n  secs: 1700000000\n  nsecs: 250000000\njson: "{\\"deep\\": {\\"cruise_speed_limit\\" \\\n : 80.5}}"\n1700000000000000002 seq: 2\njson: "{}"\n'


def test_body_and_cruise_messages(spark):
    (row,) = T.body(dump(spark, BODY)).collect()
    assert (row.at_ms, row.shown_speed) == (1700000000430.0, 41.5)
    (row,) = T.body(dump(spark, BODY.replace("    vehicle_speed_on_dashboard: 41.5\n", ""))).collect()
    assert row.shown_speed is None
    one, two = T.cruise(dump(spark, CRUISE)).orderBy("position").collect()
    assert (one.at_ms, one.cruise_limit, two.at_ms, two.cruise_limit) == (1700000000250.0, 80.5, 1700000000000000002.0, None)


def test_frames_take_the_dashboard_by_name_and_the_cruise_message_by_time(spark):
    columns = "path string, position int, at_ms double, np_on boolean, red_light boolean, stop_distance double, set_speed double, non_straight boolean, max_curvature double, curve_limit double, curve_limited boolean, lead_id long, objects_ms double, chassis_ms double, body_ms double"
    plans = spark.createDataFrame([("a", k, 1000.0 + 100 * k, True, False, 9.0, 60.0, False, 0.0, 100.0, False, None, None, None, ref) for k, ref in enumerate((980.0, None, 1210.0, None))], columns)
    things = spark.createDataFrame([], f"path string, at_ms double, objects array<struct<{T.OBJECT.replace(', ', ',').replace(' ', ':')}>>")
    vehicle = spark.createDataFrame([], "path string, at_ms double, acceleration double, speed double, pedal double, override boolean, still boolean")
    shown = spark.createDataFrame([("a", 970.0, 40.0), ("a", 1200.0, 41.0)], "path string, at_ms double, shown_speed double")
    limits = spark.createDataFrame([("a", 900.0, 80.0), ("a", 1150.0, None), ("b", 1000.0, 1.0)], "path string, at_ms double, cruise_limit double")
    got = T.frames(plans, things, vehicle, ["path"], body=shown, cruise=limits).orderBy("us").collect()
    assert [r.shown_speed for r in got] == [40.0, 40.0, 41.0, None]  # the second borrows the first one's time, the last has none behind it
    assert [r.cruise_limit for r in got] == [80.0, None, None, None]
    assert "shown_speed" not in T.frames(plans, things, vehicle, ["path"]).columns
