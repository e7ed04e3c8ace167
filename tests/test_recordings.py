"""Catalogues of recordings, signals as Parquet, result files, and the small formulas that no query reaches."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tachyline.functions import scalars as S
from tachyline.operators import reports as R, windows as W
from tachyline.sources import recordings as RC


def test_files_are_listed_and_sorted_by_their_time(spark, tmp_path):
    for name in ("20240102/x_2024-01-02-10-00-00.parquet", "20240102/x_2024-01-02-09-00-00.parquet", "20240105/undated.parquet", "none/plain.parquet", "none/other.txt"):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(b"12345")
    files = RC.list_files(spark, str(tmp_path))
    assert {(os.path.basename(r.path), r["size"]) for r in files.collect()} == {(n, 5) for n in ("x_2024-01-02-10-00-00.parquet", "x_2024-01-02-09-00-00.parquet", "undated.parquet", "plain.parquet")}
    dated = RC.with_dates(files.withColumn("path", F.replace("path", F.lit(str(tmp_path)), F.lit(""))))
    names = [os.path.basename(r.path) for r in dated.orderBy(*RC.chronological()).collect()]
    assert names == ["plain.parquet", "x_2024-01-02-09-00-00.parquet", "x_2024-01-02-10-00-00.parquet", "undated.parquet"]
    inside = RC.with_dates(files.withColumn("path", F.replace("path", F.lit(str(tmp_path)), F.lit(""))), dates="20240102-20240104")
    assert inside.count() == 2 and {r.rec_date for r in inside.collect()} == {dt.date(2024, 1, 2)}


SIGNALS = [("a", "speed", 2, 0.0, 1.0), ("a", "speed", 1, 0.0, 2.0), ("a", "speed", 1, 0.1, 3.0), ("a", "brake", 1, 0.2, 4.0), ("b", "speed", 3, 0.0, 5.0), ("b", "gear", 1, 9.0, 6.0)]


@pytest.fixture
def signals(spark, tmp_path):
    rows = spark.createDataFrame([(*s, "p") for s in SIGNALS], RC.SIGNALS)
    rows.write.partitionBy("field").parquet(f"{tmp_path}/signals")
    return f"{tmp_path}/signals"


def test_signals_are_read_by_field_time_and_recording(spark, signals):
    got = RC.read_signals(spark, signals, ["speed", "gear"], end=0.05)
    assert sorted(r.value for r in got.collect()) == [1.0, 2.0, 5.0]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "LessThanOrEqual(t,0.05)" in plan
    only = RC.read_signals(spark, signals, recordings=spark.createDataFrame([("b",)], "recording_id string"))
    assert sorted(r.value for r in only.collect()) == [5.0, 6.0]
    picked = RC.pick_paths(RC.read_signals(spark, signals))
    assert sorted((r.recording_id, r.field, r.value) for r in picked.collect()) == [("a", "brake", 4.0), ("a", "speed", 2.0), ("a", "speed", 3.0), ("b", "gear", 6.0), ("b", "speed", 5.0)]


def test_missing_signals_by_metric(spark, signals):
    required = spark.createDataFrame([("m1", "speed"), ("m1", "gear"), ("m2", "brake")], "metric string, field string")
    got = RC.missing_signals(required, RC.read_signals(spark, signals))
    assert sorted(tuple(r) for r in got.select("recording_id", "metric", "field").collect()) == [("a", "m1", "gear"), ("b", "m2", "brake")]
    assert RC.missing_signals(required.limit(0), RC.read_signals(spark, signals)).count() == 0


def test_the_primary_file_and_eligible_folders(spark):
    files = spark.createDataFrame([("f", "b_can_data.h5", True), ("f", "a.h5", True), ("g", "z_can_data.h5", False), ("g", "y.h5", True), ("h", "d.h5", False), ("h", "c.h5", False)], "folder string, name string, has_all boolean")
    assert {r.folder: r.name for r in RC.primary_files(files).collect()} == {"f": "b_can_data.h5", "g": "y.h5", "h": "c.h5"}
    folders = spark.createDataFrame([("/r/20240101_a_done", "sw v2"), ("/r/20240101_b", "sw v2"), ("/r/x_done", "sw v2"), ("/r/20240102_done", None)], "path string, info string")
    assert {r.path for r in RC.eligible_folders(folders).collect()} == {"/r/20240101_a_done", "/r/20240102_done"}
    assert {r.path for r in RC.eligible_folders(folders, software="v2").collect()} == {"/r/20240101_a_done"}


def test_results_and_events_go_to_files_and_come_back(spark, tmp_path):
    results = spark.createDataFrame([("m1", "a", 2.0), ("m1", "b", None), ("m2", "a", 0.5)], "metric string, source_path string, severity double")
    R.write_results(results, f"{tmp_path}/csv")
    back = spark.read.option("header", True).option("inferSchema", True).csv(f"{tmp_path}/csv")
    assert sorted(map(str, back.select(results.columns).collect())) == sorted(map(str, results.collect()))
    assert sorted(d for d in os.listdir(tmp_path / "csv") if d.startswith("metric=")) == ["metric=m1", "metric=m2"]
    events = spark.createDataFrame([("m1", "a", 1.0, 10, 20), ("m1", "a", 3.0, 30, 40)], "metric string, source_path string, severity double, start_us long, end_us long")
    R.write_events(results, events, ["metric", "source_path"], f"{tmp_path}/json")
    lines = [json.loads(x) for d in (tmp_path / "json").glob("metric=m1/*.json") for x in d.read_text().splitlines()]
    assert {x["source_path"]: [e["severity"] for e in x.get("events", [])] for x in lines} == {"a": [3.0, 1.0], "b": []}


def test_a_column_or_a_default(spark):
    rows = spark.createDataFrame([(1.0,)], "x double")
    assert rows.select(R.column_or(rows, "x"), R.column_or(rows, "y", 7)).first()[:] == (1.0, 7.0)
    with pytest.raises(KeyError):
        R.column_or(rows, "y")


def test_the_trailing_rate_needs_whole_windows(spark):
    values = [0.0, 1.0, 3.0, None, 4.0, 8.0, 8.0]
    rows = spark.createDataFrame([("a", 10 * k, v) for k, v in enumerate(values)], "id string, us long, v double")
    got = [r.rate for r in W.trailing_rate(rows, "v", 10, ["id"], ["us"], "us", "rate", unit=10).orderBy("us").collect()]
    means = [None if None in values[max(0, k - 1) : k + 1] else sum(values[max(0, k - 1) : k + 1]) / len(values[max(0, k - 1) : k + 1]) for k in range(7)]
    want = [None if k == 0 or means[k] is None or means[k - 1] is None else means[k] - means[k - 1] for k in range(7)]
    assert got[1:] == want[1:] and got[0] == want[1]


def test_formulas_on_invalid_and_unknown_values(spark):
    rows = spark.createDataFrame([(1, None, None), (None, 2, False), (0, 0, True), (3, 0, None)], "s int, m int, u boolean")
    got = [r.x for r in rows.select(S.non_straight(F.col("s"), F.col("m"), F.col("u")).alias("x")).collect()]
    assert got == [True, True, True, False]
    checked = spark.createDataFrame([(1.0, 0.0), (2.0, 1.0), (3.0, None), (None, 0.0)], "v double, invalid double")
    assert [r.x for r in checked.select(S.valid(F.col("v"), F.col("invalid")).alias("x")).collect()] == [1.0, None, None, None]
    assert [r.x for r in checked.select(S.valid(F.col("v"), None).alias("x")).collect()] == [1.0, 2.0, 3.0, None]
    assert [S.by_powertrain(p, 1.0, 2.0) for p in ("ICE", "PHEV", "BEV")] == [1.0, 2.0, 2.0]


def test_signals_are_discovered_by_path_name_and_values(spark):
    from tachyline.sources.discovery import Wanted, discover

    wanted = Wanted("active", ("ch1/n/d/Req_0x1/signals/Active",), (("Active", ("0x1", "Req")), ("Alias", ("0x2",))), ((0, 1), (4, 5)))
    plain, rooted = "ch1/n/d/Req_0x1/signals/Active", "root/ch1/n/d/Req_0x1/signals/Active"
    three, four, nine = "ch3/n/d/Req_0x1/signals/Active", "CH4/n/d/X_0x2/signals/Alias", "ch9/n/d/Req_0x1/signals/Active"
    data = {
        "known": {rooted: [9.0], three: [0.0]},  # a known path counts, whatever its values
        "values": {three: [4.0, 5.0], nine: [0.0, 1.9]},  # cut to whole numbers
        "channel": {nine: [7.0], three: [7.0], "ch2/n/d/Req_0x1/signals/Active": [7.0]},
        "alias": {four: [float("nan")], "ch3/n/d/Other/signals/Alias": [0.0], "x/y/ch3/n/d/Req_0x1/signals/Active": [0.0]},
        "none": {"ch3/n/d/Req_0x1/signals/Other": [0.0]},
        "both": {plain: [8.0], rooted: [0.0]},
    }
    rows = [(r, f, float(k), v) for r, paths in data.items() for f, values in paths.items() for k, v in enumerate(values)]
    signals = spark.createDataFrame(rows, "recording_id string, field string, t double, value double")
    got = {r.recording_id: (r.field, r.score) for r in discover(signals, [wanted]).collect()}
    assert got == {"known": (rooted, 2), "values": (nine, 0), "channel": (three, 2), "alias": (four, 2), "both": (rooted, 0)}
    late = spark.createDataFrame([("a", nine, float(k), float(k == 9) * 7) for k in range(10)] + [("a", three, 0.0, 4.0)], signals.schema)
    assert [r.field for r in discover(late, [wanted], sample=9).collect()] == [nine] and [r.field for r in discover(late, [wanted], None).collect()] == [three]
