"""Reports read back: headers, layouts, what counts, and what a report is of."""

from pyspark.sql import functions as F

from tachyline.operators import reports as R
from tachyline.sources import report_files as RF


def test_layouts_headers_and_broken_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Report\n\n 指标名称 ,指标类型,指标值,总次数,触发次数\njerk,CPI,0.5,10,5\nstop,mpi,\"1,200.5\",7,\nother,XYZ,1,1,1\n,CPI,9,9,9\n", "utf-8-sig")
    (tmp_path / "b.csv").write_bytes("指标来源,指标名称,MPI,CPI\ncan,急刹,3,\nTopic,急刹,4,0.1\n,急刹,,0.2\n".encode("gbk"))
    (tmp_path / "c.csv").write_text("x,y\n" * 12 + "metric,value\n")
    (tmp_path / "d.csv").write_text("metric,total\nm,1\n")
    (tmp_path / "e.csv").write_text("")
    rows = RF.read_rows(spark, str(tmp_path))
    errors = {r.path[-5:]: r.error for r in rows.where("error is not null").collect()}
    assert errors == {"c.csv": "no header", "d.csv": "no value column"}
    got = {(r.path[-5:], r.key, r.kind): (r.value, r.number, r.total, r.bad) for r in RF.values(rows).collect()}
    assert got[("a.csv", "jerk", "CPI")] == ("0.5", 0.5, "10", "5") and got[("a.csv", "stop", "MPI")] == ("1,200.5", 1200.5, "7", None)
    assert got[("b.csv", "can::急刹", "MPI")][1] == 3.0 and got[("b.csv", "topic::急刹", "CPI")][1] == 0.1
    # The plain name has its row without a source, though that one has no MPI; a name with sources only would have the first.
    assert got[("b.csv", "急刹", "MPI")][1] is None and got[("b.csv", "急刹", "CPI")][1] == 0.2
    assert len(got) == 2 + 6


def test_a_name_with_sources_only_has_its_first_row_and_a_source_its_last(spark, tmp_path):
    (tmp_path / "a.csv").write_text("metric,source,category,value\nm,can,MPI,1\nm,topic,MPI,2\nm,can,MPI,3\n")
    got = {r.key: r.number for r in RF.values(RF.read_rows(spark, str(tmp_path))).collect()}
    assert got == {"m": 1.0, "can::m": 3.0, "topic::m": 2.0}


def test_written_results_are_read_back(spark, tmp_path):
    results = spark.createDataFrame([("m1", "CPI", 0.25, 8, 2), ("m2", "MPI", 12.5, 3, 1)], "name string, category string, value double, total long, bad long")
    R.write_results(results.withColumn("metric", F.col("name")).select("metric", F.col("name").alias("signal"), "category", "value", "total", "bad"), f"{tmp_path}/out")
    got = {(r.key, r.kind, r.number, r.total, r.bad) for r in RF.values(RF.read_rows(spark, f"{tmp_path}/out")).collect()}
    assert got == {("m1", "CPI", 0.25, "8", "2"), ("m2", "MPI", 12.5, "3", "1")}


def test_what_a_report_is_of(spark):
    paths = {
        "/r/topic_E1_20240102_2024-01-09_v1_b.csv": ("topic", "E1", "20240102", "20240109", "v1_b"),
        "/r/car-7-GT-20240102~20240109-v1-2 (3).xlsx": ("unified", "car-7 GT", "20240102", "20240109", "v1-2"),
        "/r/car-20240102-v1.csv": ("unified", "car", "20240102", "20240102", "v1"),
        "/r/my_car_20240102_20240109_v_1.csv": ("unified", "my_car", "20240102", "20240109", "v_1"),
        "/r/B10x_Data/plain.csv": (None, "B10x", None, None, None),
        "/r/nothing.csv": (None, None, None, None, None),
    }
    rows = spark.createDataFrame([(p,) for p in paths], "path string").select("path", RF.identity(F.col("path")).alias("i"))
    assert {r.path: tuple(r.i) for r in rows.collect()} == paths
    one = spark.createDataFrame([("/r/nothing.csv", "/in/C5_Data/x")], "path string, text string").select(RF.identity(F.col("path"), F.col("text")).alias("i")).first()
    assert one.i.vehicle == "C5"
