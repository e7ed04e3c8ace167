"""Runs that only do what has changed, against full runs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tachyline.operators.incremental import ResultStore

SCHEMA = "path string, user_id long, n long, total double"
FILES = "path string, modified timestamp, size long"


def day(k):
    return dt.datetime(2024, 1, k)


@pytest.fixture
def store(spark, tmp_path):
    return ResultStore(spark, f"file://{tmp_path}/store", SCHEMA)


def work(spark, content, seen, broken=()):
    """What a run computes: sums by file over ``content`` (path -> rows), with the files it was asked for in ``seen``."""

    def compute(todo):
        paths = [r.path for r in todo.select("path").collect()]
        seen.append(sorted(paths))
        rows = spark.createDataFrame([(p, u, v) for p in paths for u, v in content[p]], "path string, user_id long, value double")
        failures = spark.createDataFrame([(p, "unreadable") for p in paths if p in broken], "path string, error string")
        return rows.groupBy("path", "user_id").agg(F.count("*").alias("n"), F.sum("value").alias("total")), failures

    return compute


def rows(frame):
    return sorted(map(tuple, frame.collect()))


def test_the_second_run_reads_only_what_changed_and_equals_a_full_run(spark, store, tmp_path):
    content = {f"f{k}": [(k % 3, 1.0 * k), (k, 2.0)] for k in range(6)} | {"f6": []}
    files = spark.createDataFrame([(p, day(1), 10) for p in content], FILES)
    seen = []
    first = store.run(files, "v1", work(spark, content, seen, broken=("f4",)))
    assert {r.path: r.status for r in first.collect()} == {p: "failed" if p == "f4" else "skipped" if p == "f6" else "success" for p in content}
    assert "f4" not in {r.path for r in store.results().collect()}
    # f1 has changed in time, f2 in size, f4 is whole now, f5 is gone, f7 is new.
    content = content | {"f1": [(9, 9.0)], "f2": [], "f7": [(7, 7.0)]}
    changed = spark.createDataFrame([(p, day(2) if p == "f1" else day(1), 11 if p == "f2" else 10) for p in content if p != "f5"], FILES)
    store.run(changed, "v1", work(spark, content, seen))
    assert seen[1] == ["f1", "f2", "f4", "f7"]
    full = ResultStore(spark, f"file://{tmp_path}/full", SCHEMA)
    full.run(changed, "v1", work(spark, content, []))
    assert rows(store.results(changed)) == rows(full.results()) != []
    assert {r.status: r.n for r in store.summary(changed, "v1").collect()} == {"success": 5, "skipped": 2}
    # Nothing is pending now; another configuration does all again.
    assert store.run(changed, "v1", work(spark, content, seen)).count() == 0 and len(seen) == 2
    assert store.pending(changed, "v2").count() == 7
    smaller = store.compact(f"file://{tmp_path}/compact")
    assert rows(smaller.results(changed)) == rows(full.results()) and smaller.pending(changed, "v1").count() == 0


def test_a_run_that_dies_leaves_nothing_that_counts(spark, store):
    content = {"a": [(1, 1.0)], "b": [(2, 2.0)]}
    files = spark.createDataFrame([(p, day(1), 1) for p in content], FILES)
    store.run(files.where("path = 'a'"), "v1", work(spark, content, []))
    before = rows(store.results())

    def dies(todo):
        results, _ = work(spark, content, [])(todo)
        results.write.parquet(f"{store.root}/results/run=000000000000001-dead")
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        store.run(files, "v1", dies)
    assert rows(store.results()) == before and [r.path for r in store.pending(files, "v1").collect()] == ["b"]
    # A file that did well before and fails after a change has no result until it is done again.
    again = spark.createDataFrame([("a", day(3), 1)], FILES)
    store.run(again, "v1", work(spark, content, [], broken=("a",)))
    assert rows(store.results()) == [] and store.pending(again, "v1").count() == 1


def test_nulls_and_empty_lists(spark, store):
    files = spark.createDataFrame([("a", None, None)], FILES)
    assert store.run(files.limit(0), "v1", work(spark, {}, [])).count() == 0 and store.results().count() == 0
    store.run(files, "v1", work(spark, {"a": [(1, 1.0)]}, []))
    assert store.pending(files, "v1").count() == 0 and store.results().count() == 1
