"""Reading result reports back: tables whose header is somewhere in the first rows, under several names and in three layouts.

A report is a small CSV file. Its header is the first of ten rows that has a column for the metric's name; columns are known by their
names in either language. One layout has a value with its kind (MPI or CPI) in a row, another a column for each kind, and either may
say where a metric comes from. Files are dealt out whole, one after another within a task, and what they are of is
told by their names, else by what a manifest or the folder says.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Column names of reports (fixed values), in order of preference.
COLUMNS = {
    "metric": ("指标名称", "metric", "signal"),
    "source": ("指标来源", "source", "sourcekind", "kind"),
    "kind": ("指标类型", "category", "type"),
    "value": ("指标值", "value", "metricvalue"),
    "total": ("总case之和", "总次数", "total", "总里程(km)"),
    "bad": ("bad case之和", "触发次数", "bad", "badcase"),
    "MPI": ("mpi",),
    "CPI": ("cpi",),
}
HEADER_ROWS = 10
ROWS = "path string, line long, source string, metric string, kind string, value string, total string, bad string, error string"
_NAMES = [c.split()[0] for c in ROWS.split(", ")]


def _rows(path: str, content: bytes) -> Iterator[tuple]:
    """The rows of one report, or one that says why there are none."""
    try:
        text = content.decode("utf-8-sig")
    except UnicodeDecodeError:
        text = content.decode("gbk", "ignore")
    table = list(csv.reader(io.StringIO(text)))
    for at, row in enumerate(table[:HEADER_ROWS]):
        place = {v.strip().lower(): k for k, v in reversed(list(enumerate(row))) if v.strip()}
        found = {name: next((place[x] for x in names if x in place), None) for name, names in COLUMNS.items()}
        if found["metric"] is not None:
            break
    else:
        yield (path, None, None, None, None, None, None, None, "no header")
        return
    if found["value"] is None and found["MPI"] is None and found["CPI"] is None:
        yield (path, None, None, None, None, None, None, None, "no value column")
        return
    for line, row in enumerate(table[at + 1 :], at + 2):
        get = lambda name: row[found[name]].strip() or None if found[name] is not None and found[name] < len(row) else None  # noqa: B023, E731
        if not get("metric"):
            continue
        own = (path, line, (get("source") or "").lower() or None, get("metric"))
        if found["value"] is not None and found["kind"] is not None:
            kind = (get("kind") or "").upper()
            if kind in ("MPI", "CPI"):
                yield (*own, kind, get("value"), get("total"), get("bad"), None)
            continue
        for kind in ("MPI", "CPI"):
            if found[kind] is not None:
                yield (*own, kind, get(kind), get("total"), get("bad"), None)


def read_rows(spark: SparkSession, folder: str, glob: str = "*.csv") -> DataFrame:
    """``ROWS`` of the reports under a folder. A file without a header or a value column has one row with ``error``; an
    empty file has none."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = [r for path, content in zip(part.column("path").to_pylist(), part.column("content").to_pylist(), strict=True) for r in _rows(path, content)]
            if rows:
                types = [pa.string(), pa.int64(), *[pa.string()] * 7]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], _NAMES)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(folder)
    return files.select("path", "content").mapInArrow(run, ROWS)


def values(rows: DataFrame) -> DataFrame:
    """path, key, kind, value, number, total, bad: what counts for each metric and kind.

    ``source::metric`` has its last row. The plain ``metric`` has the last row without a source, else the first with one. ``number``
    is null where the value is no number.
    """
    good = rows.where("error is null").select("path", "line", "source", "metric", "kind", F.struct("value", "total", "bad").alias("v"))
    sourced = good.where("source is not null")
    named = sourced.groupBy("path", F.concat_ws("::", "source", "metric").alias("key"), "kind").agg(F.max_by("v", "line").alias("v"))
    # Among plain rows the last counts; rows with a source come behind all of them, the first of these before the others.
    rank = F.when(F.col("source").isNull(), F.col("line")).otherwise(-F.lit(2**40) - F.col("line"))
    plain = good.groupBy("path", F.col("metric").alias("key"), "kind").agg(F.max_by("v", rank).alias("v"))
    both = named.unionByName(plain).select("path", "key", "kind", "v.*")
    return both.withColumn("number", F.replace("value", F.lit(","), F.lit("")).try_cast("double"))


def identity(path: Column, manifest: Column | None = None) -> Column:
    """Struct (kind, vehicle, start_date, end_date, version) of a report by its file name, dates as YYYYMMDD.

    ``topic`` or ``can``, vehicle, two dates and version joined by underscores; else vehicle, one or two dates and version joined by
    hyphens, or by underscores. Where the name says nothing, the vehicle is what stands before ``Data`` in the ``manifest`` text
    or in the path's folders; all else is null.
    """
    stem = F.regexp_replace(F.regexp_replace(F.substring_index(path, "/", -1), r"\.[^.]*$", ""), r" \([0-9]+\)$", "")
    day = r"(20[0-9]{2}-?[0-9]{2}-?[0-9]{2})"
    shapes = [
        (rf"^(?i:topic|can)_([^_]+)_{day}_{day}_(.+)$", F.lower(F.substring_index(stem, "_", 1)), (1, 2, 3, 4)),
        (r"^(.+?)-(20[0-9]{6})(?:[-~](20[0-9]{6}))?-(.+)$", F.lit("unified"), (1, 2, 3, 4)),
        (rf"^((?!(?i:topic|can)_).+?)_{day}_{day}_(.+)$", F.lit("unified"), (1, 2, 3, 4)),
    ]
    none = F.lit(None).cast("string")
    before_data = r"([A-Za-z][0-9]+[A-Za-z]*)[_-]?Data"
    hints = [F.regexp_extract(x, before_data, 1) for x in ([manifest] if manifest is not None else []) + [path]]
    out = F.struct(none.alias("kind"), F.coalesce(*(F.when(h != "", h) for h in hints)).alias("vehicle"), *(none.alias(n) for n in ("start_date", "end_date", "version")))
    for pattern, kind, groups in reversed(shapes):
        vehicle, start, end, version = (F.regexp_extract(stem, pattern, g) for g in groups)
        plain = lambda d: F.replace(d, F.lit("-"), F.lit(""))
        # A hyphen between a model's number and its trim is a space.
        vehicle = F.when(kind == "unified", F.regexp_replace(vehicle, r"^(.+-[0-9]+)-([A-Za-z0-9]+)$", "$1 $2")).otherwise(vehicle)
        found = F.struct(kind.alias("kind"), vehicle.alias("vehicle"), plain(start).alias("start_date"), plain(F.when(end != "", end).otherwise(start)).alias("end_date"), version.alias("version"))
        out = F.when(stem.rlike(pattern), found).otherwise(out)
    return out
