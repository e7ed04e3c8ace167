"""Runs that only do what has changed: a store of results by input file, added to by generations.

Each run writes its results as a generation and then, in one small table, what became of every file it took: path, time
of change, size and configuration with a status. That table commits the run: results that no state row names don't
count, so a run that dies leaves nothing but unread files and its files are pending again. Of several generations the
last one that did a file counts; nothing is changed in place. ``compact`` writes what counts as one generation.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

#: What one file is known by: it is done again when any of these differs.
IDENTITY = ["path", "modified", "size", "config"]
STATE = "path string, modified timestamp, size long, config string, status string, error string, run string"
DONE = ("success", "skipped")


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class ResultStore:
    """Results and states under ``root``. ``schema``: the results' columns, path among them."""

    def __init__(self, spark: SparkSession, root: str, schema: str):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema

    def states(self) -> DataFrame:
        """The last state of every file that was ever taken, failures included."""
        w = Window.partitionBy("path").orderBy(F.desc("run"))
        return _read(self.spark, f"{self.root}/state", STATE).withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")

    def pending(self, files: DataFrame, config: str) -> DataFrame:
        """Those of ``files`` (path, modified, size, ...) that aren't done as they are now: new, changed, failed, or done with another configuration."""
        done = self.states().where(F.col("status").isin(*DONE)).select(*IDENTITY)
        wanted = files.withColumn("config", F.lit(config))
        same = [wanted[c].eqNullSafe(done[c]) for c in IDENTITY]
        return wanted.join(done, same, "left_anti").drop("config")

    def run(self, files: DataFrame, config: str, compute: Callable[[DataFrame], tuple[DataFrame, DataFrame | None]]) -> DataFrame:
        """Do what is pending of ``files`` and return the state rows written, none if nothing was.

        ``compute`` takes the pending files and gives (results, failures): results with a ``path`` each, failures (path,
        error) or None. A file without results is ``skipped``; a failed one gives none that count and is pending again.
        """
        name = f"{time.time_ns() // 1_000_000:015d}-{uuid.uuid4().hex[:8]}"
        todo = self._keep(self.pending(files, config).select("path", "modified", "size"), f"{self.root}/taken/run={name}")
        if todo.isEmpty():
            return self.spark.createDataFrame([], STATE)
        results, failures = compute(todo)
        results = self._keep(results.select(*self._columns()), f"{self.root}/results/run={name}")
        failures = self.spark.createDataFrame([], "path string, error string") if failures is None else failures.groupBy("path").agg(F.min("error").alias("error"))
        gave = results.select("path").distinct().withColumn("gave", F.lit(True))
        rows = todo.join(failures.withColumn("failed", F.lit(True)), "path", "left").join(gave, "path", "left")
        status = F.when(F.col("failed"), "failed").when(F.col("gave"), "success").otherwise("skipped")
        rows = rows.select("path", "modified", "size", F.lit(config).alias("config"), status.alias("status"), "error", F.lit(name).alias("run"))
        return self._keep(rows, f"{self.root}/state/run={name}", drop="run").withColumn("run", F.lit(name))

    def results(self, files: DataFrame | None = None) -> DataFrame:
        """The results that count: of each file those of its last run, if that didn't fail; of ``files`` only, if given."""
        last = self.states().where(F.col("status") == "success").select("path", "run")
        if files is not None:
            last = last.join(files.select("path").distinct(), "path", "left_semi")
        return _read(self.spark, f"{self.root}/results", f"{self.schema}, run string").join(last, ["path", "run"], "left_semi").select(*self._columns())

    def compact(self, root: str) -> ResultStore:
        """A store at another ``root`` with what counts here, as one generation."""
        name, other = f"{time.time_ns() // 1_000_000:015d}-{uuid.uuid4().hex[:8]}", ResultStore(self.spark, root, self.schema)
        self._keep(self.results(), f"{other.root}/results/run={name}")
        self._keep(self.states().withColumn("run", F.lit(name)), f"{other.root}/state/run={name}", drop="run")
        return other

    def summary(self, files: DataFrame, config: str) -> DataFrame:
        """status, n over ``files`` as they are now; those not done so far are ``missing``."""
        known = self.states().where(F.col("config") == config).select("path", "modified", "size", "status")
        same = [files[c].eqNullSafe(known[c]) for c in ("path", "modified", "size")]
        return files.join(known, same, "left").groupBy(F.coalesce("status", F.lit("missing")).alias("status")).agg(F.count("*").alias("n"))

    def _columns(self) -> list[str]:
        return self.spark.createDataFrame([], self.schema).columns

    def _keep(self, rows: DataFrame, path: str, drop: str | None = None) -> DataFrame:
        rows = rows.drop(drop) if drop else rows
        rows.write.mode("errorifexists").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)
