"""Roll-ups: case rates (CPI), mileage rates (MPI), status, ranking of bad cases, run state."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def cpi(total: Column, bad: Column, zero_bad: float | None = 100.0) -> Column:
    """Cases per bad case; with none bad ``zero_bad``."""
    return F.when(bad == 0, F.lit(zero_bad).cast("double")).otherwise(total / bad)


def cpi_text(total: Column, bad: Column) -> Column:
    """``total/bad`` to one place with both counts, ``>total(total/0)`` if none is bad."""
    total, bad = total.cast("long"), bad.cast("long")
    return F.when(bad == 0, F.concat(F.lit(">"), total, F.lit("("), total, F.lit("/0)"))).otherwise(F.concat(F.format_string("%.1f", total / bad), F.lit("("), total, F.lit("/"), bad, F.lit(")")))


def mpi(km: Column, bad: Column) -> Column:
    """Kilometres per bad case; null without distance or bad cases."""
    return F.when(km.isNotNull() & (bad > 0), km / bad)


def mpi_text(km: Column, bad: Column) -> Column:
    return F.when(km.isNull(), "N/A").when(bad == 0, F.concat(F.lit(">"), F.format_string("%.3f", km), F.lit("("), F.format_string("%.3f", km), F.lit("/0)"))).otherwise(F.format_string("%.3f", km / bad))


def rollup(results: DataFrame, metric: Sequence[str] = ("metric",), source: str = "source_path") -> DataFrame:
    """Per metric: total, bad, skipped, errors, ok recordings, and km over its distinct sources.

    Distances are made unique by a partial aggregation per (metric, source) first, so no source counts twice.
    """
    one = results.groupBy(*metric, source).agg(F.max("distance_km").alias("km"), F.sum("total").alias("total"), F.sum("bad").alias("bad"), F.count_if(F.col("status") == "SKIPPED").alias("skipped"), F.count_if(F.col("status") == "ERROR").alias("errors"), F.count_if(~F.col("status").isin("SKIPPED", "ERROR")).alias("good"))
    return one.groupBy(*metric).agg(F.sum("total").alias("total"), F.sum("bad").alias("bad"), F.sum("km").alias("km"), F.sum("skipped").alias("skipped"), F.sum("errors").alias("errors"), F.sum("good").alias("good"))


def status(explicit: Column, error: Column, bad: Column) -> Column:
    """An explicit status, else ERROR, else BAD, else OK."""
    return F.coalesce(explicit, F.when(error.isNotNull(), "ERROR").when(bad > 0, "BAD").otherwise("OK"))


def severity_outside(value: Column, low: Column | float | None, high: Column | float | None, base: float) -> Column:
    """How far a value lies beyond its bounds, in percent of ``base``; 0 within, null without value."""
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    over = [F.lit(0.0)] + ([lit(low) - value] if low is not None else []) + ([value - lit(high)] if high is not None else [])
    worst = F.greatest(*over) if len(over) > 1 else over[0]
    return F.when(value.isNotNull(), F.round(worst / base * 100, 3))


def worst_cases(events: DataFrame, group: Sequence[str], severity: str, tie: Sequence[str | Column], top: int, least: float | None = None, ascending: bool = False) -> DataFrame:
    """The ``top`` events of each group by severity with their rank. A partial top per task keeps large groups small."""
    rows = events if least is None else events.where(F.col(severity) >= least)
    w = Window.partitionBy(*group).orderBy(F.asc(severity) if ascending else F.desc(severity), *tie)
    return rows.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= top)


def layered_rules(rules: DataFrame, targets: DataFrame, layers: Sequence[tuple[str, Column]]) -> DataFrame:
    """``targets`` with the fields of the most specific rule: ``layers`` are (scope, key), least specific first.

    A later layer replaces all fields of an earlier one. ``rules``: scope, key, fields (a struct).
    """
    picks, out = [], targets
    for k, (scope, key) in enumerate(layers):
        own = rules.where(F.col("scope") == scope).select(F.col("key").alias(f"__k{k}"), F.col("fields").alias(f"__f{k}"))
        out = out.withColumn("__key", key).join(own, F.col("__key").eqNullSafe(F.col(f"__k{k}")), "left").drop("__key", f"__k{k}")
        picks.insert(0, F.col(f"__f{k}"))
    return out.withColumn("fields", F.coalesce(*picks)).drop(*(f"__f{k}" for k in range(len(layers))))


def run_state(expected: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """status, n over the expected keys; those without a result are ``missing``."""
    return expected.join(done, list(keys), "left").groupBy(F.coalesce("status", F.lit("missing")).alias("status")).agg(F.count("*").alias("n"))


def upsert(table: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``table`` with ``rows`` in place of those of equal keys."""
    return table.join(rows.select(*keys).distinct(), list(keys), "left_anti").unionByName(rows)


def missing_fields(required: DataFrame, available: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What is required and not there."""
    return required.join(available.select(*keys).distinct(), list(keys), "left_anti")


def all_of(conditions: Sequence[Column]) -> Column:
    """All hold; an unknown one doesn't."""
    return reduce(lambda a, b: a & b, (F.coalesce(c, F.lit(False)) for c in conditions))
