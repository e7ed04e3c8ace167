"""Runs of samples: islands, gap filling, interval merging, edges and the windows after them.

All are window functions over one shuffle by recording, followed by a partial aggregation where runs become rows.
``keys`` name the recording, ``order`` the sample order, ``time`` a numeric time (seconds or integer microseconds).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def _true(mask: Column | str) -> Column:
    return F.coalesce(F.expr(mask) if isinstance(mask, str) else mask, F.lit(False))


def mark_islands(df: DataFrame, mask: Column | str, keys: Sequence[str], order: Sequence[str], name: str = "island", split_on: str | None = None) -> DataFrame:
    """``df`` with the number of the run of true ``mask`` that a row lies in, null outside. A change of ``split_on`` ends a run."""
    w = Window.partitionBy(*keys).orderBy(*order)
    df = df.withColumn("__m", _true(mask))
    starts = F.col("__m") & ~F.coalesce(F.lag("__m").over(w), F.lit(False))
    if split_on:
        starts = F.col("__m") & (starts | ~F.col(split_on).eqNullSafe(F.lag(split_on).over(w)))
    df = df.withColumn("__s", starts.cast("long"))
    return df.withColumn(name, F.when(F.col("__m"), F.sum("__s").over(w))).drop("__m", "__s")


def islands(df: DataFrame, mask: Column | str, keys: Sequence[str], order: Sequence[str], time: str, min_duration: float | None = None, split_on: str | None = None, aggs: Sequence[Column] = ()) -> DataFrame:
    """One row per run: keys, island, start_t, end_t, duration (of one sample: 0), n, and ``aggs`` over its samples."""
    runs = mark_islands(df, mask, keys, order, "island", split_on).where("island is not null")
    out = runs.groupBy(*keys, "island").agg(F.min(time).alias("start_t"), F.max(time).alias("end_t"), (F.max(time) - F.min(time)).alias("duration"), F.count("*").alias("n"), *aggs)
    return out if min_duration is None else out.where(F.col("duration") >= min_duration)


def fill_short_gaps(df: DataFrame, mask: Column | str, gap: float, keys: Sequence[str], order: Sequence[str], time: str, barrier: Column | str | None = None, name: str = "filled") -> DataFrame:
    """``df`` with ``mask`` made true in false runs between true samples at most ``gap`` apart, where ``barrier`` holds throughout."""
    ahead = Window.partitionBy(*keys).orderBy(*order)
    back = Window.partitionBy(*keys).orderBy(*(F.desc(c) for c in order))
    df = df.withColumn("__m", _true(mask)).withColumn("__ok", F.lit(True) if barrier is None else _true(barrier))
    seen = F.when(F.col("__m"), F.col(time))
    df = df.withColumn("__left", F.last(seen, True).over(ahead)).withColumn("__run", F.sum(F.col("__m").cast("long")).over(ahead))
    df = df.withColumn("__right", F.last(seen, True).over(back))
    bad = F.sum(F.when(~F.col("__m") & ~F.col("__ok"), 1).otherwise(0)).over(Window.partitionBy(*keys, "__run"))
    fill = (F.col("__right") - F.col("__left") <= gap) & (bad == 0)
    return df.withColumn(name, F.col("__m") | F.coalesce(fill, F.lit(False))).drop("__m", "__ok", "__left", "__right", "__run")


def merge_overlapping(intervals: DataFrame, keys: Sequence[str], start: str, end: str, tie: Sequence[str] = ()) -> DataFrame:
    """Unions of intervals that touch (start <= largest end before): keys, start, end, n."""
    w = Window.partitionBy(*keys).orderBy(start, end, *tie)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = intervals.withColumn("__new", F.when(F.col(start) <= before, 0).otherwise(1)).withColumn("__g", F.sum("__new").over(w))
    return marked.groupBy(*keys, "__g").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n")).drop("__g")


def edges(df: DataFrame, state: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows at which ``state`` differs from the row before, with ``previous``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("previous", F.lag(state).over(w)).where(F.col("previous").isNotNull() & (F.col("previous") != F.col(state)))


def after_edge(df: DataFrame, edge: Column | str, width: float, keys: Sequence[str], order: Sequence[str], time: str, name: str = "after_edge") -> DataFrame:
    """``df`` with whether a row lies within ``width`` of the last ``edge`` row, the edge and the end included."""
    w = Window.partitionBy(*keys).orderBy(*order)
    last = F.last(F.when(_true(edge), F.col(time)), True).over(w)
    return df.withColumn(name, F.coalesce(F.col(time) - last <= width, F.lit(False)))


def full_windows(df: DataFrame, edge: Column | str, hold: Column | str, width: float, keys: Sequence[str], order: Sequence[str], time: str) -> DataFrame:
    """(keys, start_t, n) of the edges after which ``hold`` is true for all samples within ``width`` and samples reach that far."""
    w = Window.partitionBy(*keys).orderBy(*order)
    df = df.withColumn("__e", F.sum(_true(edge).cast("long")).over(w)).withColumn("__h", _true(hold))
    df = df.withColumn("start_t", F.min(time).over(Window.partitionBy(*keys, "__e"))).withColumn("__last", F.max(time).over(Window.partitionBy(*keys)))
    inside = df.where((F.col("__e") > 0) & (F.col(time) - F.col("start_t") <= width))
    return inside.groupBy(*keys, "__e", "start_t").agg(F.count("*").alias("n"), F.bool_and("__h").alias("__all"), F.max("__last").alias("__last")).where((F.col("__all")) & (F.col("__last") >= F.col("start_t") + width)).select(*keys, "start_t", "n")


def lookahead_bridge(df: DataFrame, core: Column | str, hold: Column | str, frames: int, keys: Sequence[str], order: Sequence[str], time: str) -> DataFrame:
    """Runs of ``core`` that go on over at most ``frames`` samples without it while ``hold`` lasts: keys, start_t, end_t, n.

    Every sample knows its place among all and among those with ``core``; a break is a gap of more samples than allowed,
    or one in which a sample doesn't hold.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    rows = df.select(*keys, F.col(time).alias("__t"), F.row_number().over(w).alias("__k"), _true(core).alias("__core"), F.sum((~_true(hold) & ~_true(core)).cast("long")).over(w).alias("__loose"))
    on = Window.partitionBy(*keys).orderBy("__k")
    rows = rows.where("__core").withColumn("__new", (F.coalesce(F.col("__k") - F.lag("__k").over(on) - 1 > frames, F.lit(True)) | (F.col("__loose") != F.lag("__loose").over(on))).cast("long"))
    runs = rows.withColumn("__run", F.sum("__new").over(on)).groupBy(*keys, "__run")
    return runs.agg(F.min("__t").alias("start_t"), F.max("__t").alias("end_t"), (F.max("__k") - F.min("__k") + 1).cast("long").alias("n")).drop("__run")


def debounced_flips(df: DataFrame, value: str, stable: int, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """keys, flips: changes between the signs that ``stable`` samples in a row have; zeros are passed over."""
    signs = df.where(F.coalesce(F.col(value) != 0, F.lit(False))).withColumn("__up", F.col(value) > 0)
    runs = islands(signs, F.lit(True), keys, order, order[0], split_on="__up", aggs=[F.first("__up").alias("__up")]).where(F.col("n") >= stable)
    flip = F.col("__up") != F.lag("__up").over(Window.partitionBy(*keys).orderBy("island"))
    found = runs.withColumn("__flip", F.coalesce(flip, F.lit(False)).cast("long")).groupBy(*keys).agg(F.sum("__flip").alias("flips"))
    return df.select(*keys).distinct().join(found, list(keys), "left").select(*keys, F.coalesce("flips", F.lit(0)).cast("long").alias("flips"))


def long_cycles(df: DataFrame, value: str, short: float, long: float, amplitude: float, phases: int, gap: float, keys: Sequence[str], order: Sequence[str], time: str) -> DataFrame:
    """At least ``phases`` phases of alternating sign, each ``short`` to ``long`` and ``amplitude`` high, at most ``gap`` apart, with
    no other phase longer than ``gap`` between them: keys, start_t, end_t, phases."""
    signed = df.withColumn("__sign", F.signum(F.coalesce(value, F.lit(0.0))))
    runs = islands(signed, F.col("__sign") != 0, keys, order, time, split_on="__sign", aggs=[F.first("__sign").alias("__sign"), F.max(F.abs(value)).alias("__peak")])
    good = F.col("duration").between(short, long) & (F.col("__peak") >= amplitude)
    w = Window.partitionBy(*keys).orderBy("island")
    runs = runs.withColumn("__good", good).withColumn("__breaks", F.sum((~good & (F.col("duration") > gap)).cast("long")).over(w)).where("__good")
    first = F.lag("island").over(w).isNull() | (F.lag("__sign").over(w) == F.col("__sign")) | (F.col("start_t") - F.lag("end_t").over(w) > gap) | (F.lag("__breaks").over(w) != F.col("__breaks"))
    chains = runs.withColumn("__new", first.cast("long")).withColumn("__chain", F.sum("__new").over(w)).groupBy(*keys, "__chain")
    return chains.agg(F.min("start_t").alias("start_t"), F.max("end_t").alias("end_t"), F.count("*").alias("phases")).where(F.col("phases") >= phases).drop("__chain")
