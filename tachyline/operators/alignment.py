"""Aligning signals of different rates: as-of joins, grids, common ranges, stitching, edge and peak pairs.

An as-of join is a union of both sides sorted once per recording; the nearest sample before and after comes from a
running last value in each direction, so it costs one shuffle and two sorts, whatever the rates are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

US = 1_000_000


def asof(axis: DataFrame, signal: DataFrame, keys: Sequence[str], time: str, values: Sequence[str], direction: str = "nearest", tolerance: float | None = None, tie: Sequence[str] = ()) -> DataFrame:
    """``axis`` with ``values`` of the matching ``signal`` row, ``match_t`` and ``gap``.

    ``pad``: the last sample at or before; ``backfill``: the first at or after; ``nearest``: the closer, the earlier
    if as close. On an exact hit the first of equal times counts, before it the last, after it the first; ``tie``
    orders samples of equal time. Beyond ``tolerance`` the values are null and the gap stays.
    """
    hit = F.struct(F.col(time).alias("t"), *values)
    left = axis.withColumn("__side", F.lit(1)).withColumn("__s", F.lit(None).cast(signal.select(hit.alias("s")).schema["s"].dataType))
    ties = [F.col(c).alias(f"__t{k}") for k, c in enumerate(tie)]
    right = signal.select(*keys, time, F.lit(0).alias("__side"), hit.alias("__s"), *ties)
    both = left.unionByName(right, allowMissingColumns=True)
    ranks = [f"__t{k}" for k in range(len(tie))]
    ahead = Window.partitionBy(*keys).orderBy(time, "__side", *ranks)
    back = Window.partitionBy(*keys).orderBy(F.desc(time), "__side", *(F.desc(r) for r in ranks))
    both = both.withColumn("__b", F.last("__s", True).over(ahead)).withColumn("__f", F.last("__s", True).over(back))
    before, after, now = F.col("__b.t"), F.col("__f.t"), F.col(time)
    if direction == "pad":
        pick = F.when(before == now, F.col("__f")).otherwise(F.col("__b"))
    elif direction == "backfill":
        pick = F.col("__f")
    else:
        near = F.col("__f").isNull() | ((now - before) <= (after - now)) & (before != now)
        pick = F.when(F.col("__b").isNotNull() & near, F.col("__b")).otherwise(F.coalesce("__f", "__b"))
    out = both.where("__side = 1").withColumn("__p", pick).withColumn("gap", F.abs(F.col("__p.t") - now))
    good = F.lit(True) if tolerance is None else F.col("gap") <= tolerance
    return out.select(*axis.columns, *(F.when(good, F.col(f"__p.{v}")).alias(v) for v in values), F.when(good, F.col("__p.t")).alias("match_t"), "gap")


def grid(samples: DataFrame, keys: Sequence[str], time: str, step: int) -> DataFrame:
    """Regular ticks (multiples of ``step``, integer time) within each recording's range: keys, time."""
    ends = samples.groupBy(*keys).agg((F.ceil(F.min(time) / step)).cast("long").alias("a"), (F.floor(F.max(time) / step)).cast("long").alias("b"))
    return ends.where("a <= b").select(*keys, F.explode(F.sequence("a", "b")).alias("k")).select(*keys, (F.col("k") * step).alias(time))


def resample(samples: DataFrame, keys: Sequence[str], time: str, value: str, step: int, method: str = "linear", tie: Sequence[str] = ()) -> DataFrame:
    """``value`` at the ticks of ``grid``: ``hold`` the last sample, ``linear`` between the samples on both sides."""
    ticks = grid(samples, keys, time, step)
    held = asof(ticks, samples, keys, time, [value], "pad", tie=tie).select(*keys, time, F.col(value).alias("__v0"), F.col("match_t").alias("__t0"))
    if method == "hold":
        return held.select(*keys, time, F.col("__v0").alias(value))
    both = asof(held, samples, keys, time, [value], "backfill", tie=tie)
    part = (F.col(time) - F.col("__t0")) / (F.col("match_t") - F.col("__t0"))
    return both.select(*keys, time, F.when(F.col("match_t") == F.col("__t0"), F.col("__v0")).otherwise(F.col("__v0") + (F.col(value) - F.col("__v0")) * part).alias(value))


def common_range(samples: DataFrame, keys: Sequence[str], signal: str, time: str) -> DataFrame:
    """The range in which all signals of a recording have samples: keys, start_t, end_t; empty ones are left out."""
    one = samples.groupBy(*keys, signal).agg(F.min(time).alias("a"), F.max(time).alias("b"))
    return one.groupBy(*keys).agg(F.max("a").alias("start_t"), F.min("b").alias("end_t")).where("start_t <= end_t")


def point_lookup(samples: DataFrame, keys: Sequence[str], time: str, at: float, values: Sequence[str], tie: Sequence[str] = ()) -> DataFrame:
    """Per recording the sample nearest to ``at`` (the earlier if as close), by one partial aggregation."""
    rank = F.struct(F.abs(F.col(time) - at), F.col(time), *tie)
    return samples.groupBy(*keys).agg(F.min_by(F.struct(time, *values), rank).alias("s")).select(*keys, "s.*")


def continuous_pairs(recordings: DataFrame, group: Sequence[str], start: str, duration: str, slack: float) -> DataFrame:
    """Recordings with the one that follows in their group and ``continuous``: it starts within ``slack`` of the end."""
    w = Window.partitionBy(*group).orderBy(start)
    follow = F.lead(start).over(w)
    return recordings.withColumn("next_start", follow).withColumn("continuous", F.coalesce(F.abs(follow - F.col(start) - F.col(duration)) <= slack, F.lit(False)))


def stitch(frames: DataFrame, pairs: DataFrame, recording: str, follower: str, time: str, offset: str, context: float | None) -> DataFrame:
    """Each recording's samples (source_idx 0) and up to ``context`` (None: all) of its follower's after its end (1), on its own time."""
    ends = frames.groupBy(recording).agg(F.max(time).alias("__end"))
    tail = frames.join(pairs.select(F.col(recording).alias("__owner"), F.col(follower).alias(recording), F.col(offset).alias("__off")).hint("shuffle_hash"), recording)
    tail = tail.withColumn(recording, F.col("__owner")).withColumn(time, F.col(time) + F.col("__off")).drop("__owner", "__off").join(ends.hint("shuffle_hash"), recording)
    tail = tail.where(F.col(time) > F.col("__end"))
    if context is not None:
        tail = tail.where(F.col(time) <= F.col("__end") + context)
    tail = tail.drop("__end").withColumn("source_idx", F.lit(1))
    return frames.withColumn("source_idx", F.lit(0)).unionByName(tail)


def owned(segments: DataFrame, has_previous: str = "has_previous") -> DataFrame:
    """Segments that their recording owns: not begun in the follower, nor at its first sample if a predecessor goes on into it."""
    return segments.where((F.col("start_source") == 0) & ~((F.col("start_idx") == 0) & F.coalesce(F.col(has_previous), F.lit(False))))


def band_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_t: str, right_t: str, width: int) -> DataFrame:
    """Pairs with ``|left_t - right_t| <= width`` (integers): joined on time cells of that width, each left row in three cells."""
    cell = F.floor(F.col(left_t) / width).cast("long")
    cells = left.withColumn("__c", F.explode(F.array(cell - 1, cell, cell + 1)))
    other = right.withColumn("__c", F.floor(F.col(right_t) / width).cast("long"))
    return cells.join(other, [*keys, "__c"]).where(F.abs(F.col(left_t) - F.col(right_t)) <= width).drop("__c")


def overlapping(scenes: DataFrame, events: DataFrame, keys: Sequence[str], width: int, how: str = "left_semi") -> DataFrame:
    """Scenes (start_t, end_t) that an event (event_start, event_end) overlaps, or (``left_anti``) none does.

    Both are spread over time cells of ``width``, so only neighbours meet.
    """
    spread = lambda df, a, b: df.withColumn("__c", F.explode(F.sequence(F.floor(F.col(a) / width), F.floor(F.col(b) / width))))
    ids = [c for c in scenes.columns if c in (*keys, "start_t", "end_t")]
    left, right = spread(scenes.select(*ids), "start_t", "end_t"), spread(events.select(*keys, "event_start", "event_end"), "event_start", "event_end")
    met = left.join(right, [*keys, "__c"]).where("event_end >= start_t and event_start <= end_t").select(*ids).distinct()
    return scenes.join(met, ids, how)


def gate(axis: DataFrame, states: DataFrame, keys: Sequence[str], time: str, state: str, tolerance: float, tie: Sequence[str] = ()) -> DataFrame:
    """``axis`` with the nearest ``state`` within ``tolerance``; recordings in which any sample has none are left out whole."""
    joined = asof(axis, states, keys, time, [state], "nearest", tolerance, tie)
    covered = F.bool_and(F.col(state).isNotNull()).over(Window.partitionBy(*keys))
    return joined.withColumn("__all", covered).where("__all").drop("__all")


def priority_pick(rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key: fallback paths, primary files, latest versions."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def merge_samples(samples: DataFrame, keys: Sequence[str], time: str, source: str, width: float, tie: Sequence[str] = ()) -> DataFrame:
    """Samples of several files in time order, the first file's first; each within ``width`` of the last one kept goes.

    Samples that are farther than that from both neighbours stay as they are; only chains of close ones are walked through.
    """
    from .automata import far_from_last, scan

    w = Window.partitionBy(*keys).orderBy(time, source, *tie)
    far = lambda other: F.coalesce(F.abs(F.col(time) - other) > width, F.lit(True))
    marked = samples.withColumn("__alone", far(F.lag(time).over(w)) & far(F.lead(time).over(w)))
    rest = [c for c in samples.columns if c not in keys]
    chains = scan(marked.where("not __alone"), keys, [time, source, *tie], rest, far_from_last(time, width), ", ".join(f"`{c}` {samples.schema[c].dataType.simpleString()}" for c in rest))
    return marked.where("__alone").select(*samples.columns).unionByName(chains)
