"""Which physical path of a recording carries a signal: known paths first, else those of its names in the layout of a bus log.

A path in that layout is ``channel/network/database/message/signals/name``, below a root folder or not. Of several paths the one whose
values fit the first of some enumerations counts, so a path that carries a switch wins over one that carries something
else under the same name.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Channels in the order in which they are preferred; all others come after them.
CHANNELS = ("ch3", "ch4")
LAYOUT = r"(?i)^(?:[^/]+/)?(ch[0-9]+)/[^/]+/[^/]+/([^/]+)/signals/([^/]+)$"


@dataclass(frozen=True)
class Wanted:
    """A signal: ``paths`` in order of preference; ``names`` it has, each with what its path must contain; enumerations."""

    name: str
    paths: tuple[str, ...]
    names: tuple[tuple[str, tuple[str, ...]], ...]
    enumerations: tuple[tuple[int, ...], ...] = ()


def _rank(wanted: Wanted, path: Column) -> tuple[Column, Column]:
    """(is one of the known paths, place in the order): null places don't match at all."""
    known = F.lit(None).cast("int")
    below = F.regexp_replace(path, "^[^/]+/", "")  # without its root folder
    for k in range(len(wanted.paths) - 1, -1, -1):
        known = F.when((path == wanted.paths[k]) | (below == wanted.paths[k]), k).otherwise(known)
    channel, message, name = (F.regexp_extract(path, LAYOUT, k) for k in (1, 2, 3))
    named = F.lit(False)
    for label, parts in wanted.names:
        fits = name == label
        for part in parts:
            fits = fits & F.contains(path, F.lit(part))
        named = named | fits
    place = F.lit(len(CHANNELS))
    for k in range(len(CHANNELS) - 1, -1, -1):
        place = F.when(channel == CHANNELS[k], k).otherwise(place)
    return known, F.when(named & (message != ""), place)


def discover(signals: DataFrame, wanted: Sequence[Wanted], sample: int | None = 50_000) -> DataFrame:
    """``signals`` (recording_id, field: the path, t, value) -> recording_id, signal, field, score: one path for each signal found.

    Known paths count before others; of those left, the one whose values all lie in the earliest enumeration (``score`` is its place;
    behind all if they lie in none), then the earlier one in the order of known paths, or of channels and paths. Values are
    cut to whole numbers; null and NaN lie in no enumeration. ``sample`` bounds the values that are looked at, the
    first by time of each path (None: all of them); every path is looked at.
    """
    rows = signals.select("recording_id", "field", "t", "value")
    if sample is not None:
        w = Window.partitionBy("recording_id", "field").orderBy("t")
        rows = rows.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= sample).drop("__n")
    whole = F.when(~F.isnan("value"), F.col("value").cast("long"))
    sets = list(dict.fromkeys(s for x in wanted for s in x.enumerations))
    fits = [F.bool_and(F.coalesce(whole.isin(list(s)), F.lit(False))).alias(f"__f{k}") for k, s in enumerate(sets)]
    paths = rows.groupBy("recording_id", "field").agg(F.count("*").alias("__n"), *fits)
    found = None
    for x in wanted:
        known, place = _rank(x, F.col("field"))
        score = F.lit(len(x.enumerations))
        for k in range(len(x.enumerations) - 1, -1, -1):
            score = F.when(F.col(f"__f{sets.index(x.enumerations[k])}"), k).otherwise(score)
        own = paths.select("recording_id", "field", known.alias("known"), place.alias("place"), score.alias("score"))
        own = own.where("known is not null or place is not null").select("recording_id", F.lit(x.name).alias("signal"), F.struct(F.col("known").isNull().alias("other"), "score", F.coalesce("known", "place").alias("place"), "field").alias("pick"))
        found = own if found is None else found.unionByName(own)
    best = found.groupBy("recording_id", "signal").agg(F.min("pick").alias("pick"))
    return best.select("recording_id", "signal", F.col("pick.field").alias("field"), F.col("pick.score").alias("score"))
