"""Bus metrics over chains of folders: each folder sees a little of the next, and a scene that goes on there counts once.

A run is a list of folders in time order. Where the next folder's data begin within 10 s of the end of one's own, its first
seconds stand behind them as a tail, so a scene at the end is seen whole. The next folder finds the rest of that scene
again; a state that is carried from folder to folder, in order, tells what only goes on. Samples are read once, by
folder; what the state reads is one row for each scene, so a run of any number of folders is one short walk.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import scalars as S
from ..operators import alignment as A, automata as M
from . import planner as P
from .scenes import KEYS, SECOND

c = F.col
GAP, TAIL = 10 * SECOND, 10 * SECOND
#: Times that a planner frame may be away from a sample of the bus.
NEAR = 300_000
#: Scenes at most this far apart, with set speeds at most this different (km/h), are one.
JOIN_GAP, JOIN_SPEED = SECOND, 1.0
LEAST_DURATION, SPAN, DEFICIT, MOVING = 8 * SECOND, 1.5, 8.0, 5.0


def with_tail(frame: DataFrame, folders: DataFrame, gap: int = GAP, tail: int = TAIL) -> DataFrame:
    """``frame`` (recording_id: the folder, us: absolute) with source_idx, and the next folder's samples behind each (1).

    ``folders`` (recording_id, run, place): the next in ``place`` counts, whatever its name's time says; its data must begin
    within ``gap`` of the end, before or after, and end after the start. Its samples up to ``tail`` after the end are
    taken, those before the end aren't: that time has samples of its own.
    """
    spans = frame.groupBy(*KEYS).agg(F.min("us").alias("first_us"), F.max("us").alias("last_us"))
    w = Window.partitionBy("run").orderBy("place", "recording_id")
    rows = folders.join(spans, KEYS, "left")
    rows = rows.select(*KEYS, "last_us", "first_us", F.lead("recording_id").over(w).alias("next_id"), F.lead("first_us").over(w).alias("next_first"), F.lead("last_us").over(w).alias("next_last"))
    near = S.holds((c("next_last") > c("first_us")) & (F.abs(c("next_first") - c("last_us")) <= gap))
    return A.stitch(frame, rows.where(near).select(*KEYS, "next_id", F.lit(0).alias("shift")), "recording_id", "next_id", "us", "shift", tail)


def unhindered(frame: DataFrame, planner: DataFrame) -> DataFrame:
    """``frame`` (bus samples) with shown, wanted (displayed speeds) and ``free``: in control with a set speed, and by the planner
    frame within 300 ms no target to follow, no red light within 150 m and no curve limit below the set speed.

    A sample without a planner frame isn't free. A curve limit that isn't above 0 is none, a light at a negative distance is passed.
    """
    road = (F.size("followed") == 0) & ~c("unmatched")
    told = {"light": c("red_light"), "line": c("stop_distance"), "curve": c("curve_limited"), "limit": c("curve_limit"), "road": road}
    seen = P.candidates(planner).select(*KEYS, "us", *(v.alias(k) for k, v in told.items()))
    rows = A.asof(frame.select(*KEYS, "us", "ego_speed", "set_speed", "in_control"), seen, KEYS, "us", list(told), "nearest", NEAR)
    wanted = S.display_speed(c("set_speed"))
    stop = S.holds(c("light")) & (c("line").isNull() | c("line").between(0, 150))
    curve = ~S.holds(c("curve")) | S.holds((c("limit") <= 0) | (c("limit") >= wanted))
    free = c("in_control") & S.holds(c("set_speed") > 0) & S.holds(c("road")) & ~stop & curve
    return rows.select(*KEYS, "us", S.display_speed(c("ego_speed")).alias("shown"), wanted.alias("wanted"), free.alias("free"))


def low_speed_scenes(rows: DataFrame) -> DataFrame:
    """Stretches of ``unhindered`` samples that first reach 8 s, at one set speed, driving over 5 with a span under 1.5, 8 or
    more below the set speed; neighbours are merged: recording_id, start_us, end_us, set_speed, deficit, mean_shown, n."""
    test = lambda label, least, most: least > MOVING and most - least < SPAN and label - most >= DEFICIT
    machine = M.spans_of_length("free", "shown", "wanted", LEAST_DURATION, test, JOIN_GAP, JOIN_SPEED, "us")
    found = M.scan(rows, KEYS, ["us"], ["us", "free", "shown", "wanted"], machine, "start_us long, end_us long, set_speed double, most double, mean_shown double, n long")
    return found.select(*KEYS, "start_us", "end_us", "set_speed", (c("set_speed") - c("most")).alias("deficit"), "mean_shown", "n")


def without_continuations(scenes: DataFrame, frame: DataFrame, folders: DataFrame) -> DataFrame:
    """``scenes`` with ``goes_on``: the scene only continues the last one of the folders before it in the run.

    That is so where it begins at most a second after that one's end, at about its set speed; it then moves the end on. The
    state is forgotten where a folder with scenes begins over a second earlier than the one before. Folders without scenes
    change nothing.
    """
    starts = frame.groupBy(*KEYS).agg(F.min("us").alias("folder_us"))
    rows = scenes.join(folders.select(*KEYS, "run", "place"), KEYS).join(starts, KEYS)
    names = [x for x in scenes.columns if x not in KEYS]
    fields = ["recording_id", *names, "folder_us"]
    result = ", ".join(f"`{x}` {scenes.schema[x].dataType.simpleString()}" for x in ["recording_id", *names]) + ", goes_on boolean"
    return M.scan(rows, ["run"], ["place", "recording_id", "start_us"], fields, M.continuations("recording_id", ["recording_id", *names], "start_us", "end_us", "set_speed", "folder_us", JOIN_GAP, JOIN_SPEED), result)


def low_speed(frame: DataFrame, planner: DataFrame, folders: DataFrame) -> DataFrame:
    """Unreasonably low speeds of a run: recording_id, start_us, end_us, severity, goes_on. ``frame`` and ``planner`` in absolute time."""
    rows = unhindered(frame, planner)
    scenes = low_speed_scenes(with_tail(rows, folders))
    scenes = scenes.select(*KEYS, "start_us", "end_us", "set_speed", F.round("deficit", 3).alias("severity"))
    return without_continuations(scenes, frame, folders).select(*KEYS, "start_us", "end_us", "severity", "goes_on")


def totals(found: DataFrame) -> DataFrame:
    """Per folder with scenes: recording_id, total and bad (those that count), continued, severity (the largest)."""
    counts = ~c("goes_on")
    out = found.groupBy(*KEYS).agg(F.count_if(counts).alias("total"), F.count_if(counts & (c("severity") >= DEFICIT)).alias("bad"), F.count_if("goes_on").alias("continued"), F.max(F.when(counts, c("severity"))).alias("severity"))
    return out.withColumn("severity", F.coalesce("severity", F.lit(0.0)))
