"""Heavy braking on bus signals in control: falls of the smoothed acceleration within a window, three kinds of them, taken in turn and merged.

A sample counts where the function is in control at it and at the one before, and its jerk is known. From each such sample the falls to the samples of the
next 1.6 s in the same run are looked at, only around braking: samples that have a low one ahead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from ..functions import scalars as S
from ..operators import automata as M, segments as G, windows as W
from .scenes import KEYS, SECOND, samples_in

c = F.col
WINDOW, MERGE_GAP = 1_600_000, 500_000
PRIMARY, SPIKE, SUSTAINED = "primary_decel_jump", "deep_short_spike", "deep_sustained_brake"
#: Bounds of the kinds: least fall, stay (microseconds), jerk, and fall a second; those of the level are -2, -2.7 and (for the stay at a deep level) -1.8.
LOW, DEEP, STAY = -2.0, -2.7, -1.8
JUMP = dict(drop=3.0, dwell=200_000, jerk=-2.0, slope=3.0)
SPIKES = dict(drop=2.6, dwell=120_000, jerk=-10.0)
SUSTAINS = dict(drop=1.3, dwell=350_000, jerk=-5.0)


def _merged_score(a: str, jerk: str, drop: str, seconds: str) -> str:
    """SQL of the severity of falls that became one: what lies beyond the level, a jerk of 2, the fall and its slope, weighted."""
    return f"round(greatest(abs({a}) - {-LOW}, 0) * 30 + greatest(abs({jerk}) - 2, 0) * 20 + greatest({drop} - {JUMP['drop']}, 0) * 30 + greatest({drop} / ({seconds}) - 3, 0) * 20, 3)"


def _score(level: float, least_drop: float, least: np.ndarray, jerk: np.ndarray, drop: np.ndarray, seconds: np.ndarray) -> np.ndarray:
    """The same severity over arrays of falls."""
    beyond = lambda x, bound: np.maximum(x - bound, 0)
    total = beyond(np.abs(least), -level) * 30 + beyond(np.abs(jerk), 2) * 20 + beyond(drop, least_drop) * 30 + beyond(drop / seconds, 3) * 20
    return np.floor(total * 1000 + 0.5) / 1000


def samples(frame: DataFrame) -> DataFrame:
    """recording_id, us, a (smoothed), jerk, good, run (of good samples, else null)."""
    rows = W.time_mean(frame.select(*KEYS, "us", "acceleration", "in_control"), "acceleration", 300_000, KEYS, "us", "a")
    rows = W.time_slope(rows, "a", 300_000, KEYS, "us", "jerk")
    before = F.coalesce(F.lag("in_control").over(Window.partitionBy(*KEYS).orderBy("us")), F.lit(False))
    rows = rows.select(*KEYS, "us", "a", "jerk", (c("in_control") & before & c("jerk").isNotNull() & c("a").isNotNull()).alias("good"))
    return G.mark_islands(rows, "good", KEYS, ["us"], "run")


def _best_falls(run: np.ndarray, us: np.ndarray, a: np.ndarray, jerk: np.ndarray, since: np.ndarray, since_deep: np.ndarray, following: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """(place, end, kind, severity) of the falls that the first ``n`` of the sorted samples begin. All samples are held against the one that is one place
    on, then two, as far as any window reaches; least acceleration and jerk on the way go along."""
    end, kind, severity = np.full(n, -1), np.zeros(n, int), np.full(n, -np.inf)
    drop_, dwell_, jump, jumped = np.full(n, -np.inf), np.full(n, -1), np.full(n, -1), np.zeros(n)
    s = np.arange(n)
    least, sharpest = a[:n].copy(), jerk[:n].copy()
    k = 0
    while len(s):
        k += 1
        s = s[s + k < len(us)]
        s = s[(run[s + k] == run[s]) & (us[s + k] <= us[s] + WINDOW)]
        p = s + k
        least[s], sharpest[s] = np.minimum(least[s], a[p]), np.minimum(sharpest[s], jerk[p])
        i = s[(a[p] <= LOW) & (us[p] > us[s])]
        p = i + k
        drop, seconds = a[i] - a[p], (us[p] - us[i]) / 1e6
        dwell = us[p] - np.maximum(since[p], following[i])
        good = (jerk[p] <= JUMP["jerk"]) & (drop >= JUMP["drop"]) & (dwell >= JUMP["dwell"]) & (drop / seconds >= JUMP["slope"])
        good &= (drop > drop_[i]) | (drop == drop_[i]) & (dwell > dwell_[i])
        j, q = i[good], p[good]
        drop_[j], dwell_[j], jump[j] = drop[good], dwell[good], us[q]
        jumped[j] = _score(LOW, JUMP["drop"], a[q], sharpest[j], drop[good], seconds[good])
        deep = a[p] <= DEEP
        i, p, drop, seconds = i[deep], p[deep], drop[deep], seconds[deep]
        dwell = us[p] - np.maximum(since_deep[p], following[i])
        spike = (drop >= SPIKES["drop"]) & (dwell <= SPIKES["dwell"]) & (sharpest[i] <= SPIKES["jerk"])
        sustained = (drop >= SUSTAINS["drop"]) & (dwell >= SUSTAINS["dwell"]) & (sharpest[i] <= SUSTAINS["jerk"])
        score = _score(DEEP, SUSTAINS["drop"], least[i], sharpest[i], drop, seconds)
        good = (spike | sustained) & (score > severity[i])
        i = i[good]
        end[i], kind[i], severity[i] = us[p[good]], np.where(spike[good], 1, 2), score[good]
    leaps = jump >= 0
    end, kind, severity = np.where(leaps, jump, end), np.where(leaps, 0, kind), np.where(leaps, jumped, severity)
    found = np.flatnonzero(severity > -np.inf)
    return found, end[found], kind[found], severity[found]


def falls(rows: DataFrame) -> DataFrame:
    """The fall that each sample begins, if it begins one: recording_id, us, end_us, kind, start_a, severity. The deepest jump goes before the severest of the
    deep falls; the longer stay, then the earlier, breaks ties. A task holds a batch of samples and one window."""
    w = Window.partitionBy(*KEYS, "run").orderBy("us")
    rows = rows.where("run is not null").withColumn("next", F.lead("us").over(w))
    # A stretch at or under a level begins behind the last sample above it, or with the run.
    for name, level in (("since", LOW), ("since_deep", STAY)):
        rows = rows.withColumn(name, F.coalesce(F.last(F.when(c("a") > level, c("next")), True).over(w), F.first("us").over(w)))
    near = rows.withColumn("n", F.count_if(c("a") <= LOW).over(w.rangeBetween(0, WINDOW))).where("n > 0")
    # Runs lie whole in a partition, as the windows need them; a sample without a next one ends its run and begins no fall.
    near = near.select(*KEYS, "run", "us", "a", "jerk", "since", "since_deep", F.coalesce("next", "us").alias("next")).sortWithinPartitions(*KEYS, "run", "us")
    kinds = pa.array([PRIMARY, SPIKE, SUSTAINED])
    types = StructType([rows.schema[k] for k in KEYS] + _parse_datatype_string("us long, end_us long, kind string, start_a double, severity double").fields)
    schema = to_arrow_schema(types)

    def find(held: pa.Table, n: int) -> Iterator[pa.RecordBatch]:
        run, us, a, *rest = (held[x].to_numpy() for x in ("own", "us", "a", "jerk", "since", "since_deep", "next"))
        place, end, kind, severity = _best_falls(run, us, a, *rest, n)
        if len(place):
            out = held.take(pa.array(place))
            columns = [*(out[k] for k in KEYS), out["us"], pa.array(end), kinds.take(pa.array(kind)), out["a"], pa.array(severity)]
            yield from pa.table(columns, names=schema.names).cast(schema).to_batches()

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for part in parts:
            if not part.num_rows:
                continue
            table = pa.Table.from_batches([part])
            held = (table if held is None else pa.concat_tables([held.drop_columns("own"), table])).combine_chunks()
            fresh = np.zeros(len(held), bool)
            for k in (*KEYS, "run"):
                fresh[1:] |= pc.not_equal(held[k].slice(1), held[k].slice(0, len(held) - 1)).to_numpy()
            own = np.cumsum(fresh)
            held = held.append_column("own", pa.array(own))
            us = held["us"].to_numpy()
            done = len(held) - int(np.count_nonzero((own == own[-1]) & (us + WINDOW >= us[-1])))  # the others' windows may go on in the next batch
            yield from find(held, done)
            held = held.slice(done)
        if held is not None:
            yield from find(held, len(held))

    return near.mapInArrow(batches, types)


def heavy_braking(frame: DataFrame) -> DataFrame:
    """Heavy braking: recording_id, start_us, end_us, kind, n (falls), severity. Falls are taken in turn, each after the end of the last; those within half
    a second become one, judged by the least acceleration and jerk of all samples from its start to its end."""
    rows = samples(frame)
    first = M.scan(falls(rows), KEYS, ["us"], ["us", "end_us", "kind", "start_a", "severity"], M.disjoint("us", "end_us"), "start_us long, end_us long, kind string, start_a double, severity double")
    w = Window.partitionBy(*KEYS).orderBy("start_us")
    apart = F.coalesce((c("start_us") - F.lag("end_us").over(w) > MERGE_GAP).cast("int"), F.lit(1))
    parts = first.withColumn("apart", apart).withColumn("part", F.sum("apart").over(w)).groupBy(*KEYS, "part")
    both = lambda x, y: F.when(x == y, x).when(x.eqNullSafe(F.lit(PRIMARY)) | (y == PRIMARY), "mixed_primary_and_supplemental").otherwise("mixed_supplemental")
    found = parts.agg(F.min("start_us").alias("start_us"), F.max("end_us").alias("end_us"), F.count("*").alias("n"), F.min_by("start_a", "start_us").alias("start_a"), F.max("severity").alias("own"), F.sort_array(F.collect_list(F.struct("start_us", "kind"))).alias("kinds"))
    kinds = F.transform("kinds", lambda k: k["kind"])
    found = found.withColumn("kind", F.aggregate(F.slice(kinds, 2, 1_000_000), kinds[0], both))
    within = samples_in(rows.select(*KEYS, "us", "a", "jerk"), found.where("n > 1")).groupBy(*KEYS, "start_us").agg(F.min("a").alias("a"), F.min("jerk").alias("jerk"))
    found = found.join(within, [*KEYS, "start_us"], "left")
    merged = F.expr(_merged_score("a", "jerk", "(start_a - a)", f"(end_us - start_us) / {SECOND}"))
    return found.select(*KEYS, "start_us", "end_us", "kind", "n", F.when(c("n") > 1, merged).otherwise(c("own")).alias("severity"))


def planner_heavy_braking(frames: DataFrame) -> DataFrame:
    """``heavy_braking`` on planner frames, with the slope's part of the acceleration (0 where it isn't known): frames without an acceleration are left
    out, of those of one time the first to arrive counts, and what begins after the recording's own frames belongs to the next recording."""
    rows = frames.where(c("acceleration").isNotNull()).withColumn("__k", F.row_number().over(Window.partitionBy(*KEYS, "us").orderBy("arrival"))).where("__k = 1")
    rows = rows.select(*KEYS, "us", (c("acceleration") + F.coalesce("slope_acc", F.lit(0.0))).alias("acceleration"), (S.holds(c("np_on")) & ~S.holds(c("override"))).alias("in_control"))
    own = frames.where("primary").groupBy(*KEYS).agg(F.max("us").alias("last_us"))
    return heavy_braking(rows).join(own, KEYS).where("start_us <= last_us").drop("last_us")
