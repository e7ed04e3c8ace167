"""Order-dependent scenes over a stream: one machine for each recording, kept in state between batches.

Samples of a recording may come in any order within ``delay`` of its latest one. They wait in state until the recording's own
watermark (latest time less the delay) has passed them, and then go through the machine in order, which is the one that
batch tables are scanned with; what it keeps between two samples is a dozen numbers. A sample behind what the machine has
read is late: it isn't used, and it is told. A recording that brings nothing for ``idle`` is at its end: a timer then
reads what waits, closes the scene and clears the state, so state is bounded by the recordings at work.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions import scalars as S
from ..operators.automata import SteadyBand
from ..plans.scenes import SECOND, slope_samples

#: kind: scene (start_us, end_us), late (start_us = end_us = the sample's time).
RESULT = "recording_id string, kind string, start_us long, end_us long, candidate_us long"
BUFFER = "us long, on boolean, v double, target double"


class SlopeScenes(StatefulProcessor):
    """``scene_slope_no_front`` of each recording."""

    def __init__(self, band: float, delay_us: int, idle_ms: int):
        self.band, self.delay, self.idle = band, delay_us, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("machine", "json string")
        self.waiting = handle.getListState("waiting", BUFFER)

    def _open(self) -> tuple[SteadyBand, int | None, int | None, list[tuple]]:
        """(machine, time read so far, latest time, samples that wait)."""
        if not self.state.exists():
            return SteadyBand(self.band, SECOND, 2 * SECOND, 5 * SECOND, 0), None, None, []
        kept = json.loads(self.state.get()[0])
        return SteadyBand(**kept["machine"]), kept["read"], kept["latest"], [tuple(r) for r in self.waiting.get()] if self.waiting.exists() else []

    def _frame(self, key: str, rows: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame(rows, columns=["kind", "start_us", "end_us", "candidate_us"]).astype({c: "Int64" for c in ("start_us", "end_us", "candidate_us")})
        frame.insert(0, "recording_id", key)
        return frame

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        machine, read, latest, waiting = self._open()
        out = []
        for part in rows:
            for us, on, v, target in part[["us", "on", "v", "target"]].itertuples(index=False):
                if read is not None and us <= read:
                    out.append(("late", int(us), int(us), None))
                    continue
                waiting.append((int(us), bool(on), None if pd.isna(v) else float(v), None if pd.isna(target) else float(target)))
                latest = int(us) if latest is None else max(latest, int(us))
        if latest is not None:
            ready = sorted((s for s in waiting if s[0] <= latest - self.delay), key=lambda s: s[0])
            waiting = [s for s in waiting if s[0] > latest - self.delay]
            for s in ready:
                out += [("scene", *found) for found in machine.step(*s)]
                read = s[0]
            self.state.update((json.dumps({"machine": asdict(machine), "read": read, "latest": latest}),))
            self.waiting.clear()
            if waiting:
                self.waiting.put(waiting)
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle)
        yield self._frame(key[0], out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        machine, _, _, waiting = self._open()
        out = [("scene", *found) for s in sorted(waiting, key=lambda s: s[0]) for found in machine.step(*s)]
        out += [("scene", *found) for found in machine.step(None, None, None, None)]
        self.state.clear()
        self.waiting.clear()
        yield self._frame(key[0], out)

    def close(self) -> None:
        pass


def slope_scenes(frame: DataFrame, powertrain: str = "PHEV", delay_s: float = 10.0, idle_s: float = 60.0) -> DataFrame:
    """A stream of prepared samples -> ``RESULT``: scenes as they end, and late samples as they come.

    The session's state store must be RocksDB (``spark.sql.streaming.stateStore.providerClass``). Null recordings and times are left out;
    of samples of one time the machine reads all, in the order in which they came. A recording that goes on after its
    idle time begins anew.
    """
    rows = slope_samples(frame.where("recording_id is not null and us is not null")).withColumn("recording_id", F.col("recording_id").cast("string"))
    processor = SlopeScenes(S.by_powertrain(powertrain, 0.6, 0.3), int(delay_s * SECOND), int(idle_s * 1000))
    return rows.groupBy("recording_id").transformWithStateInPandas(processor, outputStructType=RESULT, outputMode="append", timeMode="ProcessingTime")
