"""Order-dependent detectors: what a window function can't say, because each decision depends on the ones before.

``scan`` deals rows out by recording, sorts each partition, and feeds the samples of one recording after another to
a small machine, so a task holds a machine's state and never a whole recording. A machine is a generator function:
it is sent samples (namedtuples) and yields lists of result rows; None tells it that the recording ends.
"""

from __future__ import annotations

from collections import deque, namedtuple
from collections.abc import Callable, Generator, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

Machine = Callable[[], Generator]


def scan(df: DataFrame, keys: Sequence[str], order: Sequence[str], fields: Sequence[str], machine: Machine, result: str) -> DataFrame:
    """keys and ``result`` columns: what ``machine`` gives for each recording's ``fields`` in ``order``."""
    rows = df.select(*dict.fromkeys([*keys, *order, *fields])).repartition(*keys).sortWithinPartitions(*keys, *order)  # one shuffle
    types = StructType([df.schema[k] for k in keys] + _parse_datatype_string(result).fields)
    schema, n = to_arrow_schema(types), len(keys)
    wanted = [*keys, *fields]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = namedtuple("sample", fields)
        key, state, out = None, None, []

        def finish() -> None:
            if state is not None:
                out.extend((*key, *r) for r in state.send(None) or ())

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)

        for part in parts:
            for row in zip(*(part.column(c).to_pylist() for c in wanted), strict=True):
                if state is None or row[:n] != key:
                    finish()
                    key, state = row[:n], machine()
                    next(state)
                out.extend((*key, *r) for r in state.send(sample(*row[n:])) or ())
            if out:
                yield flush()
                out = []
        finish()
        if out:
            yield flush()

    return rows.select(*wanted).mapInArrow(run, types)


def stable_ranges(limits: dict[str, float], min_duration: float, time: str = "t") -> Machine:
    """Greedy stretches in which each series spans its limit at most: (start, end, n). A sample that breaks one begins the next."""

    def machine() -> Generator:
        out, s = [], None
        first = last = None
        low: dict[str, float] = {}
        high: dict[str, float] = {}
        n = 0
        while True:
            s = yield out
            out = []
            known = s is not None and all(getattr(s, f) is not None for f in limits)
            fits = known and n and all(max(high[f], getattr(s, f)) - min(low[f], getattr(s, f)) <= limit + 1e-9 for f, limit in limits.items())
            if n and not fits:
                if last - first >= min_duration:
                    out.append((first, last, n))
                n = 0
            if s is None:
                continue
            if known:
                if not n:
                    first, low, high = getattr(s, time), {f: getattr(s, f) for f in limits}, {f: getattr(s, f) for f in limits}
                else:
                    for f in limits:
                        low[f], high[f] = min(low[f], getattr(s, f)), max(high[f], getattr(s, f))
                last, n = getattr(s, time), n + 1

    return machine


class _Extremes:
    """The samples held, and the least and the greatest of their values, at a constant cost for each sample."""

    def __init__(self) -> None:
        self.held: deque = deque()
        self.low: deque = deque()
        self.high: deque = deque()

    def add(self, item: tuple) -> None:
        x = item[1]
        self.held.append(item)
        while self.low and self.low[-1] > x:
            self.low.pop()
        self.low.append(x)
        while self.high and self.high[-1] < x:
            self.high.pop()
        self.high.append(x)

    def drop(self) -> None:
        x = self.held.popleft()[1]
        if self.low[0] == x:
            self.low.popleft()
        if self.high[0] == x:
            self.high.popleft()

    def clear(self) -> None:
        for x in (self.held, self.low, self.high):
            x.clear()


def stable_or_slide(value: str, span: float, min_duration: float, time: str = "t", reference: str | None = None, tolerance: float = 0.0) -> Machine:
    """As ``stable_ranges`` of one series, but a stretch that is too short gives up its first sample only, and a span
    that reaches the limit breaks it, as does a ``reference`` farther than ``tolerance`` from the first sample's: (start, end, n)."""

    def machine() -> Generator:
        kept = _Extremes()
        held = kept.held
        out: list = []
        while True:
            s = yield out
            out = []
            x = None if s is None else getattr(s, value)
            r = getattr(s, reference) if reference and x is not None else None
            x = None if reference and r is None else x
            while held and (x is None or max(kept.high[0], x) - min(kept.low[0], x) >= span or (reference and abs(r - held[0][2]) > tolerance)):
                if held[-1][0] - held[0][0] >= min_duration:
                    out.append((held[0][0], held[-1][0], len(held)))
                    kept.clear()
                elif x is None:
                    kept.clear()
                else:
                    kept.drop()
            if x is not None:
                kept.add((getattr(s, time), x, r))

    return machine


class _Window:
    """Samples that come and go at the ends, with least and most of a value at hand: no step looks at all of them."""

    def __init__(self, value: str, time: str):
        self.value, self.time = value, time
        self.clear()

    def clear(self) -> None:
        self.held, self.low, self.high = deque(), deque(), deque()

    def total(self) -> float:
        """The sum of the values held, the latest first. It is asked for once a window, as it ends: a sum kept up by taking values off drifts."""
        return reduce(add, (v for _, v in reversed(self.held)), 0.0)

    def push(self, s) -> None:
        v = getattr(s, self.value)
        self.held.append((getattr(s, self.time), v))
        while self.low and self.low[-1] > v:
            self.low.pop()
        self.low.append(v)
        while self.high and self.high[-1] < v:
            self.high.pop()
        self.high.append(v)

    def pop(self) -> None:
        _, v = self.held.popleft()
        if self.low[0] == v:
            self.low.popleft()
        if self.high[0] == v:
            self.high.popleft()

    def length(self) -> float:
        return self.held[-1][0] - self.held[0][0] if self.held else -1


def qualified_windows(test: Callable[[float, float], bool], length: float, gap: float, value: str, tolerance: float, time: str = "t") -> Machine:
    """Windows that first reach ``length`` and pass ``test`` (least, most); after one the next begins behind it, else one sample on.
    Neighbours at most ``gap`` apart whose mean values differ by ``tolerance`` at most are merged: (start, end, value, n)."""

    def machine() -> Generator:
        window, open_ = _Window(value, time), None
        out: list = []
        while True:
            s = yield out
            out = []
            if s is None:
                if open_:
                    out.append((open_[0], open_[1], open_[2] / open_[3], open_[3]))
                continue
            window.push(s)
            while window.length() >= length:
                if test(window.low[0], window.high[0]):
                    a, b, total, n = window.held[0][0], window.held[-1][0], window.total(), len(window.held)
                    if open_ and a - open_[1] <= gap and abs(total / n - open_[2] / open_[3]) <= tolerance:
                        open_ = [open_[0], b, open_[2] + total, open_[3] + n]
                    else:
                        if open_:
                            out.append((open_[0], open_[1], open_[2] / open_[3], open_[3]))
                        open_ = [a, b, total, n]
                    window.clear()
                else:
                    window.pop()

    return machine


def spans_of_length(mask: str, value: str, label: str, length: float, test: Callable[[float, float, float], bool], gap: float, tolerance: float, time: str = "t") -> Machine:
    """Windows of true ``mask`` and one ``label`` that first reach ``length`` and pass ``test`` (label, least, most); after one the next
    begins behind it, else one sample on. One that begins at most ``gap`` after the end of the last, at a label at most
    ``tolerance`` from that one's first, is merged into it: (start, end, first label, most, mean, n)."""

    def machine() -> Generator:
        window, now, open_ = _Window(value, time), None, None
        out: list = []

        def give(o: list) -> tuple:
            return (o[0], o[1], o[2], o[3], o[4] / o[5], o[5])

        while True:
            s = yield out
            out = []
            if s is None:
                if open_:
                    out.append(give(open_))
                continue
            if not getattr(s, mask) or getattr(s, value) is None:
                window.clear()
                continue
            if getattr(s, label) != now:
                window.clear()
                now = getattr(s, label)
            window.push(s)
            while window.length() >= length:
                if not test(now, window.low[0], window.high[0]):
                    window.pop()
                    continue
                a, b = window.held[0][0], window.held[-1][0]
                if open_ and a - open_[1] <= gap and abs(now - open_[2]) <= tolerance:
                    # The deficit of a merged scene is that of its worst window.
                    worst = open_[2] - max(open_[2] - open_[3], now - window.high[0])
                    open_ = [open_[0], b, open_[2], worst, open_[4] + window.total(), open_[5] + len(window.held)]
                else:
                    if open_:
                        out.append(give(open_))
                    open_ = [a, b, now, window.high[0], window.total(), len(window.held)]
                window.clear()

    return machine


def continuations(group: str, fields: Sequence[str], start: str, end: str, label: str, group_start: str, gap: float, tolerance: float) -> Machine:
    """Intervals in order of their ``group`` and start -> ``fields`` and whether each goes on from the last one that counts, or goes on
    itself: it starts at most ``gap`` after that one's end, at a label at most ``tolerance`` away. All is forgotten where a
    group starts over ``gap`` before the one before it."""

    def machine() -> Generator:
        out: list = []
        seen = None  # (group, its start)
        ends = known = None
        while True:
            s = yield out
            out = []
            if s is None:
                continue
            now = (getattr(s, group), getattr(s, group_start))
            if seen is not None and now[0] != seen[0] and now[1] < seen[1] - gap:
                ends = known = None
            seen = now
            goes_on = ends is not None and abs(known - getattr(s, label)) <= tolerance and getattr(s, start) <= ends + gap
            ends = max(ends, getattr(s, end)) if goes_on else getattr(s, end)
            known = getattr(s, label)
            out.append((*(getattr(s, f) for f in fields), goes_on))

    return machine


@dataclass
class SteadyBand:
    """State of ``steady_band`` between two samples: plain numbers, so that it can be kept anywhere."""

    band: float
    dwell: float
    excursion: float
    min_duration: float
    eps: float
    target: float | None = None
    candidate: float | None = None
    since: float | None = None
    start: float | None = None
    away: float | None = None
    before_away: float | None = None
    last: float | None = None

    def _forget(self) -> None:
        self.target = self.since = self.start = self.away = None

    def step(self, t: float | None, mask: bool | None, speed: float | None, set_speed: float | None) -> list[tuple]:
        """What the next sample ends; ``t`` is None after the last one."""
        out = []
        good = t is not None and bool(mask) and speed is not None and set_speed is not None
        if self.target is not None and (not good or abs(set_speed - self.target) > 1e-6):
            end = self.last if self.away is None else self.before_away
            if self.start is not None and end - self.start >= self.min_duration - self.eps:
                out.append((self.start, end, self.candidate))
            self._forget()
        if not good:
            return out
        if self.target is None:
            self.target, self.candidate = set_speed, t
        inside = abs(speed - set_speed) <= self.band + 1e-9
        if self.start is None:
            self.since = (t if self.since is None else self.since) if inside else None
            if self.since is not None and t - self.since >= self.dwell - self.eps:
                self.start = t
        elif inside:
            self.away = None
        elif self.away is None:
            self.away, self.before_away = t, self.last
        elif t - self.away >= self.excursion - self.eps:
            if self.before_away - self.start >= self.min_duration - self.eps:
                out.append((self.start, self.before_away, self.candidate))
            self._forget()
        self.last = t
        return out


def steady_band(mask: str, speed: str, set_speed: str, band: float, dwell: float = 1.0, excursion: float = 2.0, min_duration: float = 5.0, time: str = "t", eps: float = 1e-9) -> Machine:
    """Driving at the set speed: ``dwell`` within ``band`` of it confirms the state at that sample. It lasts while the mask
    holds and the set speed stays, and ends before the first sample of an excursion of ``excursion``:
    (start, end, candidate), the candidate being the first sample of the stretch with this set speed."""

    def machine() -> Generator:
        state, out = SteadyBand(band, dwell, excursion, min_duration, eps), []
        while True:
            s = yield out
            out = state.step(None, None, None, None) if s is None else state.step(*(getattr(s, x) for x in (time, mask, speed, set_speed)))

    return machine


def far_from_last(time: str, width: float) -> Machine:
    """The samples farther than ``width`` from the last one given, whole."""

    def machine() -> Generator:
        last = None
        out: list = []
        while True:
            s = yield out
            out = []
            if s is not None and (last is None or getattr(s, time) - last > width):
                last = getattr(s, time)
                out.append(tuple(s))

    return machine


def disjoint(start: str, end: str) -> Machine:
    """Of intervals that come by their start, each that begins after the end of the last one given, whole."""

    def machine() -> Generator:
        until = None
        out: list = []
        while True:
            s = yield out
            out = []
            if s is not None and (until is None or getattr(s, start) > until):
                until = getattr(s, end)
                out.append(tuple(s))

    return machine


def separated_top(score: str, start: str, count: int, apart: float) -> Machine:
    """Of windows that come by falling score, the first ``count`` that begin ``apart`` from all chosen before: (start, score, rank)."""

    def machine() -> Generator:
        out: list = []
        taken: list[float] = []
        while True:
            s = yield out
            out = []
            if s is not None and len(taken) < count and all(abs(getattr(s, start) - x) >= apart for x in taken):
                taken.append(getattr(s, start))
                out.append((getattr(s, start), getattr(s, score), len(taken)))

    return machine


def greedy_match(side: str, state: str, width: float, time: str = "t") -> Machine:
    """Each ``a`` edge, in time order, takes the nearest ``b`` edge of its state within ``width`` that none has taken, the
    earlier if as near: (a_t, b_t, lag), b_t null without one. Edges are held for twice the width."""

    def machine() -> Generator:
        out: list = []
        waiting: deque = deque()
        free: list[tuple[float, object]] = []

        def settle(now: float | None) -> None:
            while waiting and (now is None or waiting[0][0] + width < now):
                t, value = waiting.popleft()
                near = [x for x in free if x[1] == value and abs(x[0] - t) <= width]
                best = min(near, key=lambda x: (abs(x[0] - t), x[0]), default=None)
                if best is not None:
                    free.remove(best)
                out.append((t, best[0] if best else None, best[0] - t if best else None))
            floor = waiting[0][0] if waiting else now
            if floor is not None:
                free[:] = [x for x in free if x[0] >= floor - width]

        while True:
            s = yield out
            out = []
            settle(None if s is None else getattr(s, time))
            if s is not None:
                (waiting if getattr(s, side) == "a" else free).append((getattr(s, time), getattr(s, state)))

    return machine


def forward_drops(value: str, drop: float, within: float, slope: float = 0.0, floor: float | None = None, dwell: float = 0.0, time: str = "t") -> Machine:
    """From each sample the deepest fall within ``within``, the first of equals; falls of ``drop`` at ``slope`` a second, that reach
    ``floor`` and stay there for ``dwell``, are events and consume their samples: (start, end, fall).

    The least value ahead stands at the head of a queue of rising values, and a sample knows the end of its stay under the floor, so
    each sample is looked at a fixed number of times, however long the window.
    """

    def machine() -> Generator:
        out: list = []
        held: deque = deque()  # (time, value, its stay under the floor as [last time], or None)
        ahead: deque = deque()  # those not yet within reach of the first
        least: deque = deque()  # of those within reach: values that rise, the first of equals kept
        stay: list | None = None

        def settle(final: bool) -> None:
            while held and (final or held[-1][0] - held[0][0] > within + dwell):
                t0, v0, _ = held[0]
                while ahead and ahead[0][0] - t0 <= within:
                    s = ahead.popleft()
                    while least and least[-1][1] > s[1]:
                        least.pop()
                    least.append(s)
                t1, v1, low = least[0]
                good = v0 - v1 >= drop and t1 > t0 and (v0 - v1) / (t1 - t0) >= slope
                if good and floor is not None:
                    good = low is not None and low[0] - t1 >= dwell - 1e-9
                end = t0
                if good:
                    out.append((t0, t1, v0 - v1))
                    end = t1
                first = True
                while held and (held[0][0] <= end if good else first):
                    gone, first = held.popleft(), False
                    if least and least[0] is gone:
                        least.popleft()
                    elif ahead and ahead[0] is gone:
                        ahead.popleft()

        while True:
            s = yield out
            out = []
            if s is not None and getattr(s, value) is not None:
                t, v = getattr(s, time), getattr(s, value)
                if floor is None or v > floor:
                    stay = None
                elif stay is None:
                    stay = [t]
                else:
                    stay[0] = t
                held.append((t, v, stay))
                ahead.append(held[-1])
            settle(s is None)

    return machine


def turning_points(value: str, prominence: float, centre: str, field: str = "n") -> Machine:
    """Extrema in order -> how many turns they make, once at the end: one counts if it is ``prominence`` away from the last that
    counts; else it takes that one's place if it is farther from the ``centre``."""

    def machine() -> Generator:
        last, n, out = None, 0, []
        while True:
            s = yield out
            out = []
            if s is None:
                out.append((n,))
                continue
            v, mid = getattr(s, value), getattr(s, centre)
            if last is None or abs(v - last) >= prominence:
                last, n = v, n + 1
            elif abs(v - mid) > abs(last - mid):
                last = v

    return machine


def rebounds(value: str, jump: float = 0.5, jump_time: float = 0.8, jump_slope: float = 2.2, back: float = 0.5, back_time: float = 0.2, back_slope: float = 3.0, time: str = "t") -> Machine:
    """A jump and its reversal: a change of ``jump`` within ``jump_time``, then one of ``back`` the other way within
    ``back_time``, each at its slope: (start, peak, end)."""

    def machine() -> Generator:
        out: list = []
        held: deque = deque()

        def settle(final: bool) -> None:
            while held and (final or held[-1][0] - held[0][0] > jump_time + back_time):
                rows = list(held)
                t0, v0 = rows[0]
                found = None
                for k, (t1, v1) in enumerate(rows[1:], 1):
                    if t1 - t0 > jump_time:
                        break
                    if abs(v1 - v0) >= jump and abs(v1 - v0) >= jump_slope * (t1 - t0):
                        sign = 1 if v1 > v0 else -1
                        found = next(((t0, t1, t2) for t2, v2 in rows[k + 1 :] if t2 - t1 <= back_time and sign * (v1 - v2) >= max(back, back_slope * (t2 - t1))), found)
                        if found:
                            break
                if found:
                    out.append(found)
                    while held and held[0][0] <= found[2]:
                        held.popleft()
                else:
                    held.popleft()

        while True:
            s = yield out
            out = []
            if s is not None and getattr(s, value) is not None:
                held.append((getattr(s, time), getattr(s, value)))
            settle(s is None)

    return machine
