"""Stateful processors that see the rows of a key in the order of their time, however micro-batches cut and shuffle them.

Rows wait in a list until the watermark passes them; as none at or before it can come any more, what it has passed is
handed over in order (equal times by side and value). One event-time timer a key, for the earliest thing that is due,
wakes it: a row that waits, something to be said of silence, or the end of a key that has been silent for `idle`
seconds, when all its state goes. A key that speaks again later begins anew.

State lies in RocksDB, so its size is bounded by disk, not by an executor's memory. Sessions need `state_store(spark)`.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from heapq import heappop, heappush, heappushpop
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

Row = tuple[int, str, list[float]]
Out = list[tuple[Any, ...]]

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def state_store(spark: SparkSession) -> SparkSession:
    """Sets the state store that these processors need."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    return spark


class InOrder(StatefulProcessor):
    """Times are microseconds. Subclasses have open (their state), step (rows in order, up to the watermark), wake (when they
    want to be asked next, if nothing comes), finish (what is left to say at the end) and forget."""

    def __init__(self, out: list[str], idle: float) -> None:
        self.out, self.idle = out, round(idle * 1e6)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buffer = handle.getListState("buffer", "at long, side string, value array<double>")
        self.due = handle.getValueState("due", "timer long, last long")
        self.open(handle)

    def open(self, handle: StatefulProcessorHandle) -> None: ...

    def step(self, key: tuple, rows: list[Row], now: int) -> Out: ...

    def wake(self) -> int | None:
        return None

    def finish(self, key: tuple) -> Out:
        return []

    def forget(self) -> None: ...

    def schedule(self, timer: int | None, at: int, last: int) -> None:
        """Moves the key's timer to `at`."""
        ms = at // 1000 + 1
        if timer is not None and timer != ms:
            self.handle.deleteTimer(timer)
        if timer != ms:
            self.handle.registerTimer(ms)
        self.due.update((ms, last))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        new: list[Row] = []
        for part in rows:
            values = [[] if v is None else [float("nan") if x is None else float(x) for x in v] for v in part["value"]]
            new += zip(part["at"].astype("int64").tolist(), part["side"].fillna("").tolist(), values, strict=True)
        if new:
            self.buffer.appendList(new)
            timer, last = self.due.get() if self.due.exists() else (None, new[0][0])
            first = min(r[0] for r in new)
            self.schedule(timer, first if timer is None else min(first, timer * 1000 - 1000), max(last, *(r[0] for r in new)))
        yield from ()

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = sorted((tuple(r) for r in self.buffer.get()), key=lambda r: (r[0], r[1], list(r[2])))
        rest = [r for r in waiting if r[0] > now]
        _, last = self.due.get()
        out = self.step(key, waiting[: len(waiting) - len(rest)], now)
        if rest:
            self.buffer.put(rest)
        else:
            self.buffer.clear()
        if not rest and now >= last + self.idle:
            out += self.finish(key)
            self.forget()
            self.due.clear()
        else:
            ask = self.wake()
            at = rest[0][0] if rest else last + self.idle
            self.schedule(None, max(now, at if ask is None else min(at, ask)), last)
        if out:
            yield pd.DataFrame(out, columns=self.out)


class Latest(InOrder):
    """A row whenever all sides have a value, of the latest of each, which it uses up but for the first side's if kept."""

    def __init__(self, out: list[str], idle: float, sides: tuple[str, ...], keep_first: bool) -> None:
        super().__init__(out, idle)
        self.sides, self.keep_first = sides, keep_first

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.values = handle.getMapState("values", "side string", "value array<double>")

    def step(self, key: tuple, rows: list[Row], now: int) -> Out:
        held = {k[0]: list(v[0]) for k, v in self.values.iterator()}
        before, out = dict(held), []
        for at, side, value in rows:
            if side in self.sides:
                if value and not any(np.isnan(value)):
                    held[side] = list(value)
                else:
                    held.pop(side, None)
                if len(held) == len(self.sides):
                    out.append((*key, at, *(held[s] for s in self.sides)))
                    held = {s: v for s, v in held.items() if self.keep_first and s == self.sides[0]}
        for s in before.keys() - held.keys():
            self.values.removeKey((s,))
        for s, v in held.items():
            if before.get(s) != v:
                self.values.updateValue((s,), (v,))
        return out

    def forget(self) -> None:
        self.values.clear()


class Nearest(InOrder):
    """Each frame with the value of the sample nearest in time within the tolerance, the earlier of two. A frame is decided
    once the watermark is a tolerance past it; samples stay while a frame may still want them."""

    def __init__(self, out: list[str], idle: float, tolerance: float) -> None:
        self.tolerance = round(tolerance * 1e6)
        super().__init__(out, max(idle, tolerance))

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.frames = handle.getListState("frames", "at long, value double")
        self.samples = handle.getListState("samples", "at long, value double")

    def decide(self, key: tuple, frames: list, samples: list) -> Out:
        times, out = [t for t, _ in samples], []
        for at, value in frames:
            k = bisect_left(times, at)
            near = [(abs(t - at), i) for i in (k - 1, k) if 0 <= i < len(times) for t in (times[i],) if abs(t - at) <= self.tolerance]
            i = min(near, default=(0, -1))[1]
            while i > 0 and times[i - 1] == times[i]:
                i -= 1
            out.append((*key, at, value, samples[i][1] if i >= 0 else float("nan")))
        return out

    def step(self, key: tuple, rows: list[Row], now: int) -> Out:
        frames = [tuple(x) for x in self.frames.get()] + [(at, v[0]) for at, side, v in rows if side == "frame"]
        samples = [tuple(x) for x in self.samples.get()] + [(at, v[0]) for at, side, v in rows if side == "sample"]
        n = sum(at + self.tolerance <= now for at, _ in frames)
        out = self.decide(key, frames[:n], samples)
        frames, oldest = frames[n:], min([now, *(at for at, _ in frames[n:])]) - self.tolerance
        samples = [s for s in samples if s[0] >= oldest]
        for state, left in ((self.frames, frames), (self.samples, samples)):
            state.put(left) if left else state.clear()
        return out

    def wake(self) -> int | None:
        return min((at + self.tolerance for at, _ in self.frames.get()), default=None)

    def finish(self, key: tuple) -> Out:
        return self.decide(key, [tuple(x) for x in self.frames.get()], [tuple(x) for x in self.samples.get()])

    def forget(self) -> None:
        self.frames.clear()
        self.samples.clear()


class Smoothness(InOrder):
    """Over the last `window` steps (distances of neighbouring actions): their mean, population deviation and maximum, mean and
    maximum of the step's change, how many actions there have been and which share was clamped (side 'clamped')."""

    def __init__(self, out: list[str], idle: float, window: int) -> None:
        super().__init__(out, idle)
        self.window = window

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.carry = handle.getValueState("carry", "last array<double>, steps array<double>, changes array<double>, n long, clamped long")

    def step(self, key: tuple, rows: list[Row], now: int) -> Out:
        last, steps, changes, n, clamped = self.carry.get() if self.carry.exists() else (None, [], [], 0, 0)
        steps, changes, out = list(steps), list(changes), []
        for at, side, value in rows:
            n, clamped = n + 1, clamped + (side == "clamped")
            if last is not None:
                new = float(np.linalg.norm(np.subtract(value, last)))
                changes = [*changes, abs(new - steps[-1])][-self.window :] if steps else changes
                steps = [*steps, new][-self.window :]
            last = value
            if len(steps) > 1:
                out.append((*key, at, float(np.mean(steps)), float(np.std(steps)), max(steps), float(np.mean(changes)), max(changes), n, 100 * clamped / n))
        if rows:
            self.carry.update((list(last), steps, changes, n, clamped))
        return out

    def forget(self) -> None:
        self.carry.clear()


class Gaps(InOrder):
    """Rows (kind, start, end, gap). 'silent' while a topic is silent for longer than the larger of `least` and `factor` times
    the median interval so far, with the moment at which that was so as its end; 'gap' when it speaks again.

    The median is kept by two heaps in list state, the lower half (negative) and the upper half."""

    def __init__(self, out: list[str], idle: float, least: float, factor: float) -> None:
        super().__init__(out, idle)
        self.least, self.factor = least * 1e6, factor

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.low, self.high = (handle.getListState(n, "x long") for n in ("low", "high"))
        self.last = handle.getValueState("last", "at long, said boolean, limit double")

    def step(self, key: tuple, rows: list[Row], now: int) -> Out:
        out: Out = []
        last, said, limit = self.last.get() if self.last.exists() else (None, False, None)
        if rows:
            low, high = ([x[0] for x in s.get()] for s in (self.low, self.high))
            for at, *_ in rows:
                if last is not None:
                    if limit is not None and at - last > limit:
                        if not said:
                            out.append((*key, "silent", last, round(last + limit), limit / 1e6))
                        out.append((*key, "gap", last, at, (at - last) / 1e6))
                    heappush(low, -heappushpop(high, at - last))
                    if len(low) > len(high):
                        heappush(high, -heappop(low))
                    middle = high[0] if len(high) > len(low) else (high[0] - low[0]) / 2
                    limit = max(self.least, self.factor * middle)
                last, said = at, False
            for state, heap in ((self.low, low), (self.high, high)):
                state.put([(x,) for x in heap]) if heap else state.clear()
        if last is not None and limit is not None and not said and now > last + limit:
            out.append((*key, "silent", last, round(last + limit), limit / 1e6))
            said = True
        if last is not None:
            self.last.update((last, said, limit))
        return out

    def wake(self) -> int | None:
        if not self.last.exists():
            return None
        last, said, limit = self.last.get()
        return None if said or limit is None else round(last + limit) + 1000

    def forget(self) -> None:
        for state in (self.low, self.high, self.last):
            state.clear()


class Throttle(InOrder):
    """Rows at least `every` seconds after the last one kept, `most` a key at most."""

    def __init__(self, out: list[str], idle: float, every: float, most: int | None) -> None:
        super().__init__(out, idle)
        self.every, self.most = round(every * 1e6), most

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("kept", "n long, last long")

    def step(self, key: tuple, rows: list[Row], now: int) -> Out:
        n, last = self.kept.get() if self.kept.exists() else (0, None)
        out: Out = []
        for at, side, _ in rows:
            if (self.most is None or n < self.most) and (last is None or at - last >= self.every):
                n, last = n + 1, at
                out.append((*key, at, side))
        if out:
            self.kept.update((n, last))
        return out

    def forget(self) -> None:
        self.kept.clear()


def vector(df: DataFrame, name: str) -> Column:
    """The column as an array of doubles; a single number is one of one."""
    return F.col(name).cast("array<double>") if df.schema[name].dataType.typeName() == "array" else F.array(F.col(name).cast("double"))


def processed(messages: DataFrame, processor: InOrder, keys: dict[str, str], out: str, *, side: Column, value: Column, watermark: str) -> DataFrame:
    """What the processor says of each key. Rows without a first key or time only move the watermark; `out` are its columns,
    times as microseconds."""
    rows = messages.withWatermark("ts", watermark).select(*keys, "ts", F.unix_micros("ts").alias("at"), side.alias("side"), value.alias("value"))
    # a plain IS NOT NULL would be pushed below the watermark, which such rows are to move
    rows = rows.filter(F.size(F.array_compact(F.array(F.col("ts").cast("string"), F.col(next(iter(keys))).cast("string")))) == 2)
    schema = ", ".join([*(f"{k} {t}" for k, t in keys.items()), out])
    return rows.groupBy(*keys).transformWithStateInPandas(processor, schema, "append", "EventTime")
