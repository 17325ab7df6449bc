"""Recurrences over streams of samples, with state of version 2: ducking gains and keyframes of scenes that go on for ever.

A scene's samples may come in any order within the watermark's delay. They wait in a list state until the watermark has
passed them, are then taken in the order of their times, and move the recurrence on, whose last value is a value state; a
timer wakes scenes that nothing more comes for. So the stream gives, row by row, what the batch operators give for the
same samples, over any number of batches and restarts. Samples that come after the watermark has passed them are dropped.
Samples of one time come in the order of `tie`. With `idle`, a scene without samples for so long is forgotten and begins anew.
Scenes may begin with values that a batch has left (`initial`).

The state store must be RocksDB (`use_state_store`). Times are timestamps with a zone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_state_store(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)


class InOrder(StatefulProcessor):
    """Gives `step` the samples of a key in the order of time, once the watermark has passed them."""

    def __init__(self, key: str, ts: str, tie: str, value: str, idle_ms: int | None):
        self.key, self.ts, self.tie, self.value, self.idle_ms = key, ts, tie, value, idle_ms

    def step(self, last: float | None, x: float) -> tuple[float, float | None]:
        """The next value of the recurrence, and what becomes of the sample (None: nothing)."""
        raise NotImplementedError

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", T.StructType([T.StructField("value", T.DoubleType()), T.StructField("at", T.LongType())]))
        self.waiting = handle.getListState("waiting", T.StructType([T.StructField("at", T.LongType()), T.StructField("tie", T.LongType()), T.StructField("x", T.DoubleType())]))

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self.last.update((float(initialState["last"].iloc[0]), -(2**62)))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        news = []
        for part in rows:
            at = pd.to_datetime(part[self.ts], utc=True).astype("datetime64[us, UTC]").astype("int64")
            news += zip(at.tolist(), part[self.tie].tolist(), part[self.value].astype(float).tolist(), strict=True)
        if news:
            self.waiting.appendList(news)
            self.handle.registerTimer(max(n[0] for n in news) // 1000 + 1)
        yield from self._passed(key, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        yield from self._passed(key, mark)
        if self.idle_ms is not None and self.last.exists() and not self.waiting.exists():
            if self.last.get()[1] // 1000 + self.idle_ms <= expiredTimerInfo.getExpiryTimeInMs():
                self.last.clear()

    def _passed(self, key, mark: int) -> Iterator[pd.DataFrame]:
        held = sorted(tuple(r) for r in self.waiting.get()) if self.waiting.exists() else []
        ready = [r for r in held if r[0] // 1000 < mark]
        if not ready:
            return
        value, before = self.last.get() if self.last.exists() else (None, None)
        out = []
        for at, tie, x in ready:
            if self.idle_ms is not None and before is not None and before > -(2**62) and (at - before) // 1000 >= self.idle_ms:
                value = None
            value, found = self.step(value, x)
            before = at
            if found is not None:
                out.append((at, tie, found))
        self.last.update((value, before))
        rest = held[len(ready) :]
        if rest:
            self.waiting.put(rest)
        else:
            self.waiting.clear()
            if self.idle_ms is not None:
                self.handle.registerTimer(before // 1000 + self.idle_ms)
        if out:
            yield pd.DataFrame({self.key: [key[0]] * len(out), self.ts: pd.to_datetime([o[0] for o in out], unit="us", utc=True), self.tie: [o[1] for o in out], self.value: [o[2] for o in out]})

    def close(self) -> None:
        pass


class Gains(InOrder):
    def __init__(self, *where, threshold: float, reduction: float, attack: float, release: float):
        super().__init__(*where)
        self.threshold, self.reduction, self.attack, self.release = threshold, reduction, attack, release

    def step(self, last, x):
        last = 1.0 if last is None else last
        c, target = (self.attack, self.reduction) if x > self.threshold else (self.release, 1.0)
        gain = c * last + (1 - c) * target
        return gain, gain


class Keyframes(InOrder):
    def __init__(self, *where, least: float):
        super().__init__(*where)
        self.least = least

    def step(self, last, x):
        if last is None or math.isnan(last) or abs(x - last) >= self.least:
            return x, x
        return last, None


def _run(stream: DataFrame, key: str, ts: str, tie: str, value: str, late: str, processor: InOrder, initial: DataFrame | None) -> DataFrame:
    fields = {f.name: f.dataType for f in stream.schema}
    out = T.StructType([T.StructField(key, fields[key]), T.StructField(ts, T.TimestampType()), T.StructField(tie, T.LongType()), T.StructField(value, T.DoubleType())])
    rows = stream.select(key, ts, stream[tie].cast("long").alias(tie), value).withWatermark(ts, late).groupBy(key)
    begun = None if initial is None else initial.select(key, "last").groupBy(key)
    return rows.transformWithStateInPandas(processor, out, "append", "EventTime", initialState=begun)


def gain_stream(
    stream: DataFrame, key: str, ts: str, tie: str, level: str, late: str, threshold: float, reduction: float, attack: float, release: float, idle_ms: int | None = None, initial: DataFrame | None = None,
) -> DataFrame:
    """key, ts, tie and the gain (in the column `level`) of every sample: c g + (1 - c) t with (attack, reduction) while the level is
    above the threshold and (release, 1) else, from 1 on or from `initial` (key, last)."""
    return _run(stream, key, ts, tie, level, late, Gains(key, ts, tie, level, idle_ms, threshold=threshold, reduction=reduction, attack=attack, release=release), initial)


def keyframe_stream(stream: DataFrame, key: str, ts: str, tie: str, db: str, late: str, least: float = 0.5, idle_ms: int | None = None, initial: DataFrame | None = None) -> DataFrame:
    """The frames whose level differs by `least` dB or more from the last one kept, as `envelopes.keyframes`."""
    return _run(stream, key, ts, tie, db, late, Keyframes(key, ts, tie, db, idle_ms, least=least), initial)
