"""The anchored cooldown as keyed streaming state with event-time timers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from corpuslab.operators.cooldown import COOLDOWN_SECONDS, from_micros, micros

STORE_CONF = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SLICES = 24  # parts of a cooldown that errors wait in
HELD = 1 << 20  # times a call holds before it moves them to the state


class Cooldown(StatefulProcessor):
    """State of one key: its last settled anchor, and the times that may still become anchors.

    A time is settled once the watermark has passed it, as no earlier error can come any more. Until then it waits in a
    slice of the cooldown (one map entry each); times inside the cooldown of a settled anchor never enter the state. A
    timer at the earliest waiting time wakes the key, and one at the end of the last cooldown removes it.
    """

    def __init__(self, gap: int, slices: int = SLICES, held: int = HELD):
        self.gap, self.width, self.most = gap, max(1, gap // slices), held

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "anchor bigint")
        self.index = handle.getValueState("index", "slices array<bigint>")
        self.waiting = handle.getMapState("waiting", "slice bigint", "times array<bigint>")

    def _free_from(self) -> int | None:
        return self.last.get()[0] + self.gap if self.last.exists() else None

    def _slices(self) -> list[int]:
        return list(self.index.get()[0]) if self.index.exists() else []

    def _store(self, times: np.ndarray) -> None:
        known = set(self._slices())
        place = times // self.width
        for s in np.unique(place).tolist():
            mine = times[place == s]
            if s in known:
                mine = np.union1d(mine, np.array(self.waiting.getValue((s,))[0], np.int64))
            self.waiting.updateValue((s,), (mine.tolist(),))
            known.add(s)
        self.index.update((sorted(known),))

    def _drop(self, slices: list[int], gone: list[int]) -> list[int]:
        for s in gone:
            self.waiting.removeKey((s,))
        left = [s for s in slices if s not in set(gone)]
        if left != slices:
            self.index.update((left,))
        return left

    def _settle(self, watermark: int) -> list[int]:
        """New anchors up to the watermark (in microseconds), in order; sets the next timer."""
        opened, slices, free = [], self._slices(), self._free_from()
        while slices:
            if free is not None:
                slices = self._drop(slices, [s for s in slices if (s + 1) * self.width <= free])
            found = None
            for s in slices:
                times = np.array(self.waiting.getValue((s,))[0], np.int64)
                at = 0 if free is None else int(np.searchsorted(times, free))
                if at < len(times):
                    found = int(times[at])
                    break
            if found is None:
                slices = self._drop(slices, slices)
                break
            if found > watermark:
                self.handle.registerTimer(-(-found // 1000))
                return opened
            opened.append(found)
            self.last.update((found,))
            free = found + self.gap
        if free is not None:
            if free <= watermark:
                self.last.clear()
                self.index.clear()
            else:
                self.handle.registerTimer(-(-free // 1000))
        return opened

    def _rows(self, key: tuple, watermark_ms: int) -> Iterator[pd.DataFrame]:
        opened = self._settle(watermark_ms * 1000)
        if opened:
            keys = pd.Series([key[0]] * len(opened), dtype=object)
            yield pd.DataFrame({"cooldown_key": keys, "anchor_us": np.array(opened, np.int64)})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        free, held, n = self._free_from(), [], 0
        for chunk in rows:
            times = np.unique(chunk["time_us"].to_numpy())
            if free is not None:
                times = times[np.searchsorted(times, free):]
            held.append(times)
            n += len(times)
            if n >= self.most:
                self._store(np.unique(np.concatenate(held)))
                held, n = [], 0
        if n:
            self._store(np.unique(np.concatenate(held)))
        yield from self._rows(key, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._rows(key, timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def cooldown_stream(
    errors: DataFrame, key: str, stamp: str, seconds: int = COOLDOWN_SECONDS, lateness: str = "1 hour"
) -> DataFrame:
    """``key, anchor_ts`` for a stream of errors: each row that opens a cooldown.

    Errors may come in any order within ``lateness``; an anchor is returned once the watermark has passed it and is
    final then, so the stream returns what :func:`cooldown_anchors` finds in the same rows. Rows later than that are
    dropped. Repeated times of a micro-batch are reduced before the state. Needs the RocksDB state store, which is set for
    the session.
    """
    errors.sparkSession.conf.set(STORE_CONF, ROCKSDB)
    types = dict(errors.dtypes)
    # names without a leading underscore, which the Python rows would lose
    narrow = errors.select(F.col(key).alias("cooldown_key"), micros(stamp, types[stamp]).alias("time_us"))
    narrow = narrow.withColumn("event_time", F.timestamp_micros("time_us")).withWatermark("event_time", lateness)
    anchors = narrow.groupBy("cooldown_key").transformWithStateInPandas(
        Cooldown(seconds * 1_000_000), f"cooldown_key {types[key]}, anchor_us BIGINT", "Append", "EventTime"
    )
    return anchors.select(F.col("cooldown_key").alias(key), from_micros(F.col("anchor_us"), types[stamp]).alias("anchor_ts"))
