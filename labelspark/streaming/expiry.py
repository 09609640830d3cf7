"""Announced labels with a lookback, as keyed state with timers.

Each (source, label, value) is a key whose state is the time it was last seen and whose timer goes off when its lookback has
run out, by the stream's own clock, the watermark.  So a label comes and leaves without any table being read: a batch
hands on what changes, and nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from labelspark.functions.times import from_millis
from labelspark.operators.catalog import announced_pairs, as_label_sets, lookback_range
from labelspark.streaming.refresh import ANNOUNCED_EVERY, SEEN_KEYS, started
from labelspark.streaming.versions import LogTable, run_of

CHANGES = "source string, label string, value string, at_ms bigint, alive boolean"
#: The store that keyed state with timers needs; sessions set it as spark.sql.streaming.stateStore.providerClass.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class LabelClock(StatefulProcessor):
    """One row when a label appears, one when its lookback has run out."""

    def __init__(self, lookback_ms: int) -> None:
        self.lookback_ms = lookback_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "last_ms bigint")

    def _row(self, key: tuple, at_ms: int, alive: bool) -> pd.DataFrame:
        return pd.DataFrame([(*key, at_ms, alive)], columns=["source", "label", "value", "at_ms", "alive"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        newest = max(int(part["ts_ms"].max()) for part in rows)
        before = self.seen.get()[0] if self.seen.exists() else None
        if before is not None and before >= newest:
            return
        if before is not None:
            self.handle.deleteTimer(before + self.lookback_ms + 1)
        self.seen.update((newest,))
        self.handle.registerTimer(newest + self.lookback_ms + 1)
        if before is None:
            yield self._row(key, newest, True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        due = expiredTimerInfo.getExpiryTimeInMs()
        if self.seen.exists() and self.seen.get()[0] + self.lookback_ms + 1 <= due:
            self.seen.clear()
            yield self._row(key, due, False)

    def close(self) -> None:
        pass


def label_changes(samples: DataFrame, names: Sequence[str], lookback_ms: int, delay: str = "0 seconds") -> DataFrame:
    """A stream of ``(source, label, value, at_ms, alive)``: labels that appear and labels whose lookback has run out.

    ``delay`` is how late a sample may come and still count.
    """
    if lookback_range(0, lookback_ms) is None:
        raise ValueError("labels leave by a lookback, so there must be one")
    timed = announced_pairs(samples, names, "source", "ts_ms").withColumn("at", from_millis(F.col("ts_ms")))
    keyed = timed.withWatermark("at", delay).groupBy(*SEEN_KEYS)
    return keyed.transformWithStateInPandas(LabelClock(lookback_ms), CHANGES, "Update", "EventTime")


def living_log(spark: SparkSession, path: str, **settings) -> LogTable:
    """The last change of each label."""
    return LogTable(spark, path, SEEN_KEYS, {"change": F.max("change")}, **settings)


def stream_living(
    samples: DataFrame,
    names: Sequence[str],
    lookback_ms: int,
    table: LogTable,
    checkpoint: str,
    *,
    delay: str = "0 seconds",
    once: bool = False,
    every: str = ANNOUNCED_EVERY,
) -> StreamingQuery:
    """Follow a stream of samples and keep in a table which labels are within their lookback; see `living`.

    The session's state store must be `STATE_STORE`.  Samples later than ``delay`` do not count.
    """

    def keep(batch: DataFrame, batch_id: int) -> None:
        change = F.struct("at_ms", "alive").alias("change")
        table.append(batch.select(*SEEN_KEYS, change), run_of(table.spark, checkpoint), batch_id)

    changes = label_changes(samples, names, lookback_ms, delay)
    return started(changes.writeStream.outputMode("update").foreachBatch(keep), checkpoint, once, every)


def living(table: LogTable, *by: str) -> DataFrame:
    """The label sets within their lookback at the stream's last watermark, distinct and sorted by text."""
    there = table.current().filter("change.alive").select(*by, "label", "value").distinct()
    return as_label_sets(there).select(*by, "labels", "labels_s").orderBy("labels_s", *by)
