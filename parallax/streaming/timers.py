"""K3 with event-time timers: count windows of rows that may arrive out of order.

Rows of a key wait in a list state until the watermark has passed their event time; then they
are released in the order of (event time, id), and every ``size`` released rows of a key make a
window.  The state of a key is what has not been released yet, and the sums of its open window
(fewer than ``size`` rows); input comes as frames of bounded size that are appended to the state
one by one, so no key's share of a micro-batch is held as one frame.  A timer at the earliest
waiting row wakes the key when the watermark gets there.

Rows later than the watermark are dropped, as in any watermarked stream; null event times wait
for nothing and are dropped too.  Needs the RocksDB state store, which Spark ships.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from parallax.streaming.jobs import COUNT_WINDOW_OUT, ensure_input, event_time, run_available_now

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
WAITING = T.StructType([T.StructField("ms", T.LongType()), T.StructField("event_id", T.LongType()), T.StructField("value", T.DoubleType())])
OPEN = T.StructType([T.StructField("window_id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("total", T.DoubleType()),
                     T.StructField("present", T.LongType()), T.StructField("first", T.LongType()), T.StructField("last", T.LongType())])


class CountWindows(StatefulProcessor):
    def __init__(self, size: int):
        self.size = size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", WAITING)
        self.open = handle.getValueState("open", OPEN)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        earliest = None
        for frame in rows:
            new = [(int(ms), int(i), None if pd.isna(v) else float(v)) for ms, i, v in zip(frame["ms"], frame["event_id"], frame["value"])]
            if new:
                self.waiting.appendList(new)
                first = min(n[0] for n in new)
                earliest = first if earliest is None else min(earliest, first)
        if earliest is not None:
            self._wake(earliest)
        return iter(())

    def _wake(self, ms: int) -> None:
        """One timer, at the earliest waiting row."""
        timers = list(self.handle.listTimers())
        if not timers or ms + 1 < min(timers):
            for t in timers:
                self.handle.deleteTimer(t)
            self.handle.registerTimer(ms + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        rows = [tuple(r) for r in self.waiting.get()]
        ready = sorted((r for r in rows if r[0] < mark), key=lambda r: r[:2])
        rest = [r for r in rows if r[0] >= mark]
        self.waiting.clear()
        if rest:
            self.waiting.put(rest)
            self.handle.registerTimer(min(r[0] for r in rest) + 1)
        window, n, total, present, first, last = self.open.get() if self.open.exists() else (0, 0, 0.0, 0, None, None)
        out = []
        for _, i, v in ready:
            n, total, present = n + 1, total + (v or 0.0), present + (v is not None)
            first, last = i if first is None else min(first, i), i if last is None else max(last, i)
            if n == self.size:
                out.append((key[0], window, n, total / present if present else None, first, last))
                window, n, total, present, first, last = window + 1, 0, 0.0, 0, None, None
        self.open.update((window, n, total, present, first, last))
        if out:
            yield pd.DataFrame(out, columns=COUNT_WINDOW_OUT.fieldNames())


def stream_count_timers(spark: SparkSession, events_path: str, schema: T.StructType, out_path: str, watermark: str, size: int = 50,
                        arrivals: list[Callable[[], None]] | None = None) -> DataFrame:
    """One row for each complete window of ``size`` rows of a user in the order of (ts, event_id),
    whatever the order of arrival within the watermark.  The last arrival must move the watermark
    past all rows that are to be counted."""
    ensure_input(spark, events_path, schema)
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    try:
        src = (spark.readStream.schema(schema).parquet(events_path).withColumn("ets", event_time("ts")).withWatermark("ets", watermark)
               .select("user_id", "event_id", "value", "ets", F.unix_millis("ets").alias("ms")))
        windows = src.groupBy("user_id").transformWithStateInPandas(CountWindows(size), COUNT_WINDOW_OUT, "Append", "EventTime")

        def per_batch(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

        run_available_now(windows, per_batch, "count-timers", arrivals=arrivals)
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)
    return spark.read.schema(COUNT_WINDOW_OUT).parquet(out_path).select(
        *[F.round(c, 6).alias(c) if c == "value_avg" else c for c in COUNT_WINDOW_OUT.fieldNames()])
