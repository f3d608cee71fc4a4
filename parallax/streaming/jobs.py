"""Structured Streaming jobs.

K1 ``stream_translate``: file-source stream of sentences, translated in each micro-batch
   with the static top-1 table (stream-static join), Parquet sink per batch id
   (a replayed batch overwrites its own folder: idempotent).
K2 ``stream_window_metrics``: watermark + tumbling event-time windows, update mode,
   latest value per window kept.
K3 ``stream_count_windows``: keyed count windows of N rows per key with
   ``applyInPandasWithState``; state holds at most N-1 pending rows per key.

Rule for K3: rows of one key are emitted in ``event_id`` order inside each micro-batch;
the result equals the batch definition when no key receives an id smaller than one
already emitted.  The registered queries replay a table as arrivals of ``event_id``
ranges (``stage_ranges`` + ``range_arrivals``), one ``availableNow`` run per arrival, so
each micro-batch is one whole range and ranges arrive in order.
"""

from __future__ import annotations

import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from parallax.session import scratch_path
from parallax.sources.commits import Commits, ProgressLog, observed


ROWS_PER_RANGE = 20_000_000   # rows per replayed arrival (bounds one micro-batch)


def stage_ranges(df: DataFrame, path: str, order, min_parts: int = 4,
                 rows_per_range: int = ROWS_PER_RANGE) -> list[int]:
    """Label every row with an equal-width range of the numeric ``order`` column or
    expression and write the table once, partitioned by range.  The number of ranges
    grows with the table (at least ``min_parts``, about ``rows_per_range`` rows each),
    so one replayed micro-batch, and any one key's share of it, stays bounded however
    large the table is.  One aggregate job (min, max, count) sizes the ranges; the
    range id is O(1) per row.  Returns the range ids in order."""
    keyed = df.withColumn("_o", (F.col(order) if isinstance(order, str) else order).cast("double"))
    lo, hi, n = keyed.agg(F.min("_o"), F.max("_o"), F.count(F.lit(1))).first()
    parts = max(min_parts, -(-int(n or 0) // rows_per_range))
    if lo is None or hi is None or hi <= lo:
        rid = F.lit(0)
    else:
        width = (hi - lo) / parts
        rid = F.least(F.floor((F.col("_o") - F.lit(lo)) / F.lit(width)), F.lit(parts - 1))
    rid = F.coalesce(rid.cast("int"), F.lit(parts - 1))  # null order values arrive last
    keyed.withColumn("_range", rid).drop("_o").write.mode("overwrite").partitionBy("_range").parquet(path)
    return list(range(parts))


def range_arrivals(spark: SparkSession, staged: str, ranges: list[int], inp: str) -> list[Callable[[], None]]:
    """One callable per range: append that range (read by partition pruning, written in
    parallel) to the stream's input folder, so files arrive in ``order``."""
    def arrive(r: int) -> Callable[[], None]:
        def go() -> None:
            (spark.read.parquet(staged).filter(F.col("_range") == r).drop("_range")
             .write.mode("append").parquet(inp))
        return go
    return [arrive(r) for r in ranges]


def ensure_input(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Create the (empty) stream input folder: a file source checks that its path exists
    when the stream is defined, before the first arrival."""
    spark.createDataFrame([], schema).write.mode("append").parquet(path)


def staged_schema(spark: SparkSession, staged: str) -> T.StructType:
    return T.StructType([f for f in spark.read.parquet(staged).schema.fields if f.name != "_range"])


def run_available_now(stream_df: DataFrame, batch_fn: Callable[[DataFrame, int], None], name: str,
                      mode: str = "append", arrivals: list[Callable[[], None]] | None = None) -> None:
    """Run the query with ``trigger(availableNow=True)`` once per arrival (or once), all
    runs sharing one checkpoint in the shared folder: each run takes every file that has
    arrived since the last one as one micro-batch, so a micro-batch is one whole range
    and its size is bounded by the range, not by the table."""
    spark = stream_df.sparkSession
    ckpt = scratch_path(spark, f"{name}-ckpt")
    for arrive in arrivals or [lambda: None]:
        arrive()
        q = (stream_df.writeStream.outputMode(mode).foreachBatch(batch_fn)
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination()


def stream_translate(spark: SparkSession, requests_path: str, schema: T.StructType, table: DataFrame,
                     translate_fn, out_path: str, arrivals: list[Callable[[], None]] | None = None) -> DataFrame:
    """K1: translate every arriving row; returns the sink read back."""
    ensure_input(spark, requests_path, schema)
    src = spark.readStream.schema(schema).parquet(requests_path)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        out = translate_fn(batch, table).withColumn("batch_id", F.lit(batch_id).cast("long"))
        out.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    run_available_now(src, per_batch, "translate", arrivals=arrivals)
    return spark.read.parquet(out_path)


def stream_progress(spark: SparkSession, steps_path: str, schema: T.StructType, log: ProgressLog, job: str,
                    value_col: str = "value", arrivals: list[Callable[[], None]] | None = None,
                    replay_last: bool = False) -> None:
    """One row of ``log`` for each micro-batch of a step stream: its rows and the mean of
    their values, observed while the batch is processed (here it goes to no sink).  A batch that
    is handed in again, as after a failure between the log and the checkpoint, is not logged
    again; ``replay_last`` does that on purpose."""
    ensure_input(spark, steps_path, schema)
    last: list[tuple[DataFrame, int]] = []

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        began = time.monotonic()
        rows, seen = observed(batch, n=F.count("*"), loss=F.avg(value_col))
        rows.write.format("noop").mode("overwrite").save()
        m = seen.get
        if m["n"]:
            log.append(job, batch_id - empty[0], m["n"], m["loss"], time.monotonic() - began)
        else:
            empty[0] += 1
        last[:] = [(batch, batch_id)]

    empty = [0]
    run_available_now(spark.readStream.schema(schema).parquet(steps_path), per_batch, job, arrivals=arrivals)
    if replay_last and last:
        per_batch(*last[0])


def event_time(ts_col: str) -> F.Column:
    """TIMESTAMP_NTZ wall clock read as UTC, independent of the session time zone
    (the watermark needs a TIMESTAMP column)."""
    c = F.col(ts_col)
    micros = (F.unix_date(F.to_date(c)).cast("long") * 86_400_000_000
              + (F.hour(c) * 3600 + F.minute(c) * 60).cast("long") * 1_000_000
              + (F.second(c).cast("long") * 1_000_000)
              + (F.date_format(c, "SSSSSS").cast("long")))
    return F.timestamp_micros(micros)


def stream_window_metrics(spark: SparkSession, events_path: str, schema: T.StructType, out_path: str,
                          window: str = "1 day", watermark: str = "1 hour",
                          arrivals: list[Callable[[], None]] | None = None) -> DataFrame:
    """K2: tumbling event-time windows with a watermark; rows later than the watermark
    are dropped.  Update mode; the sink keeps every batch's updates and the read-back
    takes the latest per window."""
    ensure_input(spark, events_path, schema)
    src = spark.readStream.schema(schema).parquet(events_path).withColumn("ets", event_time("ts"))
    agg = (src.withWatermark("ets", watermark).groupBy(F.window("ets", window).alias("w"))
           .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("vsum"), F.count("value").alias("vn")))

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        (batch.select(F.unix_seconds(F.col("w.start")).alias("window_start"), "n", "vsum", "vn",
                      F.lit(batch_id).cast("long").alias("batch_id"))
         .write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}"))

    run_available_now(agg, per_batch, "metrics", mode="update", arrivals=arrivals)
    res = spark.read.parquet(out_path)
    latest = res.groupBy("window_start").agg(F.max_by(F.struct("n", "vsum", "vn"), "batch_id").alias("r"))
    return latest.select("window_start", F.col("r.n").alias("n"),
                         F.round(F.col("r.vsum") / F.col("r.vn"), 6).alias("value_avg"))


def stream_late_rows(spark: SparkSession, events_path: str, schema: T.StructType, out_path: str, commits: Commits,
                     window: str = "1 day", watermark_ms: int = 3_600_000,
                     arrivals: list[Callable[[], None]] | None = None) -> DataFrame:
    """K2's late rows as a side output: (*row, window_start, batch_id) of every row whose window had
    closed, by the watermark of its micro-batch, before it arrived; K2 drops exactly these.

    The watermark of a batch is the largest event time of the batches before it (in whole
    milliseconds, as Spark keeps it) less the delay.  Each batch's largest time is committed
    under its id, so a replayed batch finds the same watermark and writes the same rows."""
    ensure_input(spark, events_path, schema)
    src = spark.readStream.schema(schema).parquet(events_path).withColumn("ets", event_time("ts"))

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        before = commits.entries().filter(F.col("entry") < f"batch-{batch_id:012d}").agg(F.max("of").alias("of")).first().of
        latest = None if before is None else int(before.rpartition("_")[2].partition("-")[0])
        rows = batch.withColumn("_w", F.window("ets", window))
        closed = F.lit(False) if latest is None else F.unix_millis(F.col("_w.end")) <= latest - watermark_ms
        own = batch.agg(F.max(F.unix_millis("ets"))).first()[0]
        late = rows.filter(closed).select(*schema.fieldNames(), F.unix_seconds(F.col("_w.start")).alias("window_start"))
        late.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
        top = max(x for x in (own, latest, 0) if x is not None)
        entry = f"batch-{batch_id:012d}"
        if not commits.has(entry):
            # the time is in the name of the entry's folder, which has no data
            commits.commit(entry, commits.begin(entry, note=f"{top:020d}"))

    run_available_now(src, per_batch, "late-rows", arrivals=arrivals)
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("window_start", T.LongType()), T.StructField("batch_id", T.LongType())])).parquet(out_path)


def with_late_rows(df: DataFrame, path: str, order, late, by: int = 2, min_parts: int = 4) -> tuple[str, list[int]]:
    """Stages ``df`` for a replay in ranges of ``order`` (see ``stage_ranges``), but rows for which
    ``late`` holds arrive ``by`` ranges after their own, or with the last."""
    ranges = stage_ranges(df, f"{path}-in-order", order, min_parts=min_parts)
    staged = df.sparkSession.read.parquet(f"{path}-in-order")
    moved = F.when(late, F.least(F.col("_range") + by, F.lit(ranges[-1]))).otherwise(F.col("_range"))
    staged.withColumn("_range", moved).write.mode("overwrite").partitionBy("_range").parquet(path)
    return path, ranges


COUNT_WINDOW_OUT = T.StructType([
    T.StructField("user_id", T.LongType()), T.StructField("window_id", T.LongType()),
    T.StructField("n", T.LongType()), T.StructField("value_avg", T.DoubleType()),
    T.StructField("first_event_id", T.LongType()), T.StructField("last_event_id", T.LongType())])
COUNT_WINDOW_STATE = T.StructType([
    T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("vals", T.ArrayType(T.DoubleType())),
    T.StructField("next_window", T.LongType())])


def _count_window_fn(size: int):
    def fn(key, pdfs, state):
        if state.exists:
            ids, vals, nxt = state.get
            pending = pd.DataFrame({"event_id": list(ids), "value": list(vals)})
        else:
            nxt = 0
            pending = pd.DataFrame({"event_id": pd.Series([], dtype="int64"),
                                    "value": pd.Series([], dtype="float64")})
        frames = ([pending] if len(pending) else []) + [p[["event_id", "value"]] for p in pdfs if len(p)]
        if not frames:
            return
        allrows = pd.concat(frames, ignore_index=True).sort_values("event_id", kind="mergesort")
        full = (len(allrows) // size) * size
        out = []
        if full:
            done = allrows.iloc[:full].reset_index(drop=True)
            done["w"] = done.index // size
            g = done.groupby("w")
            res = pd.DataFrame({
                "user_id": key[0], "window_id": g.size().index.to_numpy() + nxt, "n": g.size().to_numpy(),
                "value_avg": g["value"].mean().to_numpy(),
                "first_event_id": g["event_id"].min().to_numpy(), "last_event_id": g["event_id"].max().to_numpy()})
            out.append(res.astype({"user_id": "int64", "window_id": "int64", "n": "int64"}))
            nxt += full // size
        rest = allrows.iloc[full:]
        state.update((rest["event_id"].astype("int64").tolist(), rest["value"].astype("float64").tolist(), int(nxt)))
        yield from out
    return fn


def stream_count_windows(spark: SparkSession, events_path: str, schema: T.StructType, out_path: str,
                         key: str = "user_id", size: int = 50,
                         arrivals: list[Callable[[], None]] | None = None) -> DataFrame:
    """K3: emit one row per completed window of ``size`` rows of a key (by event_id)."""
    ensure_input(spark, events_path, schema)
    src = (spark.readStream.schema(schema).parquet(events_path)
           .select(F.col(key).alias("user_id"), "event_id", "value"))
    windows = src.groupBy("user_id").applyInPandasWithState(
        _count_window_fn(size), COUNT_WINDOW_OUT, COUNT_WINDOW_STATE, "append", GroupStateTimeout.NoTimeout)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    run_available_now(windows, per_batch, "count-windows", arrivals=arrivals)
    res = spark.read.parquet(out_path).drop("batch_id")
    return res.withColumn("value_avg", F.round("value_avg", 6))
