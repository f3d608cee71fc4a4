"""Late rows: the side output holds exactly the rows that the watermarked windows drop."""

from collections import Counter
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from parallax.session import scratch_path
from parallax.sources.commits import Commits
from parallax.streaming import jobs as ST

START = datetime(2024, 1, 1)


def test_late_rows_are_those_that_windows_drop(spark):
    rows = [(i, START + timedelta(hours=i), float(i)) for i in range(24 * 12)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, value double")
    staged = scratch_path(spark, "late-staged")
    _, ranges = ST.with_late_rows(df, staged, F.unix_micros(ST.event_time("ts")), F.col("event_id") % 5 == 2, by=2, min_parts=4)
    schema = ST.staged_schema(spark, staged)
    arrived = {r.event_id: r["_range"] for r in spark.read.parquet(staged).collect()}

    top, want = None, set()
    for b in ranges:
        own = [i for i, r in arrived.items() if r == b]
        if top is not None:
            want |= {i for i in own if (i // 24 + 1) * 24 <= top - 1}
        top = max([*own, -1 if top is None else top])
    assert want

    side, marks = scratch_path(spark, "side"), Commits(spark, scratch_path(spark, "marks"))
    late = ST.stream_late_rows(spark, side, schema, scratch_path(spark, "late"), marks, arrivals=ST.range_arrivals(spark, staged, ranges, side))
    got = [r.event_id for r in late.collect()]
    assert sorted(got) == sorted(want)

    # Spark's own count: each batch is one file, so a window's late rows reach the state as one row
    inp, out, progress = scratch_path(spark, "in"), scratch_path(spark, "out"), []
    arrivals = [lambda r=r: spark.read.parquet(staged).filter(F.col("_range") == r).drop("_range").coalesce(1).write.mode("append").parquet(inp)
                for r in ranges]
    seen = ST.run_available_now

    def run(stream, batch_fn, name, mode="append", arrivals=None):
        ckpt = scratch_path(spark, "ckpt")
        for arrive in arrivals:
            arrive()
            q = (stream.writeStream.outputMode(mode).foreachBatch(batch_fn).option("checkpointLocation", ckpt)
                 .trigger(availableNow=True).start())
            q.awaitTermination()
            progress.extend(q.recentProgress)

    ST.run_available_now = run
    try:
        windows = ST.stream_window_metrics(spark, inp, schema, out, arrivals=arrivals)
    finally:
        ST.run_available_now = seen
    kept = Counter(i // 24 for i in arrived if i not in want)
    assert {r.window_start: r.n for r in windows.collect()} == {int((START - datetime(1970, 1, 1)).total_seconds()) + d * 86400: n for d, n in kept.items()}
    dropped = sum(op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"])
    assert dropped == len({(arrived[i], i // 24) for i in want})


def test_replayed_batch_keeps_its_watermark(spark, monkeypatch):
    rows = [(i, START + timedelta(hours=12 * i), 1.0) for i in range(40)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, value double")
    staged, inp = scratch_path(spark, "staged"), scratch_path(spark, "in")
    _, ranges = ST.with_late_rows(df, staged, "event_id", F.col("event_id") < 4, by=2, min_parts=3)
    calls, run = [], ST.run_available_now

    def twice(stream, batch_fn, name, mode="append", arrivals=None):
        def per_batch(batch, batch_id):
            batch_fn(batch, batch_id)
            batch_fn(batch, batch_id)
            calls.append(batch_id)
        run(stream, per_batch, name, mode, arrivals)

    monkeypatch.setattr(ST, "run_available_now", twice)
    marks = Commits(spark, scratch_path(spark, "marks"))
    late = ST.stream_late_rows(spark, inp, ST.staged_schema(spark, staged), scratch_path(spark, "late"), marks,
                               arrivals=ST.range_arrivals(spark, staged, ranges, inp))
    assert sorted(r.event_id for r in late.collect()) == [0, 1, 2, 3] and len(calls) == len(ranges) == marks.entries().count()
