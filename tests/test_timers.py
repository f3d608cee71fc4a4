"""Count windows by event-time timers, with rows that arrive out of order and one hot key."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from parallax.session import scratch_path
from parallax.streaming import jobs as ST
from parallax.streaming import timers as TM


def test_windows_of_rows_out_of_order(spark):
    rng = random.Random(5)
    start = datetime(2024, 3, 1)
    rows = [(rng.choice([1, 1, 1, 1, 2, 3]), i, start + timedelta(minutes=rng.randrange(0, 3000)), rng.choice([None, float(i % 17)])) for i in range(400)]
    arrivals_of = sorted(rows, key=lambda r: r[2] + timedelta(minutes=rng.randrange(0, 600)))  # at most ten hours late
    schema = "user_id long, event_id long, ts timestamp_ntz, value double"
    inp, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    parts = [arrivals_of[i:i + 90] for i in range(0, 400, 90)]
    parts += [[(None, -1, start + timedelta(days=30), 0.0)], [(None, -2, start + timedelta(days=40), 0.0)]]
    arrivals = [lambda p=p: spark.createDataFrame(p, schema).write.mode("append").parquet(inp) for p in parts]
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    got = TM.stream_count_timers(spark, inp, spark.createDataFrame([], schema).schema, out, "11 hours", size=10, arrivals=arrivals)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == old
    want = []
    for user in (1, 2, 3):
        own = sorted((r for r in rows if r[0] == user), key=lambda r: (r[2], r[1]))
        for w in range(len(own) // 10):
            part = own[10 * w:10 * w + 10]
            values = [r[3] for r in part if r[3] is not None]
            want.append((user, w, 10, round(sum(values) / len(values), 6) if values else None, min(r[1] for r in part), max(r[1] for r in part)))
    assert sorted(tuple(r) for r in got.filter("user_id is not null").collect()) == want
