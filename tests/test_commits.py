"""Committed folders, the progress log, and training that goes on from a saved epoch."""

import math
import random

import pytest
from pyspark.sql import functions as F

from parallax.plans import lexical as L
from parallax.session import scratch_path
from parallax.sources import commits as CM
from parallax.streaming import jobs as ST


def test_a_replayed_step_is_logged_once(spark):
    log = CM.ProgressLog(spark, scratch_path(spark, "log"))
    assert log.read().collect() == []
    assert log.append("a", 1, 10, 0.5, 1.0) and log.append("a", 2, 11, None)
    assert not log.append("a", 1, 99, 9.9, 9.9)
    assert log.append("b", 1, 12, 0.25)
    assert sorted(map(tuple, log.read().drop("secs").collect()), key=str) == [("a", 1, 10, 0.5), ("a", 2, 11, None), ("b", 1, 12, 0.25)]


def test_two_writers_of_one_entry(spark):
    """Both write their data before either commits: the first commit counts."""
    commits = CM.Commits(spark, scratch_path(spark, "commits"))
    folders = [commits.begin("x") for _ in range(2)]
    for i, f in enumerate(folders):
        spark.range(i, i + 1).write.parquet(f)
    assert commits.commit("x", folders[1]) and not commits.commit("x", folders[0])
    assert [r.id for r in spark.read.parquet(commits.folder("x")).collect()] == [1]
    with pytest.raises(ValueError):
        commits.begin("../x")


def test_interrupted_save_leaves_the_old_version(spark, monkeypatch):
    path = scratch_path(spark, "epochs")
    with pytest.raises(FileNotFoundError):
        CM.load_version(spark, path, ["t"])
    CM.save_version({"t": spark.range(3), "u": spark.range(4)}, spark, path, 1)

    def fails(*_):
        raise OSError("lost")
    with monkeypatch.context() as m:
        m.setattr(CM.Commits, "commit", fails)
        with pytest.raises(OSError):
            CM.save_version({"t": spark.range(5)}, spark, path, 2)
    epoch, tables = CM.load_version(spark, path, ["t", "u"])
    assert epoch == 1 and tables["t"].count() == 3 and CM.epochs(spark, path) == [1]
    CM.save_version({"t": spark.range(5)}, spark, path, 2)
    assert CM.load_version(spark, path, ["t"])[1]["t"].count() == 5
    assert CM.load_version(spark, path, ["t"], epoch=1)[1]["t"].count() == 3
    with pytest.raises(FileExistsError):
        CM.save_version({"t": spark.range(5)}, spark, path, 2)


def brute_em(pairs, rounds):
    cells = [{(f, e): (s.count(f), t.count(e)) for f in set(s) for e in set(t)} for s, t in pairs]
    table, losses = {k: 1.0 for c in cells for k in c}, []
    for _ in range(rounds):
        count, lost = {}, 0.0
        for c in cells:
            z = {}
            for (f, e), (nf, _) in c.items():
                z[e] = z.get(e, 0) + nf * table[f, e]
            for (f, e), (nf, ne) in c.items():
                share = ne * nf * table[f, e] / z[e]
                count[f, e] = count.get((f, e), 0) + share
                lost -= share * math.log(z[e])
        total = {}
        for (f, _), c in count.items():
            total[f] = total.get(f, 0) + c
        losses.append(lost / sum(count.values()) if count else None)
        table = {(f, e): c / total[f] for (f, e), c in count.items()}
    return table, losses


def test_em_and_resume_match_brute_force(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(12)]
    rows = [(rng.choices(words, k=rng.randrange(0, 9)), rng.choices(words, k=rng.randrange(0, 9))) for _ in range(40)]
    df = spark.createDataFrame([(str(i), " ".join(s), " ".join(t)) for i, (s, t) in enumerate(rows)] + [("n", None, "a"), ("m", "a", None)],
                               "pair_id string, src string, tgt string")
    log = CM.ProgressLog(spark, scratch_path(spark, "log"))
    want, losses = brute_em(rows, 3)
    got = {(r.f, r.e): r.t for r in L.train_lexical(df, 3, log=log).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    logged = log.read().orderBy("step").collect()
    assert [(r.job, r.step, r.n) for r in logged] == [("lexical", i, len(want)) for i in (1, 2, 3)]
    assert all(abs(r.loss - x) < 1e-9 for r, x in zip(logged, losses))

    path = scratch_path(spark, "epochs")
    CM.save_version({"lexical": L.train_lexical(df, 2)}, spark, path, 2)
    done, tables = CM.load_version(spark, path, ["lexical"])
    again = {(r.f, r.e): r.t for r in L.train_lexical(df, 1, start=tables["lexical"], done=done, log=log).collect()}
    assert again.keys() == want.keys() and all(abs(again[k] - want[k]) < 1e-12 for k in want)
    assert log.read().count() == 3  # round 3 was logged before
    assert sorted(L.top1(L.train_lexical(df, 3)).collect()) == sorted(L.train_top1(df, 3).collect())
    assert L.train_lexical(df.limit(0), 2).collect() == []


def test_stream_progress(spark):
    df = spark.range(100).select(F.col("id").alias("event_id"), F.col("id").cast("double").alias("value"))
    staged, inp = scratch_path(spark, "staged"), scratch_path(spark, "steps")
    ranges = ST.stage_ranges(df, staged, "event_id", min_parts=3)
    log = CM.ProgressLog(spark, scratch_path(spark, "log"))
    ST.stream_progress(spark, inp, ST.staged_schema(spark, staged), log, "steps",
                       arrivals=ST.range_arrivals(spark, staged, ranges, inp), replay_last=True)
    rows = log.read().orderBy("step").collect()
    assert [r.step for r in rows] == [0, 1, 2] and sum(r.n for r in rows) == 100
    assert sum(r.n * r.loss for r in rows) == sum(range(100))
