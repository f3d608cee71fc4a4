"""BLEU against a brute-force reference on literals; stream replay staging; keyed count
windows in a stream against the batch definition, with one key holding most rows."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from parallax.plans import evaluation as EV
from parallax.session import scratch_path
from parallax.streaming import jobs as ST


def _grams(toks, n):
    return Counter(tuple(toks[i:i + n]) for i in range(len(toks) - n + 1))


def _parts(hyp, ref):
    m = [sum((_grams(hyp, n) & _grams(ref, n)).values()) for n in range(1, 5)]
    t = [max(len(hyp) - n + 1, 0) for n in range(1, 5)]
    return m, t, len(hyp), len(ref)


def _score(m, t, c, r):
    if c == 0 or min(m) == 0:
        return 0.0
    bp = 1.0 if c > r else math.exp(1 - r / c)
    return bp * math.exp(sum(math.log(a / b) for a, b in zip(m, t)) / 4)


CASES = [
    ("same", "the cat sat on the mat".split(), "the cat sat on the mat".split()),
    ("short", "the cat sat on".split(), "the cat sat on the mat".split()),
    ("clip", "the the the the the".split(), "the cat the".split()),
    ("none", "a b c d".split(), "w x y z".split()),
    ("empty", [], "a b".split()),
    ("long", "a b c d e f a b c d".split(), "a b c d e".split()),
]


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame(CASES, "pair_id string, hyp array<string>, ref array<string>")


def test_bleu_sentence_brute_force(pairs):
    got = {r.pair_id: r.bleu for r in EV.bleu_sentence(pairs).collect()}
    want = {pid: round(_score(*_parts(h, r)), 6) for pid, h, r in CASES}
    assert got == want
    assert got["same"] == 1.0 and got["none"] == 0.0 and got["empty"] == 0.0


def test_bleu_corpus_brute_force(pairs):
    row = EV.bleu_corpus(pairs).first()
    tot = [0] * 10
    for _, h, r in CASES:
        m, t, c, rr = _parts(h, r)
        for i, v in enumerate(m + t + [c, rr]):
            tot[i] += v
    m, t, c, r = tot[:4], tot[4:8], tot[8], tot[9]
    assert (row.hyp_len, row.ref_len) == (c, r)
    assert row.bleu == round(_score(m, t, c, r), 6)
    assert row.p1 == round(m[0] / t[0], 6)


def test_stage_ranges_contiguous(spark):
    random.seed(3)
    rows = [(i, random.random()) for i in random.sample(range(10_000), 2_000)]
    df = spark.createDataFrame(rows, "event_id long, value double")
    path = scratch_path(spark, "test-ranges")
    ranges = ST.stage_ranges(df, path, "event_id", min_parts=3, rows_per_range=500)
    assert ranges == list(range(4))          # 2,000 rows / 500 per range
    back = spark.read.parquet(path)
    assert back.count() == 2_000
    spans = sorted(tuple(r) for r in back.groupBy("_range").agg(F.min("event_id"), F.max("event_id")).collect())
    for (_, _, hi), (_, lo, _) in zip(spans, spans[1:]):
        assert hi < lo                        # ranges cover disjoint, increasing ids


def test_stream_count_windows_hot_key(spark):
    random.seed(5)
    ids = random.sample(range(100_000), 3_000)
    # user 1 holds about 60% of all rows
    rows = [(i, 1 if random.random() < 0.6 else random.randint(2, 9), float(i % 97)) for i in ids]
    df = spark.createDataFrame(rows, "event_id long, user_id long, value double")
    staged, inp, out = scratch_path(spark, "t-staged"), scratch_path(spark, "t-in"), scratch_path(spark, "t-out")
    ranges = ST.stage_ranges(df, staged, "event_id", min_parts=5)
    got = ST.stream_count_windows(spark, inp, ST.staged_schema(spark, staged), out,
                                  arrivals=ST.range_arrivals(spark, staged, ranges, inp))
    got = sorted((r.user_id, r.window_id, r.n, r.first_event_id, r.last_event_id, r.value_avg)
                 for r in got.collect())
    want = []
    by_user = {}
    for e, u, v in sorted(rows):
        by_user.setdefault(u, []).append((e, v))
    for u, evs in by_user.items():
        for w in range(len(evs) // 50):
            chunk = evs[w * 50:(w + 1) * 50]
            want.append((u, w, 50, chunk[0][0], chunk[-1][0], round(sum(v for _, v in chunk) / 50, 6)))
    assert got == sorted(want)
