"""Lattice segmentation against all segmentations of short strings, and its training."""

import itertools
import math
import random

import pytest

from parallax.functions.text import get_tokenizer
from parallax.plans import segmentation as S


def segmentations(run):
    for cuts in itertools.product([False, True], repeat=max(len(run) - 1, 0)):
        at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(run)]
        yield [run[a:b] for a, b in zip(at[:-1], at[1:])]


def log_p(pieces, parts):
    ps = [pieces.get(p, S.FLOOR if len(p) == 1 else -math.inf) for p in parts]
    return sum(ps)


@pytest.mark.parametrize("seed", range(6))
def test_best_and_expected_over_all_segmentations(seed):
    rng = random.Random(seed)
    alphabet = "漢字かなカ"
    pieces = {"".join(rng.choices(alphabet, k=rng.randrange(1, 4))): -rng.random() * 8 for _ in range(25)}
    lattice = S.Lattice(pieces)
    for _ in range(20):
        run = "".join(rng.choices(alphabet, k=rng.randrange(1, 9)))
        every = [(log_p(pieces, s), s) for s in segmentations(run)]
        best = lattice.best(run)
        assert "".join(best) == run and log_p(pieces, best) == pytest.approx(max(p for p, _ in every), abs=1e-9)
        total = sum(math.exp(p) for p, _ in every)
        want = {}
        for p, s in every:
            for x in s:
                want[x] = want.get(x, 0.0) + 3 * math.exp(p) / total
        got = {}
        assert lattice.expected(run, 3, got) == pytest.approx(math.log(total), abs=1e-9)
        assert all(got.get(k, 0.0) == pytest.approx(v, abs=1e-9) for k, v in want.items() if v > 0)


def test_training_finds_words(spark):
    rng = random.Random(4)
    words = ["日本", "東京都", "です", "から", "食べる", "カタカナ", "山", "見る", "大学", "行きます"]
    texts = ["".join(rng.choices(words, k=rng.randrange(3, 9))) + "。" for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,), ("",), ("abc, 12!",)], "t string")
    pieces, likelihood = S.train_pieces(df, "t", vocab_size=60, rounds=4)
    assert len(pieces) <= 60 and sum(map(math.exp, pieces.values())) == pytest.approx(1, abs=1e-6)
    assert likelihood[1] < likelihood[2] < likelihood[3]  # after the first round all pieces have a share
    lattice = S.Lattice(pieces)
    cut = sum(lattice.best("".join(w)) == w for w in (rng.choices(words, k=5) for _ in range(100)))
    assert cut >= 80


def test_registered_tokenizer(spark):
    df = spark.createDataFrame([("東京東京大学大学、abcabc 12!",), ("東京大学",), (None,), ("",), ("x",)], "t string")
    S.register_lattice(df, "t", "lattice-test", vocab_size=50)
    tok = get_tokenizer("lattice-test")
    rows = [r.x for r in df.select(tok(df["t"]).alias("x")).collect()]
    assert rows[0][-4:] == ["、", "abcabc", "12", "!"] and "".join(rows[0][:-4]) == "東京東京大学大学"
    assert "".join(rows[1]) == "東京大学" and rows[2] is None and rows[3] == [] and rows[4] == ["x"]
    S.register_lattice(df, "t", "lattice-all", every=True, vocab_size=50)
    every = [r.x for r in df.select(get_tokenizer("lattice-all")(df["t"]).alias("x")).collect()]
    assert every[0][-3:-1] != ["abcabc", "12"] and "".join(every[0]) == "東京東京大学大学、abcabc12!"


def test_no_runs_and_long_runs(spark):
    empty = spark.createDataFrame([], "t string")
    assert S.train_pieces(empty, "t") == ({}, [])
    assert S.Lattice({}).best("山川") == ["山", "川"] and S.Lattice({}).best("") == []
    long = spark.createDataFrame([("日本語" * 20_000,)], "t string")
    pieces, _ = S.train_pieces(long, "t", vocab_size=30, rounds=2)
    assert "".join(S.Lattice(pieces).best("日本語" * 20_000)) == "日本語" * 20_000


def test_words_are_kept_across_batches(spark):
    from pyspark.util import PythonEvalType

    rows = [("abc abd, 7!",), (None,), ("abc",), ("。東京x",), ("é☃a",)] * 3
    df = spark.createDataFrame(rows, "t string").coalesce(1)
    tokenize = S.lattice_tokenizer(spark, {"ab": -1.0, "東京": -2.0}, every=True)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        out = df.select(tokenize(df.t).alias("toks"))
        got = [r.toks for r in out.collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == [["ab", "c", "ab", "d", ",", "7", "!"], None, ["ab", "c"], ["。", "東京", "x"], ["é", "☃", "a"]] * 3
    plan = out._jdf.queryExecution().executedPlan().toString()
    # one call for all batches of a task, so a word that was met is not segmented again
    assert f", {PythonEvalType.SQL_SCALAR_PANDAS_ITER_UDF}" in plan
