"""Literal fixtures: bad-line CSV, NA tokens, script tokenizer, split sizes, budget
batching, decode, vocabulary ids."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from parallax.functions.text import NA_TOKENS, na_normalize, tokenize, tokenize_script
from parallax.operators import batching as B
from parallax.operators import corpus as C
from parallax.operators import vocab as V
from parallax.session import scratch_path
from parallax.sources import files as FS


def test_badline_csv(spark):
    path = scratch_path(spark, "badlines-unit")
    lines = ["日本語,英語", "あ,a", "い", "う,u,extra", "お,o,", ",,", "NA,na", ",empty", '"え,x","q ""z"""', '"多\n行",multi']
    spark.sparkContext.parallelize(["\n".join(lines)], 1).saveAsTextFile(path)
    kept, quarantined = FS.read_csv_badlines(spark, path, ["日本語", "英語"])
    kept_rows = [(r[0], r[1]) for r in kept.collect()]
    assert ("い", None) in kept_rows and ("あ", "a") in kept_rows
    assert ("え,x", 'q "z"') in kept_rows and ("多\n行", "multi") in kept_rows
    assert [r.raw for r in quarantined.collect()] == ["う,u,extra", "お,o,", ",,"]
    clean = C.clean_pairs(kept, ["日本語", "英語"], id_col=None)
    got = sorted((r.src, r.tgt) for r in clean.collect())
    assert got == sorted([("あ", "a"), ("え,x", 'q "z"'), ("多\n行", "multi")])


def test_na_tokens(spark):
    df = spark.createDataFrame([(t,) for t in NA_TOKENS + ["ok", " NA", "na"]], "x string")
    out = [r.y for r in df.select(na_normalize("x").alias("y")).collect()]
    assert out[:len(NA_TOKENS)] == [None] * len(NA_TOKENS)
    assert out[len(NA_TOKENS):] == ["ok", " NA", "na"]


def test_tokenizers(spark):
    df = spark.createDataFrame([("日本語は難しいと思います。カタカナーabc 12!",), ("Hello, world! It's 3.5",)], "t string")
    rows = df.select(tokenize_script("t").alias("a"), tokenize("t").alias("b")).collect()
    assert rows[0].a == ["日本語", "は", "難", "しいと", "思", "います", "。", "カタカナー", "abc", "12", "!"]
    assert rows[1].b == ["Hello", ",", "world", "!", "It", "'", "s", "3", ".", "5"]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 9, 10])
def test_split_sizes(spark, n):
    df = spark.createDataFrame([(f"p{i}", "s", "t") for i in range(n)], "pair_id string, src string, tgt string")
    got = {r.split: r.n for r in C.split_counts(C.exact_split(df)).collect()}
    want = {"train": int(.6 * n), "val": int(.8 * n) - int(.6 * n), "test": n - int(.8 * n)}
    assert {k: got.get(k, 0) for k in want} == want
    ranked = {r.pair_id: r.split for r in C.exact_split(df).collect()}
    assert {r.pair_id: r.split for r in C.split_by_cuts(df).collect()} == ranked
    rns = sorted(r.rn for r in C.exact_split(df).collect())
    assert rns == list(range(1, n + 1))


@pytest.mark.parametrize("rows,sizes", [
    ([(3, 3)] * 4, [4]),
    ([(3, 3)] * 5, [4, 1]),
    ([(1, 1), (30, 2), (1, 1)], [1, 1, 1]),
    ([(30, 2), (1, 1)], [1, 1]),
    ([], []),
])
def test_budget_fold(rows, sizes):
    s = np.array([r[0] for r in rows], dtype=np.int64)
    t = np.array([r[1] for r in rows], dtype=np.int64)
    b = B.fold_batches(s, t, 20)
    assert [int((b == i).sum()) for i in range(len(set(b.tolist())))] == sizes


def test_budget_batches_spark(spark):
    rows = [(f"p{i}", i + 1, 3, 3) for i in range(9)]
    df = spark.createDataFrame(rows, "pair_id string, rn long, src_len long, tgt_len long")
    out = B.budget_batches(df, budget=20, pool_rows=100).collect()
    sizes = sorted([sum(1 for r in out if r.batch_id == b) for b in {r.batch_id for r in out}], reverse=True)
    assert sizes == [4, 4, 1]
    assert sorted(r.row_in_batch for r in out if r.batch_id == 0) == [0, 1, 2, 3]


def test_decode(spark):
    vocab = spark.createDataFrame([(0, "<unk>", 0), (1, "<pad>", 0), (2, "<sos>", 0), (3, "<eos>", 0),
                                   (4, "a", 1), (5, "b", 1), (6, "c", 1)], V.VOCAB_SCHEMA)
    df = spark.createDataFrame([("x", [2, 4, 5, 3, 6]), ("y", [2, 4, 6]), ("z", [])], "pair_id string, ids array<bigint>")
    got = {r.pair_id: r.text for r in V.decode_ids(df, "ids", vocab).collect()}
    assert got == {"x": "a b", "y": "a c", "z": ""}


def test_vocabulary_ids(spark):
    df = spark.createDataFrame([("1", "b b a", "b b a", "train"), ("2", "a c", "a c", "val"), ("3", "z", "z", "test")],
                               "pair_id string, src string, tgt string, split string")
    vs, vt = V.build_pair_vocabs(df)
    assert [(r.id, r.token) for r in vs.orderBy("id").collect()] == [(0, "<unk>"), (1, "<pad>"), (2, "a"), (3, "b"), (4, "c")]
    assert [r.token for r in vt.orderBy("id").collect()][:4] == ["<unk>", "<pad>", "<sos>", "<eos>"]
    enc = {r.pair_id: (r.src_ids, r.tgt_ids) for r in V.encode_pairs(df, vs, vt).collect()}
    assert enc["3"][0] == [0]
    assert enc["1"] == ([3, 3, 2], [2, 5, 5, 4, 3])


def test_apply_model_hook(spark):
    from parallax.functions.udf import apply_model
    df = spark.createDataFrame([("a", "hello world"), ("b", None)], "pair_id string, src string")
    out = apply_model(df, "src", lambda: (lambda s: s.str.upper()), "up")
    assert {r.pair_id: r.up for r in out.collect()} == {"a": "HELLO WORLD", "b": None}
