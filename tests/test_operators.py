"""Ordering primitives against plain windows, and operator properties."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from parallax.functions import vectors as VX
from parallax.operators import attention as AT
from parallax.operators import batching as B
from parallax.operators.ordering import hash_rank, ordered_rank, top_k_per_group
from parallax.plans import lexical as L


@pytest.fixture(scope="module")
def skewed(spark):
    random.seed(7)
    rows = [("hot" if i % 3 == 0 else f"g{i % 17}", i, random.random()) for i in range(3000)]
    return spark.createDataFrame(rows, "g string, id long, v double")


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_ordered_rank_matches_window(spark, skewed, parts):
    got = ordered_rank(skewed, order=[F.desc("v"), "id"], partition=["g"], num_partitions=parts)
    want = skewed.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(F.desc("v"), "id")))
    assert sorted(got.select("id", "rn").collect()) == sorted(want.select("id", F.col("rn").cast("long")).collect())


def test_ordered_rank_stated_groups(spark, skewed):
    two = skewed.withColumn("side", F.when(F.col("g") == "hot", "a").otherwise("b"))
    got = ordered_rank(two, order=[F.desc("v"), "id"], partition=["side"], max_groups=2, num_partitions=4)
    want = two.withColumn("rn", F.row_number().over(Window.partitionBy("side").orderBy(F.desc("v"), "id")))
    assert sorted(got.select("id", "rn").collect()) == sorted(want.select("id", F.col("rn").cast("long")).collect())


def test_ordered_rank_global(spark, skewed):
    got = ordered_rank(skewed, order=["v", "id"])
    want = skewed.withColumn("rn", F.row_number().over(Window.orderBy("v", "id")))
    assert sorted(got.select("id", "rn").collect()) == sorted(want.select("id", F.col("rn").cast("long")).collect())


def test_hash_rank(spark, skewed):
    df = skewed.withColumn("h", F.md5(F.col("id").cast("string")))
    got = hash_rank(df, "h", "id", prefix_hex=2)
    want = df.withColumn("rn", F.row_number().over(Window.orderBy("h", "id")))
    assert sorted(got.select("id", "rn").collect()) == sorted(want.select("id", F.col("rn").cast("long")).collect())


def test_top_k(spark, skewed):
    got = top_k_per_group(skewed, ["g"], [F.desc("v"), "id"], 3, salt_col="id", salts=8)
    want = (skewed.withColumn("rank", F.row_number().over(Window.partitionBy("g").orderBy(F.desc("v"), "id")))
            .filter("rank <= 3"))
    assert sorted(got.select("g", "id", "rank").collect()) == sorted(want.select("g", "id", F.col("rank").cast("long")).collect())


def test_sized_broadcast_judges_rows_and_bytes(spark):
    from parallax.operators.ordering import sized_broadcast
    from parallax.session import scratch_path
    path = scratch_path(spark, "wide")
    spark.range(2000).select("id", F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: F.rand(3)).alias("v")).write.parquet(path)
    wide, hinted = spark.read.parquet(path), lambda df: "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    assert hinted(sized_broadcast(wide)) and not hinted(sized_broadcast(wide, max_bytes=100_000)) and not hinted(sized_broadcast(wide, max_rows=10))
    assert hinted(sized_broadcast(wide.select("id"), max_bytes=100_000))


def test_changed_folder_is_prepared_again(spark):
    from parallax.plans import prep as P
    from parallax.session import scratch_path
    folder = scratch_path(spark, "tables")
    docs = lambda t: spark.createDataFrame([(1, t)], "doc_id long, text string")
    talk = spark.createDataFrame([(1, 1, "user", "a b"), (1, 2, "assistant", "c")], "conv_id long, turn long, role string, text string")
    talk.write.parquet(f"{folder}/conversations.parquet")
    docs("x y\nz").write.parquet(f"{folder}/documents.parquet")
    first = sorted(r.src for r in P.corpus(spark, folder).collect())
    assert P.corpus(spark, folder) is P.corpus(spark, folder)
    docs("new line\nz").write.mode("append").parquet(f"{folder}/documents.parquet")
    assert first == ["a b", "x y"] and sorted(r.src for r in P.corpus(spark, folder).collect()) == ["a b", "new line", "x y"]


def test_pad_unpad(spark):
    df = spark.createDataFrame([("a", 0, 0, [5, 6, 7]), ("b", 0, 0, [5]), ("c", 0, 1, [8, 9])],
                               "pair_id string, pool_id long, batch_id long, ids array<bigint>")
    p = B.pad_to_batch(df, cols=("ids",)).collect()
    assert {r.pair_id: r.ids for r in p} == {"a": [5, 6, 7], "b": [5, 1, 1], "c": [8, 9]}
    unpadded = {r.pair_id: [x for x in r.ids if x != 1] for r in p}
    assert unpadded == {"a": [5, 6, 7], "b": [5], "c": [8, 9]}


def test_lexical_probabilities_sum_to_one(spark):
    df = spark.createDataFrame([("1", "a b", "x y"), ("2", "a", "x"), ("3", "b c", "y z")],
                               "pair_id string, src string, tgt string")
    t = L.train_lexical(df, iterations=3)
    sums = t.groupBy("f").agg(F.sum("t").alias("s")).collect()
    assert all(abs(r.s - 1.0) < 1e-9 for r in sums)
    top = {r.f: r.e for r in L.top1(t).collect()}
    assert top["a"] == "x"


def test_softmax_and_attention(spark):
    rows = [(i, i // 5, [math.sin(i + k) for k in range(8)]) for i in range(15)]
    emb = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    sm = AT.grouped_softmax(emb.select("vec_id", "label", F.element_at("embedding", 1).alias("s")), "label", "s")
    assert all(abs(r.t - 1) < 1e-9 for r in sm.groupBy("label").agg(F.sum("w").alias("t")).collect())
    seq = AT.sequences(emb, "label", "vec_id", "embedding")
    out = AT.attention(seq).collect()
    assert len(out) == 15
    src = {(r.label, r.pos): r.v for r in seq.collect()}
    for r in out:
        if r.pos == 0:  # position 0 only sees itself
            assert all(abs(a - b) < 1e-12 for a, b in zip(r.v, src[(r.label, 0)]))


def _plain_attention(q, k, heads, allowed):
    """Softmax over all keys of one sequence, masked cells filled with -1e9."""
    q, k = (x.reshape(len(x), heads, -1).transpose(1, 0, 2) for x in (q, k))
    s = np.where(allowed, q @ k.transpose(0, 2, 1) / math.sqrt(q.shape[2]), -1e9)
    w = np.exp(s - s.max(axis=2, keepdims=True))
    return ((w / w.sum(axis=2, keepdims=True)) @ k).transpose(1, 0, 2).reshape(q.shape[1], -1)


@pytest.mark.parametrize("heads,causal", [(1, True), (4, True), (2, False)])
def test_attention_of_long_sequences(spark, heads, causal):
    rng = np.random.default_rng(1)
    rows = [(i, 0 if i < 200 else 1, (30 * rng.standard_normal(8)).tolist()) for i in range(230)]
    emb = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    seq = AT.sequences(emb, "label", "vec_id", "embedding")
    out = {(r.label, r.pos): r.v for r in AT.attention(seq, causal=causal, heads=heads).collect()}
    assert len(out) == 230
    for label, lo, hi in ((0, 0, 200), (1, 200, 230)):
        v = np.array([r[2] for r in rows[lo:hi]])
        n = hi - lo
        want = _plain_attention(v, v, heads, np.tril(np.ones((n, n), bool)) if causal else np.ones((n, n), bool))
        assert np.allclose([out[label, i] for i in range(n)], want, atol=1e-9)


def test_cross_attention_with_padding(spark):
    rng = np.random.default_rng(2)
    q, k = rng.standard_normal((5, 4)), rng.standard_normal((9, 4))
    real = np.array([True] * 6 + [False] * 3)
    schema = "s string, pos long, v array<double>"
    queries = spark.createDataFrame([(s, i, x.tolist()) for s in "abc" for i, x in enumerate(q)], schema)
    keys = spark.createDataFrame([(s, i, x.tolist(), bool(real[i]) and s == "a") for s in "ab" for i, x in enumerate(k)],
                                 schema + ", real boolean")
    got = AT.attention(queries, keys, keys=["s"], causal=False, mask="real", tile=4).collect()
    got = {(r.s, r.pos): r.v for r in got}
    assert len(got) == 10  # "c" has no keys
    assert np.allclose([got["a", i] for i in range(5)], _plain_attention(q, k, 1, real[None, :]))
    assert np.allclose([got["b", i] for i in range(5)], _plain_attention(q, k, 1, np.zeros((5, 9), bool)))
    empty = AT.attention(queries.limit(0), keys, keys=["s"], causal=False, mask="real")
    assert empty.collect() == []


def test_layer_norm(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0],)], "v array<double>")
    out = df.select(VX.layer_norm("v").alias("n")).first().n
    mean, sd = 2.5, math.sqrt(sum((x - 2.5) ** 2 for x in [1, 2, 3, 4]) / 3)
    assert all(abs(a - (x - mean) / (sd + 1e-6)) < 1e-12 for a, x in zip(out, [1, 2, 3, 4]))


@pytest.mark.parametrize("chunk", [2, 4096])
def test_next_in_group_matches_lead(spark, chunk):
    from parallax.operators.ordering import next_in_group
    random.seed(3)
    rows = [(k, t, f"x{k}-{t}") for k in range(4) for t in random.sample(range(50), 20 if k else 40)]
    df = spark.createDataFrame(rows, "k long, t long, x string")
    got = next_in_group(df, "k", "t", ["x"], chunk=chunk).select("k", "t", "next_t", "next_x")
    w = Window.partitionBy("k").orderBy("t")
    want = df.select("k", "t", F.lead("t").over(w).alias("next_t"), F.lead("x").over(w).alias("next_x"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_sort_key_hook_and_first_pool(spark):
    rows = [(f"p{i:02d}", i + 1, 1 + (i * 7) % 11, 1 + (i * 5) % 13) for i in range(40)]
    df = spark.createDataFrame(rows, "pair_id string, rn long, src_len long, tgt_len long")
    got = {r.pair_id: (r.batch_id, r.row_in_batch) for r in B.bucket_batches(df, 4, sort_keys=("src_len", "tgt_len")).collect()}
    order = [r[0] for r in sorted(rows, key=lambda r: (r[2], r[3], r[0]))]
    assert got == {p: (i // 4, i % 4) for i, p in enumerate(order)}
    by_target = B.budget_batches(df, budget=60, pool_rows=25, sort_keys=("tgt_len",))
    first = sorted((r for r in by_target.collect() if r.pool_id == 0), key=lambda r: (r.batch_id, r.row_in_batch))
    assert [r.pair_id for r in first] == [r[0] for r in sorted(rows[:25], key=lambda r: (r[3], r[0]))]
    whole = B.budget_batches(df, budget=60, pool_rows=25)
    served = B.batch_order(whole).filter("pool_id = 0 and batch_order = 0").first().batch_id
    want = sorted((r.pair_id, r.batch_id, r.row_in_batch) for r in whole.collect() if (r.pool_id, r.batch_id) == (0, served))
    assert sorted(B.first_batch(B.budget_batches(B.first_pool(df, 25), budget=60, pool_rows=25)).collect()) == want


def test_cross_entropy_from_outer_counts_and_known_splits(spark):
    from parallax.plans import bigram as G
    rows = [("1", "train", ["a", "b"]), ("2", "train", ["a", "a"]), ("3", "val", ["b"]), ("4", "test", ["z", "a"])]
    sp = spark.createDataFrame(rows, "pair_id string, split string, toks array<string>")
    vocab = spark.createDataFrame([(t,) for t in ("<unk>", "<pad>", "<sos>", "<eos>", "a", "b")], "token string")
    every = G.split_bigrams(sp, vocab, None, "toks")
    some = G.split_bigrams(sp, vocab, None, "toks", known_splits=("train", "val"))
    assert sorted(every.collect()) == sorted(some.collect())
    counts = every.filter("split = 'train'").select("prev", "next", "n")
    got = sorted(G.cross_entropy(sp, vocab, ev=every).collect())
    assert got == sorted(G.cross_entropy(sp, vocab, ev=every, counts=counts).collect())
    c = {(r.prev, r.next): r.n for r in counts.collect()}
    tot = {}
    for (p, _), n in c.items():
        tot[p] = tot.get(p, 0) + n
    test = [("<sos>", "<unk>"), ("<unk>", "a"), ("a", "<eos>")]
    x = sum(-math.log((c.get(b, 0) + 1) / (tot.get(b[0], 0) + 6)) for b in test) / 3
    assert [r for r in got if r.split == "test"][0].cross_entropy == round(x, 6)


def test_attention_keeps_no_row_by_tile(spark):
    """Queries of many tiles and several spans; what is written is one row by query, span and head."""
    import os

    from parallax.operators import attention as AT
    from parallax.session import checkpoint_dir
    rng = np.random.default_rng(3)
    v = rng.normal(size=(150, 4))
    seq = spark.createDataFrame([("a", i, v[i].tolist()) for i in range(150)], "s string, pos long, v array<double>")
    top = checkpoint_dir(spark).removeprefix("file:").rstrip("/") + "/scratch"
    for causal, tile in ((True, 2), (False, 2), (True, 64)):
        before = set(os.listdir(top)) if os.path.isdir(top) else set()
        got = {r.pos: r.v for r in AT.attention(seq, keys=["s"], causal=causal, heads=2, tile=tile).collect()}
        want = _plain_attention(v, v, 2, np.tril(np.ones((150, 150), bool)) if causal else np.ones((150, 150), bool))
        assert np.allclose([got[i] for i in range(150)], want)
        written = [x for x in set(os.listdir(top)) - before if x.startswith("attention-parts")]
        assert [spark.read.parquet(f"{top}/{x}").count() for x in written] == [300]


def test_attention_merges_spans(spark, monkeypatch):
    from parallax.operators import attention as AT
    for name, n in (("QUERY_TILES", 2), ("KEY_TILES", 1), ("SPAN_TILES", 4)):
        monkeypatch.setattr(AT, name, n)
    v = np.random.default_rng(4).normal(size=(60, 4))
    seq = spark.createDataFrame([("a", i, v[i].tolist()) for i in range(60)], "s string, pos long, v array<double>")
    for causal in (True, False):
        got = {r.pos: r.v for r in AT.attention(seq, keys=["s"], causal=causal, heads=2, tile=2).collect()}
        want = _plain_attention(v, v, 2, np.tril(np.ones((60, 60), bool)) if causal else np.ones((60, 60), bool))
        assert np.allclose([got[i] for i in range(60)], want)


def test_attention_of_ids_equals_attention(spark):
    """Ids without a vector, with two, masked keys, a repeated key, and vectors beyond the bound."""
    from pyspark.sql import functions as F

    from parallax.operators import attention as AT
    rng = np.random.default_rng(5)
    vectors = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in [0, 1, 2, 3, 4, 5, 5, 7]] + [(None, [0.0] * 4), (9, None)],
                                    "id long, v array<double>")
    rows = [("f", [5, 1], [4], [False]), ("a", [0, 1, 5, 6], [2, 3, 5, 7, 1], [True, True, True, True, False]), ("b", [1, 2], [4, 1], [False, False]),
            ("c", [1, 2], [6, 9], [True, True]), ("d", [], [1], [True]), ("e", [7], [0], [True]), ("e", [3, 4], [1, 2], [True, True])]
    df = spark.createDataFrame(rows, "s string, q array<long>, k array<long>, real array<boolean>")
    q = df.select("s", F.posexplode("q").alias("pos", "id")).join(vectors, "id").select("s", F.col("pos").cast("long").alias("pos"), "v")
    k = df.select("s", F.posexplode(F.arrays_zip("k", "real")).alias("pos", "x")).select("s", F.col("pos").cast("long").alias("pos"), F.col("x.k").alias("id"),
                                                                                        F.col("x.real").alias("real")).join(vectors, "id")
    every = AT.attention(q, k.select("s", "pos", "real", "v"), keys=["s"], causal=False, mask="real").collect()
    want = {(r.s, r.pos): r.v for r in every}
    for bound in (1 << 20, 3 * 32):
        got = AT.attention_of_ids(df, vectors, "s", bound).collect()
        assert sorted((r.s, r.pos) for r in got) == sorted((r.s, r.pos) for r in every)
        assert all(np.allclose(r.v, want[r.s, r.pos]) for r in got)


def test_one_pass_writes_no_copy_of_the_corpus(spark):
    import os

    from __spark_entry__ import queries
    from parallax.plans import prep as P
    from parallax.session import checkpoint_dir, scratch_path

    folder = scratch_path(spark, "one-pass")
    spark.createDataFrame([(i, f"a b{i}\nc{i} d\ne") for i in range(40)], "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(c, t, ("user", "assistant")[t % 2], f"w{c} x{t}") for c in range(20) for t in range(4)],
                          "conv_id long, turn int, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    top = checkpoint_dir(spark).removeprefix("file:").rstrip("/") + "/scratch"
    copies = lambda: {x for x in os.listdir(top) if x.startswith("corpus-")}
    before = copies()
    got = {name: queries()[name](spark, folder).collect() for name in ("vocab_size", "bigram_counts", "cross_entropy", "greedy_decode")}
    assert copies() == before
    rows = P.corpus(spark, folder).collect()
    assert copies() != before and P.split_once(spark, folder) is P.corpus(spark, folder)
    known = {t for r in rows if r.split != "test" for t in r.src_toks}
    assert {r.side: r.n for r in got["vocab_size"]}["src"] == len(known) + 2
    assert sum(r.n for r in got["bigram_counts"]) == sum(r.tgt_len + 1 for r in rows if r.split == "train")
    assert {r.split: r.n_tokens for r in got["cross_entropy"]} == {s: sum(r.tgt_len + 1 for r in rows if r.split == s) for s in ("train", "val", "test")}
    assert {r.pair_id for r in got["greedy_decode"]} == {r.pair_id for r in rows if r.split == "test"}


def test_bigrams_by_number_equal_bigrams_by_token(spark, monkeypatch):
    """Hot first tokens, unknown ones, tokens beyond the bound, no rows, a null text."""
    from parallax.plans import bigram as G
    rng = random.Random(4)
    words = [f"t{i}" for i in range(40)]
    rows = [(rng.choice(["train", "val", "test"]), [words[min(39, int(rng.expovariate(0.2)))] for _ in range(rng.randrange(9))]) for _ in range(150)] + [("train", None)]
    sp = spark.createDataFrame(rows, "split string, toks array<string>")
    seen = Counter(w for s, ts in rows if s != "test" for w in ts or [] if w != "t3")  # t3 is unknown
    order = sorted(seen, key=lambda w: (-seen[w], w))
    vocab = spark.createDataFrame([(i, t, 0) for i, t in enumerate(("<unk>", "<pad>", "<sos>", "<eos>"))] + [(i + 4, t, seen[t]) for i, t in enumerate(order)],
                                  "id long, token string, freq long")
    token = {r.id: r.token for r in vocab.collect()}
    old = G.split_bigrams(sp, vocab, None, "toks")
    want = {(r.split, r.prev, r.next): r.n for r in old.collect()}
    monkeypatch.setattr(G, "HOT", 1)
    for bound, dealt, again in ((1 << 20, 50, True), (0, 1 << 21, True), (0, 50, False)):
        monkeypatch.setattr(G, "DEALT", dealt)
        new = G.numbered_bigrams(sp, vocab, None, "toks", bound=bound, again=again)
        got = new.collect()
        assert len({(r.prev, r.next) for r in got}) == len(got)  # one row each
        assert {(s, token[r.prev], token[r.next]): r.n[s] for r in got for s in ("train", "val", "test") if r.n[s]} == want
    assert sorted(G.cross_entropy(sp, vocab, ev=new).collect()) == sorted(G.cross_entropy(sp, vocab, ev=old).collect())
    outer = old.filter("split = 'val'").select("prev", "next", "n")
    ids = {t: i for i, t in token.items()}
    numbers = spark.createDataFrame([(ids[r.prev], ids[r.next], r.n) for r in outer.collect()], "prev long, next long, n long")
    assert sorted(G.cross_entropy(sp, vocab, ev=new, counts=numbers).collect()) == sorted(G.cross_entropy(sp, vocab, ev=old, counts=outer).collect())
    none = G.numbered_bigrams(sp.limit(0), vocab, None, "toks")
    assert none.collect() == [] and G.cross_entropy(sp, vocab, ev=none).collect() == []


def _texts(spark, name):
    from parallax.session import scratch_path
    folder = scratch_path(spark, name)
    spark.createDataFrame([(i, f"a b{i}\nNA\nc{i} d\n\ne") for i in range(40)] + [(3, "a b\na b\nx"), (None, "p\nq"), (50, None), (51, "")],
                          "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(c, t, ("user", "assistant")[t % 2], f"w{c} x{t}") for c in range(20) for t in range(4)],
                          "conv_id long, turn int, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    spark.createDataFrame([(i, [float(i % 7), 1.0] * 32, i % 3) for i in range(30)], "vec_id long, embedding array<float>, label int").write.parquet(
        f"{folder}/embeddings.parquet")
    return folder


def test_cross_entropy_is_counted_by_number(spark):
    import os

    from __spark_entry__ import queries
    from parallax.session import checkpoint_dir
    top = checkpoint_dir(spark).removeprefix("file:").rstrip("/") + "/scratch"
    folder, before = _texts(spark, "by-number"), set(os.listdir(top))
    queries()["perplexity"](spark, folder).collect()
    new = [x for x in os.listdir(top) if x.startswith("bigrams-by-split-") and x not in before]
    assert [dict(spark.read.parquet(f"{top}/{x}").dtypes)["prev"] for x in new] == ["bigint"]


def test_lines_are_tokenized_once(spark):
    from parallax.plans import prep as P
    folder = _texts(spark, "lines")
    for name in ("words", "script"):
        got = P.pairs_b_tokens(spark, folder, name)
        want = P.with_tokens(P.pairs_b(spark, folder), P.get_tokenizer(name))
        assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        assert got._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1


@pytest.mark.parametrize("name", ["decode_ids", "embed_lookup", "attn_cross"])
def test_ids_are_made_without_a_copy_of_the_corpus(spark, name):
    import os

    from __spark_entry__ import queries
    from parallax.session import checkpoint_dir
    folder = _texts(spark, f"no-copy-{name.replace('_', '-')}")
    top = checkpoint_dir(spark).removeprefix("file:").rstrip("/") + "/scratch"
    copies = lambda: {x for x in os.listdir(top) if x.startswith("corpus-")}
    before = copies()
    assert queries()[name](spark, folder).collect() and copies() == before


def test_ids_of_keys_of_one_row_are_not_shuffled(spark, monkeypatch):
    from parallax.operators import attention as AT
    vectors = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(6)], "id long, v array<float>")
    df = spark.createDataFrame([(s, [1, 2], [i, 3], [True, True]) for i, s in enumerate(["a", "b", "c"])], "s string, q array<long>, k array<long>, real array<boolean>")
    plan = lambda x: x._jdf.queryExecution().executedPlan().toString()
    one = AT.attention_of_ids(df, vectors, "s")
    assert "Exchange" not in plan(one) and len(one.collect()) == 6
    both = df.unionByName(df.filter("s = 'b'")).unionByName(df.select(F.lit(None).cast("string").alias("s"), "q", "k", "real"))
    some = {bound: sorted(map(str, AT.attention_of_ids(both, vectors, "s", bound, keys=both.select("s")).collect())) for bound in (1 << 20, 20)}
    monkeypatch.setattr(AT, "BROADCAST_MAX_ROWS", 0)  # so many repeated keys: all are grouped
    assert some[1 << 20] == some[20] == sorted(map(str, AT.attention_of_ids(both, vectors, "s").collect()))
    assert len(some[20]) == 2 * 3 + 2 + 6
