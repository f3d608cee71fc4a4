"""Two-tier dictionaries: the same arrays whatever the bound, and what needs no shuffle."""

import random

import pytest
from pyspark.sql import functions as F

from parallax.operators import dictionary as D
from parallax.operators import vocab as V
from parallax.plans import lexical as L

BOUNDS = [0, 900, 1 << 30]


@pytest.mark.parametrize("bound", BOUNDS)
@pytest.mark.parametrize("missing", [None, "?"])
def test_arrays_whatever_the_bound(spark, monkeypatch, bound, missing):
    monkeypatch.setattr(D, "BUCKET", 4)
    rng = random.Random(7)
    words = [f"w{i}" for i in range(60)]
    table = {w: f"v{i}é" for i, w in enumerate(words[:40])}
    rows = [(i, rng.choices(words, k=rng.randrange(0, 9))) for i in range(200)] + [(5, []), (5, ["w3", "w59", "w3"]), (900, None), (901, ["w1", None, "w50"])]
    df = spark.createDataFrame(rows, "id long, words array<string>")
    keys = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(table.items())], "key string, value string, rank long")
    got = D.map_arrays(df, {"words": D.Dictionary(keys, missing)}, bound)
    want = [(i, None if ws is None else [missing if w is None else table.get(w, w if missing is None else missing) for w in ws]) for i, ws in rows]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert got.columns == df.columns
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ("Exchange" in plan) == (bound < 1 << 30)
    assert D.map_arrays(df.limit(0), {"words": D.Dictionary(keys, missing)}, bound).collect() == []
    empty = D.map_arrays(df.filter("id = 5"), {"words": D.Dictionary(keys.limit(0), "?")}, bound)
    assert sorted(map(str, (r.words for r in empty.collect()))) == sorted(["['?', '?', '?']", "[]"] + [str(["?"] * len(rows[5][1]))])


@pytest.mark.parametrize("bound", BOUNDS)
def test_encode_decode_translate(spark, monkeypatch, bound):
    monkeypatch.setattr(D, "BUCKET", 2)
    df = spark.createDataFrame([("1", "a b c z", "x y z"), ("2", None, ""), ("3", "b b q", "x x")], "pair_id string, src string, tgt string")
    vs = spark.createDataFrame([(0, "<unk>", 0), (1, "<pad>", 0), (2, "b", 3), (3, "a", 1), (4, "c", 1)], V.VOCAB_SCHEMA)
    vt = spark.createDataFrame([(0, "<unk>", 0), (1, "<pad>", 0), (2, "<sos>", 0), (3, "<eos>", 0), (4, "x", 3), (5, "y", 1)], V.VOCAB_SCHEMA)
    enc = V.encode_pairs(df, vs, vt, bound=bound)
    assert sorted(map(tuple, enc.collect())) == [("1", [3, 2, 4, 0], [2, 4, 5, 0, 3]), ("2", [], [2, 3]), ("3", [2, 2, 0], [2, 4, 4, 3])]
    back = V.decode_ids(enc.withColumn("tgt_ids", F.concat("tgt_ids", F.array(F.lit(99).cast("long")))), "tgt_ids", vt, bound=bound)
    assert sorted(map(tuple, back.collect())) == [("1", "x y <unk>"), ("2", ""), ("3", "x x")]
    loose = V.decode_ids(spark.createDataFrame([("9", [4, 99, 5])], "pair_id string, tgt_ids array<bigint>"), "tgt_ids", vt, bound=bound)
    assert loose.first().text == "x y"
    table = spark.createDataFrame([("a", "A", 1.0), ("b", "BB", 1.0)], "f string, e string, t double")
    got = L.translate(df, table, bound=bound)
    assert sorted((r.pair_id, r.translation) for r in got.collect()) == [("1", "A BB c z"), ("2", ""), ("3", "BB BB q")]
    assert sorted(r.translation for r in L.translate(df, table, max_len=2, bound=bound).collect()) == ["", "A BB", "BB BB"]


def test_rows_without_rare_keys_are_not_shuffled(spark):
    """Two columns with keys beyond the bound: arrays are exchanged in one branch, and once."""
    table = spark.createDataFrame([(f"w{i}", i, i) for i in range(3000)], "key string, value long, rank long")
    rows = [(0, ["w1", "w2999", None, "x"], ["w5"]), (1, None, ["w2998"]), (2, ["w2"], []), (3, [], ["w2500", "w2500", "w0"])]
    df = spark.createDataFrame(rows, "id long, a array<string>, b array<string>")
    words = D.Dictionary(table, -1)
    got = D.map_arrays(df, {"a": words, "b": words}, 1100 * 24)
    value = lambda x: None if x is None else [int(w[1:]) if w and w[1:] else -1 for w in x]
    assert sorted(map(tuple, got.collect())) == [(i, value(a), value(b)) for i, a, b in rows]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and plan.count("Join ") == 4  # by column its found keys and its rows


def test_numbers_packed_in_bytes():
    import pyarrow as pa
    rng = random.Random(3)
    rows = [[rng.choice([None, 0, 1, -1, 63, 64, 127, 128, 8191, -8192, 1 << 31, -(1 << 40), (1 << 63) - 1]) for _ in range(rng.randrange(6))] for _ in range(300)] + [None, []]
    for x in (rows, [], [None], [[]], [[None]]):
        lists = pa.array(x, pa.list_(pa.int64()))
        assert D.unpacked(D.packed(lists)).to_pylist() == x and D.unpacked(D.packed(lists.slice(1))).to_pylist() == x[1:]
    small = pa.array([list(range(63))] * 9, pa.list_(pa.int64()))
    assert all(len(b) == 63 for b in D.packed(small).to_pylist())


@pytest.mark.parametrize("bound", [0, 1100 * 24, 1 << 30])
def test_rows_that_can_be_read_again_are_not_written(spark, monkeypatch, bound):
    """Words to numbers, numbers to words, and a column beside them that fits the bound."""
    names = []
    monkeypatch.setattr(D, "scratch_path", lambda s, name, of=D.scratch_path: (names.append(name), of(s, name))[1])
    monkeypatch.setattr(D, "KEYS", 5)
    rows = [(i % 7, [f"w{(i * k) % 3100}" for k in range(i % 5)] + [None] * (i % 3 == 0), [(i * k) % 3100 for k in range(i % 4)] if i % 11 else None, ["w1", "w9"]) for i in range(90)]
    df = spark.createDataFrame(rows + rows[:5], "id long, a array<string>, b array<long>, c array<string>")
    words = spark.createDataFrame([(f"w{i}", i, i) for i in range(3000)], "key string, value long, rank long")
    back = spark.createDataFrame([(i, f"w{i}", i) for i in range(3000)], "key long, value string, rank long")
    few = spark.createDataFrame([("w1", -5, 0)], "key string, value long, rank long")
    got = D.map_arrays(df, {"a": D.Dictionary(words, -1), "b": D.Dictionary(back, "?"), "c": D.Dictionary(few, 0)}, bound, again=True).collect()
    number = lambda w: int(w[1:]) if w and int(w[1:]) < 3000 else -1
    want = [(i, [number(w) for w in a], None if b is None else [f"w{n}" if n < 3000 else "?" for n in b], [-5, 0]) for i, a, b, c in rows + rows[:5]]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert "half-mapped" not in names and ("rare-keys" in names) == (bound < 1 << 30)
