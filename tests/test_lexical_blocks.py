"""Lexical training by blocks of target types: results and what is written on the way."""

import math
import os
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from parallax.plans import lexical as L
from parallax.session import checkpoint_dir


def by_hand(pairs, rounds):
    cooc = [(k, f, nf, e, ne) for k, (s, t) in enumerate(pairs) for f, nf in Counter(s.split()).items() for e, ne in Counter(t.split()).items()]
    t = {(f, e): 1.0 for _, f, _, e, _ in cooc}
    for _ in range(rounds):
        z, c, total = defaultdict(float), defaultdict(float), defaultdict(float)
        for k, f, nf, e, _ in cooc:
            z[k, e] += nf * t[f, e]
        for k, f, nf, e, ne in cooc:
            c[f, e] += ne * nf * t[f, e] / z[k, e]
        for (f, _), x in c.items():
            total[f] += x
        t = {(f, e): x / total[f] for (f, e), x in c.items()}
    return t


def test_blocks_and_chunks_give_the_model(spark, monkeypatch):
    pairs = [(" ".join(f"s{(i * j) % 7}" for j in range(i % 5 + 1)), " ".join(f"t{(i + j * j) % 9}" for j in range(i % 6 + 1))) for i in range(40)]
    df = spark.createDataFrame([*pairs, (None, "t1"), ("", "t2"), ("s1", "")], "src string, tgt string")
    want = by_hand(pairs, 3)
    for block, chunk in ((1 << 20, 1 << 20), (50, 1 << 20), (50, 16)):
        monkeypatch.setattr(L, "BLOCK", block)
        monkeypatch.setattr(L, "CHUNK", chunk)
        got = {(r.f, r.e): r.t for r in L.train_lexical(df, 3).collect()}
        assert got.keys() == want.keys()
        assert all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)
        start = L.train_lexical(df, 2).filter("e <> 't3'")
        assert all(r.e != "t3" for r in L.train_lexical(df, 1, start=start, done=2).collect())
        assert sorted(L.train_top1(df, 3).collect()) == sorted(L.top1(L.train_lexical(df, 3)).collect())


def test_the_product_of_a_pair_is_not_written(spark):
    n = 200
    df = spark.createDataFrame([(" ".join(f"s{i}" for i in range(n)), " ".join(f"t{i}" for i in range(n)))], "src string, tgt string")
    top = checkpoint_dir(spark).removeprefix("file:").rstrip("/") + "/scratch"
    before = set(os.listdir(top)) if os.path.isdir(top) else set()
    assert L.train_top1(df, 2).count() == n
    rows = [spark.read.parquet(f"{top}/{x}").count() for x in set(os.listdir(top)) - before]
    assert rows and max(rows) <= 2 * n  # n * n co-occurrences


@pytest.mark.parametrize("t", [0.1250005, 0.3333335, 0.5])
def test_best_keeps_every_row_at_the_edge_of_rounding(t):
    import numpy as np
    import pyarrow as pa

    class Shared:
        value: list = []

    rows = pa.table({"fs": pa.array([[0]], pa.list_(pa.int32())), "nf": pa.array([[1]], pa.list_(pa.int32())),
                     "es": pa.array([[5, 2, 9]], pa.list_(pa.int32())), "ne": pa.array([[1, 1, 1]], pa.list_(pa.int32()))})
    begun = pa.table({"f": np.zeros(3, np.int32), "e": np.array([5, 2, 9], np.int32), "t": np.array([t, t, t / 2])})
    kept = L._best(Shared)(rows, begun).column("e").to_pylist()
    assert 2 in kept and (9 not in kept or t != 0.5)


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_rounds_read_the_dealt_pairs_without_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(L, "BLOCK", 20)
    plans = []
    by_block = L._by_block
    monkeypatch.setattr(L, "_by_block", lambda *a: plans.append(by_block(*a)) or plans[-1])
    df = spark.createDataFrame([(f"a{i % 3} b{i % 5}", f"x{i % 4} y{i % 7}") for i in range(60)], "src string, tgt string")
    begun = L.train_lexical(df, 2)
    resumed = L.train_top1(df, 1, start=begun, done=2)
    assert len(plans) == 5 and all(shuffles(p) == 0 for p in plans)
    assert sorted(resumed.select("f", "e", F.round("t", 6)).collect()) == sorted(L.train_top1(df, 3).select("f", "e", F.round("t", 6)).collect())


def test_neither_types_nor_copies_of_pairs_are_rows(spark, monkeypatch):
    """What is written has a row for each pair, token or batch of pairs, not for each (pair, token) or (pair, block)."""
    monkeypatch.setattr(L, "BLOCK", 1000)
    rows = [(" ".join(f"s{(i * 7 + j) % 40}" for j in range(20)), " ".join(f"t{(i * 3 + j) % 40}" for j in range(20))) for i in range(60)]
    df = spark.createDataFrame(rows, "src string, tgt string").coalesce(2)
    top = checkpoint_dir(spark).removeprefix("file:").rstrip("/") + "/scratch"
    before = set(os.listdir(top)) if os.path.isdir(top) else set()
    assert L.train_top1(df, 2).count() == 40
    new = {x: spark.read.parquet(f"{top}/{x}").count() for x in set(os.listdir(top)) - before}
    assert any(x.startswith("lexical_dealt") for x in new) and max(new.values()) <= 60


def test_packed_values_give_the_pairs_and_the_table_back():
    import numpy as np
    import pyarrow as pa

    lists = lambda x: pa.array(x, pa.list_(pa.int32()))
    pairs = pa.table({"fs": lists([[0, 70000, 2**31 - 1], [5]]), "nf": lists([[1, 2, 300], [1]]),
                      "es": lists([[1, 2, 3, 4, 90000], [2]]), "ne": lists([[1, 1, 9, 1, 1], [70000]])})
    got = []
    for value in L._dealt_pairs(3)(pairs.to_batches()):
        for r in L._pairs_of(pa.Table.from_batches([value])).to_pylist():
            got += [(tuple(r["fs"]), tuple(r["nf"]), e, n) for e, n in zip(r["es"], r["ne"])]
            assert set(L._block_of(np.array(r["es"]), 3)) == {value.column(0)[0].as_py()}
    want = [(tuple(r["fs"]), tuple(r["nf"]), e, n) for r in pairs.to_pylist() for e, n in zip(r["es"], r["ne"])]
    assert sorted(got) == sorted(want)
    table = pa.table({"f": pa.array([7, 2**31 - 1, 0], pa.int32()), "e": pa.array([9, 0, 9], pa.int32()), "t": [1 / 3, 5e-324, 1.0]})
    back = [r for v in L._dealt_start(2)(table.to_batches()) for r in L._start_of(pa.Table.from_batches([v])).to_pylist()]
    assert sorted(map(str, back)) == sorted(map(str, table.to_pylist()))
    assert L._start_of(pa.table({"packed": pa.array([], pa.binary())})).num_rows == 0


def test_a_saved_model_is_numbers_and_goes_on(spark, tmp_path):
    """Saved without a token in its rows; other pairs, whose tokens have other numbers, go on with it
    as with the table in tokens."""
    from parallax.sources import commits as CM

    df = spark.createDataFrame([(f"a{i % 3} b{i % 5}", f"x{i % 4} y{i % 7}") for i in range(60)], "src string, tgt string")
    other = df.limit(40).unionByName(spark.createDataFrame([("a0 0new", "x1 0new")], "src string, tgt string"))
    CM.save_version(L.train_saved(df, 2), spark, str(tmp_path / "m"), 2)
    done, saved = CM.load_version(spark, str(tmp_path / "m"), L.SAVED)
    assert dict(saved["lexical"].dtypes) == {"f": "int", "e": "int", "t": "double"}
    for pairs in (df, other):
        got = L.train_top1(pairs, 1, start=saved, done=done)
        want = L.train_top1(pairs, 1, start=L.train_lexical(df, 2), done=2)
        assert sorted(got.select("f", "e", F.round("t", 6)).collect()) == sorted(want.select("f", "e", F.round("t", 6)).collect())
