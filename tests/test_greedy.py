"""Budget batches by successor and pointer doubling against the plain fold."""

import random

import pytest

from parallax.operators import batching as B
from parallax.operators import greedy as G

SCHEMA = "pair_id string, rn long, src_len long, tgt_len long"


def both(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    native = B.budget_batches(df, **kw)
    fold = B.budget_batches(df, cost_fn=B.token_budget_cost, **kw)
    assert native.columns == fold.columns
    plan = native._jdf.queryExecution().toString()
    assert "Pandas" not in plan and "Arrow" not in plan and "Python" not in plan
    return sorted(map(tuple, native.collect())), sorted(map(tuple, fold.collect()))


@pytest.mark.parametrize("train", [True, False])
@pytest.mark.parametrize("seed,n,budget,pool_rows,longest", [
    (1, 700, 40, 130, 25), (2, 900, 200, 300, 60), (3, 300, 1300, 10_000, 900), (4, 500, 7, 90, 5), (5, 400, 20, 1, 12)])
def test_equal_to_the_fold(spark, monkeypatch, train, seed, n, budget, pool_rows, longest):
    monkeypatch.setattr(G.greedy_batches, "__defaults__", (G.MIN_WEIGHT, 16))  # many chunks in a pool
    rng = random.Random(seed)
    lengths = [rng.choice([0, 1, 2, rng.randrange(longest)]) for _ in range(2 * n)]
    rows = [(f"p{i}", i + 1, lengths[2 * i], lengths[2 * i + 1]) for i in range(n)]
    rng.shuffle(rows)
    native, fold = both(spark, rows, budget=budget, pool_rows=pool_rows, train=train)
    assert native == fold and len(native) == n


def test_heavy_rows_and_exact_closings(spark, monkeypatch):
    monkeypatch.setattr(G.greedy_batches, "__defaults__", (G.MIN_WEIGHT, 4))
    lengths = [(3, 3)] * 9 + [(30, 2)] * 5 + [(1, 1), (40, 1), (3, 3), (18, 18)] + [(0, 0)] * 30
    rows = [(f"p{i:03}", i + 1, s, t) for i, (s, t) in enumerate(lengths)]
    for train in (True, False):
        native, fold = both(spark, rows, budget=20, train=train)
        assert native == fold


def test_one_large_chunk(spark):
    rng = random.Random(8)
    rows = [(f"p{i}", i + 1, rng.randrange(100), rng.randrange(100)) for i in range(3000)]
    native, fold = both(spark, rows)
    assert native == fold


def test_null_lengths_empty_tables_and_other_keys(spark):
    rows = [("a", 1, None, 3), ("b", 2, 4, None), ("c", 3, None, None)]
    native, _ = both(spark, rows, budget=10)
    assert native == [("a", 0, 0, 1), ("b", 0, 1, 0), ("c", 0, 0, 0)]
    assert both(spark, []) == ([], [])
    df = spark.createDataFrame([(*r, f"k{9 - i}") for i, r in enumerate(rows)], SCHEMA + ", held string")
    got = B.budget_batches(df, budget=100, sort_keys=("held",)).collect()
    assert [r.pair_id for r in sorted(got, key=lambda r: r.row_in_batch)] == ["c", "b", "a"]
