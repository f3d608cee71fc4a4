"""MinHash near duplicates against brute force, the pruning rule, and odd input."""

import random

import numpy as np
import pytest

from parallax.llm import minhash_dedup as M
from parallax.llm.common import shingle_set, word_hashes
from test_jaccard_join import SCHEMA, brute, edited


def joined(rows, width, percent):
    return [(d, n, c, d is None or d == c) for d, n, c in brute(rows, width, percent)]


def found(spark, rows, width=3, percent=85):
    got = M.near_duplicates(spark.createDataFrame(rows, SCHEMA), width, percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_groups_and_chains_match_brute_force(spark, width, percent):
    rng = random.Random(width)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for g in range(12):
        base = rng.choices(words, k=rng.randrange(3, 250))
        for _ in range(rng.randrange(1, 14)):
            rows.append(" ".join(edited(rng, base, rng.randrange(0, 6))))
            if rng.random() < 0.3:
                base = edited(rng, base, 3)  # a chain
    rows += [rows[0]] * 30 + ["a", "a b", "A b", "a b c", "a b d"]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    assert found(spark, rows, width, percent) == sorted(joined(rows, width, percent), key=str)


def test_members_that_only_the_source_links(spark):
    """Copies of one text, each with edits of its own: linked to it, hardly to each other."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(300)]
    rows = [" ".join(edited(rng, base, 6)) for _ in range(60)] + [" ".join(base)]
    rows = list(enumerate(rows))
    assert found(spark, rows) == sorted(joined(rows, 3, 85), key=str)


def test_blocks_of_a_mixed_bucket(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_ROWS", 4)
    rng = random.Random(2)
    base = [f"w{i}" for i in range(200)]
    rows = [" ".join(edited(rng, base, rng.randrange(0, 12))) for _ in range(80)]
    rows = list(enumerate(rows))
    assert found(spark, rows) == sorted(joined(rows, 3, 85), key=str)


def test_odd_input(spark):
    long = " ".join(f"w{i % 5000}" for i in range(150_000))
    rows = [(1, None), (2, ""), (3, " \n"), (None, "a b c d"), (4, "a b c d"), (4, "a b c d"), (7, "A b C d"), (8, "x"), (9, long), (10, long + " end")]
    assert found(spark, rows) == sorted([
        (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (None, 2, None, True), (4, 2, 4, True), (4, 2, 4, True), (7, 2, 4, False),
        (8, 1, 8, True), (9, 5000, 9, True), (10, 5001, 9, False)], key=str)
    assert found(spark, []) == [] and found(spark, [(1, None)]) == [(1, 0, 1, True)]
    more = spark.createDataFrame([(1, "a", 5, "x", 0)], SCHEMA + ", node long, digest string, component_id long")
    assert [tuple(r) for r in M.near_duplicates(more).collect()] == [(1, 1, 1, True)]


def test_rows_of_one_id_are_one_node(spark):
    rows = [(3, "a b c d"), (5, "a b c d"), (5, "p q r s"), (9, "p q r s"), (12, "p q r s"), (12, "u v w x"), (14, "u v w x"), (15, "k l m n")]
    assert {(d, c) for d, _, c, _ in found(spark, rows)} == {(3, 3), (5, 3), (9, 3), (12, 3), (14, 3), (15, 15)}


def test_posterior_bound():
    for n in range(M.STEP, M.HASHES + 1, M.STEP):
        m, grid = M.least_matches(n, 85), np.linspace(0, 1, 200_001)
        for k, kept in ((m, True), (m - 1, False)):  # the posterior by numeric integration
            density = grid**k * (1 - grid)**(n - k)
            assert (density[grid >= 0.85].sum() / density.sum() >= M.MISS) == kept


def test_equal_hashes_estimate_the_similarity():
    rng = random.Random(1)
    base = [f"w{i}" for i in range(2000)]
    h, off = word_hashes([" ".join(t).encode() for t in (base, edited(rng, base, 60), [f"z{i}" for i in range(2000)])])
    sets = [shingle_set(h[a:b], 3) for a, b in zip(off[:-1], off[1:])]
    x, y, z = M.signatures(sets)
    shared = len(np.intersect1d(sets[0], sets[1]))
    assert abs((x == y).mean() - shared / (len(sets[0]) + len(sets[1]) - shared)) < 0.12 and (x == z).mean() < 0.03
    assert M.matches(np.array([x, x]), np.array([x, z]), 85)[0].tolist() == [True, False]


def test_bitmaps_never_end_a_link():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 1 << 63, k).astype(np.uint64)) for k in (1, 5, 40, 300, 2000)]
    sets = [np.unique(np.append(s[rng.random(len(s)) > cut], rng.integers(0, 1 << 63, int(cut * len(s))).astype(np.uint64)))
            for s in sets for cut in (0, 0, 0.02, 0.05, 0.08, 0.1, 0.3)]
    sets = [s for s in sets if len(s)]
    bitmaps = M.Bitmaps([M.parity_bitmap(s, 85) for s in sets], np.array([len(s) for s in sets]), 85)
    x, y = (a.ravel() for a in np.meshgrid(*[np.arange(len(sets))] * 2))
    allowed, ended = bitmaps.allow(x, y), 0
    for i, j, ok in zip(x, y, allowed):
        shared = len(np.intersect1d(sets[i], sets[j]))
        linked = 100 * shared >= 85 * (len(sets[i]) + len(sets[j]) - shared)
        assert ok or not linked
        ended += not ok
    assert ended > len(x) // 2
