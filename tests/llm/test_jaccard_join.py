"""The n-gram Jaccard join against brute force, and odd input."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from parallax.llm import jaccard_join as J
from parallax.llm.common import documents

SCHEMA = "doc_id long, text string"


def shingles(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans(
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    k = min(width, len(w))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()


def brute(rows, width, percent):
    sets = [shingles(t, width) for _, t in rows]
    best = {d: d for d, _ in rows if d is not None}

    def root(x):
        while best[x] != x:
            x = best[x]
        return x

    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        common = {}
        for x in s:
            for j in where[x]:
                if j < i:
                    common[j] = common.get(j, 0) + 1
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n) and None not in (rows[i][0], rows[j][0]):
                a, b = sorted((root(rows[i][0]), root(rows[j][0])))
                best[b] = a
    return sorted(((d, len(s), None if d is None else root(d)) for (d, _), s in zip(rows, sets)), key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return words


@pytest.mark.parametrize("width,percent", [(3, 90), (5, 80), (1, 50)])
def test_chains_and_edits_match_brute_force(spark, width, percent):
    rng = random.Random(7)
    rows = []
    for base in range(30):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.choice([1, 2, 4, 7, 12, 30, 80, 200]))]
        chain = words
        for k in range(rng.choice([1, 2, 6, 12])):
            rows.append((rng.randrange(10**6), " ".join(edited(rng, words, k % 4) if k % 2 else chain)))
            chain = edited(rng, chain, 1 + len(words) // 60)
    rows += [(1, "A b c d"), (2, "a  B\tc\nd"), (3, "a b"), (4, "A B"), (5, "b a")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(J.jaccard_components(df, width, percent)) == brute(rows, width, percent)


def test_passage_shared_without_links(spark):
    rng = random.Random(3)
    common = [f"c{i}" for i in range(150)]
    rows = [(i, " ".join(common + [f"d{rng.randrange(10**6)}" for _ in range(25)])) for i in range(700)]
    rows += [(1000 + i, rows[i][1] + " tail") for i in range(5)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(J.jaccard_components(df, 3, 90)) == brute(rows, 3, 90)


def test_small_table_matches_brute_force(spark):
    from conftest import SF_SMALL
    docs = documents(spark, SF_SMALL)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert found(J.jaccard_components(docs, 3, 90)) == brute(rows, 3, 90)


def test_odd_rows(spark):
    long = " ".join(f"v{i}" for i in range(300_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, "a b c"), (4, "a b c"), (4, "a b c"), (9, "A B C"),
            (10, long), (11, long + " end"), (12, "x" * 3_000_000)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("node", F.lit(1)).withColumn("key", F.lit("k"))
    got = found(J.jaccard_components(df, 3, 90))
    assert got == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (None, 1, None), (4, 1, 4), (4, 1, 4), (9, 1, 4),
                          (10, 299_998, 10), (11, 299_999, 10), (12, 1, 12)], key=str)
    kept = J.keep_one(df, 3, 90)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "10", "12", "2", "3", "4", "None"]


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert J.jaccard_components(df).collect() == []
    assert J.keep_one(df).collect() == []


def test_rows_of_one_id_are_one_node(spark):
    rows = [(3, "a b c d"), (5, "a b c d"), (5, "p q r s"), (9, "p q r s"), (12, "p q r s"), (12, "u v w x"), (14, "u v w x"), (15, "k l m n")]
    got = {(d, c) for d, _, c in found(J.jaccard_components(spark.createDataFrame(rows, SCHEMA), 3, 90))}
    assert got == {(3, 3), (5, 3), (9, 3), (12, 3), (14, 3), (15, 15)}


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_linked_sets_share_a_key(percent):
    """Pairs at the very threshold, in bands of all sizes."""
    rng = np.random.default_rng(percent)
    seen = set()
    for n in (1, 2, 5, 20, 60, 150, 400, 1000):
        for _ in range(100):
            most = J.max_difference(2 * n, percent) // 2
            both, own = rng.integers(0, 1 << 64, n - most, dtype=np.uint64), rng.integers(0, 1 << 64, (2, most), dtype=np.uint64)
            x, y = (np.unique(np.append(both, o)) for o in own)
            shared = len(np.intersect1d(x, y))
            if 100 * shared >= percent * (len(x) + len(y) - shared):
                assert len(np.intersect1d(J.tile_keys(x, percent), J.tile_keys(y, percent)))
                seen.update(empty for *_, empty in J._tiles(n, percent))
    assert seen == {True, False}


def test_large_sets_have_no_key_for_empty_slices():
    rng = np.random.default_rng(1)
    for percent in (80, 90):
        sets = [np.unique(rng.integers(0, 1 << 64, 1500, dtype=np.uint64)) for _ in range(200)]
        keys = np.concatenate([J.tile_keys(s, percent) for s in sets])
        assert len(np.unique(keys)) == len(keys)
