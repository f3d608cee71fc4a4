"""Ranked lexical search against brute force, and what its queries share."""

import math
import random
import re
from collections import Counter

import pytest

from parallax.llm import lexical_search as S

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=50):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n, length = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    queries = {}
    for i, t in items:
        if i is not None:
            queries.setdefault(i, set()).update(terms(t))
    out = []
    for i, words in queries.items():
        scores = []
        for d, b in bags:
            m = 50 + 50 * sum(b.values()) * n // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 20 * m))
                    for t in words if b[t])
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(i, r, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def found(spark, docs, items, k=50):
    got = S.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(tuple(r) for r in got.collect())


def corpus(rng, n):
    words = [f"w{i}" for i in range(60)] + ["Été", "日本", "x-y", "A.b"]
    return [(i, " ".join(rng.choices(words, weights=[1 / (j + 1) for j in range(len(words))], k=rng.randrange(0, 40)))) for i in range(n)]


def test_ranks_match_brute_force(spark):
    rng = random.Random(3)
    docs = corpus(rng, 300)
    docs += [(300 + i, docs[7][1]) for i in range(70)]  # ties over the cut
    items = [(i, docs[rng.randrange(300)][1] + " " + docs[rng.randrange(300)][1]) for i in range(25)]
    assert found(spark, docs, items) == brute(docs, items)
    assert found(spark, docs, items, k=3) == brute(docs, items, k=3)


def test_blocks_of_queries_give_the_same_rows(spark, monkeypatch):
    rng = random.Random(4)
    docs, items = corpus(rng, 80), [(i, t) for i, t in corpus(rng, 12)]
    whole = found(spark, docs, items)
    monkeypatch.setattr(S, "SQUARES", 100)
    assert found(spark, docs, items) == whole == brute(docs, items)


def test_odd_input(spark):
    docs = [(1, "a b"), (1, "a b"), (1, "a"), (None, "a b"), (2, None), (3, ""), (4, " .,;\x00\n"), (5, "A b"), (6, "b" * 300_000 + " a"),
            (7, "c d")]
    items = [(1, "a"), (2, None), (3, "!"), (None, "a"), (4, "zzz"), (5, "a"), (5, "b a"), (6, "É a b")]
    assert found(spark, docs, items) == brute(docs, items)
    assert found(spark, [], items) == [] and found(spark, docs, []) == []
    assert found(spark, [(1, None)], [(1, "a")]) == []
    more = spark.createDataFrame([(1, "a", 9, 8, 7), (2, "b", 9, 8, 7)], DOCS + ", n long, terms long, score long")
    got = S.search(more, spark.createDataFrame([(1, "a", 5)], ITEMS + ", doc_id long"))
    assert [tuple(r)[:3] for r in got.collect()] == [(1, 1, 1)]


@pytest.mark.parametrize("seed", range(5))
def test_shared_sets_add_up_to_the_queries(seed):
    rng = random.Random(seed)
    base = [set(rng.sample(range(40), 8)) for _ in range(4)]
    queries = [(i, {b"t%d" % t for t in set().union(*rng.sample(base, 2), rng.sample(range(60), 5))}) for i in range(15)]
    plan = S.share(queries)
    atoms = int(plan.atom.max()) + 1
    sets = [{plan.vocabulary[i] for i in range(len(plan.atom)) if plan.atom[i] == a} for a in range(atoms)]
    for i, j in plan.pairs:
        assert not sets[i] & sets[j]
        sets.append(sets[i] | sets[j])
    for (_, words), nodes in zip(queries, plan.nodes):
        assert sum(len(sets[n]) for n in nodes) == len(words)
        assert set().union(*(sets[n] for n in nodes)) == words
    work = len(plan.pairs) + sum(len(n) for n in plan.nodes) + len(plan.vocabulary)
    assert work < sum(len(w) for _, w in queries)
    # no pair of nodes is left in two queries
    left = Counter((a, b) for n in plan.nodes for x, a in enumerate(n) for b in n[x + 1:])
    assert max(left.values(), default=0) < 2
