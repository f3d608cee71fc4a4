"""The perplexity of quality_rules tells all characters apart, held by tasks or joined."""

import math
from collections import Counter, defaultdict

from parallax.llm import quality_rules as Q

MANY = [chr(0x4E00 + i) for i in range(150)] + ["\U0001F600", "�", "힣"]
DOCS = "doc_id long, text string, lang string"


def rows():
    """Texts in a fixed order of characters, one in another order, and odd ones."""
    ordered = [(i, " ".join("".join(MANY[(i + 5 * j + k) % len(MANY)] for k in range(5)) for j in range(40)), "xx") for i in range(40)]
    mixed = " ".join("".join(MANY[(k * 37 + j * j * 11) % len(MANY)] for k in range(5)) for j in range(40))
    return [*ordered, (100, mixed, "xx"), (101, None, None), (102, "", "en"), (103, "a b\tc", None), (3, ordered[3][1], "xx"), (None, "z", "xx")]


def by_hand(texts):
    """Mean -log p a character of an interpolated modified Kneser-Ney model over UTF-16 units."""
    def units(t):
        raw = ("   " + "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in t)).encode("utf-16-le")
        return [raw[i:i + 2] for i in range(0, len(raw), 2)]

    count = {4: Counter(tuple(u[i - 3:i + 1]) for u in map(units, texts) for i in range(3, len(u)))}
    for k in (3, 2, 1):
        count[k] = Counter(g[1:] for g in count[k + 1])
    cut = {k: Q._discounts([sum(n == i for n in c.values()) for i in (1, 2, 3, 4)]) for k, c in count.items()}
    total, left = defaultdict(int), defaultdict(float)
    for k, c in count.items():
        for g, n in c.items():
            total[g[:-1]] += n
            left[g[:-1]] += cut[k][min(n, 3)]

    def p(g):
        if not g:
            return 1 / (len(count[1]) + 1)
        n = count[len(g)][g]
        return (n - cut[len(g)][min(n, 3)]) / total[g[:-1]] + left[g[:-1]] / total[g[:-1]] * p(g[1:])

    return [-sum(math.log(p(tuple(u[i - 3:i + 1]))) for i in range(3, len(u))) / len(t) if t else None for t, u in ((t, units(t)) for t in texts)]


def test_all_characters_are_told_apart(spark, monkeypatch):
    given = rows()
    docs = spark.createDataFrame(given, DOCS)
    want = sorted(map(str, ((i, None if x is None else round(x, 6)) for (i, _, _), x in zip(given, by_hand([t or "" for _, t, _ in given])))))
    kept = None
    for held, counted in ((1 << 20, 1 << 21), (1 << 20, 50), (200, 1 << 21), (0, 50)):
        monkeypatch.setattr(Q, "KEPT", held)
        monkeypatch.setattr(Q, "HELD", counted)
        report = Q.report(docs).collect()
        assert sorted(str((r.doc_id, None if r.log_ppl is None else round(r.log_ppl, 6))) for r in report) == want
        verdict = sorted(str((r.doc_id, r.base_failed, r.kept)) for r in report)
        assert kept in (None, verdict)
        kept = verdict
        assert sorted(str(r.doc_id) for r in Q.keep_good(docs).collect()) == sorted(str(r.doc_id) for r in report if r.kept)


def test_a_model_scores_other_texts_alike_held_or_joined(spark, monkeypatch):
    docs = spark.createDataFrame(rows(), DOCS)
    other = spark.createDataFrame([(1, "".join(MANY[:30]) + " unseen ß", "xx"), (2, "a b", None)], DOCS)
    found = []
    for held in (1 << 20, 100):
        monkeypatch.setattr(Q, "KEPT", held)
        found.append([(r.doc_id, round(r.log_ppl, 6)) for r in Q.measure(other, ["doc_id"], model=Q.train(docs)).orderBy("doc_id").collect()])
    assert found[0] == found[1]
