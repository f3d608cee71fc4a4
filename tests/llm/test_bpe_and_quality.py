"""Byte-level BPE against the library on whole texts; quality rules and the n-gram model
against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from parallax.llm import bpe_codec as B
from parallax.llm import quality_rules as Q
from parallax.llm.common import documents

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = ["", " ", "  a", "a  b\n\n c\t d ", "it's I'LL we've\n 'tis", "日本語 テキスト", "\U0001F600é̀ x y",
       "<|endoftext|>", "abc123def 4a", "x" * 5000, "\x1c a\x85b", "a" * 30 + " " * 40 + "b"]


@pytest.mark.parametrize("limit", [1, 3, 50])
def test_segments_keep_the_ids(limit):
    enc = B.encoding(RANKS, P.PATTERN)
    rng = random.Random(limit)
    texts = ODD + ["".join(rng.choice(["a", "Z", "7", " ", "  ", "\n", "'s", "'", "é", "日", ".", "#"])
                           for _ in range(300)) for _ in range(200)]
    for t in texts:
        parts = list(B.segments(t, limit))
        assert "".join(parts) == t
        assert [i for p in parts for i in enc.encode_ordinary(p)] == enc.encode_ordinary(t)


@pytest.mark.parametrize("space", [" ", "\n", "\u3000", "\xa0 "])
def test_long_white_space_below_the_limit_of_the_library(monkeypatch, space):
    monkeypatch.setattr(B, "SEGMENT", 300)
    enc, rng = B.encoding(RANKS, P.PATTERN), random.Random(3)
    for limit in (5, 60):
        monkeypatch.setattr(B, "LONG", limit)
        for _ in range(200):
            t = "".join(rng.choice(["a", "é ", "12", "#", "'s", "\t", " ", space * rng.randrange(1, 90)]) for _ in range(12))
            assert B.encode_text(enc, t) == enc.encode_ordinary(t)
        for t in (space * 200, "a" + space * 200, space * 200 + "a", "a" + space * 200 + "\nb", "a" + space * 200 + " b"):
            assert B.encode_text(enc, t) == enc.encode_ordinary(t)


@pytest.mark.parametrize("space", [" ", "\n", "\u3000", "\xa0"])
def test_white_space_beyond_the_limit_of_the_library(space):
    """The run is one match: its merges, then those of what follows it."""
    enc, n = B.encoding(RANKS, P.PATTERN), 1_500_000
    whole = enc._encode_single_piece(space * n)
    assert B.encode_text(enc, space * n) == whole
    after = "x 12"
    assert B.encode_text(enc, "ab" + space * (n + 1) + after) == enc.encode_ordinary("ab") + whole + enc.encode_ordinary(space + after)
    assert enc.decode_bytes(B.encode_text(enc, "ab" + space * (n + 1) + after)) == ("ab" + space * (n + 1) + after).encode()


def test_digests(spark):
    from conftest import SF_SMALL
    enc = B.encoding(RANKS, P.PATTERN)
    docs = documents(spark, SF_SMALL).unionByName(spark.createDataFrame(
        [(None, None, None, None, None), (-1, ODD[3], "en", "s", 1), (-1, ODD[3], "en", "s", 1)], DOCS))
    long = "word 12 " * 100_000
    docs = docs.unionByName(spark.createDataFrame([(-2, long, "en", "s", 1)], DOCS)).withColumn("ids", F.lit("x"))
    rows = {(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()}
    want = Counter()
    for i, t in rows:
        ids = enc.encode_ordinary(t or "")
        key = (i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
               hashlib.sha256((t or "").encode()).hexdigest())
        want[key] += 2 if i == -1 else 1
    assert Counter(tuple(r) for r in B.digests(docs, RANKS, P.PATTERN).collect()) == want
    encoded = B.encode(docs, RANKS, P.PATTERN).select("row.doc_id", "ids")
    back = B.decode(encoded, RANKS, P.PATTERN, ["doc_id"])
    assert {(r.doc_id, bytes(r.decoded)) for r in back.collect()} == {(i, (t or "").encode()) for i, t in rows}
    assert B.digests(docs.limit(0), RANKS, P.PATTERN).collect() == []


def rules(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    win = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    hit = {j for i in range(len(w) - 4) if win[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit)]


def test_rule_counts():
    texts = ODD + ["a b c d e f " * 3 + "z", "l one\nl one\n\n \nl one", "# a | b\n# a | b", "a b \x1fc"]
    assert Q.rule_counts([t.encode() for t in texts]) == [rules(t) for t in texts]


def test_model_is_a_distribution_and_matches_counts():
    rng = random.Random(1)
    alphabet = np.zeros(0x110000, np.uint8)
    alphabet[[10, 32]] = Q.SPACE
    for i, c in enumerate("abcdef"):
        alphabet[ord(c)] = i + 2
    texts = ["".join(rng.choice("aabbbcd ef") for _ in range(200)).encode() for _ in range(20)]
    g, off = Q.grams(*Q.symbols(texts, alphabet))
    assert off[-1] == len(g) == 4000
    codes, n = np.unique(g, return_counts=True)
    model = Q.KneserNey(codes, n)
    for ctx in (codes[5] >> Q.BITS, codes[70] >> Q.BITS, (63 << 12) | (2 << 6) | 3, (63 << 12) | (62 << 6) | 61):
        p = np.exp(model.log_prob((int(ctx) << Q.BITS) | np.arange(Q.SYMBOLS)))
        assert abs(p.sum() - 1) < 1e-5
    # the top order by hand
    code, count = int(codes[10]), int(n[10])
    ctx = code >> Q.BITS
    same = [int(c) for c, k in zip(n, codes) if k >> Q.BITS == ctx]
    d = Q.discounts(n)
    low = np.exp(model._log(np.array([code & ((1 << 18) - 1)]), 3))[0]
    left = sum(d[min(c, 3)] for c in same) / sum(same)
    want = (count - d[min(count, 3)]) / sum(same) + left * low
    assert abs(np.exp(model.log_prob(np.array([code])))[0] - want) < 1e-6


def test_quality_report_and_filter(spark):
    from conftest import SF_SMALL
    extra = [(None, None, None, None, None), (-1, "", "en", "s", 0), (-2, "a b c d e f g h i j k", "xx", None, 1),
             (-3, "one two three " * 50, "en", "s", 1)]
    docs = documents(spark, SF_SMALL).unionByName(spark.createDataFrame(extra, DOCS)).withColumn("n_words", F.lit(1))
    report = {r.doc_id: r for r in Q.report(docs).collect()}
    for r in docs.select("doc_id", "text").collect():
        got = report[r.doc_id]
        want = rules(r.text)
        assert [got.n_words, got.word_chars, got.n_symbols, got.n_dup_lines, got.n_repeat_words] == want
        assert got.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (got.base_failed and got.kept)
    kept = Q.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in report.items() if r.kept}
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").filter("quality = 1").collect()
    good = [report[r.doc_id] for r in labels if not report[r.doc_id].base_failed]
    assert sum(r.kept for r in good) >= 0.98 * len(good)
    assert Q.report(docs.limit(0)).collect() == [] and Q.keep_good(docs.limit(0)).collect() == []
