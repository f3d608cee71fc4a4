"""Tokenizer alignment against a plain library run and brute force over offsets."""

import hashlib
import json
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from parallax.llm import token_alignment as T

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def tools():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    byte = T.byte_level_alphabet()
    vocabulary = json.load(open(A, encoding="utf-8"))["model"]["vocab"]
    bytes_a = {i: bytes(byte[c] for c in t) for t, i in vocabulary.items()}
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    bytes_b = {i: bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
               for i in range(b.get_piece_size())}
    return a, bytes_a, b, bytes_b


def brute(tools, rows):
    a, bytes_a, b, bytes_b = tools
    counts, out = Counter(), []
    for d, t in rows:
        x = a.encode(" " + t, add_special_tokens=False).ids if t else []
        y = b.encode(t) if t else []
        whole = b" " + (t or "").encode()
        if b"".join(bytes_a[i] for i in x) != whole or b"".join(bytes_b[i] for i in y) != whole:
            out.append((d, [], [], [], ""))
            continue
        ends_a, ends_b, at = {}, {}, 0
        for k, i in enumerate(x):
            at += len(bytes_a[i])
            ends_a[at] = k
        at = 0
        for k, i in enumerate(y):
            at += len(bytes_b[i])
            ends_b[at] = k
        cuts = sorted(set(ends_a) & set(ends_b))
        links = [(x[ends_a[c]], y[ends_b[c]]) for c in cuts]
        groups, i, j = [], 0, 0
        for c in cuts:
            groups.append(",".join(map(str, x[i:ends_a[c] + 1])) + "|" + ",".join(map(str, y[j:ends_b[c] + 1])))
            i, j = ends_a[c] + 1, ends_b[c] + 1
        counts.update(links)
        out.append((d, x, y, links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = defaultdict(int)
    for (_, i), n in counts.items():
        most[i] = max(most[i], n)
    return sorted(((d, len(x), len(y), len(k), len(k), sum(counts[p] == most[p[1]] for p in k), sum(counts[p] for p in k), h)
                   for d, x, y, k, h in out), key=str)


def found(spark, rows):
    got = T.align(spark.createDataFrame(rows, SCHEMA), A, B)
    assert got.columns == COLUMNS
    return sorted((tuple(r) for r in got.collect()), key=str)


def texts(rng, n):
    alphabet = ["the ", "Über", " straße", "日本語", "\n", "  ", "\t", "é", "🙂", "<s>", "<|endoftext|>", "<0x0A>", " ", "x1y2", "'s", "\x00", "ﬁ"]
    return ["".join(rng.choices(alphabet, k=rng.randrange(1, 30))) for _ in range(n)]


def test_alignment_matches_brute_force(spark, tools):
    rng = random.Random(5)
    rows = list(enumerate(texts(rng, 200)))
    rows += [(500 + i, rows[3][1]) for i in range(40)]  # copies weigh in the counts
    assert found(spark, rows) == brute(tools, rows)


def test_texts_by_parts(tools):
    """Parts that are kept, forgotten and learned again give what the library gives."""
    rng = random.Random(11)
    words = ["the", "Über", "straße.", "日本語", "a\nb", "\n\nx", "é,", "🙂", "<s>", "x1y2", "it's", "\x00", "ﬁ", "▁", "a▁b", "C\u3000D", "_", "--"]
    for kept in (5, 1000):
        aligner = T.Aligner(A, B, kept)
        assert aligner.by_parts
        for _ in range(40):
            rows = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 12)))) for i in range(6)]
            got = [(n_a, n_b, len(links), "" if groups is None else hashlib.sha256(groups).hexdigest())
                   for n_a, n_b, links, groups in aligner.texts([t for _, t in rows])]
            assert got == [(r[1], r[2], r[3], r[7]) for r in brute(tools, rows)]


def test_rare_pairs_are_joined_alike(spark, tools, monkeypatch):
    rows = list(enumerate(texts(random.Random(6), 60)))
    monkeypatch.setattr(T, "FREQUENT", 20)  # most pairs are rare now
    assert found(spark, rows) == brute(tools, rows)


def test_odd_input(spark, tools):
    rows = [(1, None), (2, ""), (3, "▁"), (4, " "), (5, "a"), (5, "a"), (5, "b"), (None, "a"), (6, "ab " * 100_000), (7, " " * 50_000), (8, "\u0000")]
    got = found(spark, rows)
    assert got == brute(tools, rows)
    zeros = (0, 0, 0, 0, 0, 0, "")
    assert [r for r in got if r[0] in (1, 2, 3)] == [(1, *zeros), (2, *zeros), (3, *zeros)]
    assert found(spark, []) == [] and found(spark, [(1, None)]) == [(1, *zeros)]
    more = spark.createDataFrame([(1, "a b", "x", 1, 2)], SCHEMA + ", digest string, copies long, n_a long")
    assert [tuple(r) for r in T.align(more, A, B).collect()] == found(spark, [(1, "a b")])
