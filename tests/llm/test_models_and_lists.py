"""Language ID, LM scoring, URL filters and licence scan: accuracy, brute force, odd input."""

import datetime
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parallax.llm import language_id as G
from parallax.llm import license_scan as S
from parallax.llm import lm_scoring as M
from parallax.llm import url_filters as U
from parallax.llm.common import documents

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
RANKS = P.path("byte_bpe_50k.tiktoken")


def crc(i, n):
    return zlib.crc32(str(i).encode()) % n


def test_language_id_held_out(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    extra = spark.createDataFrame([(None, "the and of", "en", "s", 1), (-1, None, "en", "s", 1), (-2, " 12 |", "fr", "s", 1),
                                   (-3, "x", None, None, None)], DOCS)
    rows = docs.unionByName(extra).withColumn("lang_pred", F.lit("no")).withColumn("score", F.lit(9.0))
    got = {r.doc_id: r for r in G.report(rows).collect()}
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [i for i in truth if got[i].held_out]
    assert all(got[i].held_out == (crc(i, 4) == 2) for i in truth)
    assert sum(got[i].lang_pred == truth[i] for i in held) >= 0.99 * len(held)
    assert all(0 <= r.score <= 1 and r.lang_pred in {"en", "de", "fr", "es", "und"} for r in got.values())
    assert got[-1].lang_pred == got[-2].lang_pred == "und" and got[None].held_out is False


def test_language_id_counts_long_texts_once_and_odd_tables(spark, monkeypatch):
    text = "Über Größe, naïve façade 123 " * 20
    whole = G.gram_counts(text)
    monkeypatch.setattr(G, "CHARS", 37)
    assert (G.gram_counts(text) == whole).all() and whole.sum() > 0 and G.gram_counts("1 2 |") is None
    none = spark.createDataFrame([(1, "some text", None, "s", 1)], DOCS)
    assert [tuple(r) for r in G.report(none).collect()] == [(1, crc(1, 4) == 2, "und", 0.0)]
    one = spark.createDataFrame([(i, "some text", "xx", "s", 1) for i in range(9)], DOCS)
    assert {(r.lang_pred, r.score) for r in G.report(one).collect()} == {("xx", 1.0)}
    assert G.report(none.limit(0)).collect() == []


def test_lm_base_matches_brute_force_and_model_beats_uniform(spark, monkeypatch):
    from conftest import SF_SMALL
    monkeypatch.setattr(M, "FREQUENT", 2000)  # the join of rarer words takes part
    extra = spark.createDataFrame([(None, "the and", "en", "s", 1), (-1, None, "en", "s", 1), (-2, "", "fr", "s", 1)], DOCS)
    docs = documents(spark, SF_SMALL).unionByName(extra).withColumn("base", F.lit(1)).withColumn("row", F.lit("r"))
    texts = {r.doc_id: (r.text or "").encode().lower().split() + [b"\n"] for r in docs.select("doc_id", "text").collect()}
    c = Counter(w for i, ws in texts.items() if i is not None and crc(i, 5) != 1 for w in ws)
    n, v = sum(c.values()), len(c)
    got = M.report(docs, RANKS, P.PATTERN).collect()
    assert len(got) == len(texts)
    for r in got:
        ws = texts[r.doc_id]
        base = sum(math.log10((c.get(w, 0) + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        assert abs(base - r.base_score) < 1e-6 * abs(base)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(w in c for w in ws), n)
        assert r.held_out == (r.doc_id is not None and crc(r.doc_id, 5) == 1) and r.score < 0
    pieces = M.Pieces(RANKS, P.PATTERN)
    places = [pieces.look_up(w) for w in texts.values()]  # before ``n`` is read: new words extend it
    ids = sum(int(pieces.n[at].sum()) for at in places)
    assert sum(r.score for r in got) > -ids * math.log10(pieces.size) * 0.6


def test_lm_score_does_not_depend_on_which_counts_are_broadcast(spark, monkeypatch):
    from conftest import SF_SMALL
    monkeypatch.setattr(M, "ROUNDS", 1)
    docs, got = documents(spark, SF_SMALL), []
    for frequent in (50, 1 << 21):
        monkeypatch.setattr(M, "FREQUENT", frequent)
        got.append({r.doc_id: r for r in M.report(docs, RANKS, P.PATTERN).collect()})
    few, all_ = got
    assert few.keys() == all_.keys()
    for i, r in few.items():
        assert r.n_known == all_[i].n_known and abs(r.score - all_[i].score) < 1e-6 * abs(r.score)


def vocabulary_of(texts):
    pieces = M.Pieces(RANKS, P.PATTERN)
    ids, lens, _, per, _ = M.sequences(texts, pieces)
    begins = np.array([pieces.enc.decode_single_token_bytes(i)[:1] == b" " for i in range(pieces.size)])
    return M.Vocabulary(np.bincount(ids, minlength=pieces.size + 1), begins), ids, lens, per


def test_lm_words_encoded_together_have_their_own_ids():
    pieces = M.Pieces(RANKS, P.PATTERN)
    odd = ["it's", "a\u3000b", "\u3000", "\xa0x", "x\u2003", "12ab", "!?", "é", "日本", "\x1c", "#$%", "'", "'s", "\x00"]
    words = [w.encode() for i in range(40) for w in (f"w{i}", odd[i % len(odd)] + str(i), odd[i % len(odd)])] + [M.END]
    flat, n = pieces._ids(words)
    want = [[pieces.size] if w == M.END else pieces.enc.encode_ordinary(" " + w.decode()) for w in words]
    assert n.tolist() == [len(x) for x in want] and flat.tolist() == [i for x in want for i in x]


def test_lm_rounds_average_the_steps_of_all_tasks(spark, monkeypatch):
    monkeypatch.setattr(M, "ROUNDS", 2)
    texts = [f"word{i % 7} other text {i} {'and so on ' * (i % 5)}".encode() for i in range(60)]
    vocabulary, *_ = vocabulary_of(texts)
    rows = spark.createDataFrame([(t.decode(),) for t in texts], "text string").repartition(3).cache()
    parts = [[r.text.encode() for r in p] for p in rows.rdd.glom().collect()]
    want = M.Attention(vocabulary.bias)
    for t in range(2):
        sums = 0
        for part in filter(None, parts):
            own = M.Attention(vocabulary.bias)
            own.p = {k: v.copy() for k, v in want.p.items()}
            pieces = M.Pieces(RANKS, P.PATTERN)
            coded = [vocabulary.symbol[M.sequences([x], pieces)[0]].astype("<u4").tobytes() for x in part]
            n = M.local_steps(own, iter([coded]), M.RATE * (1 - t / 2))
            sums = sums + np.append(own.flat().astype(np.float64) * n, n)
        want.take(sums[:-1] / sums[-1])
    # one learner for each part: what Spark sums in any order
    got = M.fit_network(rows, vocabulary, RANKS, P.PATTERN)
    assert max(np.abs(got.p[k] - M.Attention(vocabulary.bias).p[k]).max() for k in got.p) > 1e-3
    assert all(np.allclose(got.p[k], want.p[k], atol=2e-3) for k in got.p)
    assert {k: v.shape for k, v in M.fit_network(rows.limit(0), vocabulary, RANKS, P.PATTERN).p.items()} == {k: v.shape for k, v in got.p.items()}


def test_lm_probabilities_within_classes(monkeypatch):
    monkeypatch.setattr(M, "OWN", 5)
    texts = [b"the cat sat on the mat and the dog ate a hat", b"unusual wording entirely", b"the the the mat mat"] * 3
    vocabulary, ids, lens, per = vocabulary_of(texts)
    assert len(np.unique(vocabulary.symbol)) > 0.98 * len(vocabulary.symbol)  # nearly every id has a symbol of its own
    assert vocabulary.cls.max() < M.CLASSES and vocabulary.code.max() < M.CODES
    first = np.zeros(len(ids), bool)
    first[np.cumsum(per) - per] = True
    total = np.zeros((M.CLASSES, M.CLASSES))
    counts = Counter()
    for k, i in enumerate(ids):
        before = 0 if first[k] else vocabulary.cls[ids[k - 1]]
        if vocabulary.cls[i] > M.OWN:
            counts[before, i] += 1
            total[before, vocabulary.cls[i]] += 1
    kept = [(k, n) for k, n in counts.most_common(len(counts) // 2 + 1)]
    vocabulary.after(np.array([a * len(vocabulary.alone) + i for (a, i), _ in kept]), np.array([n for _, n in kept]), total)
    for before in {a for a, _ in counts}:
        for of in {vocabulary.cls[i] for _, i in counts}:
            members = np.flatnonzero(vocabulary.cls == of)
            pairs = np.ravel(np.column_stack([np.full(len(members), np.flatnonzero(vocabulary.cls == before)[0]), members]))
            p = np.exp(vocabulary.within(pairs, np.zeros(len(pairs), bool))[1::2])
            assert abs(p.sum() - 1) < 1e-6


def test_lm_weight_is_the_most_likely_over_all_words(spark):
    rng = np.random.default_rng(4)
    logs, c, n = rng.uniform(-12, -1, 500).astype(np.float32).astype(float), rng.integers(0, 60, 500), 2000
    out = spark.createDataFrame([(True, logs[:300].tolist(), c[:300].tolist()), (False, [-1.0], [1])],
                                "learned boolean, logs array<float>, c array<long>")
    rare = spark.createDataFrame([(True, float(a), int(b)) for a, b in zip(logs[300:], c[300:])], "learned boolean, logs float, c long")
    share = np.maximum(c - 1, 0) / n
    tried = np.linspace(0.01, 0.99, 9801)
    best = tried[np.argmax([M.mixed(logs, share, w).sum() for w in tried])]
    assert abs(M.fit_weight(out, rare, n) - best) < 1e-3


def test_lm_windows_score_once_and_are_causal():
    lens = np.array([1, 5, 32, 33, 56, 57, 200])
    classes = np.random.default_rng(1).integers(1, M.CLASSES * M.CODES, lens.sum())
    of, x, y, ok, at = M.framed(classes, lens)
    assert (np.bincount(at[ok], minlength=lens.sum()) == 1).all()
    assert (y[ok] == classes[at[ok]]).all()
    begin = np.cumsum(lens) - lens
    assert all(x[w, p] == (0 if at[w, p] == begin[of[w]] else classes[at[w, p] - 1]) for w, p in zip(*np.nonzero(ok)))
    model = M.Attention(np.zeros(M.CLASSES))
    changed = x.copy()
    changed[:, 20] = 7
    a, b = (model.hidden(*(m[i] for i in (0, -1)))[2].reshape(len(x), M.WIDTH, -1)
            for m in (model.attend(x), model.attend(changed)))
    assert np.allclose(a[:, :20], b[:, :20], atol=1e-5) and not np.allclose(a[:, 20:], b[:, 20:], atol=1e-3)
    every = np.ones((1, M.WIDTH), bool)
    z = [model.log_prob(x[:1], np.full((1, M.WIDTH), k), every) for k in range(M.CLASSES)]
    assert np.allclose(np.exp(z).sum(axis=0), 1, atol=1e-4)


def test_lm_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(3)
    model = M.Attention(np.zeros(M.CLASSES))
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    x, y = rng.integers(0, M.CLASSES * M.CODES, (2, 3, M.WIDTH))
    ok = rng.random((3, M.WIDTH)) < 0.8
    _, grad = model.gradients(x, y, ok)
    for name, value in model.p.items():
        flat = value.reshape(-1)
        i = int(np.argmax(np.abs(grad[name].reshape(-1))))
        flat[i] += 1e-5
        up, _ = model.gradients(x, y, ok)
        flat[i] -= 2e-5
        down, _ = model.gradients(x, y, ok)
        flat[i] += 1e-5
        assert abs((up - down) / 2e-5 - grad[name].reshape(-1)[i]) < 1e-4, name


def test_lm_texts_are_coded_and_scored_once(spark, monkeypatch):
    calls, names = Counter(), []
    for name in ("_scored", "_coded", "_symbols"):
        def counted(*args, of=getattr(M, name, None), name=name):
            calls[name] += 1
            return of(*args)
        monkeypatch.setattr(M, name, counted, raising=False)
    for name in ("written", "keep"):
        monkeypatch.setattr(M, name, lambda df, table, of=getattr(M, name, None), **options: (names.append(table), of(df, table, **options))[1], raising=False)
    docs = spark.createDataFrame([(i, f"word{i % 7} it's a\u3000b {'rare' + str(i)} \xa0x" if i % 9 else None) for i in range(60)], "doc_id long, text string")
    rows = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = M.report(docs.unionByName(docs), RANKS, P.PATTERN).collect()
    assert len(got) == 120 and len({tuple(r) for r in got}) == 60  # repeated rows are scored alike
    assert calls == {"_coded": 1, "_scored": 1} and names.count("lm-scored") == 1
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == rows


def test_lm_id_and_pair_counts_match_brute_force():
    pieces = M.Pieces(RANKS, P.PATTERN)
    cls = np.append(np.arange(pieces.size) % M.CLASSES, 0)
    words = [w.encode() for i in range(300) for w in (f"w{i}", "a\u3000b" + str(i), f"it's{i}", "\xa0x")] + [M.END]
    c = np.arange(1, len(words) + 1)
    batch = pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(c)], names=["word", "c"])
    ids, pairs = Counter(), Counter()
    for w, n in zip(words, c.tolist()):
        before = 0
        for i in [pieces.size] if w == M.END else pieces.enc.encode_ordinary(" " + w.decode()):
            ids[i] += n
            if cls[i] > M.OWN:
                pairs[(before * M.CLASSES + int(cls[i])) * len(cls) + i] += n
            before = int(cls[i])
    assert {i: n for b in M._id_counts(RANKS, P.PATTERN)(iter([batch])) for i, n in zip(*(x.to_pylist() for x in b.columns))} == ids
    got = Counter()
    for b in M._pair_counts(RANKS, P.PATTERN, cls)(iter([batch.slice(0, 500), batch.slice(500)])):
        for k, n in zip(*(x.to_pylist() for x in b.columns)):
            got[k] += n
    assert got == pairs
    assert list(M._pair_counts(RANKS, P.PATTERN, cls)(iter([]))) == []


def test_lm_empty(spark):
    assert M.report(spark.createDataFrame([], DOCS), RANKS, P.PATTERN).collect() == []


def test_url_hosts_and_paths(spark):
    d = datetime.date(2024, 6, 1)
    entries = [(k, "add", datetime.date(2024, 1, 1)) for k in ("evil.com", "[::1]", "deep.org/a/b/c/d/e", "x.net/p")]
    urls = {"http://good.com@evil.com/x": "evil.com", "http://user:pw@evil.com/x": "evil.com", "http://evil.com./x": "evil.com",
            "http://a@b@sub.evil.com..:8080?q": "evil.com", "http://evil.com#f": "evil.com", "http://evil.com:": "evil.com",
            "http://[::1]:80/x": "[::1]", "http://u@[::1]": "[::1]", "http://deep.org/a/b/c/d/e/f": "deep.org/a/b/c/d/e",
            "http://deep.org//a/b/c/d/e?x": "deep.org/a/b/c/d/e", "http://deep.org/a/b/c/d": None, "http://x.net:99/p#q": "x.net/p",
            "http://evil.com:port/x": None, "http://evil.com.good.com/": None, "http://good.com/@evil.com": None, "http://good.com/?u@evil.com": None,
            "http://localhost/p": None, "evil.com/x": None, "": None}
    cap = spark.createDataFrame([(u, d) for u in urls], "url string, fetched date")
    for c in ("row", "date", "key", "month", "_url", "_date", "n_listed", "listed_key", "valid_to"):
        cap = cap.withColumn(c, F.lit("own"))
    out = U.as_of(cap, spark.createDataFrame(entries, "key string, action string, date date"))
    assert {r.url: r.listed_key for r in out.collect()} == urls
    assert sorted(out.columns) == sorted(cap.columns) and {(r._url, r.row, r.month) for r in out.collect()} == {("own", "own", "own")}


def test_url_filters_as_of(spark):
    d = datetime.date
    entries = [("bad.com", "add", d(2024, 1, 10)), ("bad.com", "remove", d(2024, 2, 10)), ("bad.com", "add", d(2024, 5, 1)),
               ("bad.com", "add", d(2024, 5, 1)), ("ok.org/ads/x", "add", d(2024, 1, 1)), (None, "add", d(2024, 1, 1)),
               ("t.com", "remove", d(2024, 3, 1)), ("t.com", "add", d(2024, 3, 1)), ("n.com", "add", None)]
    pages = [(1, "http://a.bad.com/x", d(2024, 1, 9)), (2, "HTTPS://a.BAD.com:80/x?q", d(2024, 1, 10)), (3, "http://bad.com", d(2024, 2, 9)),
             (4, "http://bad.com", d(2024, 2, 10)), (5, "http://bad.com", d(2025, 7, 1)), (6, "http://ok.org/ads/x/1", d(2024, 6, 1)),
             (7, "http://ok.org/ads", d(2024, 6, 1)), (8, None, d(2024, 6, 1)), (9, "nothing", d(2024, 6, 1)), (10, "http://bad.com", None),
             (11, "http://t.com/a", d(2024, 3, 1)), (5, "http://bad.com", d(2025, 7, 1)), (None, "http://notbad.com", d(2025, 7, 1))]
    cap = spark.createDataFrame(pages, "page_id long, url string, fetched date").withColumn("key", F.lit(1)).withColumn("month", F.lit(2))
    out = U.as_of(cap, spark.createDataFrame(entries, "key string, action string, date date"))
    got = Counter((r.page_id, r.n_listed, r.listed_key) for r in out.collect())
    assert out.columns == [*cap.columns, "n_listed", "listed_key"]
    assert got == Counter([(1, 0, None), (2, 1, "bad.com"), (3, 1, "bad.com"), (4, 0, None), (5, 1, "bad.com"), (5, 1, "bad.com"),
                           (6, 1, "ok.org/ads/x"), (7, 0, None), (8, 0, None), (9, 0, None), (10, 0, None), (11, 1, "t.com"), (None, 0, None)])
    assert U.as_of(cap.limit(0), spark.createDataFrame(entries, "key string, action string, date date")).collect() == []
    assert U.as_of(cap, spark.createDataFrame([], "key string, action string, date date")).filter("n_listed > 0").collect() == []


def test_license_scan_draws_copies_once_and_needs_no_negatives(spark, monkeypatch):
    notice = "Released under the MIT License."
    monkeypatch.setattr(S, "TRAIN_DOCS", 20)
    monkeypatch.setattr(S, "HELD_DOCS", 10)
    hot = [(i, "one long plain line of a hot group\n" + notice, "en", "s", 1) for i in range(300)]
    own = [(1000 + i, f"plain line number {i} of an own text", "en", "s", 1) for i in range(60)]
    drawn = S._drawn(spark.createDataFrame(hot + own, DOCS)).collect()
    assert len(drawn) == len({r.text for r in drawn}) == 30 and {r.held for r in drawn} == {True, False}
    for rows in (hot, [(i, notice, "en", "s", 1) for i in range(5)]):  # one text, and none without a licence
        got = {(r.doc_id, r.line_no): r.family for r in S.report(spark.createDataFrame(rows, DOCS)).collect()}
        assert got == {(r[0], r[1].split("\n").index(notice)): "mit" for r in rows}


def test_license_scan(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    known = {"Licensed under CC BY-NC 4.0.": "cc-by-nc", "Released under the MIT License.": "mit", "All rights reserved.": "proprietary",
             "This work is licensed under the GNU General Public License, version 3.": "gpl",
             "Licensed under the Apache License, Version 2.0.": "apache"}
    extra = [(-1, "plain words\n(c) 2020. All rights reserved.", "en", "s", 1), (-2, None, "en", "s", 1), (-3, "", "en", "s", 1),
             (-4, "the license of the public version of general terms", "en", "s", 1), (-5, "All rights reserved.\nAll rights reserved.", "en", "s", 1)]
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(spark.createDataFrame(extra, DOCS))
    found = {(r.doc_id, r.line_no): r.family for r in S.report(docs.withColumn("line", F.lit("x")).withColumn("n", F.lit(0))).collect()}
    want = {(r.doc_id, i): known[x] for r in docs.select("doc_id", "text").collect()
            for i, x in enumerate((r.text or "").split("\n")) if x in known}
    assert {k: v for k, v in found.items() if k[0] >= 0} == {k: v for k, v in want.items() if k[0] >= 0}
    assert found[(-1, 1)] == "proprietary" and found[(-5, 0)] == found[(-5, 1)] == "proprietary"
    assert not any(k[0] in (-2, -3, -4) for k in found) and not re.search("mit|gpl", str(found.get((-4, 0))))
    assert S.report(docs.limit(0)).collect() == []


def test_network_learns_from_every_training_document(spark, monkeypatch):
    class Seen(Exception):
        pass

    def fit(rows, *_):
        raise Seen(rows.count())

    monkeypatch.setattr(M, "fit_network", fit)
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.concat(F.lit("one word and "), F.col("id").cast("string")).alias("text"))
    with pytest.raises(Seen) as found:
        M.report(docs, RANKS, P.PATTERN)
    assert found.value.args[0] == docs.filter(~M.held_out()).count() > 4000


def test_lm_scores_are_products_of_one_shape(monkeypatch):
    """A window has the same bits alone and among others, and no product depends on their number."""
    rng = np.random.default_rng(6)
    model = M.Attention(np.log(rng.random(M.CLASSES) + 0.1))
    x, y = (rng.integers(0, M.CLASSES * M.CODES, (70, M.WIDTH)).astype(np.uint32) for _ in range(2))
    ok = rng.random((70, M.WIDTH)) < 0.5
    every, shapes = model.log_prob(x, y, ok), set()
    product = np.matmul
    monkeypatch.setattr(M.np, "matmul", lambda a, b, **to: (shapes.add((a.shape[-2:], b.shape[-2:])), product(a, b, **to))[1])
    for n in (1, 2, 33, 70):
        assert (model.log_prob(x[:n], y[:n], ok[:n]) == every[:ok[:n].sum()]).all()
    assert {a[0] for a, _ in shapes} == {M.ALIKE, M.EACH}
