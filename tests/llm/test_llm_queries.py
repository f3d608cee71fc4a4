"""Registered training-data queries on sf0.001, and the pipeline stage by stage."""

import math
from collections import Counter

import duckdb
import pytest
import public_tokenizers as P
from pyspark.sql import functions as F

import corpus_pipeline as C
from conftest import SF_SMALL
from parallax.llm import bpe_codec, decontaminate, line_dedup
from parallax.llm.common import documents
from parallax.llm.queries import ORACLE, QUERIES
from parallax.llm.quality_rules import report
from test_jaccard_join import brute

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return tuple(map(norm, v)) if isinstance(v, list) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF_SMALL)
    columns = sorted(got.columns)
    rows = Counter(tuple(norm(r[c]) for c in columns) for r in got.collect())
    found = duck.execute(ORACLE[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    assert rows == Counter(tuple(norm(dict(zip(names, r))[c]) for c in columns) for r in found.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - {"op10_license_scan"}))
def test_query_has_a_row_for_each_document(spark, name):
    ids = [r.doc_id for r in documents(spark, SF_SMALL).select("doc_id").collect()]
    assert sorted(r.doc_id for r in QUERIES[name](spark, SF_SMALL).select("doc_id").collect()) == sorted(ids)


def rows_of(df):
    return Counter(tuple(norm(v) for v in r) for r in df.collect())


def test_pipeline_stage_by_stage(spark):
    """Each stage against its rule on what the one before kept; the stages together against run."""
    docs = documents(spark, SF_SMALL)
    for name in ("row", "bytes", "_before", "_bytes", "lines", "key", "node"):
        docs = docs.withColumn(name, F.lit(name))
    docs = docs.unionByName(spark.createDataFrame([(-1, None, "en", "s", 0), (None, "a b", None, None, 3)], DOCS), allowMissingColumns=True).cache()

    kept = C.quality(spark, docs, SF_SMALL).cache()
    judged = Counter((r.doc_id for r in report(docs).filter("kept").collect()))
    assert kept.columns == docs.columns and Counter(r.doc_id for r in kept.collect()) == judged and 0 < len(judged) < docs.count()

    clean = C.lines(spark, kept, SF_SMALL).cache()
    texts = {r.doc_id: r.text for r in line_dedup.drop_boilerplate(kept, "source").collect()}
    before = {r.doc_id: (r.text, r.n_chars) for r in kept.collect()}
    assert clean.columns == docs.columns
    for r in clean.collect():
        assert r.text == texts[r.doc_id] and r._before == "_before"
        assert r.n_chars == (before[r.doc_id][1] if r.text == before[r.doc_id][0] else len(r.text))

    one = C.near_duplicates(spark, clean, SF_SMALL).cache()
    want = brute([(r.doc_id, r.text) for r in clean.collect()], 5, 80)
    assert sorted(r.doc_id for r in one.collect()) == sorted(d for d, _, c in want if d == c)

    good = C.decontamination(spark, one, SF_SMALL).cache()
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    bad = {r.doc_id for r in decontaminate.leaks(one, items).collect()}
    assert sorted(r.doc_id for r in good.collect()) == sorted(r.doc_id for r in one.collect() if r.doc_id not in bad)

    out = C.encoding(spark, good, SF_SMALL).collect()
    enc = bpe_codec.encoding(C.RANKS, P.PATTERN)
    texts = {r.doc_id: r.text for r in good.collect()}
    assert all(r.ids == enc.encode_ordinary(texts[r.doc_id]) and r.n_tokens == len(r.ids) and r.round_trip and r.bytes == "bytes" for r in out)
    assert {r.doc_id for r in out} == set(texts)


def test_pipeline_run_and_its_result(spark):
    run = C.run(spark, SF_SMALL)
    docs = documents(spark, SF_SMALL)
    for _, stage in C.STAGES:
        docs = stage(spark, docs, SF_SMALL)
    assert run.columns == docs.columns and rows_of(run) == rows_of(docs) and run.count() > 0


def test_pipeline_on_an_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    for name, stage in C.STAGES:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.collect() == [], name


def test_pipeline_on_null_rows(spark):
    docs = spark.createDataFrame([(None, None, None, None, None), (1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0)], DOCS)
    assert C.quality(spark, docs, SF_SMALL).collect() == []
    assert rows_of(C.lines(spark, docs, SF_SMALL)) == rows_of(docs)
    assert C.near_duplicates(spark, docs, SF_SMALL).count() == 3  # of the rows that repeat id and text one stays
    assert C.decontamination(spark, docs, SF_SMALL).count() == 4
    assert {(tuple(r.ids), r.round_trip) for r in C.encoding(spark, docs, SF_SMALL).collect()} == {((), True)}
