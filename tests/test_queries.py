"""Every query of the engine against its DuckDB oracle on sf0.001 (the one without an oracle is
held against its input); determinism of the split and vocabulary under different shuffle widths.
The training-data queries are tested in tests/llm."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from parallax.catalog import ORACLE
from parallax.sources.tables import TABLES


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return tuple(map(_norm, v)) if isinstance(v, list) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["side", "token", "n", "rank"]
    assert df.count() > 0


def test_lattice_tokens_join_to_the_plain_ones(spark):
    lattice = E.queries()["tokenize_lattice"](spark, SF_SMALL).collect()
    plain = {r.pair_id: r.src_tokens for r in E.queries()["tokenize"](spark, SF_SMALL).collect()}
    assert len(lattice) == len(plain)
    assert all(r.src_tokens.replace(" ", "") == plain[r.pair_id].replace(" ", "") for r in lattice)
    assert sum(r.n_src for r in lattice) > sum(len(t.split()) for t in plain.values())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    srows = Counter(tuple(_norm(r[c]) for c in cols) for r in (x.asDict() for x in sdf.collect()))
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == cols
    drows = Counter(tuple(_norm(dict(zip(dcols, r))[c]) for c in cols) for r in res.fetchall())
    assert srows == drows


@pytest.mark.parametrize("parts", ["1", "4", "200"])
def test_determinism(spark, parts):
    from parallax.operators.corpus import exact_split
    from parallax.operators.vocab import build_pair_vocabs
    from parallax.plans import prep as P
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        sp = exact_split(P.pairs_union(spark, SF_SMALL))
        got = sorted((r.pair_id, r.rn, r.split) for r in sp.collect())
        vs, _ = build_pair_vocabs(sp)
        voc = sorted((r.id, r.token) for r in vs.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    ref_sp = sorted((r.pair_id, r.rn, r.split) for r in E.queries()["split_rank"](spark, SF_SMALL).collect())
    cut = sorted((r.pair_id, r.split) for r in E.queries()["split_exact"](spark, SF_SMALL).collect())
    assert cut == [(p, s) for p, _, s in got]
    ref_v = sorted((r.id, r.token) for r in E.queries()["vocab_src"](spark, SF_SMALL).collect())
    assert got == ref_sp and voc == ref_v
