"""Registered queries (Spark) and their DuckDB oracle SQL.

Each query is ``fn(spark, sf_dir) -> DataFrame`` and reads the given tables (or data
Spark derives from them) in full.  Column names and types are aligned with the
oracle: counts and ranks are bigint, doubles are rounded to 6 decimals, arrays are
emitted as space-joined strings.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parallax import oracle_sql as O
from parallax.functions.text import PAD_ID, get_tokenizer, ids_text, na_normalize, tokenize_script
from parallax.operators import buckets as BK
from parallax.operators import corpus as C
from parallax.operators import dictionary as D
from parallax.operators import vocab as V
from parallax.plans import prep as P
from parallax.plans import segmentation as SG
from parallax.session import release, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- 1. minimum slice
@query("token_counts", O.with_("pairs_a", extra=f"""
tc AS (
  SELECT 'src' AS side, t AS token FROM pairs_a, unnest({O.tok('src')}) AS u(t)
  UNION ALL SELECT 'tgt', t FROM pairs_a, unnest({O.tok('tgt')}) AS u(t)),
cnt AS (SELECT side, token, count(*) AS n FROM tc GROUP BY side, token)""") + """
SELECT side, token, n, CAST(row_number() OVER (PARTITION BY side ORDER BY n DESC, token) AS BIGINT) AS rank
FROM cnt""")
def q_token_counts(spark, sf):
    return V.token_counts(P.pairs_a_tokens(spark, sf), tokenizer=None, src="src_toks", tgt="tgt_toks")


# ---------------------------------------------------------------- 2. corpus
@query("na_normalize", O.with_("pb_raw") + f"""
SELECT pair_id, {O.na('line')} AS src, {O.na('next_line')} AS tgt FROM pb_raw""")
def q_na_normalize(spark, sf):
    raw = P.pairs_b_raw(spark, sf)
    return raw.select("pair_id", na_normalize("line").alias("src"), na_normalize("next_line").alias("tgt"))


@query("pairs_clean", O.with_("pairs_b") + "SELECT pair_id, src, tgt FROM pairs_b")
def q_pairs_clean(spark, sf):
    return P.pairs_b(spark, sf)


@query("pairs_union", O.with_("pairs_union") + "SELECT pair_id, src, tgt FROM pairs_union")
def q_pairs_union(spark, sf):
    return P.pairs_union(spark, sf)


@query("pairs_maxlen", O.with_("pairs_union") + f"""
SELECT pair_id, src, tgt, src_len, tgt_len FROM (
  SELECT pair_id, src, tgt, CAST(len({O.tok('src')}) AS BIGINT) AS src_len,
         CAST(len({O.tok('tgt')}) AS BIGINT) AS tgt_len FROM pairs_union)
WHERE src_len <= 80 AND tgt_len <= 78""")
def q_pairs_maxlen(spark, sf):
    return C.filter_max_len(P.pairs_union(spark, sf)).select("pair_id", "src", "tgt", "src_len", "tgt_len")


@query("split_exact", O.with_("split") + "SELECT pair_id, src, tgt, split FROM split")
def q_split_exact(spark, sf):
    return P.split(spark, sf).select("pair_id", "src", "tgt", "split")


@query("split_rank", O.with_("split") + "SELECT pair_id, rn, split FROM split")
def q_split_rank(spark, sf):
    return C.exact_split(P.split(spark, sf).select("pair_id")).select("pair_id", "rn", "split")


@query("split_counts", O.with_("split") + "SELECT split, count(*) AS n FROM split GROUP BY split")
def q_split_counts(spark, sf):
    return C.split_counts(P.split(spark, sf))


@query("split_leakage", O.with_("split", extra="""
flags AS (
  SELECT src, tgt, max(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS in_train,
         max(CASE WHEN split = 'val' THEN 1 ELSE 0 END) AS in_val,
         max(CASE WHEN split = 'test' THEN 1 ELSE 0 END) AS in_test
  FROM split GROUP BY src, tgt)""") + """
SELECT 'val' AS other_split, CAST(count(*) FILTER (WHERE in_train = 1 AND in_val = 1) AS BIGINT) AS n_shared FROM flags
UNION ALL
SELECT 'test', CAST(count(*) FILTER (WHERE in_train = 1 AND in_test = 1) AS BIGINT) FROM flags""")
def q_split_leakage(spark, sf):
    return C.split_leakage(P.split(spark, sf))


@query("tokenize", O.with_("pairs_union") + f"""
SELECT pair_id, array_to_string({O.tok('src')}, ' ') AS src_tokens, CAST(len({O.tok('src')}) AS BIGINT) AS n_src,
       array_to_string({O.tok('tgt')}, ' ') AS tgt_tokens, CAST(len({O.tok('tgt')}) AS BIGINT) AS n_tgt
FROM pairs_union""")
def q_tokenize(spark, sf):
    tok = get_tokenizer("words")
    df = P.pairs_union(spark, sf).select("pair_id", tok(F.col("src")).alias("src_toks"), tok(F.col("tgt")).alias("tgt_toks"))
    s, t = F.col("src_toks"), F.col("tgt_toks")
    return df.select("pair_id", F.array_join(s, " ").alias("src_tokens"), F.size(s).cast("long").alias("n_src"),
                     F.array_join(t, " ").alias("tgt_tokens"), F.size(t).cast("long").alias("n_tgt"))


@query("tokenize_ja", O.with_("pairs_union") + f"""
SELECT pair_id, array_to_string({O.tok_script('src')}, ' ') AS src_tokens, CAST(len({O.tok_script('src')}) AS BIGINT) AS n_src
FROM pairs_union""")
def q_tokenize_ja(spark, sf):
    df = P.pairs_union(spark, sf)
    t = tokenize_script("src")
    return df.select("pair_id", F.array_join(t, " ").alias("src_tokens"), F.size(t).cast("long").alias("n_src"))


@query("tokenize_lattice")  # rows-only: forward-backward sums and best paths have no plain SQL
def q_tokenize_lattice(spark, sf):
    """Runs of letters of all sources, segmented by a unigram lattice trained on them."""
    df = P.pairs_union(spark, sf).select("pair_id", "src")
    SG.register_lattice(df, "src", "lattice", every=True)
    tokens = df.select("pair_id", get_tokenizer("lattice")(F.col("src")).alias("toks"))
    return tokens.select("pair_id", F.array_join("toks", " ").alias("src_tokens"), F.size("toks").cast("long").alias("n_src"))


# ---------------------------------------------------------------- 3. encoding
@query("vocab_src", O.with_("vocabs") + "SELECT id, token, freq FROM vocab_src")
def q_vocab_src(spark, sf):
    return P.vocabs(spark, sf)[0]


@query("vocab_tgt", O.with_("vocabs") + "SELECT id, token, freq FROM vocab_tgt")
def q_vocab_tgt(spark, sf):
    return P.vocabs(spark, sf)[1]


@query("vocab_size", O.with_("vocabs") + """
SELECT 'src' AS side, count(*) AS n FROM vocab_src UNION ALL SELECT 'tgt', count(*) FROM vocab_tgt""")
def q_vocab_size(spark, sf):
    vs, vt = P.vocabs(spark, sf)
    return V.vocab_size(vs, "src").unionByName(V.vocab_size(vt, "tgt"))


@query("vocab_size_approx", O.with_("side_tokens", extra="""
vx AS (SELECT split, side, token FROM side_tokens UNION ALL
       SELECT 'train+val', side, token FROM side_tokens WHERE split <> 'test' UNION ALL SELECT 'all', side, token FROM side_tokens)""") + """
SELECT split, side, count(DISTINCT token) AS n, TRUE AS within FROM vx GROUP BY split, side""")
def q_vocab_size_approx(spark, sf):
    """Distinct tokens by split and side, by merged sketches, held against exact counts."""
    sketches = V.token_sketches(P.split(spark, sf), tokenizer=None, src="src_toks", tgt="tgt_toks")
    path = scratch_path(spark, "token-sketches")
    sketches.write.parquet(path)
    stored = spark.read.parquet(path)
    toks = V.side_tokens(P.split(spark, sf), None, "src_toks", "tgt_toks", keep=["split"]).select("split", "side", "token").distinct()
    out = []
    for name, splits in {"train": ["train"], "val": ["val"], "test": ["test"], "train+val": ["train", "val"],
                         "all": ["train", "val", "test"]}.items():
        exact = (toks.filter(F.col("split").isin(splits)).select("side", "token").distinct()
                 .groupBy("side").agg(F.count("*").alias("n")))
        about = V.approx_vocab_size(stored.filter(F.col("split").isin(splits)))
        out.append(exact.join(about, "side").select(F.lit(name).alias("split"), "side", "n",
                                                    (F.abs(F.col("about") - F.col("n")) <= V.SKETCH_ERROR * F.col("n")).alias("within")))
    return reduce(DataFrame.unionAll, out)


def _encoded(spark, sf):
    vs, vt = P.vocabs(spark, sf)
    return V.encode_pairs(P.split_once(spark, sf), vs, vt, tokenizer=None, src="src_toks", tgt="tgt_toks", carry=("split",), again=True)


@query("encode", O.with_("encoded") + """
SELECT pair_id, split, array_to_string(src_ids, ' ') AS src_ids, array_to_string(tgt_ids, ' ') AS tgt_ids
FROM encoded""")
def q_encode(spark, sf):
    e = _encoded(spark, sf)
    return e.select("pair_id", "split", ids_text("src_ids").alias("src_ids"), ids_text("tgt_ids").alias("tgt_ids"))


@query("decode_ids", O.with_("encoded", extra="""
cut AS (
  SELECT pair_id, CASE WHEN list_position(tgt_ids, 3) IS NOT NULL
                       THEN tgt_ids[1:list_position(tgt_ids, 3) - 1] ELSE tgt_ids END AS ids
  FROM encoded),
dl AS (SELECT pair_id, u.id, u.pos FROM cut, unnest(list_filter(ids, lambda x: x <> 2)) WITH ORDINALITY AS u(id, pos))""") + """
SELECT c.pair_id, COALESCE((SELECT string_agg(v.token, ' ' ORDER BY d.pos) FROM dl d JOIN vocab_tgt v ON v.id = d.id
                            WHERE d.pair_id = c.pair_id), '') AS text
FROM cut c""")
def q_decode_ids(spark, sf):
    return V.decode_ids(_encoded(spark, sf), "tgt_ids", P.vocabs(spark, sf)[1])


@query("oov_report", O.with_("vocabs") + """
SELECT s.split, s.side, CAST(count(*) AS BIGINT) AS oov_tokens, CAST(count(DISTINCT s.token) AS BIGINT) AS oov_types
FROM side_tokens s LEFT JOIN vocab_all v ON s.side = v.side AND s.token = v.token
WHERE v.token IS NULL GROUP BY s.split, s.side""")
def q_oov_report(spark, sf):
    sp = P.split(spark, sf)
    vs, vt = P.vocabs(spark, sf)
    return V.oov_report(sp, vs, vt, tokenizer=None, src="src_toks", tgt="tgt_toks")


@query("teacher_forcing", O.with_("encoded") + """
SELECT pair_id, CAST(u.pos - 1 AS BIGINT) AS pos, u.in_id, tgt_ids[u.pos + 1] AS out_id
FROM encoded, unnest(tgt_ids[1:len(tgt_ids) - 1]) WITH ORDINALITY AS u(in_id, pos)
WHERE split = 'train'""")
def q_teacher_forcing(spark, sf):
    e = _encoded(spark, sf).filter(F.col("split") == "train")
    n = F.size("tgt_ids")
    io = e.select("pair_id", F.arrays_zip(F.slice("tgt_ids", 1, n - 1).alias("in_id"),
                                          F.slice("tgt_ids", 2, n - 1).alias("out_id")).alias("z"))
    return io.select("pair_id", F.posexplode("z").alias("pos", "r")).select(
        "pair_id", F.col("pos").cast("long").alias("pos"), F.col("r.in_id").alias("in_id"),
        F.col("r.out_id").alias("out_id"))


@query("length_hist", O.with_("pairs_union") + f"""
SELECT side, len, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT 'src' AS side, CAST(len({O.tok('src')}) AS BIGINT) AS len FROM pairs_union
  UNION ALL SELECT 'tgt', CAST(len({O.tok('tgt')}) AS BIGINT) FROM pairs_union) GROUP BY side, len""")
def q_length_hist(spark, sf):
    df = C.with_lengths(P.pairs_union(spark, sf))
    long = df.select(F.explode(F.array(F.struct(F.lit("src").alias("side"), F.col("src_len").alias("len")),
                                       F.struct(F.lit("tgt").alias("side"), F.col("tgt_len").alias("len"))))
                     .alias("r")).select("r.side", "r.len")
    return long.groupBy("side", "len").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- 4. batching (whole pairs_a, one pool)
from parallax.operators import batching as B  # noqa: E402

O.register("pa_len", f"""
pa_len AS (
  SELECT pair_id, src, tgt, CAST(len({O.tok('src')}) AS BIGINT) AS s, CAST(len({O.tok('tgt')}) AS BIGINT) AS t,
         row_number() OVER (ORDER BY md5('42:' || pair_id), pair_id) AS rn
  FROM pairs_a)""", ["pairs_a"])


def _fold_sql(name: str, order: str, budget: int = B.TOKEN_BUDGET) -> str:
    return f"""
{name}_ord AS (SELECT *, row_number() OVER (ORDER BY {order}) AS k FROM pa_len),
{name}_fold(k, pair_id, batch_id, cnt, ms, mt, closed) AS (
  SELECT k, pair_id, 0::BIGINT, 1::BIGINT, s, t + 2, greatest(s, t + 2) = {budget} FROM {name}_ord WHERE k = 1
  UNION ALL
  SELECT k, pair_id,
         CASE WHEN nb THEN batch_id + 1 ELSE batch_id END,
         CASE WHEN nb THEN 1 ELSE cnt + 1 END,
         CASE WHEN nb THEN s ELSE ms2 END,
         CASE WHEN nb THEN t2 ELSE mt2 END,
         CASE WHEN nb THEN greatest(s, t2) = {budget} ELSE cost = {budget} END
  FROM (SELECT o.k, o.pair_id, o.s, o.t + 2 AS t2, f.batch_id, f.cnt,
               greatest(f.ms, o.s) AS ms2, greatest(f.mt, o.t + 2) AS mt2,
               (f.cnt + 1) * greatest(greatest(f.ms, o.s), greatest(f.mt, o.t + 2)) AS cost,
               f.closed OR (f.cnt + 1) * greatest(greatest(f.ms, o.s), greatest(f.mt, o.t + 2)) > {budget} AS nb
        FROM {name}_fold f JOIN {name}_ord o ON o.k = f.k + 1))"""


O.register("bud", _fold_sql("bud", "s, t, pair_id") + """,
bud_batches AS (
  SELECT f.pair_id, 0::BIGINT AS pool_id, f.batch_id,
         CAST(row_number() OVER (PARTITION BY f.batch_id ORDER BY f.k) - 1 AS BIGINT) AS row_in_batch
  FROM bud_fold f)""", ["pa_len"])
O.register("ev", _fold_sql("ev", "rn") + """,
ev_batches AS (
  SELECT f.pair_id, 0::BIGINT AS pool_id, f.batch_id,
         CAST(row_number() OVER (PARTITION BY f.batch_id ORDER BY o.s, o.t, o.pair_id) - 1 AS BIGINT) AS row_in_batch
  FROM ev_fold f JOIN ev_ord o ON o.k = f.k)""", ["pa_len"])
O.register("bud_order", """
bud_order AS (
  SELECT pool_id, batch_id,
         CAST(row_number() OVER (PARTITION BY pool_id ORDER BY md5('42:' || CAST(pool_id AS VARCHAR) || ':' || CAST(batch_id AS VARCHAR)), batch_id) - 1 AS BIGINT) AS batch_order
  FROM (SELECT DISTINCT pool_id, batch_id FROM bud_batches))""", ["bud"])
O.register("bud_padded", """
bud_enc AS (
  SELECT b.pair_id, b.pool_id, b.batch_id, e.src_ids, e.tgt_ids
  FROM bud_batches b JOIN encoded e ON e.pair_id = b.pair_id),
bud_padded AS (
  SELECT pair_id, pool_id, batch_id,
         list_concat(src_ids, list_transform(range(max(len(src_ids)) OVER w - len(src_ids)), lambda x: 1::BIGINT)) AS src_ids,
         list_concat(tgt_ids, list_transform(range(max(len(tgt_ids)) OVER w - len(tgt_ids)), lambda x: 1::BIGINT)) AS tgt_ids
  FROM bud_enc WINDOW w AS (PARTITION BY pool_id, batch_id))""", ["bud", "encoded"])


def _pa_ordered(spark, sf):
    return P.pairs_a_ordered(spark, sf)


def _budget(spark, sf, train=True):
    return B.budget_batches(_pa_ordered(spark, sf), train=train)


def _padded(spark, sf):
    vs, vt = P.vocabs(spark, sf)
    pa = P.pairs_a_tokens(spark, sf)
    enc = V.encode_pairs(pa, vs, vt, tokenizer=None, src="src_toks", tgt="tgt_toks")
    return B.pad_to_batch(_budget(spark, sf).join(enc, "pair_id"))


@query("batch_budget", O.with_("bud", recursive=True) + """
SELECT b.pair_id, b.pool_id, b.batch_id, b.row_in_batch, p.s AS src_len, p.t AS tgt_len
FROM bud_batches b JOIN pa_len p ON p.pair_id = b.pair_id""")
def q_batch_budget(spark, sf):
    pa = _pa_ordered(spark, sf)
    return B.budget_batches(pa).join(pa.select("pair_id", "src_len", "tgt_len"), "pair_id")


@query("batch_eval", O.with_("ev", recursive=True) + "SELECT pair_id, pool_id, batch_id, row_in_batch FROM ev_batches")
def q_batch_eval(spark, sf):
    return _budget(spark, sf, train=False)


@query("batch_bucket", O.with_("pa_len", extra="""
bk AS (SELECT pair_id, CAST(floor((rn - 1) / 2000) AS BIGINT) AS pool_id, s, t FROM pa_len),
bk2 AS (SELECT pair_id, pool_id, row_number() OVER (PARTITION BY pool_id ORDER BY t, pair_id) - 1 AS k FROM bk)""") + """
SELECT pair_id, pool_id, CAST(floor(k / 20) AS BIGINT) AS batch_id, CAST(k % 20 AS BIGINT) AS row_in_batch FROM bk2""")
def q_batch_bucket(spark, sf):
    return B.bucket_batches(_pa_ordered(spark, sf))


@query("batch_order", O.with_("bud_order", recursive=True) + "SELECT pool_id, batch_id, batch_order FROM bud_order")
def q_batch_order(spark, sf):
    return B.batch_order(_budget(spark, sf))


@query("first_batch", O.with_("bud_order", recursive=True) + """
SELECT b.pair_id, b.batch_id, b.row_in_batch FROM bud_batches b
JOIN bud_order o ON o.pool_id = b.pool_id AND o.batch_id = b.batch_id
WHERE b.pool_id = 0 AND o.batch_order = 0""")
def q_first_batch(spark, sf):
    return B.first_batch(B.budget_batches(B.first_pool(_pa_ordered(spark, sf))))


@query("pad_batch", O.with_("bud_padded", recursive=True) + """
SELECT pair_id, batch_id, array_to_string(src_ids, ' ') AS src_padded, array_to_string(tgt_ids, ' ') AS tgt_padded
FROM bud_padded""")
def q_pad_batch(spark, sf):
    p = _padded(spark, sf)
    return p.select("pair_id", "batch_id", ids_text("src_ids").alias("src_padded"), ids_text("tgt_ids").alias("tgt_padded"))


@query("pad_mask", O.with_("bud_padded", recursive=True) + """
SELECT pair_id,
       array_to_string(list_transform(src_ids, lambda x: CASE WHEN x <> 1 THEN '1' ELSE '0' END), '') AS src_mask,
       array_to_string(list_transform(tgt_ids, lambda x: CASE WHEN x <> 1 THEN '1' ELSE '0' END), '') AS tgt_mask
FROM bud_padded""")
def q_pad_mask(spark, sf):
    p = _padded(spark, sf)
    return p.select("pair_id", B.mask_text(B.pad_mask("src_ids")).alias("src_mask"),
                    B.mask_text(B.pad_mask("tgt_ids")).alias("tgt_mask"))


@query("mask_counts", O.with_("bud_padded", recursive=True, extra="""
mc AS (SELECT pair_id, batch_id, src_ids, tgt_ids[1:len(tgt_ids) - 1] AS t_in FROM bud_padded)""") + """
SELECT pair_id, batch_id,
       CAST(COALESCE((SELECT sum(CASE WHEN u.x <> 1 THEN len(t_in) - (u.j - 1) ELSE 0 END)
                      FROM unnest(t_in) WITH ORDINALITY AS u(x, j)), 0) AS BIGINT) AS n_causal,
       CAST(len(t_in) * len(list_filter(src_ids, lambda x: x <> 1)) AS BIGINT) AS n_cross,
       CAST(len(t_in) * len(t_in) AS BIGINT) AS n_cells
FROM mc""")
def q_mask_counts(spark, sf):
    return B.mask_counts(_padded(spark, sf))


@query("batch_stats", O.with_("bud", recursive=True) + """
SELECT b.pool_id, b.batch_id, count(*) AS n, CAST(max(p.s) AS BIGINT) AS max_src, CAST(max(p.t + 2) AS BIGINT) AS max_tgt,
       CAST(greatest(count(*) * max(p.s), count(*) * max(p.t + 2)) AS BIGINT) AS cost,
       round(1.0::DOUBLE - CAST(sum(p.s + p.t + 2) AS DOUBLE) / CAST(count(*) * max(p.s) + count(*) * max(p.t + 2) AS DOUBLE), 6) AS pad_share
FROM bud_batches b JOIN pa_len p ON p.pair_id = b.pair_id GROUP BY b.pool_id, b.batch_id""")
def q_batch_stats(spark, sf):
    return B.batch_stats(_budget(spark, sf), _pa_ordered(spark, sf))


# ---------------------------------------------------------------- 5. models and evaluation
from parallax.functions.text import EOS, SOS, UNK  # noqa: E402,F401
from parallax.plans import bigram as G  # noqa: E402
from parallax.plans import evaluation as EV  # noqa: E402
from parallax.plans import lexical as L  # noqa: E402
from parallax.sources import commits as CM  # noqa: E402
from parallax.sources.tables import table  # noqa: E402
from parallax.operators.ordering import sized_broadcast  # noqa: E402


def _lx_sql(iterations: int = L.ITERATIONS, source: str = "pairs_a", x: str = "lx") -> str:
    parts = [f"""
{x}_pairs AS (SELECT pair_id, {O.tok('src')} AS fs, {O.tok('tgt')} AS es FROM {source}),
{x}_f AS (SELECT pair_id, f, CAST(count(*) AS DOUBLE) AS nf FROM {x}_pairs, unnest(fs) AS u(f)
         GROUP BY pair_id, f),
{x}_e AS (SELECT pair_id, e, CAST(count(*) AS DOUBLE) AS ne FROM {x}_pairs, unnest(es) AS u(e)
         GROUP BY pair_id, e),
{x}_cooc AS (SELECT a.pair_id, a.f, a.nf, b.e, b.ne FROM {x}_f a JOIN {x}_e b ON a.pair_id = b.pair_id),
{x}_t0 AS (SELECT DISTINCT f, e, 1.0::DOUBLE AS t FROM {x}_cooc)"""]
    for i in range(1, iterations + 1):
        parts.append(f"""
{x}_j{i} AS (SELECT c.pair_id, c.f, c.e, c.nf, c.ne, t.t FROM {x}_cooc c JOIN {x}_t{i - 1} t ON c.f = t.f AND c.e = t.e),
{x}_z{i} AS (SELECT pair_id, e, sum(nf * t) AS z FROM {x}_j{i} GROUP BY pair_id, e),
{x}_c{i} AS (SELECT j.f, j.e, sum(j.ne * j.nf * j.t / z.z) AS c FROM {x}_j{i} j
            JOIN {x}_z{i} z ON j.pair_id = z.pair_id AND j.e = z.e GROUP BY j.f, j.e),
{x}_t{i} AS (SELECT f, e, c / sum(c) OVER (PARTITION BY f) AS t FROM {x}_c{i})""")
    parts.append(f"""
{x}_top AS (SELECT f, e, round(t, 6) AS t FROM (
  SELECT f, e, t, row_number() OVER (PARTITION BY f ORDER BY round(t, 6) DESC, e) AS r FROM {x}_t{iterations})
  WHERE r = 1)""")
    return ",".join(parts)


O.register("lexical", _lx_sql(), ["pairs_a"])
O.register("translated", f"""
tr_tok AS (SELECT p.pair_id, u.f, u.pos FROM pairs_a p, unnest({O.tok('src')}) WITH ORDINALITY AS u(f, pos)),
tr_map AS (SELECT t.pair_id, t.pos, COALESCE(x.e, t.f) AS w FROM tr_tok t LEFT JOIN lx_top x ON x.f = t.f),
tr_list AS (SELECT pair_id, list(w ORDER BY pos) AS hyp FROM tr_map GROUP BY pair_id),
translated AS (
  SELECT p.pair_id, COALESCE(array_to_string(l.hyp, ' '), '') AS translation,
         COALESCE(l.hyp, []::VARCHAR[]) AS hyp, {O.tok('p.tgt')} AS ref
  FROM pairs_a p LEFT JOIN tr_list l ON l.pair_id = p.pair_id)""", ["lexical"])


def _side_ngrams(col: str, h: int) -> str:
    return (f"SELECT b.pair_id, {h} AS h, k.n, u.gram FROM translated b CROSS JOIN (SELECT unnest([1, 2, 3, 4]) AS n) k, "
            f"unnest(list_transform(range(1, len(b.{col}) - k.n + 2), "
            f"lambda i: array_to_string(b.{col}[i:i + k.n - 1], ' '))) AS u(gram)")


O.register("bleu_parts", f"""
bl_ng AS ({_side_ngrams('hyp', 1)} UNION ALL {_side_ngrams('ref', 0)}),
bl_cnt AS (SELECT pair_id, n, gram, sum(h) AS ch, sum(1 - h) AS cr FROM bl_ng GROUP BY pair_id, n, gram),
bl_m AS (SELECT pair_id, n, sum(least(ch, cr)) AS m FROM bl_cnt WHERE ch > 0 AND cr > 0 GROUP BY pair_id, n),
bl_s AS (
  SELECT b.pair_id, CAST(len(b.hyp) AS BIGINT) AS c, CAST(len(b.ref) AS BIGINT) AS r,
         CAST(COALESCE(max(m.m) FILTER (WHERE m.n = 1), 0) AS BIGINT) AS m1,
         CAST(COALESCE(max(m.m) FILTER (WHERE m.n = 2), 0) AS BIGINT) AS m2,
         CAST(COALESCE(max(m.m) FILTER (WHERE m.n = 3), 0) AS BIGINT) AS m3,
         CAST(COALESCE(max(m.m) FILTER (WHERE m.n = 4), 0) AS BIGINT) AS m4
  FROM translated b LEFT JOIN bl_m m ON m.pair_id = b.pair_id GROUP BY b.pair_id, len(b.hyp), len(b.ref))""",
           ["translated"])


def _bleu_expr(m, t, c, r):
    logs = " + ".join(f"ln(CAST({m[i]} AS DOUBLE) / CAST({t[i]} AS DOUBLE))" for i in range(4))
    ok = " AND ".join(f"{m[i]} > 0" for i in range(4))
    bp = f"(CASE WHEN {c} > {r} THEN 1.0::DOUBLE ELSE exp(1.0::DOUBLE - CAST({r} AS DOUBLE) / CAST({c} AS DOUBLE)) END)"
    return f"CASE WHEN {ok} AND {c} > 0 THEN {bp} * exp(({logs}) / 4.0) ELSE 0.0::DOUBLE END", bp


def _lexical_top1(spark, sf):
    return P._memo(spark, sf, "lexical_top1",
                   lambda: L.train_top1(P.pairs_a_tokens(spark, sf), tokenizer=None,
                                        src="src_toks", tgt="tgt_toks").checkpoint(eager=True))


def _translated(spark, sf):
    pa = P.pairs_a_tokens(spark, sf)
    tr = L.translate(pa, _lexical_top1(spark, sf), tokenizer=None, text_col="src_toks", carry=("tgt_toks",))
    return tr.withColumnRenamed("tgt_toks", "ref")


@query("lexical_train", O.with_("lexical") + "SELECT f, e, t FROM lx_top")
def q_lexical_train(spark, sf):
    return _lexical_top1(spark, sf)


@query("lexical_resume", O.with_("lexical") + "SELECT f, e, t FROM lx_top")
def q_lexical_resume(spark, sf):
    """Two rounds saved as an epoch, loaded again (the last epoch), and one more round."""
    pairs, saved = P.pairs_a_tokens(spark, sf), scratch_path(spark, "lexical-epochs")
    kw = {"tokenizer": None, "src": "src_toks", "tgt": "tgt_toks"}
    CM.save_version(L.train_saved(pairs, 2, **kw), spark, saved, epoch=2)
    done, tables = CM.load_version(spark, saved, L.SAVED)
    return L.train_top1(pairs, 1, start=tables, done=done, **kw)


def _round_sql(i: int) -> str:
    return f"""
SELECT 'lexical' AS job, {i}::BIGINT AS step, (SELECT count(*) FROM lx_t{i}) AS n,
       round((SELECT sum(j.ne * j.nf * j.t / z.z * -ln(z.z)) / sum(j.ne * j.nf * j.t / z.z)
              FROM lx_j{i} j JOIN lx_z{i} z ON j.pair_id = z.pair_id AND j.e = z.e), 6) AS loss"""


@query("progress_log", O.with_("lexical", extra="""
pl_size AS (SELECT min(event_id)::DOUBLE AS lo, max(event_id)::DOUBLE AS hi, greatest(4, ceil(count(*) / 20000000.0))::BIGINT AS parts FROM events),
pl_events AS (
  SELECT value, least(floor((event_id - lo) / ((hi - lo) / parts)), parts - 1)::BIGINT AS step FROM events, pl_size)""")
       + " UNION ALL ".join(_round_sql(i) for i in range(1, L.ITERATIONS + 1)) + """
UNION ALL SELECT 'events', step, count(*), round(avg(value), 6) FROM pl_events GROUP BY step""")
def q_progress_log(spark, sf):
    """One row for each training round and for each micro-batch of the step stream; the last
    micro-batch is handed in twice and counts once."""
    log = CM.ProgressLog(spark, scratch_path(spark, "progress"))
    L.train_top1(P.pairs_a_tokens(spark, sf), tokenizer=None, src="src_toks", tgt="tgt_toks", log=log)
    staged, inp = scratch_path(spark, "steps-staged"), scratch_path(spark, "steps")
    ranges = ST.stage_ranges(table(spark, sf, "events").select("event_id", "value"), staged, "event_id")
    ST.stream_progress(spark, inp, ST.staged_schema(spark, staged), log, "events",
                       arrivals=ST.range_arrivals(spark, staged, ranges, inp), replay_last=True)
    return log.read().select("job", "step", "n", F.round("loss", 6).alias("loss"))


@query("translate_batch", O.with_("translated") + "SELECT pair_id, translation FROM translated")
def q_translate_batch(spark, sf):
    return _translated(spark, sf).select("pair_id", "translation")


_sb, _ = _bleu_expr(["m1", "m2", "m3", "m4"], [f"greatest(c - {n - 1}, 0)" for n in range(1, 5)], "c", "r")


@query("bleu_sentence", O.with_("bleu_parts") + f"SELECT pair_id, round({_sb}, 6) AS bleu FROM bl_s")
def q_bleu_sentence(spark, sf):
    tr = _translated(spark, sf).select("pair_id", F.col("translation_tokens").alias("hyp"), "ref")
    return EV.bleu_sentence(tr)


_cb, _cbp = _bleu_expr(["m1", "m2", "m3", "m4"], ["t1", "t2", "t3", "t4"], "hyp_len", "ref_len")


@query("bleu_corpus", O.with_("bleu_parts", extra="""
bl_tot AS (
  SELECT CAST(sum(c) AS BIGINT) AS hyp_len, CAST(sum(r) AS BIGINT) AS ref_len,
         CAST(sum(m1) AS BIGINT) AS m1, CAST(sum(m2) AS BIGINT) AS m2, CAST(sum(m3) AS BIGINT) AS m3, CAST(sum(m4) AS BIGINT) AS m4,
         CAST(sum(greatest(c, 0)) AS BIGINT) AS t1, CAST(sum(greatest(c - 1, 0)) AS BIGINT) AS t2,
         CAST(sum(greatest(c - 2, 0)) AS BIGINT) AS t3, CAST(sum(greatest(c - 3, 0)) AS BIGINT) AS t4
  FROM bl_s)""") + f"""
SELECT round({_cb}, 6) AS bleu, round(CASE WHEN hyp_len > 0 THEN {_cbp} ELSE 0.0 END, 6) AS bp,
       round(CASE WHEN t1 > 0 THEN m1 / t1 ELSE 0.0 END, 6) AS p1, round(CASE WHEN t2 > 0 THEN m2 / t2 ELSE 0.0 END, 6) AS p2,
       round(CASE WHEN t3 > 0 THEN m3 / t3 ELSE 0.0 END, 6) AS p3, round(CASE WHEN t4 > 0 THEN m4 / t4 ELSE 0.0 END, 6) AS p4,
       hyp_len, ref_len
FROM bl_tot""")
def q_bleu_corpus(spark, sf):
    tr = _translated(spark, sf).select("pair_id", F.col("translation_tokens").alias("hyp"), "ref")
    return EV.bleu_corpus(tr)


O.register("held_out", "lh_train AS (SELECT * FROM split WHERE split = 'train' AND pair_id LIKE 'c:%')," + _lx_sql(source="lh_train", x="lh") + f""",
lh_tok AS (SELECT p.pair_id, u.f, u.pos FROM split p, unnest({O.tok('src')}) WITH ORDINALITY AS u(f, pos)
           WHERE p.split <> 'train' AND p.pair_id LIKE 'c:%'),
lh_list AS (SELECT t.pair_id, list(COALESCE(x.e, t.f) ORDER BY t.pos) AS hyp FROM lh_tok t LEFT JOIN lh_top x ON x.f = t.f GROUP BY t.pair_id),
translated AS (
  SELECT p.pair_id, p.split, COALESCE(l.hyp, []::VARCHAR[]) AS hyp, {O.tok('p.tgt')} AS ref
  FROM split p LEFT JOIN lh_list l ON l.pair_id = p.pair_id WHERE p.split <> 'train' AND p.pair_id LIKE 'c:%')""", ["split"])


def _held_out(spark, sf):
    """Validation and test conversations, translated by a model of the training ones."""
    pairs = P.split(spark, sf).filter(F.col("pair_id").startswith("c:"))
    table = P._memo(spark, sf, "lexical_train_top1", lambda: L.train_top1(
        pairs.filter(F.col("split") == "train"), tokenizer=None, src="src_toks", tgt="tgt_toks").checkpoint(eager=True))
    return L.translate(pairs.filter(F.col("split") != "train"), table, tokenizer=None, text_col="src_toks", carry=("split", "tgt_toks")).select(
        "pair_id", "split", F.col("translation_tokens").alias("hyp"), F.col("tgt_toks").alias("ref"))


@query("bleu_held_out", O.with_("held_out") + "," + O.FRAG["bleu_parts"].strip() + f""",
bl_tot AS (
  SELECT t.split, CAST(sum(c) AS BIGINT) AS hyp_len, CAST(sum(r) AS BIGINT) AS ref_len,
         CAST(sum(m1) AS BIGINT) AS m1, CAST(sum(m2) AS BIGINT) AS m2, CAST(sum(m3) AS BIGINT) AS m3, CAST(sum(m4) AS BIGINT) AS m4,
         CAST(sum(greatest(c, 0)) AS BIGINT) AS t1, CAST(sum(greatest(c - 1, 0)) AS BIGINT) AS t2,
         CAST(sum(greatest(c - 2, 0)) AS BIGINT) AS t3, CAST(sum(greatest(c - 3, 0)) AS BIGINT) AS t4
  FROM bl_s s JOIN translated t USING (pair_id) GROUP BY t.split)
SELECT split, round({_cb}, 6) AS bleu, round(CASE WHEN t1 > 0 THEN m1 / t1 ELSE 0.0 END, 6) AS p1, hyp_len, ref_len FROM bl_tot""")
def q_bleu_held_out(spark, sf):
    tr = _held_out(spark, sf)
    return reduce(DataFrame.unionAll, [
        EV.bleu_corpus(tr.filter(F.col("split") == name)).select(F.lit(name).alias("split"), "bleu", "p1", "hyp_len", "ref_len")
        for name in ("val", "test")])


@query("translate_ids", O.with_("lexical", "vocabs", extra=f"""
ti_tok AS (SELECT p.pair_id, CASE WHEN v.token IS NULL THEN '<unk>' ELSE u.f END AS f, u.pos
           FROM pairs_a p, unnest({O.tok('src')}) WITH ORDINALITY AS u(f, pos) LEFT JOIN vocab_src v ON v.token = u.f),
ti_list AS (SELECT t.pair_id, list(COALESCE(x.e, t.f) ORDER BY t.pos) AS hyp FROM ti_tok t LEFT JOIN lx_top x ON x.f = t.f GROUP BY t.pair_id)""") + """
SELECT p.pair_id, COALESCE(array_to_string(l.hyp, ' '), '') AS translation FROM pairs_a p LEFT JOIN ti_list l ON l.pair_id = p.pair_id""")
def q_translate_ids(spark, sf):
    """The conversation pairs as ids of the source vocabulary, translated by what the column holds."""
    vs, vt = P.vocabs(spark, sf)
    ids = V.encode_pairs(P.pairs_a_tokens(spark, sf), vs, vt, tokenizer=None, src="src_toks", tgt="tgt_toks")
    return L.translate(ids, _lexical_top1(spark, sf), text_col="src_ids", vocab=vs).select("pair_id", "translation")


O.register("bigrams", f"""
bg_seq AS (SELECT pair_id, split, list_concat(['<sos>'], {O.tok('tgt')}, ['<eos>']) AS seq FROM split),
bg_raw AS (SELECT split, seq[i] AS prev, seq[i + 1] AS next FROM bg_seq, unnest(range(1, len(seq))) AS u(i)),
bg_map AS (
  SELECT b.split, CASE WHEN vp.token IS NULL THEN '<unk>' ELSE b.prev END AS prev,
         CASE WHEN vn.token IS NULL THEN '<unk>' ELSE b.next END AS next
  FROM bg_raw b LEFT JOIN vocab_tgt vp ON vp.token = b.prev LEFT JOIN vocab_tgt vn ON vn.token = b.next),
bg_eval AS (SELECT split, prev, next, count(*) AS n FROM bg_map GROUP BY split, prev, next),
bg_train AS (SELECT prev, next, CAST(n AS BIGINT) AS n FROM bg_eval WHERE split = 'train'),
bg_prev AS (SELECT prev, sum(n) AS cp FROM bg_train GROUP BY prev),
bg_v AS (SELECT count(*) AS v FROM vocab_tgt),
bg_succ AS (SELECT prev, next FROM (
  SELECT prev, next, row_number() OVER (PARTITION BY prev ORDER BY n DESC, next) AS r FROM bg_train) WHERE r = 1)""",
           ["vocabs"])


def _bigram_parts(spark, sf):
    def build():
        vt = P.vocabs(spark, sf)[1]
        counts = G.bigram_counts(P.split_once(spark, sf), vt, tokenizer=None, text_col="tgt_toks", known=True).checkpoint(eager=True)
        return counts, G.successors(counts).checkpoint(eager=True)
    return P._memo(spark, sf, "bigram_parts", build)


def _xent(spark, sf):
    def build():
        vt = P.vocabs(spark, sf)[1]
        path = scratch_path(spark, "bigrams-by-split")
        G.numbered_bigrams(P.split_once(spark, sf), vt, tokenizer=None, text_col="tgt_toks") \
            .write.mode("overwrite").option("compression", "zstd").parquet(path)
        release(spark)  # of the dealt bigrams
        return spark.read.parquet(path)
    ev = P._memo(spark, sf, "bigrams_by_split", build)
    return G.cross_entropy(P.split_once(spark, sf), P.vocabs(spark, sf)[1], ev=ev)


@query("bigram_counts", O.with_("bigrams") + "SELECT prev, next, n FROM bg_train")
def q_bigram_counts(spark, sf):
    return _bigram_parts(spark, sf)[0]


_XENT = """
xe AS (
  SELECT e.split, CAST(sum(e.n) AS BIGINT) AS n_tokens,
         sum(e.n * -ln((COALESCE(t.n, 0) + 1.0::DOUBLE) / (COALESCE(p.cp, 0) + 1.0::DOUBLE * v.v))) / sum(e.n) AS x
  FROM bg_eval e LEFT JOIN bg_train t ON t.prev = e.prev AND t.next = e.next
  LEFT JOIN bg_prev p ON p.prev = e.prev CROSS JOIN bg_v v GROUP BY e.split)"""


@query("cross_entropy", O.with_("bigrams", extra=_XENT) + "SELECT split, n_tokens, round(x, 6) AS cross_entropy FROM xe")
def q_cross_entropy(spark, sf):
    return _xent(spark, sf).select("split", "n_tokens", "cross_entropy")


@query("cross_entropy_padded", O.with_("bud_padded", "bigrams", recursive=True, extra="""
xp_raw AS (SELECT tgt_ids[i] AS a, tgt_ids[i + 1] AS b FROM bud_padded, unnest(range(1, len(tgt_ids))) AS u(i)),
xp AS (SELECT p.token AS prev, n.token AS next, count(*) AS n FROM xp_raw x JOIN vocab_tgt p ON p.id = x.a JOIN vocab_tgt n ON n.id = x.b
       WHERE x.b <> 1 GROUP BY p.token, n.token)""") + """
SELECT CAST(sum(e.n) AS BIGINT) AS n_tokens, (SELECT count(*) FROM xp_raw WHERE b = 1) AS n_pads,
       round(sum(e.n * -ln((COALESCE(t.n, 0) + 1.0::DOUBLE) / (COALESCE(p.cp, 0) + 1.0::DOUBLE * v.v))) / sum(e.n), 6) AS cross_entropy
FROM xp e LEFT JOIN bg_train t ON t.prev = e.prev AND t.next = e.next LEFT JOIN bg_prev p ON p.prev = e.prev CROSS JOIN bg_v v""")
def q_cross_entropy_padded(spark, sf):
    return G.padded_cross_entropy(_padded(spark, sf), P.vocabs(spark, sf)[1], _bigram_parts(spark, sf)[0])


@query("perplexity", O.with_("bigrams", extra=_XENT) + """
SELECT split, round(x, 6) AS cross_entropy, round(exp(x), 6) AS perplexity FROM xe""")
def q_perplexity(spark, sf):
    return _xent(spark, sf).select("split", "cross_entropy", "perplexity")


@query("topk_tokens", O.with_("bigrams") + """
SELECT prev, next, n, rank FROM (
  SELECT prev, next, n, CAST(row_number() OVER (PARTITION BY prev ORDER BY n DESC, next) AS BIGINT) AS rank FROM bg_train)
WHERE rank <= 3""")
def q_topk_tokens(spark, sf):
    return G.top_k_successors(_bigram_parts(spark, sf)[0], 3)


def _decode_starts(spark, sf):
    vt = P.vocabs(spark, sf)[1]
    t = F.col("tgt_toks")
    s = P.split_once(spark, sf).filter(F.col("split") == "test").select(
        "pair_id", F.size(t).alias("_n"), F.try_element_at(t, F.lit(1)).alias("_first"))
    known = sized_broadcast(vt.select(F.col("token").alias("_first"), F.lit(1).alias("_k")))
    s = s.join(known, "_first", "left")
    return s.select("pair_id", F.when(F.col("_n") == 0, F.lit(SOS))
                    .when(F.col("_k").isNull(), F.lit(UNK)).otherwise(F.col("_first")).alias("start"))


@query("greedy_decode", O.with_("bigrams", recursive=True, extra=f"""
gd_start AS (
  SELECT s.pair_id, CASE WHEN len({O.tok('s.tgt')}) = 0 THEN '<sos>' WHEN v.token IS NULL THEN '<unk>'
                         ELSE {O.tok('s.tgt')}[1] END AS start
  FROM split s LEFT JOIN vocab_tgt v ON v.token = {O.tok('s.tgt')}[1] WHERE s.split = 'test'),
gd(start, step, last, path) AS (
  SELECT DISTINCT start, 0, start, []::VARCHAR[] FROM gd_start
  UNION ALL
  SELECT g.start, g.step + 1, s.next, list_append(g.path, s.next)
  FROM gd g JOIN bg_succ s ON s.prev = g.last WHERE g.step < 79 AND g.last <> '<eos>'),
gd_final AS (SELECT start, arg_max(path, step) AS path FROM gd GROUP BY start),
gd_cut AS (SELECT start, path, CASE WHEN list_position(path, '<eos>') IS NOT NULL
                                    THEN path[1:list_position(path, '<eos>') - 1] ELSE path END AS kept FROM gd_final)""") + """
SELECT s.pair_id, s.start,
       array_to_string(list_concat(CASE WHEN s.start = '<sos>' THEN []::VARCHAR[] ELSE [s.start] END, c.kept), ' ') AS decoded,
       CAST(len(c.path) AS BIGINT) AS n_gen
FROM gd_start s JOIN gd_cut c ON c.start = s.start""")
def q_greedy_decode(spark, sf):
    return G.greedy_decode(_decode_starts(spark, sf), _bigram_parts(spark, sf)[1])


@query("truncate_eos", O.with_("bigrams", extra=f"""
tf_seq AS (SELECT pair_id, list_concat(['<sos>'], {O.tok('tgt')}, ['<eos>']) AS seq FROM split),
tf_tok AS (SELECT pair_id, u.pos, u.tok FROM tf_seq, unnest(seq[1:len(seq) - 1]) WITH ORDINALITY AS u(tok, pos)),
tf_map AS (SELECT t.pair_id, t.pos, CASE WHEN v.token IS NULL THEN '<unk>' ELSE t.tok END AS tok
           FROM tf_tok t LEFT JOIN vocab_tgt v ON v.token = t.tok),
tf_pred AS (SELECT m.pair_id, list(COALESCE(s.next, '<unk>') ORDER BY m.pos) AS p
            FROM tf_map m LEFT JOIN bg_succ s ON s.prev = m.tok GROUP BY m.pair_id),
tf_cut AS (SELECT pair_id, p, CASE WHEN list_position(p, '<eos>') IS NOT NULL
                                   THEN p[1:list_position(p, '<eos>') - 1] ELSE p END AS cut FROM tf_pred)""") + """
SELECT pair_id, array_to_string(cut, ' ') AS predicted, CAST(len(cut) AS BIGINT) AS n_kept, CAST(len(p) AS BIGINT) AS n_raw
FROM tf_cut""")
def q_truncate_eos(spark, sf):
    return G.teacher_forced_predictions(P.split(spark, sf), P.vocabs(spark, sf)[1], _bigram_parts(spark, sf)[1],
                                        tokenizer=None, text_col="tgt_toks")


@query("loss_windows", """
SELECT event_type, window_id, n, round(a, 6) AS loss_avg, round((epoch_us(t1) - epoch_us(t0)) / 1e6, 6) AS secs FROM (
  SELECT event_type, CAST(floor((rn - 1) / 50) AS BIGINT) AS window_id, count(*) AS n, avg(value) AS a,
         min(ts) AS t0, max(ts) AS t1
  FROM (SELECT event_type, value, ts, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn FROM events)
  GROUP BY event_type, floor((rn - 1) / 50))
WHERE n = 50""")
def q_loss_windows(spark, sf):
    return EV.loss_windows(table(spark, sf, "events"), "event_type", "event_id", "value", "ts")


# ---------------------------------------------------------------- 6. vectors (embeddings table)
from parallax.functions import vectors as VX  # noqa: E402
from parallax.operators import attention as AT  # noqa: E402

D_MODEL = 64  # width of the embeddings table vectors

O.register("emb_seq", """
emb_seq AS (
  SELECT vec_id, label, CAST(r - 1 AS BIGINT) AS pos,
         CAST(embedding AS DOUBLE[]) AS v
  FROM (SELECT vec_id, label, embedding, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS r FROM embeddings))""")


def _pe_sql(pos: str, d: str, variant: str, d_model: int = D_MODEL) -> str:
    d = f"({d})"
    if variant == "a":
        ang = f"CAST({pos} AS DOUBLE) / pow(10000.0::DOUBLE, 2.0::DOUBLE * CAST({d} AS DOUBLE) / {float(d_model)}::DOUBLE)"
    else:
        ang = (f"CAST({pos} AS DOUBLE) * exp((2.0::DOUBLE * CAST(floor({d} / 2) AS DOUBLE)) * "
               f"(-ln(10000.0::DOUBLE) / {float(d_model)}::DOUBLE))")
    return f"(CASE WHEN {d} % 2 = 0 THEN sin({ang}) ELSE cos({ang}) END)"


def _seq(spark, sf):
    return P._memo(spark, sf, "emb_seq", lambda: AT.sequences(table(spark, sf, "embeddings"), "label", "vec_id",
                                                             "embedding"))


POSENC_WIDTH = 512


def _posenc(spark, sf, variant):
    """Position table for the longest label of ``embeddings``, of at least 80 positions."""
    longest = table(spark, sf, "embeddings").groupBy("label").count().agg(F.max("count").alias("n"))
    rows = F.greatest(F.lit(VX.MAX_POSITIONS), F.coalesce("n", F.lit(0)))
    pos = longest.select(F.explode(F.sequence(F.lit(0).cast("long"), rows - 1)).alias("pos"))
    cells = pos.select("pos", F.explode(F.sequence(F.lit(0), F.lit(POSENC_WIDTH - 1))).alias("dim"))
    return cells.select("pos", F.col("dim").cast("long").alias("dim"),
                        F.round(VX.position_value("pos", "dim", POSENC_WIDTH, variant), 6).alias("v"))


for _variant in ("a", "b"):
    def _mk(variant):
        def fn(spark, sf):
            return _posenc(spark, sf, variant)
        return fn
    query(f"posenc_{_variant}", f"""
WITH longest AS (SELECT greatest(80, max(c)) AS n FROM (SELECT count(*) AS c FROM embeddings GROUP BY label))
SELECT CAST(p.pos AS BIGINT) AS pos, CAST(t.d AS BIGINT) AS dim, round({_pe_sql('p.pos', 't.d', _variant, POSENC_WIDTH)}, 6) AS v
FROM (SELECT unnest(range(n)) AS pos FROM longest) p, range({POSENC_WIDTH}) AS t(d)""")(_mk(_variant))


@query("embed_lookup", O.with_("encoded") + """
SELECT e.pair_id, CAST(u.pos - 1 AS BIGINT) AS pos, u.id AS token_id, m.vec_id,
       round(list_sum(CAST(m.embedding AS DOUBLE[])), 6) AS v_sum,
       round(list_sum(list_transform(CAST(m.embedding AS DOUBLE[]), lambda x: x * x)), 6) AS v_sq
FROM encoded e, unnest(e.src_ids) WITH ORDINALITY AS u(id, pos)
JOIN embeddings m ON m.vec_id = u.id % (SELECT count(*) FROM embeddings)""")
def q_embed_lookup(spark, sf):
    emb = table(spark, sf, "embeddings")
    n = emb.count()  # scalar table size
    ids = F.transform("src_ids", lambda x: F.pmod(x, F.lit(n)))
    enc = _encoded(spark, sf).select(
        "pair_id", "src_ids", ids.alias("vec_ids"), ids.alias("sums"), ids.alias("squares"))
    wanted = enc.select(F.explode(F.array_distinct("vec_ids")).alias("vec_id"))
    path = scratch_path(spark, "vector-sums")
    BK.features(wanted, emb.select("vec_id", VX.as_double("embedding").alias("v")), "vec_id",
                {"v_sum": VX.vsum("v"), "v_sq": VX.vsum(F.transform("v", lambda x: x * x))}).write.parquet(path)
    del wanted
    release(spark)  # of what the ids have shuffled
    sums = spark.read.parquet(path)
    sums_of = lambda c: D.Dictionary(sums.select(F.col("vec_id").alias("key"), F.col(c).alias("value"), F.col("vec_id").alias("rank")), float("nan"))
    found = D.map_arrays(enc, {"sums": sums_of("v_sum"), "squares": sums_of("v_sq")})
    each = found.select("pair_id", F.posexplode(F.arrays_zip("src_ids", "vec_ids", "sums", "squares")).alias("pos", "x"))
    return each.filter(~F.isnan("x.sums")).select(  # ids without a vector have no row
        "pair_id", F.col("pos").cast("long").alias("pos"), F.col("x.src_ids").alias("token_id"), F.col("x.vec_ids").alias("vec_id"),
        F.round("x.sums", 6).alias("v_sum"), F.round("x.squares", 6).alias("v_sq"))


@query("embed_plus_pos", O.with_("emb_seq") + f"""
SELECT label, pos, CAST(u.d - 1 AS BIGINT) AS dim,
       round(u.x * sqrt({float(D_MODEL)}::DOUBLE) + {_pe_sql('pos', 'u.d - 1', 'a')}, 6) AS v
FROM emb_seq, unnest(v) WITH ORDINALITY AS u(x, d)""")
def q_embed_plus_pos(spark, sf):
    s = AT.embed_plus_position(_seq(spark, sf), D_MODEL)
    return AT.long_form(s, ["label", "pos"])


@query("layer_norm", """
WITH b AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
m AS (SELECT vec_id, v, list_sum(v) / len(v) AS mean FROM b),
s AS (SELECT vec_id, v, mean, sqrt(list_sum(list_transform(v, lambda x: (x - mean) * (x - mean))) / (len(v) - 1)) AS sd FROM m)
SELECT vec_id, CAST(u.d - 1 AS BIGINT) AS dim, round(1.0 * (u.x - mean) / (sd + 1e-6) + 0.0, 6) AS v
FROM s, unnest(v) WITH ORDINALITY AS u(x, d)""")
def q_layer_norm(spark, sf):
    emb = table(spark, sf, "embeddings")
    return AT.long_form(emb.select("vec_id", VX.layer_norm(VX.as_double("embedding")).alias("v")), ["vec_id"])


@query("softmax", """
WITH s AS (SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS s FROM embeddings),
e AS (SELECT vec_id, label, exp(s - max(s) OVER (PARTITION BY label)) AS e FROM s)
SELECT vec_id, label, round(e / sum(e) OVER (PARTITION BY label), 6) AS w FROM e""")
def q_softmax(spark, sf):
    emb = table(spark, sf, "embeddings").select("vec_id", "label", F.try_element_at("embedding", F.lit(1)).cast("double").alias("s"))
    return AT.grouped_softmax(emb, "label", "s").select("vec_id", "label", F.round("w", 6).alias("w"))


def _attn_sql(heads: int) -> str:
    dk = D_MODEL // heads
    return O.with_("emb_seq", extra=f"""
at_pairs AS (
  SELECT a.label, a.pos AS i, b.pos AS j, h.h, b.v[h.h * {dk} + 1 : h.h * {dk} + {dk}] AS vh,
         list_dot_product(a.v[h.h * {dk} + 1 : h.h * {dk} + {dk}], b.v[h.h * {dk} + 1 : h.h * {dk} + {dk}])
           / sqrt({float(dk)}::DOUBLE) AS s
  FROM emb_seq a JOIN emb_seq b ON a.label = b.label AND b.pos <= a.pos
  CROSS JOIN range({heads}) AS h(h)),
at_e AS (SELECT *, exp(s - max(s) OVER (PARTITION BY label, i, h)) AS e FROM at_pairs),
at_w AS (SELECT *, e / sum(e) OVER (PARTITION BY label, i, h) AS wt FROM at_e)""") + f"""
SELECT label, i AS pos, CAST(h * {dk} + u.d - 1 AS BIGINT) AS dim, round(sum(wt * u.x), 6) AS v
FROM at_w, unnest(vh) WITH ORDINALITY AS u(x, d) GROUP BY label, i, h, u.d"""


@query("attn_causal", _attn_sql(1))
def q_attn_causal(spark, sf):
    return AT.long_form(AT.attention(_seq(spark, sf)), ["label", "pos"])


@query("attn_heads", _attn_sql(8))
def q_attn_heads(spark, sf):
    return AT.long_form(AT.attention(_seq(spark, sf), heads=8), ["label", "pos"])


@query("attn_cross", O.with_("encoded", extra="""
ac_emb AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
ac_n AS (SELECT count(*) AS n FROM embeddings),
ac_q AS (SELECT e.pair_id, u.pos - 1 AS i, m.v FROM encoded e, unnest(e.tgt_ids) WITH ORDINALITY AS u(id, pos), ac_n
         JOIN ac_emb m ON m.vec_id = u.id % ac_n.n),
ac_k AS (SELECT e.pair_id, u.pos - 1 AS j, m.v, list_sum(m.v) AS vs
         FROM encoded e, unnest(e.src_ids) WITH ORDINALITY AS u(id, pos), ac_n
         JOIN ac_emb m ON m.vec_id = u.id % ac_n.n),
ac_s AS (SELECT q.pair_id, i, list_dot_product(q.v, k.v) / 8.0::DOUBLE AS s, vs, k.v[1] AS v1, k.v[64] AS v64
         FROM ac_q q JOIN ac_k k ON q.pair_id = k.pair_id),
ac_e AS (SELECT *, exp(s - max(s) OVER (PARTITION BY pair_id, i)) AS e FROM ac_s)""") + """
SELECT pair_id, CAST(i AS BIGINT) AS pos, round(sum(e * vs) / sum(e), 6) AS v_sum,
       round(sum(e * v1) / sum(e), 6) AS v_first, round(sum(e * v64) / sum(e), 6) AS v_last
FROM ac_e GROUP BY pair_id, i""")
def q_attn_cross(spark, sf):
    """Target positions attend to the source positions of their pair; sources are padded to a
    multiple of eight, and the mask leaves the padding out.  Vectors go to the ids of a pair in the
    task that holds it, so no vector is shuffled with its occurrences."""
    emb = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    n = emb.count()  # scalar table size
    enc = _encoded(spark, sf)
    padding = F.array_repeat(F.lit(PAD_ID).cast("long"), F.pmod(-F.size("src_ids"), F.lit(8)))
    sides = enc.select("pair_id", "tgt_ids", F.concat("src_ids", padding).alias("src_ids"))
    of = lambda c: F.transform(c, lambda x: F.pmod(x, F.lit(n)))
    got = AT.attention_of_ids(sides.select("pair_id", of("tgt_ids").alias("q"), of("src_ids").alias("k"),
                                           F.transform("src_ids", lambda x: x != PAD_ID).alias("real")), emb, "pair_id",
                              keys=P.pair_ids(spark, sf))
    return got.select("pair_id", "pos", F.round(VX.vsum("v"), 6).alias("v_sum"), F.round(F.col("v")[0], 6).alias("v_first"),
                      F.round(F.element_at("v", -1), 6).alias("v_last"))


@query("vec_elementwise", """
SELECT vec_id, CAST(u.d - 1 AS BIGINT) AS dim, round(greatest(u.x, 0.0), 6) AS relu, round(u.x + greatest(u.x, 0.0), 6) AS resid
FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), unnest(v) WITH ORDINALITY AS u(x, d)""")
def q_vec_elementwise(spark, sf):
    emb = table(spark, sf, "embeddings").select("vec_id", VX.as_double("embedding").alias("v"))
    ex = emb.select("vec_id", F.posexplode("v").alias("dim", "x"))
    return ex.select("vec_id", F.col("dim").cast("long").alias("dim"),
                     F.round(F.greatest("x", F.lit(0.0)), 6).alias("relu"),
                     F.round(F.col("x") + F.greatest("x", F.lit(0.0)), 6).alias("resid"))


# ---------------------------------------------------------------- 7. files and streams

from parallax.sources import files as FS  # noqa: E402
from parallax.streaming import jobs as ST  # noqa: E402
from parallax.streaming import timers as TM  # noqa: E402


@query("src_tsv", O.with_("pairs_union") + "SELECT pair_id, src, tgt FROM pairs_union")
def q_src_tsv(spark, sf):
    path = scratch_path(spark, "tsv")
    FS.write_tsv(P.pairs_union(spark, sf), path, ["pair_id", "tgt", "src"])
    return FS.read_tsv(spark, path, {0: "pair_id", 1: "tgt", 2: "src"}, 3).select("pair_id", "src", "tgt")


@query("src_csv_badlines", O.with_("pb_raw", extra=f"""
bl_fields AS (SELECT string_split(line, ',') AS f FROM pb_raw WHERE line <> ''),
bl_kept AS (SELECT {O.na('f[1]')} AS src, {O.na('f[2]')} AS tgt FROM bl_fields WHERE len(f) <= 2)""") + """
SELECT src, tgt, (SELECT count(*) FROM bl_fields WHERE len(f) > 2) AS quarantined
FROM bl_kept WHERE src IS NOT NULL AND tgt IS NOT NULL""")
def q_src_csv_badlines(spark, sf):
    """Document lines as raw CSV (no field of theirs begins with a quote, so the oracle splits at
    commas); the number of lines with too many fields beside each kept row."""
    path = scratch_path(spark, "badlines")
    lines = P.pairs_b_raw(spark, sf).select("line")
    FS.write_raw_lines(lines, path, "line", "日本語,英語")
    kept, quarantined = FS.read_csv_badlines(spark, path, ["日本語", "英語"])
    return C.clean_pairs(kept, ["日本語", "英語"], id_col=None).withColumn("quarantined", F.lit(quarantined.count()))


@query("csv_roundtrip", O.with_("split") + "SELECT pair_id, src, tgt, split FROM split")
def q_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "splits")
    FS.write_splits(P.split(spark, sf), path)
    return FS.read_splits(spark, path).select("pair_id", "src", "tgt", "split")


@query("split_reload", O.with_("split") + f"""
SELECT split, count(*) AS n, CAST(sum(len({O.tok('src')})) AS BIGINT) AS n_src_tokens,
       CAST(sum(len({O.tok('tgt')})) AS BIGINT) AS n_tgt_tokens
FROM split GROUP BY split""")
def q_split_reload(spark, sf):
    path = scratch_path(spark, "splits")
    FS.write_splits(P.split(spark, sf), path)
    back = C.with_lengths(FS.read_splits(spark, path))
    return back.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("src_len").cast("long").alias("n_src_tokens"),
                                     F.sum("tgt_len").cast("long").alias("n_tgt_tokens"))


@query("artifact_roundtrip", O.with_("bigrams", "lexical") + """
SELECT 'vocab_src' AS artifact, token AS key, CAST(id AS VARCHAR) AS value FROM vocab_src
UNION ALL SELECT 'vocab_tgt', token, CAST(id AS VARCHAR) FROM vocab_tgt
UNION ALL SELECT 'bigram', prev || ' ' || next, CAST(n AS VARCHAR) FROM bg_train
UNION ALL SELECT 'lexical', f, e FROM lx_top""")
def q_artifact_roundtrip(spark, sf):
    path = scratch_path(spark, "artifacts")
    vs, vt = P.vocabs(spark, sf)
    FS.save_artifacts({"vocab_src": vs, "vocab_tgt": vt, "bigram": _bigram_parts(spark, sf)[0],
                       "lexical": _lexical_top1(spark, sf)}, path)
    a = FS.load_artifacts(spark, path, ["vocab_src", "vocab_tgt", "bigram", "lexical"])
    return (a["vocab_src"].select(F.lit("vocab_src").alias("artifact"), F.col("token").alias("key"),
                                  F.col("id").cast("string").alias("value"))
            .unionByName(a["vocab_tgt"].select(F.lit("vocab_tgt").alias("artifact"), F.col("token").alias("key"),
                                               F.col("id").cast("string").alias("value")))
            .unionByName(a["bigram"].select(F.lit("bigram").alias("artifact"),
                                            F.concat_ws(" ", "prev", "next").alias("key"),
                                            F.col("n").cast("string").alias("value")))
            .unionByName(a["lexical"].select(F.lit("lexical").alias("artifact"), F.col("f").alias("key"),
                                             F.col("e").alias("value"))))


@query("stream_translate", O.with_("translated") + "SELECT pair_id, translation FROM translated")
def q_stream_translate(spark, sf):
    req = P.pairs_a_tokens(spark, sf).select("pair_id", "src")
    staged, inp, out = (scratch_path(spark, "requests-staged"), scratch_path(spark, "requests"),
                        scratch_path(spark, "translations"))
    ranges = ST.stage_ranges(req, staged, F.xxhash64("pair_id"))
    res = ST.stream_translate(spark, inp, ST.staged_schema(spark, staged), _lexical_top1(spark, sf),
                              lambda b, t: L.translate(b, t).select("pair_id", "translation"), out,
                              arrivals=ST.range_arrivals(spark, staged, ranges, inp))
    return res.select("pair_id", "translation")


@query("stream_metrics", """
SELECT CAST(floor(epoch(ts) / 86400) * 86400 AS BIGINT) AS window_start, count(*) AS n, round(avg(value), 6) AS value_avg
FROM events WHERE ts IS NOT NULL GROUP BY floor(epoch(ts) / 86400)""")
def q_stream_metrics(spark, sf):
    ev = table(spark, sf, "events").filter(F.col("ts").isNotNull())
    staged, inp, out = scratch_path(spark, "events-ts-staged"), scratch_path(spark, "events-ts"), scratch_path(spark, "metrics")
    ranges = ST.stage_ranges(ev, staged, F.unix_micros(ST.event_time("ts")))
    return ST.stream_window_metrics(spark, inp, ST.staged_schema(spark, staged), out,
                                    arrivals=ST.range_arrivals(spark, staged, ranges, inp))


@query("stream_late", """
WITH size AS (SELECT min(epoch_us(ts))::DOUBLE AS lo, max(epoch_us(ts))::DOUBLE AS hi, greatest(4, ceil(count(*) / 20000000.0))::BIGINT AS parts
              FROM events WHERE ts IS NOT NULL),
own AS (SELECT event_id, value, epoch_us(ts) // 1000 AS ms, floor(epoch_us(ts) / 86400e6) * 86400 AS w, parts,
               least(floor((epoch_us(ts) - lo) / ((hi - lo) / parts)), parts - 1)::BIGINT AS r FROM events, size WHERE ts IS NOT NULL),
arrived AS (SELECT *, CASE WHEN event_id % 7 = 3 THEN least(r + 2, parts - 1) ELSE r END AS b FROM own),
top AS (SELECT b, max(max(ms)) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM arrived GROUP BY b),
judged AS (SELECT a.*, coalesce((w + 86400) * 1000 <= before - 3600000, FALSE) AS late FROM arrived a JOIN top USING (b))
SELECT CAST(w AS BIGINT) AS window_start, CAST(count(*) FILTER (WHERE NOT late) AS BIGINT) AS n,
       round(avg(value) FILTER (WHERE NOT late), 6) AS value_avg, CAST(count(*) FILTER (WHERE late) AS BIGINT) AS n_late
FROM judged GROUP BY w""")
def q_stream_late(spark, sf):
    """Daily windows of a stream in which every seventh event arrives two ranges late, and how
    many rows came after their window had closed."""
    ev = table(spark, sf, "events").filter(F.col("ts").isNotNull()).select("event_id", "ts", "value")
    staged, inp, out = scratch_path(spark, "late-staged"), scratch_path(spark, "late"), scratch_path(spark, "late-metrics")
    ST.with_late_rows(ev, staged, F.unix_micros(ST.event_time("ts")), F.col("event_id") % 7 == 3)
    ranges = sorted(r["_range"] for r in spark.read.parquet(staged).select("_range").distinct().collect())
    schema = ST.staged_schema(spark, staged)
    on_time = ST.stream_window_metrics(spark, inp, schema, out, arrivals=ST.range_arrivals(spark, staged, ranges, inp))
    side = scratch_path(spark, "late-side")
    late = ST.stream_late_rows(spark, side, schema, scratch_path(spark, "late-rows"), CM.Commits(spark, scratch_path(spark, "late-marks")),
                               arrivals=ST.range_arrivals(spark, staged, ranges, side))
    gone = late.groupBy("window_start").agg(F.count("*").alias("n_late"))
    return on_time.join(gone, "window_start", "full").select(
        "window_start", F.coalesce("n", F.lit(0)).alias("n"), "value_avg", F.coalesce("n_late", F.lit(0)).alias("n_late"))


@query("stream_count_windows", """
SELECT user_id, CAST(floor((rn - 1) / 50) AS BIGINT) AS window_id, count(*) AS n, round(avg(value), 6) AS value_avg,
       min(event_id) AS first_event_id, max(event_id) AS last_event_id
FROM (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events)
GROUP BY user_id, floor((rn - 1) / 50) HAVING count(*) = 50""")
def q_stream_count_windows(spark, sf):
    ev = table(spark, sf, "events")
    staged, inp, out = scratch_path(spark, "events-id-staged"), scratch_path(spark, "events-id"), scratch_path(spark, "count-windows")
    ranges = ST.stage_ranges(ev, staged, "event_id")
    return ST.stream_count_windows(spark, inp, ST.staged_schema(spark, staged), out,
                                   arrivals=ST.range_arrivals(spark, staged, ranges, inp))


@query("stream_count_timers", """
SELECT user_id, CAST(floor((rn - 1) / 50) AS BIGINT) AS window_id, count(*) AS n, round(avg(value), 6) AS value_avg,
       min(event_id) AS first_event_id, max(event_id) AS last_event_id
FROM (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events WHERE ts IS NOT NULL)
GROUP BY user_id, floor((rn - 1) / 50) HAVING count(*) = 50""")
def q_stream_count_timers(spark, sf):
    """Count windows in event-time order of a stream in which every third event arrives one range
    late, within the watermark; a last row moves the watermark past all events."""
    ev = table(spark, sf, "events").filter(F.col("ts").isNotNull()).select("user_id", "event_id", "ts", "value")
    staged, inp, out = scratch_path(spark, "timers-staged"), scratch_path(spark, "timers"), scratch_path(spark, "timer-windows")
    time = ST.event_time("ts")
    ST.with_late_rows(ev, staged, F.unix_micros(time), F.col("event_id") % 3 == 1, by=1)
    schema = ST.staged_schema(spark, staged)
    ranges = sorted(r["_range"] for r in spark.read.parquet(staged).select("_range").distinct().collect())
    lo, hi = ev.agg(F.min(F.unix_seconds(time)), F.max(F.unix_seconds(time))).first()
    delay = ((hi or 0) - (lo or 0)) // max(len(ranges) - 1, 1) + 60  # a range is no longer
    arrivals = ST.range_arrivals(spark, staged, ranges, inp)
    for step in (1, 2):  # the second closing row lets the batch after the first act on its watermark
        last = spark.createDataFrame([(None, -step, (hi or 0) + 3 * delay + step * 86_400, 0.0)], "user_id long, event_id long, s long, value double").select(
            "user_id", "event_id", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"), "value")
        arrivals.append(lambda last=last: last.write.mode("append").parquet(inp))
    return TM.stream_count_timers(spark, inp, schema, out, f"{delay} seconds", arrivals=arrivals).filter("user_id is not null")
