"""Evaluation: BLEU (D11, Papineni et al. 2002) per sentence and per corpus, and
windowed loss metrics over a step table (D6, H18).

BLEU: clipped n-gram precision for n = 1..4, geometric mean, brevity penalty
BP = 1 if c > r else exp(1 - r/c).  No smoothing: a sentence (or corpus) with an order
without any match scores 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parallax.operators.ordering import ordered_rank

MAX_N = 4
REPORT_EVERY = 50


def _gram_at(tokens: Column, n: int):
    # one-argument lambda: F.transform treats a two-argument lambda as (element, index)
    return lambda i: F.struct(F.lit(n).alias("n"), F.array_join(F.slice(tokens, i, n), " ").alias("gram"))


def ngrams(tokens: Column, max_n: int = MAX_N) -> Column:
    """array<struct<n, gram>> of all 1..max_n-grams (tokens joined by one space)."""
    parts = []
    for n in range(1, max_n + 1):
        cnt = F.size(tokens) - n + 1
        idx = F.when(cnt > 0, F.sequence(F.lit(1), cnt)).otherwise(F.array().cast("array<int>"))
        parts.append(F.transform(idx, _gram_at(tokens, n)))
    return F.flatten(F.array(*parts))


def clipped_matches(df: DataFrame, hyp: str, ref: str, id_col: str = "pair_id") -> DataFrame:
    """(id, n, clipped, c, r): clipped n-gram matches per sentence and order, plus the
    hypothesis / reference lengths.  Every sentence keeps an ``n = 0`` row (its
    lengths), so sentences without any match survive without a join back.

    All three aggregations are keyed by the sentence id first; when the input is
    already partitioned by id (as translation output is) they add no shuffle."""
    lens = F.array(F.struct(F.lit(0).alias("n"), F.lit("").alias("gram")))
    g = df.select(id_col, F.size(hyp).alias("_c"), F.size(ref).alias("_r"), F.explode(F.array(
        F.struct(F.lit(1).alias("h"), F.concat(lens, ngrams(F.col(hyp))).alias("g")),
        F.struct(F.lit(0).alias("h"), ngrams(F.col(ref)).alias("g")))).alias("s"))
    g = g.select(id_col, "_c", "_r", F.col("s.h").alias("h"), F.explode("s.g").alias("x"))
    counts = g.groupBy(id_col, F.col("x.n").alias("n"), F.col("x.gram").alias("gram")).agg(
        F.sum("h").alias("ch"), F.sum(1 - F.col("h")).alias("cr"),
        F.max("_c").alias("c"), F.max("_r").alias("r"))
    kept = counts.filter((F.col("n") == 0) | ((F.col("ch") > 0) & (F.col("cr") > 0)))
    return kept.groupBy(id_col, "n").agg(
        F.sum(F.when(F.col("n") > 0, F.least("ch", "cr")).otherwise(F.lit(0))).cast("long").alias("clipped"),
        F.max("c").alias("c"), F.max("r").alias("r"))


def _per_order(df: DataFrame, id_col: str, max_n: int) -> DataFrame:
    m = clipped_matches(df, "hyp", "ref", id_col)
    out = m.groupBy(id_col).agg(
        F.max(F.when(F.col("n") == 0, F.col("c"))).cast("long").alias("c"),
        F.max(F.when(F.col("n") == 0, F.col("r"))).cast("long").alias("r"),
        *[F.coalesce(F.sum(F.when(F.col("n") == n, F.col("clipped"))), F.lit(0)).cast("long").alias(f"m{n}")
          for n in range(1, max_n + 1)])
    for n in range(1, max_n + 1):
        out = out.withColumn(f"t{n}", F.greatest(F.col("c") - (n - 1), F.lit(0)).cast("long"))
    return out


def _bleu(m, t, c, r, max_n):
    ok = F.lit(True)
    logp = F.lit(0.0)
    for n in range(1, max_n + 1):
        ok = ok & (m[n - 1] > 0)
        logp = logp + F.log(m[n - 1].cast("double") / t[n - 1].cast("double"))
    bp = F.when(c > r, F.lit(1.0)).otherwise(F.exp(F.lit(1.0) - r.cast("double") / c.cast("double")))
    return F.when(ok & (c > 0), bp * F.exp(logp / max_n)).otherwise(F.lit(0.0)), bp


def bleu_sentence(df: DataFrame, id_col: str = "pair_id", max_n: int = MAX_N) -> DataFrame:
    """Input (id, hyp array<string>, ref array<string>) -> (id, bleu)."""
    o = _per_order(df, id_col, max_n)
    score, _ = _bleu([F.col(f"m{n}") for n in range(1, max_n + 1)],
                     [F.col(f"t{n}") for n in range(1, max_n + 1)], F.col("c"), F.col("r"), max_n)
    return o.select(id_col, F.round(score, 6).alias("bleu"))


def bleu_corpus(df: DataFrame, id_col: str = "pair_id", max_n: int = MAX_N) -> DataFrame:
    """Corpus BLEU: clipped counts and totals summed over sentences first."""
    o = _per_order(df, id_col, max_n)
    s = o.agg(F.sum("c").cast("long").alias("hyp_len"), F.sum("r").cast("long").alias("ref_len"),
              *[F.sum(f"m{n}").cast("long").alias(f"m{n}") for n in range(1, max_n + 1)],
              *[F.sum(f"t{n}").cast("long").alias(f"t{n}") for n in range(1, max_n + 1)])
    m = [F.col(f"m{n}") for n in range(1, max_n + 1)]
    t = [F.col(f"t{n}") for n in range(1, max_n + 1)]
    score, bp = _bleu(m, t, F.col("hyp_len"), F.col("ref_len"), max_n)
    return s.select(F.round(score, 6).alias("bleu"),
                    F.round(F.when(F.col("hyp_len") > 0, bp).otherwise(F.lit(0.0)), 6).alias("bp"),
                    *[F.round(F.when(t[n] > 0, m[n] / t[n]).otherwise(F.lit(0.0)), 6).alias(f"p{n + 1}")
                      for n in range(max_n)],
                    "hyp_len", "ref_len")


def loss_windows(steps: DataFrame, group_col: str, order_col: str, value_col: str, ts_col: str,
                 every: int = REPORT_EVERY) -> DataFrame:
    """Mean of each ``every`` consecutive steps per group (partial windows are not
    reported), with the window's elapsed seconds (H18).  Steps are numbered by an exact
    rank spread over range partitions, so a group with most of the rows is not one task."""
    ranked = ordered_rank(steps.select(group_col, order_col, value_col, ts_col),
                          order=[order_col], partition=[group_col], rank_col="_step")
    w = ranked.withColumn("window_id", F.floor((F.col("_step") - 1) / every).cast("long"))
    g = w.groupBy(group_col, "window_id").agg(
        F.count(F.lit(1)).alias("n"), F.avg(value_col).alias("_avg"),
        F.min(ts_col).alias("_t0"), F.max(ts_col).alias("_t1"))
    return (g.filter(F.col("n") == every)
            .select(group_col, "window_id", "n", F.round("_avg", 6).alias("loss_avg"),
                    F.round(F.timestamp_diff("MICROSECOND", F.col("_t0"), F.col("_t1")) / 1e6, 6).alias("secs")))
