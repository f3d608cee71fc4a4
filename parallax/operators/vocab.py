"""Vocabulary and id mapping: token counts, vocabulary build (D1), size (D2),
token -> id with unknown default (C1, H4), id -> token (C2, F8, H5) and the
out-of-vocabulary report (C7).

A vocabulary is a table ``(id bigint, token string, freq bigint)``: the specials first,
then tokens by count descending and token ascending (byte order).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parallax.functions.text import (EOS_ID, SOS_ID, SRC_SPECIALS, TGT_SPECIALS, UNK_ID,
                                     get_tokenizer)
from parallax.operators.dictionary import BOUND, Dictionary, map_arrays
from parallax.operators.ordering import ordered_rank, sized_broadcast

_NONE = "\u0000"  # stands for an id without a token
VOCAB_SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("token", T.StringType()),
                             T.StructField("freq", T.LongType())])


def side_tokens(df: DataFrame, tokenizer="words", src="src", tgt="tgt",
                keep: Sequence[str] = (), outer: bool = False) -> DataFrame:
    """One row per token occurrence: (*keep, side, pos, token); pos is 0-based.  With
    ``outer`` a side without tokens still yields one row (pos and token null)."""
    tok = get_tokenizer(tokenizer)
    stacked = df.select(*keep, F.explode(F.array(
        F.struct(F.lit("src").alias("side"), tok(F.col(src)).alias("toks")),
        F.struct(F.lit("tgt").alias("side"), tok(F.col(tgt)).alias("toks")))).alias("_s"))
    pe = F.posexplode_outer if outer else F.posexplode
    return stacked.select(*keep, F.col("_s.side").alias("side"), pe("_s.toks").alias("pos", "token"))


def token_counts(df: DataFrame, tokenizer="words", src: str = "src", tgt: str = "tgt") -> DataFrame:
    """(side, token, n, rank): counts per side, ranked by n desc then token."""
    counts = (side_tokens(df, tokenizer, src, tgt).groupBy("side", "token")
              .agg(F.count(F.lit(1)).alias("n")))
    return ordered_rank(counts, order=[F.desc("n"), F.asc("token")], partition=["side"],
                        rank_col="rank", max_groups=2)


def build_pair_vocab_table(split_df: DataFrame, splits: Sequence[str] = ("train", "val"),
                           tokenizer="words", src: str = "src", tgt: str = "tgt") -> DataFrame:
    """Both vocabularies as one table (side, id, token, freq), counted over the given
    splits (train + val) in one pass: one partial aggregation keyed by (side, token) and
    one ranked sort."""
    spark = split_df.sparkSession
    toks = side_tokens(split_df.filter(F.col("split").isin(list(splits))), tokenizer, src, tgt)
    specials = F.when(F.col("side") == "src", F.array(*[F.lit(t) for t in SRC_SPECIALS])) \
        .otherwise(F.array(*[F.lit(t) for t in TGT_SPECIALS]))
    counts = (toks.groupBy("side", "token").agg(F.count(F.lit(1)).alias("freq"))
              .filter(~F.array_contains(specials, F.col("token"))))
    ranked = ordered_rank(counts, order=[F.desc("freq"), F.asc("token")], partition=["side"], rank_col="_r",
                          max_groups=2)
    return side_vocab_table(spark, ranked)


def build_pair_vocabs(split_df: DataFrame, splits: Sequence[str] = ("train", "val"),
                      tokenizer="words", src: str = "src", tgt: str = "tgt") -> tuple[DataFrame, DataFrame]:
    """Source and target vocabularies (id, token, freq), see ``build_pair_vocab_table``."""
    both = build_pair_vocab_table(split_df, splits, tokenizer, src, tgt)
    return (both.filter(F.col("side") == "src").drop("side"),
            both.filter(F.col("side") == "tgt").drop("side"))


def side_vocab_table(spark: SparkSession, ranked: DataFrame) -> DataFrame:
    """(side, id, token, freq) for both vocabularies: each side's specials, then its ranked
    tokens shifted past them.  One frame, so both sides are written in one job."""
    offset = F.when(F.col("side") == "src", F.lit(len(SRC_SPECIALS))).otherwise(F.lit(len(TGT_SPECIALS)))
    body = ranked.select("side", (F.col("_r") + offset - 1).alias("id"), "token", "freq")
    head = spark.createDataFrame([(side, i, t, 0) for side, sp in (("src", SRC_SPECIALS), ("tgt", TGT_SPECIALS))
                                  for i, t in enumerate(sp)],
                                 "side string, id bigint, token string, freq bigint").coalesce(1)
    return head.unionByName(body)


def vocab_size(vocab: DataFrame, side: str) -> DataFrame:
    """Distinct tokens plus specials."""
    return vocab.agg(F.count(F.lit(1)).alias("n")).select(F.lit(side).alias("side"), "n")


SKETCH_LG = 13
SKETCH_ERROR = 0.04  # over three standard errors of a sketch of 2^SKETCH_LG registers


def token_sketches(split_df: DataFrame, tokenizer="words", src: str = "src", tgt: str = "tgt") -> DataFrame:
    """(split, side, sketch): a mergeable sketch of the distinct tokens of each split and side,
    of a fixed size whatever the corpus.  Sketches are merged in each task before the shuffle."""
    toks = side_tokens(split_df, tokenizer, src, tgt, keep=["split"])
    return toks.groupBy("split", "side").agg(F.hll_sketch_agg("token", F.lit(SKETCH_LG)).alias("sketch"))


def approx_vocab_size(sketches: DataFrame) -> DataFrame:
    """D2 approximately: (side, about), the distinct tokens of all given sketches together."""
    return sketches.groupBy("side").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("about"))


def encode_pairs(df: DataFrame, vocab_src: DataFrame, vocab_tgt: DataFrame,
                 id_col: str = "pair_id", tokenizer="words", markers: bool = True,
                 src: str = "src", tgt: str = "tgt", carry: Sequence[str] = (), bound: int = BOUND, again: bool = False) -> DataFrame:
    """C1 on both sides in one pass: (id_col, *carry, src_ids, tgt_ids).

    Token arrays are mapped by a dictionary of two tiers (``bound`` bytes of frequent tokens sent
    to every task, the rest by shuffle); unknown and null tokens -> <unk>, a null text has no
    ids.  The target gets <sos>/<eos> (H4, Q8).  ``again``: see ``map_arrays``."""
    tok = get_tokenizer(tokenizer)
    toks = [F.coalesce(tok(F.col(c)), F.array().cast("array<string>")).alias(name) for c, name in ((src, "src_ids"), (tgt, "tgt_ids"))]
    words = {name: Dictionary(v.select(F.col("token").alias("key"), F.col("id").alias("value"), F.col("id").alias("rank")), UNK_ID)
             for name, v in (("src_ids", vocab_src), ("tgt_ids", vocab_tgt))}
    out = map_arrays(df.select(id_col, *carry, *toks), words, bound, again)
    if not markers:
        return out
    return out.withColumn("tgt_ids", F.concat(F.array(F.lit(SOS_ID).cast("long")), "tgt_ids", F.array(F.lit(EOS_ID).cast("long"))))


def truncate_at(ids, stop_id: int = EOS_ID):
    """F8: the ids before the first ``stop_id`` (all of them when absent)."""
    c = F.col(ids) if isinstance(ids, str) else ids
    p = F.array_position(c, F.lit(stop_id))
    return F.when(p > 0, F.slice(c, 1, (p - 1).cast("int"))).otherwise(c)


def decode_ids(df: DataFrame, ids_col: str, vocab: DataFrame, id_col: str = "pair_id",
               out_col: str = "text", carry: Sequence[str] = (), bound: int = BOUND) -> DataFrame:
    """C2 + F8 + H5: cut at the first <eos>, drop <sos>, map ids to tokens, join with spaces.
    Ids that the vocabulary lacks give no token."""
    cut = df.select(id_col, *carry, F.coalesce(F.filter(truncate_at(F.col(ids_col)), lambda x: x != SOS_ID),
                                               F.array().cast("array<bigint>")).alias(out_col))
    words = Dictionary(vocab.select(F.col("id").alias("key"), F.col("token").alias("value"), F.col("id").alias("rank")), _NONE)
    out = map_arrays(cut, {out_col: words}, bound)
    return out.withColumn(out_col, F.array_join(F.filter(out_col, lambda t: t != _NONE), " "))


def oov_report(split_df: DataFrame, vocab_src: DataFrame, vocab_tgt: DataFrame,
               tokenizer="words", src: str = "src", tgt: str = "tgt") -> DataFrame:
    """Per split and side, occurrences and distinct types missing from the vocabulary."""
    toks = side_tokens(split_df, tokenizer, src, tgt, keep=["split"])
    vocab = (vocab_src.select(F.lit("src").alias("side"), "token")
             .unionByName(vocab_tgt.select(F.lit("tgt").alias("side"), "token")))
    # pre-aggregate per (split, side, token) before the anti join
    per_type = toks.groupBy("split", "side", "token").agg(F.count(F.lit(1)).alias("n"))
    missing = per_type.join(sized_broadcast(vocab), ["side", "token"], "left_anti")
    return missing.groupBy("split", "side").agg(
        F.sum("n").cast("long").alias("oov_tokens"), F.count(F.lit(1)).alias("oov_types"))
