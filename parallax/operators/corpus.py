"""Corpus operators: select/rename/null-drop (B1-B3), missing-value normalization (A3),
bag union (G1), length filter (B5), exact reproducible split (E1, F1, D5) and the
split leakage report (G2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parallax.functions.text import get_tokenizer, na_normalize
from parallax.operators.ordering import hash_rank

SEED = 42
MAX_SRC_TOKENS = 80   # position-table length
MAX_TGT_TOKENS = 78   # target plus <sos>/<eos> stays within 80


def clean_pairs(df: DataFrame, columns: Sequence[str], names: Sequence[str] = ("src", "tgt"),
                id_col: str | None = "pair_id", normalize_na: bool = True) -> DataFrame:
    """B1 select the given columns in order, B2 rename them by position, A3 null the
    missing-value tokens, B3 drop rows with any null."""
    keep = ([id_col] if id_col else []) + list(columns)
    out = df.select(*[F.col(f"`{c}`") for c in keep]).toDF(*(([id_col] if id_col else []) + list(names)))
    if normalize_na:
        out = out.select(*[na_normalize(c).alias(c) if c in names else F.col(c) for c in out.columns])
    return out.na.drop("any")


def union_pairs(*frames: DataFrame) -> DataFrame:
    """G1: UNION ALL by column name, duplicates kept."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def with_lengths(df: DataFrame, tokenizer="words", src="src", tgt="tgt") -> DataFrame:
    tok = get_tokenizer(tokenizer)
    return (df.withColumn("src_len", F.size(tok(F.col(src))).cast("long"))
              .withColumn("tgt_len", F.size(tok(F.col(tgt))).cast("long")))


def filter_max_len(df: DataFrame, max_src: int = MAX_SRC_TOKENS, max_tgt: int = MAX_TGT_TOKENS,
                   tokenizer="words") -> DataFrame:
    """Keep pairs whose token counts fit the position table."""
    return (with_lengths(df, tokenizer)
            .filter((F.col("src_len") <= max_src) & (F.col("tgt_len") <= max_tgt)))


def order_key(id_col: str = "pair_id", seed: int = SEED):
    """reproducible shuffle key md5('<seed>:<id>')."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def shuffled_rank(df: DataFrame, id_col: str = "pair_id", seed: int = SEED,
                  rank_col: str = "rn", total_col: str | None = "_n", keep: list | None = None) -> DataFrame:
    """Row number in the seeded hash order (ties by id), plus the table size."""
    keyed = df.withColumn("_h", order_key(id_col, seed))
    return hash_rank(keyed, "_h", id_col, rank_col=rank_col, total_col=total_col, keep=keep).drop("_h")


def exact_split(df: DataFrame, id_col: str = "pair_id", seed: int = SEED,
                fractions: tuple[float, float] = (0.6, 0.8), keep: list | None = None) -> DataFrame:
    """Contiguous cuts of the seeded order at int(f1*n) and int(f2*n) (double
    arithmetic, as int(.6*n) computes it).  Adds ``rn`` and ``split``."""
    r = shuffled_rank(df, id_col, seed, keep=keep)
    c1 = F.floor(F.col("_n").cast("double") * F.lit(fractions[0]))
    c2 = F.floor(F.col("_n").cast("double") * F.lit(fractions[1]))
    return (r.withColumn("split", F.when(F.col("rn") <= c1, "train")
                         .when(F.col("rn") <= c2, "val").otherwise("test"))
            .drop("_n"))


def split_by_cuts(df: DataFrame, id_col: str = "pair_id", seed: int = SEED,
                  fractions: tuple[float, float] = (0.6, 0.8), ids: DataFrame | None = None) -> DataFrame:
    """E1 without a rank: the split of ``exact_split``, from the two (hash, id) keys at which
    the seeded order is cut.

    Rows are counted by hash prefix (65,536 counts, reduced map-side), only the buckets of the
    two cuts are ranked, and every row is then labelled by comparing its key with literals, so
    no text is shuffled or cached.  Ids are unique, as in ``exact_split``: rows that share the
    id of a cut stay on its side.  ``ids`` may give the same ids by a cheaper plan.
    """
    key = F.struct(order_key(id_col, seed).alias("h"), F.col(id_col).cast("string").alias("id"))
    bucket = F.conv(F.substring("key.h", 1, 4), 16, 10).cast("int")
    keyed = (df if ids is None else ids).select(key.alias("key")).withColumn("bucket", bucket)
    counts = sorted((r.bucket, r.n) for r in keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect())
    total = sum(n for _, n in counts)
    wanted, before = {}, 0  # by cut, its bucket and its rank there
    for b, n in counts:
        for f in fractions:
            if before < int(f * total) <= before + n:
                wanted[f] = (b, int(f * total) - before)
        before += n
    cuts = {}
    if wanted:
        rank = F.row_number().over(Window.partitionBy("bucket").orderBy("key"))
        ranked = keyed.filter(F.col("bucket").isin([b for b, _ in wanted.values()])).withColumn("rank", rank)
        hit = F.lit(False)
        for b, r in wanted.values():
            hit = hit | ((F.col("bucket") == b) & (F.col("rank") == r))
        found = {(r.bucket, r["rank"]): r.key for r in ranked.filter(hit).collect()}  # at most two rows
        cuts = {f: found[at] for f, at in wanted.items()}

    def up_to(f: float):
        if f not in cuts:  # nothing lies before this cut
            return F.lit(False)
        return key <= F.struct(F.lit(cuts[f].h).alias("h"), F.lit(cuts[f].id).alias("id"))

    return df.withColumn("split", F.when(up_to(fractions[0]), "train").when(up_to(fractions[1]), "val").otherwise("test"))


def split_counts(split_df: DataFrame) -> DataFrame:
    return split_df.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def split_leakage(split_df: DataFrame, cols: Sequence[str] = ("src", "tgt")) -> DataFrame:
    """Distinct pairs present in train and in val / test.

    One aggregation keyed by the pair text; duplicates collapse map-side (partial
    aggregation), so a hot group of copies shrinks before the shuffle.
    """
    flags = (split_df.groupBy(*cols)
             .agg(F.max((F.col("split") == "train").cast("int")).alias("in_train"),
                  F.max((F.col("split") == "val").cast("int")).alias("in_val"),
                  F.max((F.col("split") == "test").cast("int")).alias("in_test")))
    shared = flags.filter(F.col("in_train") == 1).agg(
        F.sum("in_val").cast("long").alias("val"), F.sum("in_test").cast("long").alias("test"))
    return shared.select(F.explode(F.array(
        F.struct(F.lit("val").alias("other_split"), F.coalesce("val", F.lit(0)).alias("n_shared")),
        F.struct(F.lit("test").alias("other_split"), F.coalesce("test", F.lit(0)).alias("n_shared"))))
        .alias("r")).select("r.other_split", F.col("r.n_shared").cast("long").alias("n_shared"))
