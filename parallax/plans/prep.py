"""Corpus preparation job: feeds -> clean -> union -> split -> vocabularies.

The frames are lazy plans; the vocabularies and ranks are checkpointed (shared
checkpoint dir), so they are memoised per session and input folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parallax.operators.corpus import clean_pairs, split_by_cuts, union_pairs
from parallax.operators.vocab import build_pair_vocab_table
from parallax.functions.text import get_tokenizer, na_normalize, tokenize, tokenize_script
from parallax.session import release, scratch_path
from parallax.sources.tables import conversation_turn_pairs, document_line_pairs, spread, table

_MEMO: dict = {}


def _state(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and times of what lies in the folder; a table that is a folder gets a new time
    when files are added to it or taken away."""
    path = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.listStatus(path) if files.exists(path) else []
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in found))


def _memo_key(spark: SparkSession, sf_dir: str, key: str) -> tuple:
    return spark.sparkContext.applicationId, sf_dir.rstrip("/"), _state(spark, sf_dir), key


def _memo(spark: SparkSession, sf_dir: str, key: str, build):
    """Prepared tables by session, folder and the state of the folder, so a folder that has
    changed is prepared again."""
    k = _memo_key(spark, sf_dir, key)
    if k not in _MEMO:
        _MEMO[k] = build()
    return _MEMO[k]


def pairs_a_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _memo(spark, sf_dir, "pairs_a_raw",
                 lambda: conversation_turn_pairs(table(spark, sf_dir, "conversations")))


def pairs_b_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_line_pairs(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))


def pairs_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_pairs(pairs_a_raw(spark, sf_dir), ["user_text", "reply_text"])


def pairs_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_pairs(pairs_b_raw(spark, sf_dir), ["line", "next_line"])


def pairs_b_tokens(spark: SparkSession, sf_dir: str, tokenizer="words") -> DataFrame:
    """pairs_b with its tokens and lengths.  A line is the source of one pair and the target of
    the one before; a tokenizer of this library reads it once for both."""
    tok = get_tokenizer(tokenizer)
    if tok not in (tokenize, tokenize_script):  # another one may not run inside an array
        return with_tokens(pairs_b(spark, sf_dir), tok)
    raw = document_line_pairs(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), tok)
    return with_lengths(raw.select("pair_id", na_normalize("line").alias("src"), na_normalize("next_line").alias("tgt"),
                                   F.col("line_toks").alias("src_toks"), F.col("next_toks").alias("tgt_toks"))
                        .na.drop("any", subset=["pair_id", "src", "tgt"]))


def pairs_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_pairs(pairs_a(spark, sf_dir), pairs_b(spark, sf_dir))


def split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split corpus with token arrays (``src_toks``, ``tgt_toks``), read from the
    prepared table."""
    return corpus(spark, sf_dir)


def corpus(spark: SparkSession, sf_dir: str, tokenizer="words") -> DataFrame:
    """Prepared corpus: both feeds, exact split, token arrays and lengths, written once
    as Parquet in the shared folder and read back, so every later job scans tokens
    instead of re-running the tokenizer (and the lineage is cut there).  The split compares
    each row's hash key with two literals, so no text is shuffled or cached."""
    def build():
        path = scratch_path(spark, "corpus")
        _split_plan(spark, sf_dir, tokenizer).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)
    return _memo(spark, sf_dir, f"corpus:{tokenizer}", build)


def _split_plan(spark: SparkSession, sf_dir: str, tokenizer="words") -> DataFrame:
    def build():
        a = pairs_a_tokens(spark, sf_dir, tokenizer)
        b = pairs_b_tokens(spark, sf_dir, tokenizer)
        return split_by_cuts(a.unionByName(b), ids=pair_ids(spark, sf_dir, tokenizer))
    return _memo(spark, sf_dir, f"split-plan:{tokenizer}", build)


def pair_ids(spark: SparkSession, sf_dir: str, tokenizer="words") -> DataFrame:
    """(pair_id) of the rows of ``corpus``, without their tokens."""
    return pairs_a_tokens(spark, sf_dir, tokenizer).select("pair_id").unionByName(pairs_b(spark, sf_dir).select("pair_id"))


def split_once(spark: SparkSession, sf_dir: str, tokenizer="words") -> DataFrame:
    """The rows of ``corpus`` for a job that reads them once: the written table if there is one
    already, otherwise its plan, so that no copy of all texts and tokens is written and only the
    side that is asked for is tokenized."""
    ready = _MEMO.get(_memo_key(spark, sf_dir, f"corpus:{tokenizer}"))
    return _split_plan(spark, sf_dir, tokenizer) if ready is None else ready


def with_tokens(df: DataFrame, tok) -> DataFrame:
    return with_lengths(df.withColumn("src_toks", tok(F.col("src"))).withColumn("tgt_toks", tok(F.col("tgt"))))


def with_lengths(df: DataFrame) -> DataFrame:
    return df.withColumn("src_len", F.size("src_toks").cast("long")).withColumn("tgt_len", F.size("tgt_toks").cast("long"))


def vocabs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Source and target vocabularies, written once as Parquet in the shared folder
    (Q5: the vocabulary is a persisted table, not rebuilt per consumer).  Every lookup
    then scans a small written table, and its size check is a metadata count."""
    def build():
        path = scratch_path(spark, "vocabs")
        # both sides in one job, partitioned by side; each side reads back only its folder
        (build_pair_vocab_table(split_once(spark, sf_dir), tokenizer=None, src="src_toks", tgt="tgt_toks")
         .write.mode("overwrite").partitionBy("side").parquet(path))
        release(spark)  # of the counts' shuffles
        both = spark.read.parquet(path)
        return (both.filter(F.col("side") == "src").drop("side"),
                both.filter(F.col("side") == "tgt").drop("side"))
    return _memo(spark, sf_dir, "vocabs", build)


def pairs_a_tokens(spark: SparkSession, sf_dir: str, tokenizer="words") -> DataFrame:
    """Prepared pairs_a: (pair_id, src, tgt, src_toks, tgt_toks, src_len, tgt_len),
    written once as Parquet in the shared folder.  Token counts, batching, lexical
    training, translation and BLEU all scan it, so the conversation-turn pairing and
    the tokenizer run once instead of once per consumer."""
    def build():
        tok = get_tokenizer(tokenizer)
        path = scratch_path(spark, "pairs-a")
        with_tokens(pairs_a(spark, sf_dir), tok).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)
    return _memo(spark, sf_dir, f"pairs_a_tokens:{tokenizer}", build)


def pairs_a_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and token lengths of the whole pairs_a with its seeded order ``rn`` (batching
    input).  Only the narrow (id, lengths) projection is shuffled by the rank."""
    from parallax.operators.corpus import shuffled_rank

    def build():
        held: list = []
        slim = pairs_a_tokens(spark, sf_dir).select("pair_id", "src_len", "tgt_len")
        path = scratch_path(spark, "pairs-a-ordered")
        shuffled_rank(slim, total_col=None, keep=held).write.mode("overwrite").parquet(path)
        for d in held:
            d.unpersist()
        return spark.read.parquet(path)
    return _memo(spark, sf_dir, "pairs_a_ordered", build)
