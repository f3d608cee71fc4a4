"""Training-data pipeline: each stage calls one operator of ``parallax.llm`` on what the
stage before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parallax.llm import bpe_codec, decontaminate, jaccard_join, line_dedup, quality_rules
from parallax.llm.common import documents, written

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the perplexity band of their language reject go; null and
    empty texts have no words and go, null ids do not matter, repeated rows are judged alike."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source leave its documents; n_chars follows the text where it
    changes.  Null texts stay null; repeated rows are cleaned alike, and copies count once."""
    out = line_dedup.cleaned(docs, "source")
    changed = ~F.col("text").eqNullSafe(F.col("row.text"))
    n = F.when(changed, F.length("text").cast("long")).otherwise(F.col("row.n_chars"))
    new = {"text": F.col("text"), "n_chars": n}
    return out.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8) stays, the one of the
    smallest id.  Rows without id or words stay; of rows that repeat id and text one stays."""
    return jaccard_join.keep_one(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; rows without id or text stay."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontaminate.drop_contaminated(docs, items)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text, and whether they decode to it; a null text is empty."""
    keys = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*keys).alias("row"), F.coalesce("text", F.lit("")).cast("binary").alias("bytes"), "text")
    out = bpe_codec.encode_decode(rows, RANKS, public_tokenizers.PATTERN, ["row", "bytes"])
    return out.select("row.*", "ids", F.size("ids").cast("long").alias("n_tokens"), (F.col("decoded") == F.col("bytes")).alias("round_trip"))


STAGES = [("quality rules", quality), ("line dedup", lines), ("n-gram Jaccard join", near_duplicates),
          ("benchmark decontamination", decontamination), ("byte-level BPE", encoding)]
#: Perplexity, set similarity and merges have no SQL; tests/llm holds each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
