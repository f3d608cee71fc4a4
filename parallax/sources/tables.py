"""Table access and the two parallel-text feeds built from the given tables.

pairs_a: each ``user`` turn of ``conversations`` with the following turn when that one
         is ``assistant`` (columns user_text, reply_text before renaming).
pairs_b: each line of ``documents.text`` with the next line of the same document
         (columns line, next_line before renaming; the last line has a null partner).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parallax.operators.ordering import next_in_group

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt over the session's parallelism where the scan has fewer tasks (a table
    of one row group); a scan with enough tasks is left alone."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= n else df.repartition(n)


def conversation_turn_pairs(conversations: DataFrame) -> DataFrame:
    """pairs_a before cleaning: (pair_id, user_text, reply_text).

    The 'next turn' is an exact lead over ``turn`` inside the conversation, computed by
    ``next_in_group`` (chunked by turn, so one huge conversation is not one task).
    """
    nx = next_in_group(conversations.select("conv_id", "turn", "role", "text"),
                       "conv_id", "turn", ["role", "text"])
    pairs = nx.filter((F.col("role") == "user") & (F.col("next_role") == "assistant"))
    return pairs.select(F.concat(F.lit("c:"), F.col("conv_id").cast("string"), F.lit(":"),
                                 F.col("turn").cast("string")).alias("pair_id"),
                        F.col("text").alias("user_text"), F.col("next_text").alias("reply_text"))


def document_line_pairs(documents: DataFrame, tokenizer: Callable[[Column], Column] | None = None) -> DataFrame:
    """pairs_b before cleaning: (pair_id, line, next_line).

    Each document's line array is zipped with itself shifted by one and exploded with
    positions: no window and no shuffle, linear in the text size.  With a (native) ``tokenizer``
    also the tokens of both, line_toks and next_toks, each line tokenized once.
    """
    lines = documents.select("doc_id", F.split(F.col("text"), "\n").alias("_l"))
    after = lambda c: F.slice(c, 2, F.greatest(F.size(c), F.lit(1)))
    columns = {"line": F.col("_l"), "next_line": after("_l")}
    if tokenizer is not None:
        lines = lines.withColumn("_t", F.transform("_l", tokenizer))
        columns |= {"line_toks": F.col("_t"), "next_toks": after("_t")}
    zipped = lines.select("doc_id", F.posexplode(F.arrays_zip(*[c.alias(n) for n, c in columns.items()])).alias("line_no", "_z"))
    return zipped.select(
        F.concat(F.lit("d:"), F.col("doc_id").cast("string"), F.lit(":"),
                 F.col("line_no").cast("string")).alias("pair_id"),
        *[F.col(f"_z.{n}").alias(n) for n in columns])
