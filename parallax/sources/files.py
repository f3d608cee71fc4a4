"""File sources and sinks: headerless TSV with an explicit column map (A1), headed CSV
with bad-line quarantine (A2), per-split CSV sink (A4), split reload under a declared
field list (A5), and Parquet artifacts (A6, A7).

Paths are plain Hadoop paths; callers pass folders under the shared checkpoint dir
(``parallax.session.scratch_path``) or their own table locations.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parallax.sources.records import read_delimited

# Write options that keep text intact (the CSV writer trims whitespace by default).
_WRITE_TEXT = {"quoteAll": "true", "escape": '"', "quote": '"',
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_tsv(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Headerless tab-separated file in the given column order."""
    (df.select(*columns).write.mode("overwrite").options(**_WRITE_TEXT)
     .option("sep", "\t").option("header", "false").csv(path))


def _named(rows: DataFrame, names: Mapping[int, str]) -> DataFrame:
    return rows.select(*[F.get("f", F.lit(i)).alias(name) for i, name in sorted(names.items())])


def read_tsv(spark: SparkSession, path: str, column_map: Mapping[int, str], n_columns: int) -> DataFrame:
    """A1: headerless TSV; ``column_map`` names columns by 0-based position (no guessing
    of column order or index columns).  One file is read by many tasks."""
    return _named(read_delimited(spark, path, n_columns, sep="\t", header=False), column_map)


def write_raw_lines(df: DataFrame, path: str, line_col: str, header: str) -> None:
    """Write each value of ``line_col`` verbatim as one line, under a header line (one per
    part file).  Used to produce messy delimited text from table data."""
    (df.select(F.col(line_col).alias(header)).write.mode("overwrite")
     .option("sep", "\u0001").option("quote", "").option("escapeQuotes", "false")
     .option("header", "true").option("ignoreLeadingWhiteSpace", "false")
     .option("ignoreTrailingWhiteSpace", "false").csv(path))


def read_csv_badlines(spark: SparkSession, path: str, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """A2: headed CSV.  Returns (kept, quarantined):

    * short rows are kept with nulls in the missing fields (as a pandas read does),
    * rows with more fields than the header, empty ones included, and a row whose quoted field
      its file never closes, are quarantined with their raw text (``raw``) and first fields.
    One file is read by many tasks, quoted line breaks or not.
    """
    rows = read_delimited(spark, path, len(columns))
    names, too_long = dict(enumerate(columns)), F.col("size") > len(columns)
    quarantined = rows.filter(too_long)
    return (_named(rows.filter(~too_long), names),
            quarantined.select(F.col("record").alias("raw"), *[F.get("f", F.lit(i)).alias(c) for i, c in names.items()]))


def write_splits(split_df: DataFrame, path: str, columns: Sequence[str] = ("pair_id", "src", "tgt")) -> None:
    """A4: one headed CSV set per split (``split=`` folders), values quoted, quotes doubled."""
    (split_df.select(*columns, "split").write.mode("overwrite").options(**_WRITE_TEXT)
     .option("header", "true").partitionBy("split").csv(path))


def read_splits(spark: SparkSession, path: str, fields: Sequence[str] = ("pair_id", "src", "tgt")) -> DataFrame:
    """A5: re-read the split files binding columns to ``fields`` by position (the header
    line is skipped, not trained on); ``split`` comes back from the folder names.  One file is
    read by many tasks."""
    rows = read_delimited(spark, path, len(fields))
    return rows.select(*[F.get("f", F.lit(i)).alias(c) for i, c in enumerate(fields)], F.regexp_extract("file", "/split=([^/]+)/", 1).alias("split"))


def save_artifacts(tables: Mapping[str, DataFrame], path: str) -> None:
    """Each table to ``path/<name>`` as Parquet, replacing the previous save."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")


def load_artifacts(spark: SparkSession, path: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """Load saved tables by name."""
    return {n: spark.read.parquet(f"{path.rstrip('/')}/{n}") for n in names}
