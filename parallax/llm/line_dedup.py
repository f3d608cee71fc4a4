"""Line dedup by site-relative frequency, in DataFrame operations only.

For each host the pages that contain a line are divided by the host's pages; lines above
``MAX_RATIO`` on at least ``MIN_PAGES`` pages are boilerplate and leave every page of that
host.  Pages of a host that have the same text are one page, so copies of a text do not make its
lines boilerplate.  Lines are compared without outer spaces, tabs and carriage returns, by their MD5
digest; a page counts once however often it repeats a line.

The counts are partial aggregations by (host, line), so neither a hot host nor a hot line
gathers in one task.  A host's boilerplate is a short list: the counts of its lines add up
to pages x lines per page, so fewer than (lines per page) / MAX_RATIO lines can be above
the ratio.  The list joins the pages by host, which Spark broadcasts or splits by size.

Results for odd input: null text stays null; blank lines are never counted or dropped; null
and empty hosts are one host; a page that loses all lines keeps its row with an empty text;
rows of one text are one page of their host, whatever their ids, and each row is returned; other
columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parallax.llm.common import written

MAX_RATIO = 0.02
MIN_PAGES = 5


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(_bare(line)))


def boilerplate(pages: DataFrame, host_col: str, text_col: str, max_ratio: float = MAX_RATIO,
                min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, lines): the digests of each host's boilerplate lines."""
    slim = pages.select(F.coalesce(F.col(host_col), F.lit("")).alias("host"), F.unhex(F.md5(F.col(text_col))).alias("page"), F.col(text_col).alias("text"))
    totals = slim.select("host", "page").distinct().groupBy("host").agg(F.count("page").alias("pages"))
    found = F.array_distinct(F.transform(F.filter(_lines(F.col("text")), lambda x: _bare(x) != ""), _digest))
    each = slim.select("host", "page", F.explode(found).alias("line")).distinct()
    counts = each.groupBy("host", "line").agg(F.count("*").alias("n"))
    common = counts.filter(F.col("n") >= min_pages).join(totals, "host").filter(
        F.col("n") > max_ratio * F.col("pages"))
    return common.groupBy("host").agg(F.collect_list("line").alias("lines"))


def cleaned(pages: DataFrame, host_col: str, text_col: str = "text", max_ratio: float = MAX_RATIO,
            min_pages: int = MIN_PAGES) -> DataFrame:
    """(row, text): each row of ``pages`` as it is, and its text without the boilerplate lines."""
    # written, so that Spark knows its size before it deals the pages out by host
    common = written(boilerplate(pages, host_col, text_col, max_ratio, min_pages), "line-boilerplate")
    rows = pages.select(F.struct("*").alias("row"), F.coalesce(F.col(host_col), F.lit("")).alias("host"), F.col(text_col).alias("text"))
    kept = F.array_join(F.filter(_lines(F.col("text")), lambda x: (_bare(x) == "") | ~F.array_contains("lines", _digest(x))), "\n")
    return rows.join(common, "host", "left").select("row", F.when(F.col("lines").isNull(), F.col("text")).otherwise(kept).alias("text"))


def drop_boilerplate(pages: DataFrame, host_col: str, text_col: str = "text", max_ratio: float = MAX_RATIO,
                     min_pages: int = MIN_PAGES) -> DataFrame:
    """``pages`` with the boilerplate lines taken out of ``text_col``."""
    out = cleaned(pages, host_col, text_col, max_ratio, min_pages)
    return out.select(*[F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in pages.columns])


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_dropped, text) of each document, with its source as host."""
    out = cleaned(docs.select("doc_id", "source", "text"), "source")
    n = lambda c: F.when(c.isNull(), 0).otherwise(F.size(F.filter(_lines(c), lambda x: _bare(x) != ""))).cast("long")
    before, after = n(F.col("row.text")), n(F.col("text"))
    return out.select("row.doc_id", before.alias("n_lines"), (before - after).alias("n_dropped"), "text")


ORACLE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, text FROM documents),
l AS (
  SELECT r, host, text, u.pos AS pos, u.line AS line, trim(u.line, ' ' || chr(9) || chr(13)) AS bare
  FROM (SELECT r, host, text, string_split(text, chr(10)) AS a FROM d),
       LATERAL (SELECT unnest(a) AS line, unnest(range(len(a))) AS pos) AS u),
totals AS (SELECT host, count(DISTINCT text) AS pages FROM d GROUP BY 1),
common AS (
  SELECT host, bare FROM (SELECT host, bare, count(DISTINCT text) AS n FROM l WHERE bare <> '' GROUP BY 1, 2)
  JOIN totals USING (host) WHERE n >= {MIN_PAGES} AND n > {MAX_RATIO}::DOUBLE * pages),
kept AS (
  SELECT l.r, count(*) FILTER (WHERE l.bare <> '') AS n_lines,
         count(*) FILTER (WHERE c.bare IS NOT NULL) AS n_dropped,
         string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE c.bare IS NULL) AS text
  FROM l LEFT JOIN common c ON l.host = c.host AND l.bare = c.bare GROUP BY l.r)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text
FROM d LEFT JOIN kept USING (r)"""
