"""URL filters by a temporal list join.

Dated list entries (key, action, date) become validity intervals: of the entries of one key
and date an addition stands before a removal, and an addition holds from its date until the
key's next entry.  A key is a host, which also covers its subdomains, or a host with the
first parts of a path, of any number.  User info, port and dots at the end of a host do not
belong to it.  An as-of join finds the intervals in force when a capture was
fetched: both sides are cut by month, so the join has an equality on (key, month) and no
key compares all its captures with all its intervals.

Captures of one URL and day are looked up once.  A hot host is a hot join key, which Spark
splits or, as lists are small beside captures, broadcasts by size; nothing is collected.

Results for odd input: a null or malformed URL has no key and passes; a host of one label has
no key, an address in brackets is one; a null fetch date meets no entry; entries with null key,
action or date are ignored; repeated entries are one; repeated captures are each returned; other
columns are kept, but for n_listed and listed_key, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

URL = (r"^[a-z][a-z0-9+.\-]*://(?:[^/?#]*@)?(\[[0-9a-f:.]+\]|[^/:?#@\[\]]+?)"
       r"\.*(?::[0-9]*)?(/[^?#]*)?(?:[?#].*)?$")


def host(url: Column) -> Column:
    return F.regexp_extract(F.lower(url), URL, 1)


def path_parts(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda x: x != "")


def keys(url: Column, lengths: list[int]) -> Column:
    """The host and its parent domains of two labels or more, and the host with the first
    parts of the path, as many as each of ``lengths``."""
    name = host(url)
    address = name.startswith("[")
    labels = F.split(name, r"\.")
    n = F.size(labels)
    domains = F.when(address, F.array(name)).when(n > 1, F.transform(
        F.sequence(F.lit(1), n - 1), lambda i: F.array_join(F.slice(labels, i, n), ".")))
    parts = path_parts(F.regexp_extract(F.lower(url), URL, 2))
    counts = F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda i: i <= F.size(parts))
    paths = F.when((n > 1) | address, F.transform(counts, lambda i: F.concat(name, F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/"))))
    none = F.array().cast("array<string>")
    return F.concat(F.coalesce(domains, none), F.coalesce(paths, none))


def key_lengths(entries: DataFrame) -> list[int]:
    """The numbers of path parts that the keys of a list have (one row for each depth)."""
    depth = F.size(path_parts(F.regexp_extract("key", "/(.*)", 1))).alias("depth")
    return sorted(r.depth for r in entries.filter("key is not null").select(depth).distinct().collect() if r.depth > 0)


def _month(date: Column) -> Column:
    return F.year(date) * 12 + F.month(date)


def intervals(entries: DataFrame) -> DataFrame:
    """(key, valid_from, valid_to) in force; valid_to is exclusive, null if open."""
    day = (entries.filter(F.col("key").isNotNull() & F.col("date").isNotNull() & F.col("action").isin("add", "remove"))
           .groupBy("key", "date").agg(F.max(F.col("action") == "add").alias("listed")))
    step = day.withColumn("valid_to", F.lead("date").over(Window.partitionBy("key").orderBy("date")))
    return step.filter("listed").select("key", F.col("date").alias("valid_from"), "valid_to")


def as_of(captures: DataFrame, entries: DataFrame, url_col: str = "url", date_col: str = "fetched") -> DataFrame:
    """``captures`` with n_listed (intervals in force at fetch time) and listed_key (the
    smallest key of them, null if none)."""
    rows = captures.select(F.struct("*").alias("row"), F.col(url_col).alias("url"), F.col(date_col).alias("date"))
    seen = rows.select("url", "date").distinct().filter("url is not null and date is not null")
    each = seen.select("url", "date", F.explode(keys(F.col("url"), key_lengths(entries))).alias("key"), _month(F.col("date")).alias("month"))
    span = seen.agg(F.max("date").alias("d"))
    held = intervals(entries)
    last = F.least(F.coalesce(F.date_sub("valid_to", 1), F.col("d")), F.col("d"))
    months = (held.join(F.broadcast(span))  # one row
              .filter(F.col("valid_from") <= last)
              .select("*", F.explode(F.sequence(_month(F.col("valid_from")), _month(last))).alias("month")))
    hits = (each.join(months, ["key", "month"])
            .filter((F.col("date") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("date") < F.col("valid_to"))))
            .groupBy("url", "date").agg(F.count("*").alias("n_listed"), F.min("key").alias("listed_key")))
    kept = [F.col(f"row.`{c}`") for c in captures.columns if c not in ("n_listed", "listed_key")]
    return rows.join(hits, ["url", "date"], "left").select(*kept, F.coalesce("n_listed", F.lit(0).cast("long")).alias("n_listed"), "listed_key")


def _draw(text: Column, n: int) -> Column:
    return (F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("int") % n).cast("int")


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages with a fetch date; the table has none, so it is drawn from the page's id
    and URL."""
    pages = spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet").select("page_id", "url")
    seed = F.concat(F.col("page_id").cast("string"), F.lit("@"), F.col("url"))
    return pages.withColumn("fetched", F.date_add(F.lit("2024-01-01").cast("date"), _draw(seed, 366)))


def entries_of(pages: DataFrame) -> DataFrame:
    """A dated list over the sites and site sections of the pages: an addition for each
    third key, a removal for half of them, a second addition for some."""
    url = F.lower("url")
    site = F.regexp_replace(host(url), r"^(www|m|blog)\.", "")
    part = F.regexp_extract(url, URL, 2)
    section = F.concat(host(url), F.lit("/"), F.regexp_extract(part, "^/([^/]+)", 1))
    key = pages.select(F.explode(F.array(site, section)).alias("key")).filter("key rlike '^[^/]+(/.+)?$'").distinct()
    listed = key.filter(_draw(F.col("key"), 3) == 0)
    first = F.date_add(F.lit("2023-11-01").cast("date"), _draw(F.concat("key", F.lit("#a")), 300))
    until = F.date_add(first, _draw(F.concat("key", F.lit("#r")), 90) + 20)
    again = F.date_add(until, _draw(F.concat("key", F.lit("#b")), 60) + 10)
    kind = _draw(F.concat("key", F.lit("#k")), 4)
    row = lambda a, d, least: F.when(kind >= least, F.struct(F.lit(a).alias("action"), d.alias("date")))
    return (listed.select("key", F.explode(F.array(row("add", first, 0), row("remove", until, 2), row("add", again, 3))).alias("e"))
            .filter("e is not null").select("key", "e.action", "e.date"))


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, url, fetched, n_listed, listed_key, blocked) of every page."""
    pages = captures(spark, sf_dir)
    return as_of(pages, entries_of(pages)).withColumn("blocked", F.col("n_listed") > 0)


def _sql_draw(x: str, n: int) -> str:
    return f"(('0x' || substr(md5({x}), 1, 7))::INT % {n})"


ORACLE_SQL = rf"""
WITH c AS (
  SELECT page_id, url, fetched, CASE WHEN name LIKE '[%]' OR name NOT SIMILAR TO '.*[:@\[\]].*' THEN name ELSE '' END AS host,
         CASE WHEN name LIKE '[%]' OR name NOT SIMILAR TO '.*[:@\[\]].*' THEN path ELSE '' END AS path
  FROM (SELECT page_id, url, DATE '2024-01-01' + {_sql_draw("page_id::VARCHAR || '@' || url", 366)} AS fetched,
               rtrim(regexp_replace(regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.\-]*://([^/?#]*)', 1), '^.*@', ''), ':[0-9]*$', ''), '.') AS name,
               regexp_extract(lower(url), '^[a-z][a-z0-9+.\-]*://[^/?#]*(/[^?#]*)', 1) AS path FROM pages)),
k AS (SELECT DISTINCT key FROM (
  SELECT regexp_replace(host, '^(www|m|blog)\.', '') AS key FROM c
  UNION ALL SELECT host || '/' || regexp_extract(path, '^/([^/]+)', 1) FROM c)
  WHERE regexp_matches(key, '^[^/]+(/.+)?$') AND {_sql_draw("key", 3)} = 0),
d AS (SELECT key, {_sql_draw("key || '#k'", 4)} AS kind, DATE '2023-11-01' + {_sql_draw("key || '#a'", 300)} AS a,
             {_sql_draw("key || '#r'", 90)} + 20 AS r, {_sql_draw("key || '#b'", 60)} + 10 AS b FROM k),
e AS (SELECT key, true AS listed, a AS date FROM d UNION ALL SELECT key, false, a + r FROM d WHERE kind >= 2
      UNION ALL SELECT key, true, a + r + b FROM d WHERE kind >= 3),
i AS (SELECT key, listed, date AS valid_from, lead(date) OVER (PARTITION BY key ORDER BY date) AS valid_to FROM e),
lists AS (SELECT page_id, url, fetched, host, string_split(host, '.') AS l,
                 list_filter(string_split(path, '/'), lambda x: x <> '') AS p FROM c),
keys AS (
  SELECT page_id, array_to_string(l[n:], '.') AS key, fetched FROM (SELECT *, unnest(range(1, len(l))) AS n FROM lists)
  UNION ALL SELECT page_id, host || '/' || array_to_string(p[:n], '/'), fetched
  FROM (SELECT *, unnest(range(1, len(p) + 1)) AS n FROM lists WHERE len(l) > 1)),
h AS (SELECT page_id, count(*) AS n_listed, min(key) AS listed_key FROM keys JOIN i USING (key)
      WHERE listed AND fetched >= valid_from AND (valid_to IS NULL OR fetched < valid_to) GROUP BY 1)
SELECT page_id, url, fetched, coalesce(n_listed, 0)::BIGINT AS n_listed, listed_key, n_listed IS NOT NULL AS blocked
FROM c LEFT JOIN h USING (page_id)"""
