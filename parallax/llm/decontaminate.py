"""Benchmark decontamination in DataFrame operations only: size-partitioned MinHash
containment search, then exact shingle containment.

Words are runs of letters and digits of the lower-cased text; shingles have ``WIDTH`` words
(fewer words make one shingle).  A document holds an item if at least ``PERCENT`` % of the
item's distinct shingles occur in it.

Items are partitioned by their number of shingles n, and each partition's MinHash sketch
holds the n - ceil(n * PERCENT / 100) + 1 smallest hashes.  A document that holds the item
misses at most n - ceil(n * PERCENT / 100) shingles, so it has one of the sketch: the
search loses nothing, however long the document, and most documents meet no sketch.
Candidates are checked on the shingles themselves, not their hashes.

The sketches are broadcast after a count of their rows, else joined by shuffle.  Documents
are identified by the MD5 digest of their text, so copies share one verdict.

Results for odd input: null, empty or wordless items match nothing; null or empty texts hold
nothing; repeated items are one; a repeated document gives a row each time; null ids are
carried; other columns are kept (filter) or not read (search).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parallax.llm.common import written
from parallax.operators.ordering import sized_broadcast

WIDTH = 5
PERCENT = 80


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda x: x != "")


def _with_words(df: DataFrame, text_col: str) -> DataFrame:
    """``_w``: the words; ``_at``: the start of each shingle."""
    df = df.withColumn("_w", _words(F.coalesce(F.col(text_col), F.lit(""))))
    last = F.greatest(F.size("_w") - WIDTH, F.lit(0))
    return df.withColumn("_at", F.when(F.size("_w") > 0, F.sequence(F.lit(0), last)).otherwise(
        F.array().cast("array<int>")))


def _shingles() -> Column:
    return F.array_distinct(F.transform("_at", lambda i: F.array_join(F.slice("_w", i + 1, WIDTH), " ")))


def _hashes(df: DataFrame) -> DataFrame:
    """``_h``: the shingles' hashes, made from one hash for each word."""
    df = df.withColumn("_x", F.transform("_w", lambda x: F.xxhash64(x)))
    return df.withColumn("_h", F.transform("_at", lambda i: F.xxhash64(*[F.get("_x", i + k) for k in range(WIDTH)])))


def sketches(items: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(item_id, hash) of the sketches and (item_id, n_item, shingles) of the items."""
    base = _with_words(items.select("item_id", "text").distinct(), "text").filter(F.size("_w") > 0)
    table = written(_hashes(base).select("item_id", _shingles().alias("shingles"),
                                         F.array_sort(F.array_distinct("_h")).alias("hashes"))
                    .withColumn("n_item", F.size("shingles").cast("long")), "decon-items")
    need = F.ceil(F.col("n_item") * percent / 100)
    size = (F.col("n_item") - need + 1).cast("int")
    return (table.select("item_id", F.explode(F.slice("hashes", F.lit(1), size)).alias("hash")).distinct(),
            table.select("item_id", "n_item", "shingles"))


def search(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, key, item_id, n_item, n_shared) of every document and item it holds; key is
    the digest of the text."""
    sketch, full = sketches(items, percent)
    texts = docs.select("doc_id", "text", F.unhex(F.md5("text")).alias("key")).filter("text is not null")
    # explode() would push a filter on the array's size below its making, and so make it anew
    # for every element
    hashed = (_hashes(_with_words(texts.select("key", "text"), "text"))
              .select("key", F.explode_outer("_h").alias("hash")).filter("hash is not null"))
    sketch = written(sketch, "decon-sketch")
    found = (hashed.join(sized_broadcast(sketch), "hash").groupBy("key")
             .agg(F.collect_set("item_id").alias("found")))
    found = written(found, "decon-found")
    held = (_with_words(texts.join(found, "key"), "text").select("doc_id", "key", "found", _shingles().alias("_s"))
            .select("doc_id", "key", "_s", F.explode("found").alias("item_id")))
    shared = F.size(F.array_intersect("_s", "shingles")).cast("long")
    return (held.join(full, "item_id").select("doc_id", "key", "item_id", "n_item", shared.alias("n_shared"))
            .filter(F.col("n_shared") * 100 >= F.col("n_item") * percent))


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared) of every leak."""
    return search(docs, items).select("doc_id", "item_id", "n_item", "n_shared")


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item."""
    gone = written(search(docs, items).select(F.col("key").alias("_gone")).distinct(), "decon-gone")
    return docs.join(gone, F.unhex(F.md5(docs["text"])) == gone["_gone"], "left_anti")


ORACLE_SQL = rf"""
WITH dw AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w FROM documents),
iw AS (SELECT item_id, list_filter(string_split_regex(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, array_to_string(w[i + 1:i + {WIDTH}], ' ') AS s
       FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - {WIDTH - 1}, 1))) AS i FROM dw WHERE len(w) > 0)),
si AS (SELECT DISTINCT item_id, array_to_string(w[i + 1:i + {WIDTH}], ' ') AS s
       FROM (SELECT item_id, w, unnest(range(greatest(len(w) - {WIDTH - 1}, 1))) AS i FROM iw WHERE len(w) > 0)),
n AS (SELECT item_id, count(*) AS n_item FROM si GROUP BY 1),
j AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN si USING (s) GROUP BY 1, 2)
SELECT doc_id, item_id, n_item, n_shared FROM j JOIN n USING (item_id) WHERE n_shared * 100 >= n_item * {PERCENT}"""
