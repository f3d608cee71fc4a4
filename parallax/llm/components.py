"""Connected components of a table of links by alternating star steps.

Large star: each node sends its larger neighbours to the smallest node it knows; small
star: its smaller neighbours and itself.  Both keep the components and end in stars with
the smallest node as centre.  A step is a partial aggregation and a join on the node, so a
node with very many links is reduced before the shuffle and its join can be split; nothing
is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parallax.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b").filter("a < b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    joined = edges.join(least, "b")
    return (joined.select(F.col("m").alias("a"), F.col("a").alias("b"))
            .union(least.select(F.col("m").alias("a"), "b")).filter("a < b").distinct())


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that occurs in ``links`` (a, b): the smallest node
    reachable.  Empty links give an empty table."""
    edges = written(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                    .filter("a < b").distinct(), "components")
    state = None
    while True:
        new = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == state or not new[0]:
            break
        state = new
        edges = written(_small_star(_large_star(edges)), "components")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
        edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
