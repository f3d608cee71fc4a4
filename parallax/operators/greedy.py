"""Greedy budget batches as the orbit of a successor function, without a Python worker.

With the weight w of a row (its padded width) a batch of the rows i..k costs
(k - i + 1) * max(w_i..w_k).  Weights are positive, so the cost grows with k and the row after
the batch that starts at i does not depend on what lies before i:

    next(i) = the first k > i at which the batch i..k is over the budget

Batch starts are therefore the orbit of row 0.  Both parts run by doubling on arrays:

1. ``next`` by binary lifting: level j holds the greatest weight of 2^j rows, and a batch is
   extended by 2^j rows at a time, from the largest j down, while it stays within the budget.
2. The orbit by pointer doubling: after j steps a row points 2^j batches ahead, so in
   log2(rows) steps every row knows where a chain of batches through it leaves its chunk, and
   how many batches that takes.

A pool is cut into chunks of at least as many rows as a batch can hold; chunks are dealt over
all tasks by (pool, chunk), and each brings the weights of the rows behind it.  Only the chunks'
pointers meet by pool, to find the row at which each chunk is entered.  A pool, and so what
meets, is bounded by ``pool_rows``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MIN_WEIGHT = 2  # a target is never shorter than its two markers
CHUNK_ROWS = 1024


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _range(n: Column) -> Column:
    """0 .. n - 1 (an empty array for 0)."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def successors(weights: Column, rows: Column, budget: int, longest: int) -> Column:
    """For the first ``rows`` places of ``weights`` (which goes on behind them) the place after
    the batch that starts there; at most ``longest`` rows fit in a batch."""
    over = F.lit(budget + 1).cast("long")  # behind the last row nothing fits
    powers = [1 << j for j in range(max(longest, 1).bit_length())]

    def widened(levels: Column, power: Column) -> Column:
        return let(F.element_at(levels, -1), lambda last: F.concat(levels, F.array(F.transform(
            _range(F.size(last)), lambda p: F.greatest(F.get(last, p), F.coalesce(F.get(last, p + power), over))))))

    levels = F.aggregate(F.array(*[F.lit(p) for p in powers[:-1]]), F.array(weights), widened)

    def longest_from(levels: Column, i: Column) -> Column:
        start = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("m"))

        def extended(acc: Column, j: Column) -> Column:
            power = F.element_at(F.array(*[F.lit(p) for p in powers]), j + 1)
            most = F.greatest(acc["m"], F.coalesce(F.get(F.get(levels, j), i + acc["n"]), over))
            return F.when((acc["n"] + power) * most <= budget, F.struct((acc["n"] + power).alias("n"), most.alias("m"))).otherwise(acc)

        return F.aggregate(F.array(*[F.lit(j) for j in reversed(range(len(powers)))]), start, extended)["n"]

    return let(levels, lambda ls: F.transform(_range(rows), lambda i: i + F.greatest(longest_from(ls, i), F.lit(1))))


def exits(after: Column, rows: Column, doublings: int) -> Column:
    """(at, n) arrays by place: where the chain of batches from it leaves the chunk, and in how
    many batches."""
    start = F.struct(after.alias("at"), F.transform(after, lambda _: F.lit(1)).alias("n"))

    def doubled(acc: Column, _: Column) -> Column:
        return F.struct(
            F.transform(acc["at"], lambda x: F.when(x < rows, F.get(acc["at"], x)).otherwise(x)).alias("at"),
            F.zip_with(acc["at"], acc["n"], lambda x, n: F.when(x < rows, n + F.get(acc["n"], x)).otherwise(n)).alias("n"))

    return F.aggregate(F.array(*[F.lit(j) for j in range(doublings)]), start, doubled)


def _entries(chunks: Column) -> Column:
    """For the chunks of a pool in order, the place at which a batch first starts in each, and
    the number of batches before."""
    none = F.array().cast("array<struct<at:int,batch:int>>")
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("batch"), none.alias("out"))

    def entered(acc: Column, c: Column) -> Column:
        return F.struct(
            (F.coalesce(F.get(c["out"]["at"], acc["at"]), acc["at"]) - c["rows"]).alias("at"),
            (acc["batch"] + F.coalesce(F.get(c["out"]["n"], acc["at"]), F.lit(0))).alias("batch"),
            F.concat(acc["out"], F.array(F.struct(acc["at"].alias("at"), acc["batch"].alias("batch")))).alias("out"))

    return F.aggregate(chunks, start, entered)["out"]


def _labels(chunk: Column, entry: Column) -> Column:
    """The batch of each row of a chunk."""
    n = F.coalesce(F.get(chunk["out"]["n"], entry["at"]), F.lit(0))
    starts = F.aggregate(_range(n), F.array(entry["at"]),
                         lambda acc, _: F.concat(acc, F.array(F.get(chunk["after"], F.element_at(acc, -1)))))
    lead = F.least(entry["at"], chunk["rows"])  # rows of the batch that began in a chunk before
    own = let(starts, lambda s: F.flatten(F.transform(_range(F.size(s) - 1), lambda k: F.array_repeat(
        entry["batch"] + k, F.least(F.get(s, k + 1), chunk["rows"]) - F.get(s, k)))))
    return F.concat(F.array_repeat(entry["batch"] - 1, lead), own)


def greedy_batches(df: DataFrame, group: str, order: Sequence, weight: Column, keep: Sequence[str], budget: int,
                   min_weight: int = MIN_WEIGHT, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(group, *keep, batch_id): rows of each group in ``order`` (a total order), cut greedily
    so that rows x greatest weight stays within ``budget``; a heavier row is alone.  Weights
    are at least ``min_weight``.  A group must fit in a task, as pointers, once."""
    longest = max(1, budget // min_weight)
    size = max(chunk_rows, longest)
    held = F.struct(*keep)
    rows = (df.select(group, weight.cast("long").alias("_w"), held.alias("_held"),
                      (F.row_number().over(Window.partitionBy(group).orderBy(*order)) - 1).alias("_pos")))
    chunk, place = F.floor(F.col("_pos") / size).cast("int"), F.col("_pos") % size
    seen_by = F.when((place < longest) & (chunk > 0), F.array(chunk, chunk - 1)).otherwise(F.array(chunk))
    dealt = rows.select(group, "_w", "_held", "_pos", chunk.alias("_of"), F.explode(seen_by).alias("_chunk"))
    item = F.struct("_pos", "_w", F.when(F.col("_of") == F.col("_chunk"), F.col("_held")).alias("held"),
                    (F.col("_of") == F.col("_chunk")).alias("own"))
    chunks = (dealt.repartition(group, "_chunk").groupBy(group, "_chunk")
              .agg(F.array_sort(F.collect_list(item)).alias("items"), F.count_if(F.col("_of") == F.col("_chunk")).cast("int").alias("rows")))
    pointed = chunks.select(group, "_chunk", "rows", F.transform(F.slice("items", F.lit(1), F.col("rows")), lambda x: x["held"]).alias("held"),
                            successors(F.transform("items", lambda x: x["_w"]), F.col("rows"), budget, longest).alias("after"))
    doublings = max(1, size).bit_length()
    joined = F.struct("_chunk", "rows", "held", "after", let(F.col("after"), lambda a: exits(a, F.col("rows"), doublings)).alias("out"))
    pools = pointed.groupBy(group).agg(F.collect_list(joined).alias("chunks"))
    entered = pools.select(group, F.inline(let(F.array_sort("chunks", lambda a, b: a["_chunk"] - b["_chunk"]), lambda cs: F.zip_with(
        cs, _entries(cs), lambda c, e: F.struct(c.alias("c"), e.alias("e"))))))
    labelled = entered.select(group, F.inline(F.zip_with(F.col("c.held"), _labels(F.col("c"), F.col("e")),
                                                         lambda h, b: F.struct(h.alias("held"), b.alias("batch")))))
    return labelled.select(group, "held.*", F.col("batch").cast("long").alias("batch_id"))
