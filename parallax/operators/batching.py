"""Batching: pools (E3), greedy token-budget batches (E2, I3), evaluation batches (F5),
length-bucket batches (F3), batch shuffle order (F4), first batch (F6), padding (E5),
pad / causal masks (B4, H6, H7) and batch statistics (D3, D4).

Every grouped step is keyed by a pool or a batch, whose size is bounded by
``pool_rows`` or by the token budget, never by the corpus.  Budget batches move ids and
lengths only; texts are joined back by id.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parallax.functions.text import PAD_ID
from parallax.operators.corpus import SEED
from parallax.operators.greedy import greedy_batches

BATCH_SIZE = 20          # bucket iterator batch size
TOKEN_BUDGET = 1300      # padded-token budget per batch
POOL_FACTOR = 100        # pool = 100 x batch size examples

FOLD_SCHEMA = "pair_id string, pool_id long, batch_id long, row_in_batch long"


def token_budget_cost(count: int, max_src: int, max_tgt: int) -> int:
    """I3 default: padded elements of the larger side; max_tgt already counts <sos>/<eos>."""
    return max(count * max_src, count * max_tgt)


def fold_batches(src_len: np.ndarray, tgt_len: np.ndarray, budget: int,
                 cost_fn: Callable[[int, int, int], int] = token_budget_cost) -> np.ndarray:
    """Greedy budget fold over rows in the given order -> 0-based batch id per row.

    A batch closes when its cost equals the budget, or before the row that would push
    it over; a row over the budget on its own forms its own batch.  No empty batch.
    """
    n = len(src_len)
    out = np.empty(n, dtype=np.int64)
    b, cnt, ms, mt, closed = -1, 0, 0, 0, True
    for i in range(n):
        s, t = int(src_len[i]), int(tgt_len[i]) + 2
        if not closed:
            ms2, mt2 = max(ms, s), max(mt, t)
            cost = cost_fn(cnt + 1, ms2, mt2)
            if cost <= budget:
                cnt, ms, mt = cnt + 1, ms2, mt2
                closed = cost == budget
                out[i] = b
                continue
        b, cnt, ms, mt = b + 1, 1, s, t
        closed = cost_fn(1, s, t) == budget
        out[i] = b
    return out


def with_pools(df: DataFrame, pool_rows: int, order_col: str = "rn") -> DataFrame:
    """Consecutive rows of the shuffled order form pools of ``pool_rows``."""
    return df.withColumn("pool_id", F.floor((F.col(order_col) - 1) / F.lit(pool_rows)).cast("long"))


def first_pool(df: DataFrame, pool_rows: int = TOKEN_BUDGET * POOL_FACTOR, order_col: str = "rn") -> DataFrame:
    """The rows of pool 0, for work that needs no other (a filter that reaches the scan)."""
    return df.filter(F.col(order_col) <= pool_rows)


def budget_batches(df: DataFrame, budget: int = TOKEN_BUDGET, pool_rows: int = TOKEN_BUDGET * POOL_FACTOR,
                   train: bool = True, order_col: str = "rn",
                   cost_fn: Callable[[int, int, int], int] | None = None,
                   sort_keys: tuple[str, ...] = ("src_len", "tgt_len")) -> DataFrame:
    """E2 (train=True): sort each pool by ``sort_keys`` (I2), then pair_id, and fold.
    F5 (train=False): fold in input order, then order rows inside each batch by the keys.

    The default cost is folded natively, as the orbit of a successor function; a cost of the
    user's own (I3) by a Python fold of each pool.  A null length counts as 0.

    Input columns: pair_id, ``order_col``, src_len, tgt_len.  Output: FOLD_SCHEMA.
    """
    lengths = [F.coalesce(c, F.lit(0)).alias(c) for c in ("src_len", "tgt_len")]
    slim = with_pools(df.select("pair_id", order_col, *lengths, *(k for k in sort_keys if k not in ("src_len", "tgt_len", order_col))),
                      pool_rows, order_col)
    keys = list(dict.fromkeys([*sort_keys, "pair_id"]))
    if cost_fn is None:
        batched = greedy_batches(slim, "pool_id", keys if train else [order_col],
                                 F.greatest(F.col("src_len"), F.col("tgt_len") + 2), keys, budget)
        place = F.row_number().over(Window.partitionBy("pool_id", "batch_id").orderBy(*keys)) - 1
        return batched.select("pair_id", "pool_id", "batch_id", place.cast("long").alias("row_in_batch"))

    def per_pool(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(keys if train else [order_col], kind="mergesort").reset_index(drop=True)
        batch = fold_batches(pdf["src_len"].to_numpy(), pdf["tgt_len"].to_numpy(), budget, cost_fn)
        pdf = pdf.assign(batch_id=batch, _k=np.arange(len(pdf)))
        if not train:
            pdf = pdf.sort_values(["batch_id", *keys], kind="mergesort")
            pdf["_k"] = np.arange(len(pdf))
        pdf["row_in_batch"] = pdf["_k"] - pdf.groupby("batch_id")["_k"].transform("min")
        return pdf[["pair_id", "pool_id", "batch_id", "row_in_batch"]].astype(
            {"pool_id": "int64", "batch_id": "int64", "row_in_batch": "int64"})

    return slim.groupBy("pool_id").applyInPandas(per_pool, FOLD_SCHEMA)


def bucket_batches(df: DataFrame, batch_size: int = BATCH_SIZE, pool_rows: int | None = None,
                   order_col: str = "rn", sort_keys: tuple[str, ...] = ("tgt_len",)) -> DataFrame:
    """pools of 100 x batch_size rows in shuffled order, sorted by ``sort_keys`` (I2;
    ties by id), cut every ``batch_size`` rows."""
    pool_rows = pool_rows or batch_size * POOL_FACTOR
    p = with_pools(df.select("pair_id", order_col, *(k for k in sort_keys if k != order_col)), pool_rows, order_col)
    w = Window.partitionBy("pool_id").orderBy(*sort_keys, "pair_id")
    k = F.row_number().over(w) - 1
    return p.select("pair_id", "pool_id", (F.floor(k / batch_size)).cast("long").alias("batch_id"),
                    (k % batch_size).cast("long").alias("row_in_batch"))


def batch_order(batches: DataFrame, seed: int = SEED) -> DataFrame:
    """shuffled order of the batches inside each pool, by md5('<seed>:pool:batch')."""
    b = batches.select("pool_id", "batch_id").distinct()
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.col("pool_id").cast("string"), F.lit(":"),
                         F.col("batch_id").cast("string")))
    w = Window.partitionBy("pool_id").orderBy(key, "batch_id")
    return b.select("pool_id", "batch_id", (F.row_number().over(w) - 1).cast("long").alias("batch_order"))


def first_batch(batches: DataFrame, seed: int = SEED) -> DataFrame:
    """rows of the batch served first (pool 0, batch_order 0): the batch with the least
    key, by one window over the (bounded) pool, so the batches are made once."""
    key = F.md5(F.concat(F.lit(f"{seed}:0:"), F.col("batch_id").cast("string")))
    w = Window.partitionBy("pool_id")
    rows = batches.filter(F.col("pool_id") == 0).withColumn("_k", F.struct(key.alias("k"), F.col("batch_id").alias("b")))
    return (rows.withColumn("_m", F.min("_k").over(w)).filter(F.col("_k") == F.col("_m"))
            .select("pair_id", "batch_id", "row_in_batch"))


def pad_to_batch(batched: DataFrame, cols=("src_ids", "tgt_ids"), pad_id: int = PAD_ID) -> DataFrame:
    """E5: pad each id array to the longest of its batch (window keyed by batch)."""
    w = Window.partitionBy("pool_id", "batch_id")
    out = batched
    for c in cols:
        m = F.max(F.size(c)).over(w)
        out = out.withColumn(c, F.concat(F.col(c), F.array_repeat(F.lit(pad_id).cast("long"),
                                                                  (m - F.size(c)).cast("int"))))
    return out


def pad_mask(ids, pad_id: int = PAD_ID):
    """Element-wise non-pad flags."""
    c = F.col(ids) if isinstance(ids, str) else ids
    return F.transform(c, lambda x: x != F.lit(pad_id))


def mask_text(mask):
    return F.array_join(F.transform(mask, lambda b: F.when(b, "1").otherwise("0")), "")


def mask_counts(padded: DataFrame, pad_id: int = PAD_ID) -> DataFrame:
    """H7: allowed cells of the causal+pad target mask over the decoder input (target
    without its last column) and of the cross mask (every input position x every
    non-pad source position)."""
    t_in = F.slice("tgt_ids", 1, F.size("tgt_ids") - 1)
    T = F.size(t_in)
    causal = F.aggregate(F.sequence(F.lit(0), T - 1), F.lit(0).cast("long"),
                         lambda acc, j: acc + F.when(F.element_at(t_in, j + 1) != pad_id,
                                                     (T - j).cast("long")).otherwise(F.lit(0).cast("long")))
    src_real = F.size(F.filter("src_ids", lambda x: x != pad_id))
    return padded.select(
        "pair_id", "batch_id",
        F.when(T > 0, causal).otherwise(F.lit(0).cast("long")).alias("n_causal"),
        (T * src_real).cast("long").alias("n_cross"),
        (T * T).cast("long").alias("n_cells"))


def batch_stats(batches: DataFrame, lengths: DataFrame) -> DataFrame:
    """Rows, max lengths, padded cost and padding share per batch."""
    j = batches.join(lengths.select("pair_id", "src_len", "tgt_len"), "pair_id")
    g = j.groupBy("pool_id", "batch_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("src_len").alias("max_src"),
        F.max(F.col("tgt_len") + 2).alias("max_tgt"),
        F.sum(F.col("src_len") + F.col("tgt_len") + 2).alias("_real"))
    padded = F.col("n") * F.col("max_src") + F.col("n") * F.col("max_tgt")
    return g.select(
        "pool_id", "batch_id", "n", F.col("max_src").cast("long").alias("max_src"),
        F.col("max_tgt").cast("long").alias("max_tgt"),
        F.greatest(F.col("n") * F.col("max_src"), F.col("n") * F.col("max_tgt")).cast("long").alias("cost"),
        F.round(F.lit(1.0) - F.col("_real") / padded, 6).alias("pad_share"))
