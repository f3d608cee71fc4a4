"""Exact ordering primitives that never funnel a table (or a hot group) into one task.

* ``ordered_rank``  - row_number() over (partition by g order by k), computed by
  range-partitioning on (g, k), numbering rows inside each sorted range partition,
  and adding per-(partition, group) offsets from a segment table whose size is
  bounded by #groups + #partitions.  A group holding a third of all rows is spread
  over many range partitions instead of landing in one window task.
* ``hash_rank``     - the same for a uniformly distributed hex hash key (md5), using
  the hash prefix as a monotone bucket: the input is evaluated once (persisted), no
  sampling job, no checkpoint.
* ``next_in_group`` - exact lead() over an integral order, windowed by (key, chunk)
  with a chunk-heads table for the chunk boundaries.
* ``sized_broadcast`` - broadcast a side only after its rows and bytes are checked; meant
  for materialised sides (checkpoint or Parquet scan), where the count is cheap.
  Un-materialised aggregates are left to AQE's runtime broadcast conversion.
* ``top_k_per_group`` - exact top-k with a salted first stage, so a hot group is
  reduced in parallel before the final per-group ranking.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parallax.session import checkpoint_dir, shuffle_partitions

# Bounds under which a derived side table may be broadcast.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 128 << 20


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _width(name: str, kind: T.DataType) -> Column:
    """Bytes of a value, about."""
    c = F.col(f"`{name}`")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 8
    if isinstance(kind, T.ArrayType):
        each = 24 if isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.StructType)) else 8
        return F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0)) * each + 16
    return F.lit(8)


def sized_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Return ``F.broadcast(df)`` when its rows and the bytes of its values are within bounds;
    otherwise the plain frame, so the planner falls back to a shuffle join (AQE may still demote
    it).  For materialised sides: numbers are counted by a metadata read, texts and arrays by
    a scan."""
    if all(isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, (T.StringType, T.BinaryType)) for f in df.schema):
        rows = df.count()
        size = 8 * len(df.columns) * rows
    else:
        total = sum((_width(f.name, f.dataType) for f in df.schema), F.lit(0)).cast("long")
        rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(total), F.lit(0))).first()
    return F.broadcast(df) if rows <= max_rows and size <= max_bytes else df


def ordered_rank(df: DataFrame, order: Sequence, partition: Sequence[str] = (),
                 rank_col: str = "rn", num_partitions: int | None = None,
                 max_groups: int | None = None) -> DataFrame:
    """Add ``rank_col`` = row_number() over (partition by ``partition`` order by ``order``).

    ``order`` must be a total order inside each group (end it with a unique id).
    ``max_groups`` states a known bound on the number of groups (e.g. 2 for the two
    vocabulary sides); the segment table is then at most groups x partitions rows and
    is broadcast without a size-check job.
    The range-partitioned, locally numbered table is checkpointed (reliable, shared
    checkpoint dir) so both passes see identical partition ids.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = num_partitions or shuffle_partitions(spark)
    keys = [F.col(p) for p in partition] + [_col(o) for o in order]
    # the range sampler and the shuffle both evaluate the input: keep it for the second
    # pass (recomputed from lineage if a block is lost)
    held = df.storageLevel.useMemory or df.storageLevel.useDisk  # by the caller, who releases it
    df = df if held else df.persist(StorageLevel.MEMORY_AND_DISK)
    numbered = (df.repartitionByRange(n, *keys)
                .sortWithinPartitions(*keys)
                .withColumn("_rk_p", F.spark_partition_id())
                .withColumn("_rk_i", F.monotonically_increasing_id()
                            - F.shiftleft(F.col("_rk_p").cast("long"), 33)))
    numbered = numbered.checkpoint(eager=True)
    if not held:
        df.unpersist()
    seg = (numbered.groupBy("_rk_p", *partition)
           .agg(F.count(F.lit(1)).alias("_rk_n"), F.min("_rk_i").alias("_rk_first")))
    before = Window.partitionBy(*partition).orderBy("_rk_p").rowsBetween(Window.unboundedPreceding, -1)
    seg = seg.withColumn("_rk_off", F.coalesce(F.sum("_rk_n").over(before), F.lit(0))
                         - F.col("_rk_first")).drop("_rk_n", "_rk_first")
    # without group columns (or with a stated small number of groups) the segment table
    # has a fixed bound; otherwise it is bounded by groups + partitions and is checked
    bounded = not partition or (max_groups is not None and max_groups * n <= BROADCAST_MAX_ROWS)
    seg_side = F.broadcast(seg) if bounded else sized_broadcast(seg)
    out = numbered.join(seg_side, ["_rk_p", *partition])
    return (out.withColumn(rank_col, (F.col("_rk_i") + F.col("_rk_off") + 1).cast("long"))
            .drop("_rk_p", "_rk_i", "_rk_off"))


def hash_rank(df: DataFrame, hash_col: str, tie_col: str, rank_col: str = "rn",
              prefix_hex: int = 4, total_col: str | None = None, keep: list | None = None) -> DataFrame:
    """Global row_number() ordered by (hash_col, tie_col) for a uniform hex hash column.

    The first ``prefix_hex`` hex digits form 16**prefix_hex monotone buckets.  Bucket
    sizes come from a partial count of the bucket key alone (tiny shuffle: at most
    16**prefix_hex rows per map task); their prefix sums (a table of at most
    16**prefix_hex rows, broadcast) give each bucket's offset.  Rows are numbered
    inside their bucket by a window keyed by the bucket.  The keyed input is persisted
    (memory and disk, recomputed from lineage if lost), so its upstream runs once for
    both passes.  Optionally adds the table size as ``total_col``.  The persisted frame
    is appended to ``keep`` so a caller that materialises the result can release it.
    """
    bucket = F.conv(F.substring(F.col(hash_col), 1, prefix_hex), 16, 10).cast("int")
    keyed = df.withColumn("_hb", bucket).persist(StorageLevel.MEMORY_AND_DISK)
    # fill the cache in one job: otherwise AQE starts both consumer stages at once and
    # each would evaluate the upstream for the same partitions
    keyed.count()
    if keep is not None:
        keep.append(keyed)
    counts = keyed.groupBy("_hb").agg(F.count(F.lit(1)).alias("_hn"))
    before = Window.orderBy("_hb").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.withColumn("_hoff", F.coalesce(F.sum("_hn").over(before), F.lit(0)))
    if total_col:
        offs = offs.withColumn(total_col, F.sum("_hn").over(Window.partitionBy()).cast("long"))
    offs = offs.drop("_hn")
    inner = Window.partitionBy("_hb").orderBy(hash_col, tie_col)
    numbered = keyed.withColumn("_hr", F.row_number().over(inner))
    out = numbered.join(F.broadcast(offs), "_hb")  # at most 16**prefix_hex rows
    return (out.withColumn(rank_col, (F.col("_hoff") + F.col("_hr")).cast("long"))
            .drop("_hb", "_hr", "_hoff"))


def next_in_group(df: DataFrame, key: str, order_col: str, cols: Sequence[str],
                  prefix: str = "next_", chunk: int = 4096) -> DataFrame:
    """Exact lead(): add ``prefix + c`` for each c in ``cols`` (and ``order_col``) from the
    next row of the same ``key`` by the integral ``order_col``.

    A window keyed by (key, order_col div chunk) finds the next row inside each chunk;
    the last row of a chunk takes the first row of the key's next non-empty chunk from
    a chunk-heads table (one row per chunk).  A key holding a third of all rows is thus
    spread over many window groups.  One scan, no checkpoint.
    """
    fields = [order_col, *cols]
    c = df.withColumn("_ck", F.floor(F.col(order_col) / chunk).cast("long"))
    w = Window.partitionBy(key, "_ck").orderBy(order_col)
    c = c.withColumn("_nx", F.lead(F.struct(*fields)).over(w))
    heads = c.groupBy(key, "_ck").agg(F.min(F.struct(*fields)).alias("_hd"))
    nxt = (heads.withColumn("_nh", F.lead("_hd").over(Window.partitionBy(key).orderBy("_ck")))
           .select(key, "_ck", "_nh"))
    out = c.join(nxt, [key, "_ck"], "left").withColumn("_n", F.coalesce("_nx", "_nh"))
    for f in fields:
        out = out.withColumn(prefix + f, F.col("_n")[f])
    return out.drop("_ck", "_nx", "_nh", "_n")


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence, k: int,
                    salt_col: str, salts: int = 64, rank_col: str = "rank") -> DataFrame:
    """Exact top-k rows per group by ``order`` (a total order); ``rank_col`` is 1-based.

    Stage 1 keeps the top-k of each (group, salt) slice, so a hot group is cut down in
    parallel; stage 2 ranks the at most k*salts survivors of each group.
    """
    order_cols = [_col(o) for o in order]
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(F.col(salt_col)), F.lit(salts)))
    w1 = Window.partitionBy(*group, "_salt").orderBy(*order_cols)
    stage1 = salted.withColumn("_r1", F.row_number().over(w1)).filter(F.col("_r1") <= k)
    w2 = Window.partitionBy(*group).orderBy(*order_cols)
    return (stage1.withColumn(rank_col, F.row_number().over(w2).cast("long"))
            .filter(F.col(rank_col) <= k).drop("_salt", "_r1"))
