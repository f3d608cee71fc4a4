"""C1/C2/J2 dictionary of two tiers: arrays of keys are mapped to arrays of values.

The first rows of a dictionary, by rank and up to a bound in bytes, are sent to every task,
which maps whole arrays by a hash look-up on their flat values; nothing is exploded, and a row
whose keys are all there is finished.  Keys that are not there meet the rest of the dictionary
by a shuffle: distinct keys first, then the found ones with their occurrences, which go back to
their rows; rows without such keys are not shuffled, the others once for all columns, with their
numbers in as few bytes as they need.  A dictionary that fits the bound as a whole needs no shuffle
at all.  Rows that can be read again are not written in between, only their keys beyond the bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parallax.operators.ordering import sized_broadcast
from parallax.session import release, scratch_path

BOUND = 32 << 20  # bytes of keys and values in the first tier of each dictionary
BUCKET = 1024     # ranks that enter the first tier together
KEYS = 1 << 20    # keys that are looked up at a time, in batches of up to
BYTES = 32 << 20  # bytes in all columns
PACKED = 1 << 18  # numbers that are packed at a time


@dataclass
class Dictionary:
    """``table`` has (key, value, rank): distinct keys, and whole ranks from 0, the most wanted
    first.  ``missing`` stands for keys that it lacks (None: the key itself)."""
    table: DataFrame
    missing: object = None


def first_tier(d: Dictionary, bound: int) -> tuple[pa.Table, int, bool]:
    """(key, value) of the ranks below a cut, the cut, and whether that is the whole table."""
    size = sum((F.octet_length(c) if isinstance(d.table.schema[c].dataType, T.StringType) else F.lit(8)) + 8 for c in ("key", "value"))
    sizes = sorted((r.b, r.n) for r in d.table.groupBy(F.floor(F.col("rank") / BUCKET).alias("b")).agg(F.sum(size).alias("n")).collect())
    total, cut = 0, 0
    for b, n in sizes:
        if total + n > bound:
            break
        total, cut = total + n, (b + 1) * BUCKET
    whole = total == sum(n for _, n in sizes)
    return d.table.filter(F.col("rank") < cut).select("key", "value").toArrow(), cut, whole


def packed(lists: pa.ListArray) -> pa.Array:
    """Lists of whole numbers or nulls as bytes: seven bits a byte, the lowest first, of twice a
    number (of -1 - twice a negative one) and 1 more; null is 0."""
    v, out, sizes = lists.flatten(), [], []
    for i in range(0, len(v), PACKED):
        part = v[i:i + PACKED]
        n = part.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        u = ((n << 1) ^ (n >> 63)).astype(np.uint64)
        if u.max() == np.iinfo(np.uint64).max:
            raise OverflowError("the least number of 64 bits cannot be packed")
        u = np.where(part.is_null().to_numpy(zero_copy_only=False), 0, u + np.uint64(1))
        size = 1 + sum((u >= np.uint64(1 << bits)).astype(np.uint8) for bits in range(7, 64, 7) if u.max() >= 1 << bits)
        size = np.broadcast_to(np.asarray(size, np.uint8), len(u))
        at = np.cumsum(size, dtype=np.int64) - size
        to, left = np.empty(int(size.sum(dtype=np.int64)), np.uint8), np.arange(len(u))
        while len(left):
            low = (u[left] & np.uint64(127)).astype(np.uint8)
            u[left] >>= np.uint64(7)
            more = u[left] > 0
            to[at[left]] = low | (more.astype(np.uint8) << 7)
            at[left] += 1
            left = left[more]
        out.append(to)
        sizes.append(size)
    end = np.append(0, np.cumsum(np.concatenate(sizes) if sizes else [], dtype=np.int64))
    off = np.append(0, np.cumsum(lists.value_lengths().fill_null(0).to_numpy()))
    valid = pa.array(~lists.is_null().to_numpy(zero_copy_only=False))
    return pa.Array.from_buffers(pa.binary(), len(lists), [valid.buffers()[1], pa.py_buffer(end[off].astype(np.int32)),
                                                           pa.py_buffer(np.concatenate(out) if out else np.zeros(0, np.uint8))])


def unpacked(column: pa.Array) -> pa.ListArray:
    """The lists of ``packed``."""
    sizes = pc.binary_length(column).fill_null(0).to_numpy()
    b = np.frombuffer(b"".join(column.drop_null().to_pylist()), np.uint8)
    last = b < 128
    end = np.flatnonzero(last)
    begin = np.append(0, end[:-1] + 1)[:len(end)]
    size = end - begin + 1
    u = (b[begin] & 127).astype(np.uint64)
    for k in range(1, int(size.max(initial=1))):
        some = np.flatnonzero(size > k)
        u[some] |= (b[begin[some] + k] & 127).astype(np.uint64) << np.uint64(7 * k)
    null = u == 0
    u = np.where(null, 0, u - np.uint64(1))
    n = (u >> np.uint64(1)).astype(np.int64) ^ -(u & np.uint64(1)).astype(np.int64)
    off = np.append(0, np.cumsum(last))[np.append(0, np.cumsum(sizes))].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(n, mask=null), mask=column.is_null())


def _found(flat: pa.Array, keys: pa.Array, values: pa.Array) -> pa.Array:
    """The value of each key, null for those that ``keys`` lack.  The keys of a batch repeat, so its
    distinct ones are hashed, and the dictionary is looked up in them."""
    coded = flat.dictionary_encode()
    at = pc.index_in(keys, value_set=coded.dictionary)
    hit = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
    place = np.full(len(coded.dictionary) + 1, -1, np.int32)  # last, of null
    place[at.drop_null().to_numpy()[::-1]] = hit[::-1]  # of a repeated key the first
    place = place[coded.indices.fill_null(len(coded.dictionary)).to_numpy()]
    return values.take(pa.array(place, mask=place < 0))


def _joined(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches put together until they hold ``KEYS`` keys or ``BYTES``, since each look-up of a batch
    hashes the dictionary anew."""
    held, n, size = [], 0, 0
    for batch in batches:
        held.append(batch)
        n += sum(int(pc.sum(batch.column(c).value_lengths()).as_py() or 0) for c in names)
        size += batch.nbytes
        if n >= KEYS or size >= BYTES:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n, size = [], 0, 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _mapped(shared, names: list[str], schema: pa.Schema):
    """The columns ``names`` as arrays of values; keys that are not in the first tier become the
    missing value, or null with themselves in ``rare``, in their order.  Columns that ``schema`` has
    as bytes are packed: values, or the keys themselves where these are numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiers = shared.value
        for batch in _joined(batches, names):
            columns = {n: batch.column(n) for n in batch.schema.names}
            for name in names:
                keys, values, whole, missing = tiers[name]
                lists = columns[name]
                flat, off, null = lists.flatten(), lists.value_lengths().fill_null(0).to_numpy(), lists.is_null()
                off = np.append(0, np.cumsum(off)).astype(np.int32)
                mask = null.to_numpy(zero_copy_only=False)
                as_lists = lambda x, m=mask, o=off: pa.ListArray.from_arrays(pa.array(o), x, mask=pa.array(m))
                found = _found(flat, keys, values)
                gone = found.is_null()
                if whole:
                    columns[name] = as_lists(pc.if_else(gone, flat if missing is None else pa.scalar(missing, values.type), found))
                else:
                    at = gone.to_numpy(zero_copy_only=False)
                    count = np.append(0, np.cumsum(at))
                    columns[name] = as_lists(flat if pa.types.is_integer(flat.type) else found)
                    columns[f"_rare_{name}"] = pa.ListArray.from_arrays(pa.array(count[off].astype(np.int32)), flat.filter(pa.array(at)))
                if pa.types.is_binary(schema.field(name).type):
                    columns[name] = packed(columns[name])
            yield pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in schema], schema=schema)
            pa.default_memory_pool().release_unused()

    return run


def _filled(shared, names: list[str], half: list[str], by_key: dict[str, pa.DataType], schema: pa.Schema, fills: bool):
    """Rows of ``_mapped`` with their columns ``names`` unpacked; in those of ``half`` the keys beyond
    the first tier are replaced, in order, by the values in ``fill``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = [n for n in half if pa.types.is_integer(by_key[n])]
        tiers = shared.value if numbers else {}
        for batch in _joined(batches, []) if numbers else batches:
            columns = {n: batch.column(n) for n in batch.schema.names}
            for name in names:
                lists = columns[name]
                if pa.types.is_binary(lists.type):
                    lists = unpacked(lists)
                if name in half:
                    flat = lists.flatten()
                    off = np.append(0, np.cumsum(lists.value_lengths().fill_null(0).to_numpy())).astype(np.int32)
                    if name in numbers:
                        keys, values, *_ = tiers[name]
                        flat = _found(flat, keys.cast(flat.type), values)
                    if fills:  # none in rows without rare keys
                        flat = pc.replace_with_mask(flat, flat.is_null(), columns[f"_fill_{name}"].flatten())
                    lists = pa.ListArray.from_arrays(pa.array(off), flat, mask=lists.is_null())
                columns[name] = lists
            yield pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in schema], schema=schema)

    return run


def map_arrays(df: DataFrame, dictionaries: dict[str, Dictionary], bound: int = BOUND, again: bool = False) -> DataFrame:
    """``df`` with each named column, an array of keys, as the array of their values.  Null
    arrays stay null; a null key is missing.

    ``again``: ``df`` gives the same rows in the same order each time that it is read (files and
    steps by row, no shuffle), and may be read several times; otherwise its rows are written
    once, half mapped, if some have to be shuffled."""
    spark = df.sparkSession
    tiers, cuts = {}, {}
    for name, d in dictionaries.items():
        table, cut, whole = first_tier(d, bound)
        tiers[name], cuts[name] = (table.column("key").combine_chunks(), table.column("value").combine_chunks(), whole, d.missing), cut
    half = [n for n in dictionaries if not tiers[n][2]]
    value = {n: d.table.schema["value"].dataType for n, d in dictionaries.items()}
    kept = T.StructType([T.StructField(f.name, T.ArrayType(value[f.name]) if f.name in dictionaries else f.dataType) for f in df.schema])
    shared, names = spark.sparkContext.broadcast(tiers), list(dictionaries)
    from pyspark.sql.pandas.types import to_arrow_schema

    if not half:
        return df.mapInArrow(_mapped(shared, names, to_arrow_schema(kept)), kept)
    number = lambda kind: isinstance(kind, T.IntegralType)
    key = {n: df.schema[n].dataType.elementType for n in names}
    half_way = T.StructType([T.StructField(f.name, T.BinaryType() if f.name in names and (number(value[f.name]) or f.name in half and number(key[f.name])) else kept[f.name].dataType)
                           for f in df.schema] + [T.StructField("_row", T.LongType())] + [T.StructField(f"_rare_{n}", df.schema[n].dataType) for n in half])
    rows = df.withColumn("_row", F.monotonically_increasing_id()).mapInArrow(_mapped(shared, names, to_arrow_schema(half_way)), half_way)
    rare = [f"_rare_{n}" for n in half]
    some = reduce(Column.__or__, [F.size(c) > 0 for c in rare])
    path, seen = scratch_path(spark, "rare-keys" if again else "half-mapped"), Observation()
    counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.count(F.when(some, 1)).alias("some"))
    (counted.filter(some).select("_row", *rare) if again else counted).write.option("compression", "zstd").parquet(path)
    written = spark.read.parquet(path)
    rows = rows if again else written
    most = again and 2 * seen.get["some"] > seen.get["rows"]  # then all rows are shuffled, and made once more only
    part = (rows if most else rows.filter(some)).drop(*rare)
    for n in half:
        d = dictionaries[n]
        each = written.filter(F.size(f"_rare_{n}") > 0).select("_row", F.posexplode(f"_rare_{n}").alias("pos", "key"))
        rest = d.table.filter(F.col("rank") >= cuts[n]).select("key", "value")
        path = scratch_path(spark, "found-keys")
        each.select("key").distinct().join(rest, "key").write.parquet(path)
        found = each.join(sized_broadcast(spark.read.parquet(path), max_bytes=bound), "key", "left")
        filler = F.coalesce("value", "key" if d.missing is None else F.lit(d.missing))
        fill = F.transform(F.array_sort(F.collect_list(F.struct("pos", filler.alias("value")))), lambda x: x["value"])
        part = part.join(found.groupBy("_row").agg(fill.alias(f"_fill_{n}")), "_row", "left")
    release(spark)  # of what the keys have shuffled
    by_key = {n: tiers[n][0].type for n in half}
    end = lambda x, fills: x.mapInArrow(_filled(shared, names, half, by_key, to_arrow_schema(kept), fills), kept)
    # keys that are null are among the rare ones of their row: they are missing
    full = end(part.drop("_row"), True)
    return full if most else end(rows.filter(~some).drop("_row", *rare), False).unionByName(full)
