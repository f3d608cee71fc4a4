"""Delimited text with quoted line breaks, read by many tasks.

A quoted field may hold line breaks, so a line is not a record.  Whether a line begins inside a
quoted field depends on all lines before it in its file, but a run of lines only maps one of two
states, outside or inside a quoted field, to one of two, and such maps compose.  (If quotes stood
in quoted fields only, the map would be the parity of their number; a quote inside an unquoted
field, as messy files have it, is an ordinary character and must not count.)

1. Files are read as lines by Spark's text source, which cuts them into splits of bytes at any
   place and gives each line to the split it begins in.  Each split's map is computed on its own.
2. The maps are composed along each file, which gives the state before each split.
3. Each split is walked once from its state: lines are joined to records.  What a split cannot
   close goes on in the next one: it hands over an unfinished tail, and lines up to the first
   record that begins in it, as fragments.
4. Fragments (two for each split at most) are put together by record: a record is named by the
   split that its tail came from.

Records are then parsed one by one.  No step shuffles text but the fragments.  The driver holds
one row for each split, and sends to the tasks the splits that begin inside a quoted field.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_MARK = "\u0001end"
_MAP = pa.schema([("file", pa.string()), ("begin", pa.int64()), ("from_outside", pa.bool_()), ("from_inside", pa.bool_())])
_FRAGMENT = pa.schema([("file", pa.string()), ("begin", pa.int64()), ("nth", pa.int64()), ("part", pa.int64()),
                       ("open", pa.bool_()), ("record", pa.string())])


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, begin, line): the lines, with the file and the first byte of their split.  Lines
    end at line feeds only, so a carriage return before one stays for the records."""
    raw = spark.read.option("lineSep", "\n").text(path)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begin"), F.col("value").alias("line"))


def ends_inside(line: str, inside: bool, sep: str, quote: str = '"') -> bool:
    """Whether a line that begins outside (at a field's start) or inside a quoted field ends
    inside one.  A quote opens a field at its start only; a doubled one closes nothing."""
    at = 0
    while quote in line[at:] if at else quote in line:
        if not inside:
            if not line.startswith(quote, at):  # an unquoted field: go to the next one
                at = line.find(sep, at) + len(sep)
                if at < len(sep):
                    return False
                continue
            inside, at = True, at + 1
        close = line.find(quote, at)
        while close >= 0 and line.startswith(quote, close + 1):
            close = line.find(quote, close + 2)
        if close < 0:
            return True
        inside = False
        at = line.find(sep, close + 1) + len(sep)
        if at < len(sep):
            return False
    return inside


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], str]]:
    for batch in batches:
        file, begin, line = (c.to_pylist() for c in batch.columns)
        yield from zip(zip(file, begin), line)


def _maps(sep: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, out = None, [False, True], []
        for split, line in _splits(batches):
            if split != at:
                if at is not None:
                    out.append((*at, *state))
                at, state = split, [False, True]
            if '"' in line:
                state = [ends_inside(line, s, sep) for s in state]
        if at is not None:
            out.append((*at, *state))
        if out:
            yield _batch(out, _MAP)

    return run


def begin_inside(maps: list) -> set[tuple[str, int]]:
    """The splits (file, begin) that begin inside a quoted field."""
    inside, file, state = set(), None, False
    for m in sorted(maps, key=lambda m: (m.file, m.begin)):
        if m.file != file:
            file, state = m.file, False
        if state:
            inside.add((m.file, m.begin))
        state = m.from_inside if state else m.from_outside
    return inside


def _records(shared, sep: str):
    """Records of the splits in a task.  ``part`` 0 is a record or the tail that begins one
    (``open`` if it does not end here); ``part`` 1 is what comes before the first record, of one
    that began in an earlier split."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, inside, head, nth = None, [], False, False, 0
        out: list[tuple] = []
        for split, line in _splits(batches):
            if split != at:
                if held:
                    out.append((*at, -1 if head else nth, int(head), True, "\n".join(held)))
                at, held, nth = split, [], 0
                inside = head = split in shared.value
            held.append(line)
            if '"' in line:
                inside = ends_inside(line, inside, sep)
            if not inside:
                out.append((*at, -1 if head else nth, int(head), False, "\n".join(held)))
                held, nth, head = [], nth if head else nth + 1, False
                if len(out) >= 4096:
                    yield _batch(out, _FRAGMENT)
                    out = []
        if held:
            out.append((*at, -1 if head else nth, int(head), True, "\n".join(held)))
        if out:
            yield _batch(out, _FRAGMENT)

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def quoted_records(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """(file, begin, nth, record): every record of the files that is not empty; (begin, nth)
    orders those of a file, whose first is (0, 0).  Line breaks in a record are those of the
    file; a carriage return at its end goes.  A quoted field that a file never closes ends with
    the file."""
    raw = lines(spark, path)
    maps = raw.mapInArrow(_maps(sep), "file string, begin long, from_outside boolean, from_inside boolean").collect()  # a row for each split
    shared = spark.sparkContext.broadcast(begin_inside(maps))
    found = raw.mapInArrow(_records(shared, sep), "file string, begin long, nth long, part long, open boolean, record string")
    whole = found.filter(~F.col("open") & (F.col("part") == 0)).select("file", "begin", "nth", "record")
    parts = found.filter(F.col("open") | (F.col("part") == 1))
    # in the order of their splits, a head before the tail of the same split: each tail begins a
    # record, the heads after it belong to it
    order = Window.partitionBy("file").orderBy("begin", F.desc("part"))  # two rows for each split at most
    starts = F.last(F.when(F.col("part") == 0, F.struct("begin", "nth")), ignorenulls=True).over(order)
    joined = (parts.withColumn("of", starts).groupBy("file", "of")
              .agg(F.array_sort(F.collect_list(F.struct("begin", "part", "record"))).alias("parts"))
              .select("file", "of.begin", "of.nth", F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record")))
    every = whole.unionByName(joined).withColumn("record", F.regexp_replace("record", "\r$", ""))
    return every.filter((F.col("record") != "") | ((F.col("begin") == 0) & (F.col("nth") == 0)))


def read_delimited(spark: SparkSession, path: str, n: int, sep: str = ",", header: bool = True) -> DataFrame:
    """(file, record, size, f): each record with its first ``n`` fields as an array of strings,
    missing and empty ones null; size is the number of its fields, n + 1 if there are more or if
    a quoted field is not closed."""
    records = quoted_records(spark, path, sep)
    if header:
        records = records.filter((F.col("begin") != 0) | (F.col("nth") != 0))
    # parsed with a mark behind the last field: its place is the number of fields
    options = {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true", "maxCharsPerColumn": "-1", "mode": "PERMISSIVE"}
    schema = ", ".join(f"f{i} string" for i in range(n + 1))
    parsed = records.filter("record != ''").select("file", "record", F.from_csv(F.concat("record", F.lit(sep + _MARK)), schema, options).alias("x"))
    seen = parsed.select("file", "record", F.array(*[F.col(f"x.f{i}") for i in range(n + 1)]).alias("x"))
    place = F.array_position(F.transform("x", lambda v: F.coalesce(v, F.lit(""))), _MARK)
    size = F.when(place > 0, place - 1).otherwise(n + 1).cast("int")
    return seen.select("file", "record", size.alias("size"), F.transform(
        F.slice("x", 1, n), lambda v: F.when(v != _MARK, v)).alias("f"))
