"""J1 lexical translation model (IBM Model 1, Brown et al. 1993) trained by EM with
joins and aggregations, and J2 batch translation with its top-1 table.

Definitions (fixed so engine and oracle agree): per pair, nf / ne are the
multiplicities of source token f / target token e; t(e|f) starts at 1.0 for every
co-occurring (f, e); no empty word.  Each iteration:
    z(pair, e) = sum_f nf * t(e|f)
    c(f, e)    = sum_pairs ne * nf * t(e|f) / z(pair, e)
    t(e|f)     = c(f, e) / sum_e c(f, e)
Top-1 per f: round(t, 6) descending, then e ascending.  The loss of a round is the mean of
-ln z(pair, e) over all target tokens, by the table the round began with.

Training works on numbers: tokens are numbered in their byte order by written tables, and each
pair is held as two arrays of numbers and multiplicities.  The target types are dealt to blocks;
a block gets, of each pair, its own target types and all source types, so z and c are complete
inside it and only sums by source type leave it.  A round makes the rounds before it anew from
those sums, so neither the co-occurrences nor the tables of the rounds are shuffled or written.
Pairs are numbered where they lie, by dictionaries of two tiers.  The dealt pairs are shuffled
once, into buckets of whole blocks, which every round reads; what a batch of pairs has for a block
is one packed value of about two bytes a number.  Tokens come back for the final table or its top-1
rows only.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parallax.functions.text import UNK, get_tokenizer
from parallax.operators.buckets import bucketed
from parallax.operators.dictionary import BOUND, BUCKET as DICT_BUCKET, Dictionary, map_arrays
from parallax.operators.ordering import ordered_rank, sized_broadcast
from parallax.session import checkpoint_dir, release, scratch_path
from parallax.sources.commits import ProgressLog

ITERATIONS = 3
BLOCK = 12 << 20  # co-occurrences of a block, about
SMALL_BLOCK = 1 << 18  # of a block of small tables, which are spread over the cores
CHUNK = 4 << 20  # co-occurrences that are laid out at a time
SPREAD = 2  # buckets for each block, so that few blocks share one
SAVED = ["lexical", "lexical_source", "lexical_target"]


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered_tokens(rows: DataFrame, col: str, name: str) -> DataFrame:
    """(token, id, n): the distinct tokens of an array column, numbered in byte order from 0, and how
    often they occur."""
    tokens = rows.select(F.explode(col).alias("token")).filter("token is not null").groupBy("token").agg(F.count("*").alias("n"))
    return _written(ordered_rank(tokens, order=["token"], rank_col="id").select("token", (F.col("id") - 1).alias("id"), "n"), name)


def _by_frequency(numbers: DataFrame) -> Dictionary:
    """Tokens to their numbers, the most frequent ones first (in steps of two); -1 for null."""
    rank = (F.lit(63) - F.floor(F.log2("n"))) * DICT_BUCKET
    return Dictionary(numbers.select(F.col("token").alias("key"), F.col("id").cast("int").alias("value"), rank.alias("rank")), -1)


def _lists(batch, names: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The flat values and the lengths of list columns; null is empty."""
    columns = [batch.column(n) for n in names]
    columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
    return [(c.flatten().to_numpy(), c.value_lengths().fill_null(0).to_numpy().astype(np.int64)) for c in columns]


def _list_array(flat: np.ndarray, many: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(many)).astype(np.int32)), pa.array(flat.astype(np.int32)))


def _types(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(fs, nf, es, ne): the distinct numbers of both sides and how often each occurs; a pair with
    a side that has none goes."""
    for batch in batches:
        sides = []
        for flat, many in _lists(batch, ["src", "tgt"]):
            row = np.repeat(np.arange(len(many)), many)
            key, n = np.unique((row[flat >= 0] << 32) | flat[flat >= 0], return_counts=True)
            sides.append((key, n, np.bincount(key >> 32, minlength=len(many))))
        both = np.logical_and(*(many > 0 for _, _, many in sides))
        out = []
        for key, n, many in sides:
            kept = both[key >> 32]
            out += [_list_array(x[kept], many[both]) for x in (key & 0xFFFFFFFF, n)]
        yield pa.RecordBatch.from_arrays(out, names=["fs", "nf", "es", "ne"])


def _packed(arrays: list[np.ndarray]) -> bytes:
    """Arrays of numbers in one value: equal bytes of all numbers side by side, compressed."""
    planes = b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes() for a in arrays)
    return np.array([len(a) for a in arrays], np.int64).tobytes() + pa.compress(planes, codec="zstd", asbytes=True)


def _unpacked(value: bytes, kinds: list) -> list[np.ndarray]:
    kinds = [np.dtype(k) for k in kinds]
    sizes = [int(n) * k.itemsize for n, k in zip(np.frombuffer(value, np.int64, len(kinds)), kinds)]
    planes = pa.decompress(value[8 * len(kinds):], sum(sizes), codec="zstd", asbytes=True)
    ends = np.cumsum(sizes)
    return [np.ascontiguousarray(np.frombuffer(planes[e - n:e], np.uint8).reshape(k.itemsize, -1).T).view(k).ravel()
            for e, n, k in zip(ends, sizes, kinds)]


def _gaps(x: np.ndarray) -> np.ndarray:
    return np.diff(x.astype(np.int32), prepend=np.int32(0))


def _parts(flat: np.ndarray, begin: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The values of runs of ``flat``."""
    return flat[np.repeat(begin - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))]


def _block_of(e: np.ndarray, blocks: int) -> np.ndarray:
    x = e.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(33)).astype(np.int64) % blocks


def _runs(block: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(block, where it stands, in order) of each block."""
    order = np.argsort(block, kind="stable")
    for at in np.split(order, np.flatnonzero(np.diff(block[order])) + 1):
        if len(at):
            yield int(block[at[0]]), at


def _values(found: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([b for b, _ in found], pa.int32()), pa.array([v for _, v in found], pa.binary())],
                                      names=["block", "packed"])


def _dealt_pairs(blocks: int):
    """(block, packed): of the pairs of a batch their target types of a block beside all their source
    types."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (fs, many_f), (nf, _), (es, many_e), (ne, _) = _lists(batch, ["fs", "nf", "es", "ne"])
            begin_f, row = np.cumsum(many_f) - many_f, np.repeat(np.arange(len(many_e)), many_e)
            for b, at in _runs(_block_of(es, blocks)):
                rows, own = np.unique(row[at], return_counts=True)
                f, n = (_parts(x, begin_f[rows], many_f[rows]) for x in (fs, nf))
                yield _values([(b, _packed([many_f[rows].astype(np.int32), own.astype(np.int32), _gaps(f), n, _gaps(es[at]), ne[at]]))])

    return run


def _pairs_of(values: pa.Table) -> pa.Table:
    """(fs, nf, es, ne) of the packed pairs of a block."""
    out = []
    for value in values.column("packed").to_pylist():
        many_f, many_e, f, nf, e, ne = _unpacked(value, [np.int32] * 6)
        f, e = np.cumsum(f, dtype=np.int32), np.cumsum(e, dtype=np.int32)
        out.append(pa.table([_list_array(f, many_f), _list_array(nf, many_f), _list_array(e, many_e), _list_array(ne, many_e)],
                            names=["fs", "nf", "es", "ne"]))
    return pa.concat_tables(out)


def _dealt_start(blocks: int):
    """(block, packed): the rows (f, e, t) of a batch that are of a block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f, e, t = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("f", "e", "t"))
            order = np.lexsort((f, e))
            f, e, t = f[order], e[order], t[order]
            for b, at in _runs(_block_of(e, blocks)):
                yield _values([(b, _packed([_gaps(e[at]), _gaps(f[at]), t[at]]))])

    return run


def _start_of(values: pa.Table) -> pa.Table:
    """(f, e, t) of the packed rows of a block."""
    e, f, t = ([] for _ in range(3))
    for value in values.column("packed").to_pylist():
        for held, x in zip((e, f, t), _unpacked(value, [np.int32, np.int32, np.float64])):
            held.append(x if held is t else np.cumsum(x, dtype=np.int32))
    e, f, t = (np.concatenate([np.zeros(0, k), *x]) for x, k in ((e, np.int32), (f, np.int32), (t, np.float64)))
    return pa.table({"f": f, "e": e, "t": t})


@dataclass
class Corpus:
    """Pairs (fs, nf, es, ne) in numbers with multiplicities, the numbers of the tokens of both
    sides, and the number of blocks."""
    pairs: DataFrame
    source: DataFrame
    target: DataFrame
    blocks: int

    def encode(self, table: DataFrame | dict[str, DataFrame]) -> DataFrame:
        """(f, e, t) in numbers, of a table in tokens or of the tables of ``train_saved``; rows with a
        token that the corpus lacks go."""
        if isinstance(table, dict):
            for col, own in (("source", self.source), ("target", self.target)):
                name = f"lexical_{col}"
                renamed = table[name].join(own.select("token", F.col("id").cast("int").alias("new")), "token").select("id", "new")
                table = {**table, name: _written(renamed, name)}
            return (table["lexical"].join(sized_broadcast(table["lexical_source"].toDF("f", "fi")), "f")
                    .join(sized_broadcast(table["lexical_target"].toDF("e", "ei")), "e").select(F.col("fi").alias("f"), F.col("ei").alias("e"), "t"))
        return (table.join(sized_broadcast(self._named(self.source, "f", "fi")), "f")
                .join(sized_broadcast(self._named(self.target, "e", "ei")), "e")
                .select(F.col("fi").cast("int").alias("f"), F.col("ei").cast("int").alias("e"), "t"))

    def decode(self, table: DataFrame) -> DataFrame:
        return (table.join(sized_broadcast(self._named(self.source, "word", "f")), "f")
                .join(sized_broadcast(self._named(self.target, "other", "e")), "e")
                .select(F.col("word").alias("f"), F.col("other").alias("e"), "t"))

    @staticmethod
    def _named(numbers: DataFrame, token: str, number: str) -> DataFrame:
        return numbers.select(F.col("token").alias(token), F.col("id").alias(number))

    def by_block(self, rows: DataFrame, dealt, name: str) -> DataFrame:
        """Rows dealt to blocks, in buckets of whole blocks."""
        table = bucketed(rows.mapInArrow(dealt(self.blocks), "block int, packed binary"), "block", SPREAD * self.blocks, name)
        release(rows.sparkSession)
        return table


def prepare(pairs: DataFrame, tokenizer="words", src: str = "src", tgt: str = "tgt") -> Corpus:
    """The types of both sides of each pair in numbers.  Texts are tokenized once, into a written
    table; token arrays (no tokenizer) are read where they lie.  The blocks grow in number with the
    co-occurrences, sum |types(src)| * |types(tgt)| over all pairs, of which a block has about
    ``BLOCK``."""
    spark, tok = pairs.sparkSession, get_tokenizer(tokenizer)
    held = pairs.select(tok(F.col(src)).alias("src"), tok(F.col(tgt)).alias("tgt"))
    held = held if tokenizer is None else _written(held, "lexical-pairs")
    source, target = (numbered_tokens(held, c, f"lexical-{c}-tokens") for c in ("src", "tgt"))
    numbers = map_arrays(held, {"src": _by_frequency(source), "tgt": _by_frequency(target)})
    both = _written(numbers.mapInArrow(_types, "fs array<int>, nf array<int>, es array<int>, ne array<int>"), "lexical-numbers")
    total = both.agg(F.sum(F.size("fs").cast("long") * F.size("es"))).first()[0] or 0
    release(spark)
    return Corpus(both, source, target, max(1, -(-total // BLOCK), min(spark.sparkContext.defaultParallelism, -(-total // SMALL_BLOCK))))


class Block:
    """The co-occurrences of one block in chunks of whole pairs: by chunk the place of each (e, f)
    among the block's own ones, nf, and by (pair, e) where it begins and ne."""

    def __init__(self, rows: pa.Table, start: pa.Table | None = None):
        fs, nf, es, ne = (rows.column(c).combine_chunks() for c in ("fs", "nf", "es", "ne"))
        many_f, many_e = (a.value_lengths().to_numpy().astype(np.int64) for a in (fs, es))
        fs, nf, es, ne = (a.flatten().to_numpy() for a in (fs, nf, es, ne))
        begin_f, begin_e = np.cumsum(many_f) - many_f, np.cumsum(many_e) - many_e
        chunk = np.cumsum(many_f * many_e) // CHUNK
        held, own = [], []
        for rows_of in np.split(np.arange(len(chunk)), np.flatnonzero(np.diff(chunk)) + 1):
            if not len(rows_of):
                continue
            of = np.repeat(rows_of, many_e[rows_of])  # row of each (pair, e)
            at_e = slice(begin_e[rows_of[0]], begin_e[rows_of[-1]] + many_e[rows_of[-1]])
            size = many_f[of]
            first = np.cumsum(size) - size
            at_f = np.repeat(begin_f[of] - first, size) + np.arange(int(size.sum()))
            key = (np.repeat(es[at_e].astype(np.int64), size) << 32) | fs[at_f]
            distinct, place = np.unique(key, return_inverse=True)
            held.append((place.astype(np.int32), nf[at_f].astype(np.float32), first, size, ne[at_e].astype(np.float64)))
            own.append(distinct)
        self.keys = np.unique(np.concatenate(own)) if len(own) != 1 else own[0]
        self.chunks = [(np.searchsorted(self.keys, k).astype(np.int32)[p], *rest) for k, (p, *rest) in zip(own, held)]
        self.f, self.e = self.keys & 0xFFFFFFFF, self.keys >> 32
        self.t = np.ones(len(self.keys))
        if start is not None:  # co-occurrences that a saved table lacks have no weight and no row
            key = (start.column("e").to_numpy().astype(np.int64) << 32) | start.column("f").to_numpy()
            at = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
            hit = self.keys[at] == key if len(self.keys) else np.zeros(len(key), bool)
            self.t = np.full(len(self.keys), np.nan)
            self.t[at[hit]] = start.column("t").to_numpy()[hit]
        self.known = ~np.isnan(self.t)
        self.t = np.where(self.known, self.t, 0.0)

    def counts(self) -> tuple[np.ndarray, float]:
        """c of each (e, f) by the present t, and the part of c that is weighed by -ln z."""
        c, lost = np.zeros(len(self.keys)), 0.0
        for place, nf, first, size, ne in self.chunks:
            w = nf * self.t[place]
            z = np.add.reduceat(w, first)
            seen = z > 0
            share = np.divide(ne, z, out=np.zeros(len(z)), where=seen)
            lost -= float((ne[seen] * np.log(z[seen])).sum())
            w *= np.repeat(share, size)
            c += np.bincount(place, weights=w, minlength=len(c))
        return c, lost

    def after(self, totals: list[np.ndarray]) -> np.ndarray:
        """t after as many rounds as there are totals of c by f."""
        for total in totals:
            self.t = self.counts()[0] / np.where(total[self.f] > 0, total[self.f], 1.0)
        return self.t


def _round(shared):
    """(f, c): the sums of c over the e of a block in the round after those of the totals; c of
    f = -1 and -2 are the block's number of (e, f) and the part of c that is weighed by -ln z."""
    def run(rows: pa.Table, start: pa.Table | None = None) -> pa.Table:
        block = Block(rows, start)
        block.after(shared.value)
        c, lost = block.counts()
        f, back = np.unique(block.f[block.known], return_inverse=True)
        sums = np.bincount(back, weights=c[block.known], minlength=len(f))
        return pa.table({"f": pa.array(np.append(f, [-1, -2]).astype(np.int32)), "c": pa.array(np.append(sums, [block.known.sum(), lost]))})

    return run


def _table(shared):
    """(f, e, t) of a block after the rounds of the totals."""
    def run(rows: pa.Table, start: pa.Table | None = None) -> pa.Table:
        block = Block(rows, start)
        t = block.after(shared.value)[block.known]
        return pa.table({"f": block.f[block.known], "e": block.e[block.known], "t": t})

    return run


def _best(shared):
    """The rows of ``_table`` that may be the best of their f: its first e among those whose t is
    the largest to six places, and all whose sixth place is at the edge of rounding."""
    def run(rows: pa.Table, start: pa.Table | None = None) -> pa.Table:
        table = _table(shared)(rows, start)
        f, e, t = (table.column(c).to_numpy() for c in ("f", "e", "t"))
        low, high = np.floor(t * 1e6 + 0.5 - 1e-6), np.floor(t * 1e6 + 0.5 + 1e-6)
        order = np.lexsort((e, -high, f))
        first = np.zeros(len(f), bool)
        sure = order[(low == high)[order]]
        first[sure[np.flatnonzero(np.diff(f[sure], prepend=-1))]] = True
        return table.filter(pa.array(first | (low != high)))

    return run


def _by_block(dealt: DataFrame, run, schema: str, start: DataFrame | None) -> DataFrame:
    if start is None:
        return dealt.groupBy("block").applyInArrow(lambda rows: run(_pairs_of(rows)), schema)
    return dealt.groupBy("block").cogroup(start.groupBy("block")).applyInArrow(
        lambda rows, begun: run(_pairs_of(rows), _start_of(begun)) if rows.num_rows else _none(schema), schema)


def _none(schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in schema.split(", "))]).empty_table()


def train_rounds(corpus: Corpus, iterations: int = ITERATIONS, start: DataFrame | None = None, done: int = 0,
                 log: ProgressLog | None = None, job: str = "lexical", best: bool = False) -> DataFrame:
    """J1 in numbers: (f, e, t) after ``iterations`` more rounds than the ``done`` ones that led
    to ``start``, or with ``best`` the rows of it that ``top1`` chooses from.  What a round leaves
    is one sum by source type, written in the shared folder and sent to every task (eight bytes a
    source type and round).  A round that ``log`` holds already is not logged again."""
    spark, totals = corpus.pairs.sparkSession, []
    size = corpus.source.count()
    dealt = corpus.by_block(corpus.pairs, _dealt_pairs, "lexical_dealt")
    if start is not None:
        start = corpus.by_block(start, _dealt_start, "lexical_start")
    for i in range(done + 1, done + iterations + 1):
        began = time.monotonic()
        shared = spark.sparkContext.broadcast(totals)
        sums = _written(_by_block(dealt, _round(shared), "f int, c double", start).groupBy("f").agg(F.sum("c").alias("c")), f"lexical-c{i}")
        found = sums.toArrow()
        release(spark)
        f, c = found.column("f").to_numpy(), found.column("c").to_numpy()
        total = np.zeros(size)
        total[f[f >= 0]] = c[f >= 0]
        totals = [*totals, total]
        if log is not None:
            n, lost = (float(c[f == k].sum()) for k in (-1, -2))
            log.append(job, i, int(n), lost / float(total.sum()) if total.sum() else None, time.monotonic() - began)
    return _by_block(dealt, (_best if best else _table)(spark.sparkContext.broadcast(totals)), "f long, e long, t double", start)


def _trained(pairs: DataFrame, iterations: int, tokenizer, src: str, tgt: str, start, done: int, log: ProgressLog | None,
             best: bool = False) -> tuple[Corpus, DataFrame]:
    checkpoint_dir(pairs.sparkSession)
    corpus = prepare(pairs, tokenizer, src, tgt)
    begun = None if start is None else corpus.encode(start)
    return corpus, train_rounds(corpus, iterations, begun, done, log, best=best)


def train_lexical(pairs: DataFrame, iterations: int = ITERATIONS, tokenizer="words", src: str = "src", tgt: str = "tgt",
                  start: DataFrame | dict[str, DataFrame] | None = None, done: int = 0, log: ProgressLog | None = None) -> DataFrame:
    """The translation table (f, e, t) of every pair, whatever its length.  Training goes on
    from a saved table ``start`` (or the tables of ``train_saved``, after ``done`` rounds) if there is
    one; co-occurrences that it lacks stay out."""
    corpus, table = _trained(pairs, iterations, tokenizer, src, tgt, start, done, log)
    return corpus.decode(table)


def train_saved(pairs: DataFrame, iterations: int = ITERATIONS, tokenizer="words", src: str = "src", tgt: str = "tgt",
                start: DataFrame | dict[str, DataFrame] | None = None, done: int = 0, log: ProgressLog | None = None) -> dict[str, DataFrame]:
    """The whole table of ``train_lexical`` as it is saved: (f, e, t) in numbers, which lie by e and f in
    each block, and the tokens of both sides."""
    corpus, table = _trained(pairs, iterations, tokenizer, src, tgt, start, done, log)
    return {"lexical": table.select(F.col("f").cast("int").alias("f"), F.col("e").cast("int").alias("e"), "t"),
            **{f"lexical_{n}": t.select(F.col("id").cast("int").alias("id"), "token") for n, t in (("source", corpus.source), ("target", corpus.target))}}


def train_top1(pairs: DataFrame, iterations: int = ITERATIONS, tokenizer="words", src: str = "src", tgt: str = "tgt",
               start: DataFrame | dict[str, DataFrame] | None = None, done: int = 0, log: ProgressLog | None = None) -> DataFrame:
    """``top1`` of ``train_lexical``; only its rows are turned back into tokens."""
    corpus, table = _trained(pairs, iterations, tokenizer, src, tgt, start, done, log, best=True)
    return corpus.decode(top1(table))


def top1(t: DataFrame) -> DataFrame:
    """Best e per f: round(t,6) desc, e asc (numbers follow the order of their tokens).  A min()
    over a struct, so it is a partial aggregation and a frequent f is reduced map-side."""
    best = t.groupBy("f").agg(F.min(F.struct((-F.round("t", 6)).alias("nt"), F.col("e"))).alias("b"))
    return best.select("f", F.col("b.e").alias("e"), (-F.col("b.nt")).alias("t"))


def as_tokens(df: DataFrame, col: str, tokenizer="words", vocab: DataFrame | None = None) -> tuple[DataFrame, Column]:
    """The tokens of a column by its type: a string is tokenized, an array of strings is
    tokens, an array of integers holds ids of ``vocab`` (id, token), <unk> where it lacks one.  Null
    has no tokens."""
    kind, none = df.schema[col].dataType, F.array().cast("array<string>")
    if isinstance(kind, T.StringType):
        return df, F.coalesce(get_tokenizer(tokenizer or "words")(F.col(col)), none)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
        return df, F.coalesce(col, none)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.IntegralType) and vocab is not None:
        words = Dictionary(vocab.select(F.col("id").alias("key"), F.col("token").alias("value"), F.col("id").alias("rank")), UNK)
        mapped = map_arrays(df.withColumn(col, F.col(col).cast("array<bigint>")), {col: words})
        return mapped, F.coalesce(col, none)
    raise TypeError(f"{col} is {kind.simpleString()}: text, tokens, or ids with a vocabulary are wanted")


def translate(df: DataFrame, table: DataFrame, id_col: str = "pair_id", text_col: str = "src",
              out_col: str = "translation", tokenizer="words", max_len: int | None = None,
              carry: tuple[str, ...] = (), bound: int = BOUND, vocab: DataFrame | None = None) -> DataFrame:
    """Each source token -> its top-1 target token, or itself when unknown; tokens
    joined with one space.  Whole texts by default (``max_len`` optionally cuts); a null text has
    no tokens.  Token arrays are mapped by a dictionary of two tiers, so nothing is exploded or
    joined back; (f, e) pairs of short tokens, which are the frequent ones, come first.
    The column's type tells what it holds (B7): text, tokens, or ids of ``vocab``.
    ``carry`` columns of ``df`` (e.g. the reference tokens) ride along."""
    df, toks = as_tokens(df, text_col, tokenizer, vocab)
    if max_len is not None:
        toks = F.slice(toks, 1, max_len)
    words = f"{out_col}_tokens"
    ranked = table.select(F.col("f").alias("key"), F.col("e").alias("value"), (F.length("f") * DICT_BUCKET).alias("rank"))
    out = map_arrays(df.select(id_col, *carry, toks.alias(words)), {words: Dictionary(ranked)}, bound)
    return out.select(id_col, *carry, F.array_join(words, " ").alias(out_col), words)
