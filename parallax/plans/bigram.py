"""J3 next-token (bigram) model with add-k smoothing, cross-entropy (D8, B6) and
perplexity (D7); F7 top-k successors; J4 bounded greedy decoding; F8 truncation.

Definitions: a sequence is <sos>, the target tokens (unknown -> <unk>), <eos>.
p(next|prev) = (c(prev,next) + k) / (c(prev) + k * V), V = target vocabulary size with
specials.  Cross-entropy = mean of -ln p over all evaluated positions.
The successor of a token is its most frequent next token, ties -> smallest token.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parallax.functions.text import EOS, EOS_ID, PAD_ID, SOS, SOS_ID, UNK, UNK_ID, get_tokenizer, with_markers
from parallax.operators.dictionary import BOUND, Dictionary, map_arrays, packed as _packed, unpacked as _unpacked
from parallax.operators.ordering import sized_broadcast, top_k_per_group
from parallax.operators.vocab import truncate_at
from parallax.session import checkpoint_dir, scratch_path, shuffle_partitions

MAX_STEPS = 79   # generated tokens after <sos> within the 80-position limit
DEALT = 1 << 21  # bigrams that a task counts at a time, and of a bucket
HOT = 16         # times the number of buckets: tokens whose bigrams are dealt by both tokens


def raw_bigrams(df: DataFrame, keep=("split",), tokenizer="words", text_col="tgt") -> DataFrame:
    """(*keep, prev, next, n) with raw tokens, pre-aggregated before any join."""
    seq = with_markers(get_tokenizer(tokenizer)(F.col(text_col)))
    z = df.select(*keep, F.arrays_zip(F.slice(seq, 1, F.size(seq) - 1).alias("prev"),
                                      F.slice(seq, 2, F.size(seq) - 1).alias("next")).alias("z"))
    return (z.select(*keep, F.explode("z").alias("b"))
            .groupBy(*keep, F.col("b.prev").alias("prev"), F.col("b.next").alias("next"))
            .agg(F.count(F.lit(1)).alias("n")))


def map_unknown(bi: DataFrame, vocab: DataFrame, keep=("split",)) -> DataFrame:
    """Replace tokens outside the vocabulary by <unk> on the distinct-bigram table
    (much smaller than the token stream), then re-aggregate."""
    known = sized_broadcast(vocab.select(F.col("token").alias("_k")))
    m = (bi.join(known, bi["prev"] == known["_k"], "left")
         .withColumn("prev", F.when(F.col("_k").isNull(), F.lit(UNK)).otherwise(F.col("prev"))).drop("_k"))
    m = (m.join(known, m["next"] == known["_k"], "left")
         .withColumn("next", F.when(F.col("_k").isNull(), F.lit(UNK)).otherwise(F.col("next"))).drop("_k"))
    return m.groupBy(*keep, "prev", "next").agg(F.sum("n").cast("long").alias("n"))


def bigram_counts(split_df: DataFrame, vocab_tgt: DataFrame, split: str = "train",
                  tokenizer="words", text_col: str = "tgt", known: bool = False) -> DataFrame:
    """(prev, next, n) over one split.  ``known``: the vocabulary was built from it, so it has
    every token and nothing needs mapping."""
    bi = raw_bigrams(split_df.filter(F.col("split") == split), keep=(), tokenizer=tokenizer, text_col=text_col)
    return bi if known else map_unknown(bi, vocab_tgt, keep=())


def split_bigrams(split_df: DataFrame, vocab_tgt: DataFrame, tokenizer="words", text_col: str = "tgt",
                  known_splits: tuple[str, ...] = ()) -> DataFrame:
    """(split, prev, next, n) over every split, unknown tokens mapped to <unk>.

    ``known_splits``: splits whose every token is in the vocabulary (it was built from
    them); their bigrams need no mapping."""
    rest = ~F.col("split").isin(*known_splits) if known_splits else F.lit(True)
    mapped = map_unknown(raw_bigrams(split_df.filter(rest), tokenizer=tokenizer, text_col=text_col), vocab_tgt)
    if not known_splits:
        return mapped
    return raw_bigrams(split_df.filter(~rest), tokenizer=tokenizer, text_col=text_col).unionByName(mapped)


def _spread(prev: np.ndarray, following: np.ndarray, hot: int, buckets: int) -> np.ndarray:
    """The bucket of each bigram: by its first token, and by both if that is one of the ``hot``
    most frequent."""
    h = np.where(prev < hot, prev * 1_000_003 + following, prev).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((h >> np.uint64(33)) % np.uint64(buckets)).astype(np.uint16 if buckets < 1 << 16 else np.int64)


def _lists(values: np.ndarray, many: np.ndarray) -> pa.Array:
    """Consecutive runs of the values, packed."""
    return _packed(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(many)).astype(np.int32)), pa.array(values)))


def _dealt(hot: int, buckets: int):
    """(bucket, split, prev, next, n) of (split, ids): distinct bigrams of some rows, sorted, as
    packed lists of differences of their first ids, of second ids and of counts."""
    def out(held: dict[str, list]) -> Iterator[pa.RecordBatch]:
        for split, keys in held.items():
            key, n = np.unique(np.concatenate(keys), return_counts=True)
            prev, following = key >> 32, key & 0xFFFFFFFF
            bucket = _spread(prev, following, hot, buckets)
            order = np.argsort(bucket, kind="stable")
            bucket, prev, following, n = (x[order] for x in (bucket, prev, following, n))
            first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            many, step = np.diff(first, append=len(bucket)), np.diff(prev, prepend=0)
            step[first] = prev[first]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[first].astype(np.int32)), pa.array([split] * len(first), pa.string()), _lists(step, many),
                                              _lists(following, many), _lists(n, many)], names=["bucket", "split", "prev", "next", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0
        for batch in batches:
            split, ids = batch.column(0).dictionary_encode(), batch.column(1)
            flat, off = ids.flatten().to_numpy(), np.append(0, np.cumsum(ids.value_lengths().fill_null(0).to_numpy()))
            if len(flat) and flat.max() >= 1 << 31:
                raise OverflowError("a vocabulary has fewer than 2^31 tokens here")
            key = (flat[:-1] << 32) | flat[1:]
            of = np.repeat(split.indices.fill_null(-1).to_numpy(zero_copy_only=False), np.diff(off))[1:]
            inside = np.ones(len(flat), bool)
            inside[off[off < len(flat)]] = False  # what a row begins with follows nothing
            for i, name in enumerate(split.dictionary.to_pylist()):
                held.setdefault(name, []).append(key[inside[1:] & (of == i)])
            size += len(key)
            if size >= DEALT:
                yield from out({k: v for k, v in held.items() if sum(map(len, v))})
                held, size = {}, 0
        yield from out({k: v for k, v in held.items() if sum(map(len, v))})

    return run


def _met(splits: tuple[str, ...]):
    """(prev, next, n) of all dealt rows of a bucket: each bigram once, with its counts by split."""
    def run(table: pa.Table) -> pa.Table:
        keys, counts, of = [], [], []
        for batch in table.to_batches():
            prev, following, n = (_unpacked(batch.column(c)) for c in ("prev", "next", "n"))
            many, step = prev.value_lengths().to_numpy(), prev.flatten().to_numpy()
            total, first = np.cumsum(step), np.cumsum(many) - many
            key = total - np.repeat(total[first] - step[first], many)  # sums begin anew in each row
            keys.append((key << 32) | following.flatten().to_numpy())
            counts.append(n.flatten().to_numpy())
            of.append(np.repeat([splits.index(s) for s in batch.column("split").to_pylist()], many))
        key, n, of = (np.concatenate(x) for x in (keys, counts, of))
        order = np.argsort(key, kind="stable")
        key, n, of = key[order], n[order], of[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        by_split = [pa.array(np.add.reduceat(np.where(of == i, n, 0), first)) for i in range(len(splits))]
        return pa.table({"prev": key[first] >> 32, "next": key[first] & 0xFFFFFFFF, "n": pa.StructArray.from_arrays(by_split, names=list(splits))})

    return run


def numbered_bigrams(split_df: DataFrame, vocab_tgt: DataFrame, tokenizer="words", text_col: str = "tgt",
                     splits: tuple[str, ...] = ("train", "val", "test"), bound: int = BOUND, again: bool = False) -> DataFrame:
    """(prev, next, n): each bigram once, by the ids of its tokens (unknown: <unk>), with its
    counts by split in ``n``.

    Tokens become ids where they lie; a task counts its bigrams and deals them to buckets by
    the first token (by both tokens after the most frequent ones, so no bucket gets all bigrams
    of a hot token), sorted and packed, in a few bytes each.  A bucket has about ``DEALT``
    occurrences.  ``again``: see ``map_arrays``."""
    tokens = F.coalesce(get_tokenizer(tokenizer)(F.col(text_col)), F.array().cast("array<string>"))
    rows = split_df.filter(F.col("split").isin(*splits) & F.col(text_col).isNotNull()).select("split", tokens.alias("ids"))
    words = Dictionary(vocab_tgt.select(F.col("token").alias("key"), F.col("id").alias("value"), F.col("id").alias("rank")), UNK_ID)
    ids = map_arrays(rows, {"ids": words}, bound, again).select(
        "split", F.concat(F.array(F.lit(SOS_ID).cast("long")), "ids", F.array(F.lit(EOS_ID).cast("long"))).alias("ids"))
    total = vocab_tgt.agg(F.sum("freq")).first()[0] or 0
    buckets = max(shuffle_partitions(split_df.sparkSession), -(-total // DEALT))
    dealt = ids.mapInArrow(_dealt(HOT * buckets, buckets), "bucket int, split string, prev binary, next binary, n binary")
    counts = ", ".join(f"`{s}`: bigint" for s in splits)
    return dealt.groupBy("bucket").applyInArrow(_met(splits), f"prev bigint, next bigint, n struct<{counts}>")


def _by_split(ev: DataFrame, train_split: str, counts: DataFrame | None) -> tuple[DataFrame, list[str]]:
    """(prev, next, c, n): each bigram once, with its count in the model and those by split, and the
    names of the splits."""
    if isinstance(ev.schema["n"].dataType, T.StructType):
        splits = ev.schema["n"].dataType.names
        wide = ev.select("prev", "next", *[F.coalesce(F.col("n")[s], F.lit(0)).alias(f"n{i}") for i, s in enumerate(splits)])
        if counts is None:
            return wide.withColumn("c", F.col(f"n{splits.index(train_split)}")), splits
        rows = wide.withColumn("c", F.lit(0).cast("long")).unionByName(
            counts.select("prev", "next", F.col("n").alias("c")), allowMissingColumns=True)
    else:
        splits = sorted(r.split for r in ev.select("split").filter("split is not null").distinct().collect())
        rows = ev.select("prev", "next", *[F.when(F.col("split") == s, F.col("n")).alias(f"n{i}") for i, s in enumerate(splits)],
                         (F.when(F.col("split") == train_split, F.col("n")) if counts is None else F.lit(None).cast("long")).alias("c"))
        if counts is not None:
            rows = rows.unionByName(counts.select("prev", "next", F.col("n").alias("c")), allowMissingColumns=True)
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("c", *[f"n{i}" for i in range(len(splits))])]
    return rows.groupBy("prev", "next").agg(*sums), splits


def cross_entropy(split_df: DataFrame, vocab_tgt: DataFrame, k: float = 1.0,
                  train_split: str = "train", counts: DataFrame | None = None,
                  tokenizer="words", text_col: str = "tgt", ev: DataFrame | None = None) -> DataFrame:
    """D8/D7 per split: (split, n_tokens, cross_entropy, perplexity).

    ``ev`` (the bigrams by split, of ``split_bigrams`` or ``numbered_bigrams``) may be passed in
    materialised; the model counts are then its train rows, so the train bigrams are not built
    twice.  -ln p is ln(c(prev) + k V) - ln(c(prev, next) + k), so the first part is summed by
    token and the second by bigram, each over the occurrences with the same model count:
    bigrams and totals of tokens need not meet."""
    V = vocab_tgt.count()
    if ev is None:
        ev = split_bigrams(split_df, vocab_tgt, tokenizer, text_col)
    wide, splits = _by_split(ev, train_split, counts)
    ns = [f"n{i}" for i in range(len(splits))]
    sums = [F.sum(n).alias(n) for n in ns]
    by_bigram = wide.groupBy("c").agg(*sums).select((-F.log(F.col("c") + F.lit(k))).alias("x"), *ns, F.lit(True).alias("count"))
    by_token = (wide.groupBy("prev").agg(F.sum("c").alias("c"), *sums).groupBy("c").agg(*sums)
                .select(F.log(F.col("c") + F.lit(k * V)).alias("x"), *ns, F.lit(False).alias("count")))
    each = F.explode(F.array(*[F.struct(F.lit(s).alias("split"), F.col(n).alias("n")) for s, n in zip(splits, ns)])) if splits else F.explode(
        F.array().cast("array<struct<split:string,n:bigint>>"))
    terms = by_bigram.unionByName(by_token).select("x", "count", each.alias("r")).select("x", "count", "r.split", "r.n")
    total = F.sum(F.when(F.col("count"), F.col("n")))
    g = terms.groupBy("split").agg(total.cast("long").alias("n_tokens"), (F.sum(F.col("n") * F.col("x")) / total).alias("_x")).filter("n_tokens > 0")
    return g.select("split", "n_tokens", F.round("_x", 6).alias("cross_entropy"),
                    F.round(F.exp("_x"), 6).alias("perplexity"))


def padded_cross_entropy(padded: DataFrame, vocab_tgt: DataFrame, counts: DataFrame, k: float = 1.0,
                         ids_col: str = "tgt_ids", pad_id: int = PAD_ID) -> DataFrame:
    """D8 with B6: (n_tokens, n_pads, cross_entropy) over batches of padded target ids; targets
    that are padding do not count.  Pairs of ids are counted before tokens are looked up."""
    V = vocab_tgt.count()
    ids = F.col(ids_col)
    z = padded.select(F.explode(F.arrays_zip(F.slice(ids, 1, F.size(ids) - 1).alias("a"), F.slice(ids, 2, F.size(ids) - 1).alias("b"))).alias("z"))
    pairs = z.groupBy(F.col("z.a").alias("a"), F.col("z.b").alias("b")).agg(F.count("*").alias("n"))
    real = pairs.filter(F.col("b") != pad_id)
    word = sized_broadcast(vocab_tgt.select("id", "token"))
    named = (real.join(word.toDF("a", "prev"), "a").join(word.toDF("b", "next"), "b").select("prev", "next", "n"))
    prev_tot = counts.groupBy("prev").agg(F.sum("n").alias("cp"))
    j = named.join(counts.select("prev", "next", F.col("n").alias("c")), ["prev", "next"], "left").join(prev_tot, "prev", "left")
    p = (F.coalesce("c", F.lit(0)) + F.lit(k)) / (F.coalesce("cp", F.lit(0)) + F.lit(k * V))
    pads = pairs.filter(F.col("b") == pad_id).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_pads"))
    total = j.agg(F.sum("n").cast("long").alias("n_tokens"), F.round(F.sum(F.col("n") * -F.log(p)) / F.sum("n"), 6).alias("cross_entropy"))
    return total.crossJoin(F.broadcast(pads)).select("n_tokens", "n_pads", "cross_entropy")  # one row each


def successors(counts: DataFrame) -> DataFrame:
    """(prev, next): highest count, ties -> smallest token (partial aggregation)."""
    b = counts.groupBy("prev").agg(F.min(F.struct((-F.col("n")).alias("nn"), F.col("next"))).alias("b"))
    return b.select("prev", F.col("b.next").alias("next"))


def top_k_successors(counts: DataFrame, k: int = 3) -> DataFrame:
    """(prev, next, n, rank) for the k most frequent successors (ties by token)."""
    return top_k_per_group(counts, ["prev"], [F.desc("n"), F.asc("next")], k, salt_col="next")


def successor_paths(succ: DataFrame, max_steps: int = MAX_STEPS) -> DataFrame:
    """(start, path): the greedy chain of up to ``max_steps`` successors from every
    token that has one, by pointer doubling: log2(max_steps) self-joins of a table
    with one row per token instead of max_steps joins of the request table.  The chain
    stops at a token without successor (``<eos>`` has none)."""
    checkpoint_dir(succ.sparkSession)
    paths = succ.select(F.col("prev").alias("start"), F.array("next").alias("path"))
    length = 1
    while length < max_steps:
        paths = paths.checkpoint(eager=True)
        ext = paths.select(F.col("start").alias("_s"), F.col("path").alias("_p"))
        joined = paths.join(ext, F.element_at(paths["path"], -1) == ext["_s"], "left")
        grown = F.when((F.col("_p").isNotNull()) & (F.element_at("path", -1) != F.lit(EOS)),
                       F.concat("path", "_p")).otherwise(F.col("path"))
        paths = joined.select("start", F.slice(grown, 1, max_steps).alias("path"))
        length *= 2
    return paths.checkpoint(eager=True)


def greedy_decode(starts: DataFrame, succ: DataFrame, id_col: str = "pair_id",
                  start_col: str = "start", max_steps: int = MAX_STEPS) -> DataFrame:
    """Decode from each request's start token -> (id, start, decoded, n_gen).

    ``decoded`` is the start (unless it is <sos>) followed by the generated tokens up to,
    not including, <eos>; n_gen counts generated tokens including a final <eos>."""
    paths = successor_paths(succ, max_steps)
    # path rows carry up to max_steps tokens, so a row count does not bound their bytes:
    # AQE sizes this join from the measured shuffle output instead
    j = starts.select(id_col, start_col).join(paths.withColumnRenamed("start", start_col), start_col, "left")
    path = F.coalesce("path", F.array().cast("array<string>"))
    kept = truncate_at(path, EOS)
    head = F.when(F.col(start_col) == SOS, F.array().cast("array<string>")).otherwise(F.array(start_col))
    return j.select(id_col, start_col, F.array_join(F.concat(head, kept), " ").alias("decoded"),
                    F.size(path).cast("long").alias("n_gen"))


def teacher_forced_predictions(split_df: DataFrame, vocab_tgt: DataFrame, succ: DataFrame,
                               split: str | None = None, tokenizer="words", text_col: str = "tgt", bound: int = BOUND) -> DataFrame:
    """F8 over model output: for each pair (of one split, if given), the successor predicted at
    every position of its own marked target (unknown -> <unk>), cut before the first predicted
    <eos>.  A token's prediction is one dictionary entry: its successor, or that of <unk> for
    tokens the vocabulary lacks; <unk> where there is no successor."""
    rows = split_df if split is None else split_df.filter(F.col("split") == split)
    seq = with_markers(F.coalesce(get_tokenizer(tokenizer)(F.col(text_col)), F.array().cast("array<string>")))
    unknown = [r.next for r in succ.filter(F.col("prev") == UNK).collect()] or [UNK]
    known = vocab_tgt.select(F.col("token").alias("key"), F.col("id").alias("rank")).join(
        sized_broadcast(succ.toDF("key", "value")), "key", "left").select("key", F.coalesce("value", F.lit(UNK)).alias("value"), "rank")
    path = scratch_path(succ.sparkSession, "predictions")
    known.write.parquet(path)
    words = Dictionary(succ.sparkSession.read.parquet(path), unknown[0])
    out = map_arrays(rows.select("pair_id", F.slice(seq, 1, F.size(seq) - 1).alias("p")), {"p": words}, bound)
    cut = truncate_at(F.col("p"), EOS)
    return out.select("pair_id", F.array_join(cut, " ").alias("predicted"), F.size(cut).cast("long").alias("n_kept"), F.size("p").cast("long").alias("n_raw"))
