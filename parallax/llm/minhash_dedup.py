"""MinHash near duplicates with sequential Bayesian verification.

A text is a set of word shingles and has a signature of ``BANDS`` x ``ROWS`` minimum hashes,
16 bits each.  Texts that agree on a whole band share a bucket; a pair at a similarity of 0.85
shares none with a chance of 7e-9.  Bucket mates are verified in steps:

1. Signatures are compared ``STEP`` hashes at a time.  With m of n hashes equal and a uniform
   prior, the similarity is at least t with the probability P(Bin(n + 1, t) <= m).  A pair
   leaves once this posterior is under ``MISS``, the chosen chance of a miss.  Pairs whose set
   sizes rule a link out leave before.
2. Survivors are verified exactly.  A parity bitmap beside each signature bounds the difference
   of two sets from below, which ends most pairs that the posterior could not; the others are
   verified on their full shingle sets, made again from the texts.  First every text is held
   against the partner that agrees with it most; pairs that lie in one component by then need no
   check, all others get one.  So components are those of all confirmed links.

A bucket is worked in two rounds, so that a group of N copies costs N comparisons: every
member against the hub (the member whose buckets hold most), then, only in buckets whose
members are in several components, all pairs of different components, in blocks of
``BLOCK_ROWS`` rows.  A pair that shares several buckets is passed on by the first only.

Results for odd input: null, empty or blank text has no shingle and no link; a null id takes
no part in links, gets a null component and is kept; equal sets are one class, compared once;
rows that repeat an id are one node, with the links of all its texts, and each row is
returned; empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parallax.llm.common import blocks, mix64, release, shingle_set, utf8, word_hashes, written
from parallax.llm.components import connected_components
from parallax.llm.jaccard_join import max_difference, parity_bitmap, runs, same_id_links
from parallax.session import shuffle_partitions

BANDS, ROWS, STEP = 32, 5, 32
HASHES = BANDS * ROWS
MISS = 1e-7
BLOCK_ROWS = 4096
CHUNK = 1 << 22  # compared hashes held at once
_U = np.uint64
_SEEDS = mix64(np.arange(1, 2 * HASHES + 1, dtype=_U) * _U(0x9E3779B97F4A7C15))
_FLIP, _FACTOR = _SEEDS[:HASHES], _SEEDS[HASHES:] | _U(1)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of 16-bit minimum hashes for each set; none may be empty."""
    flat = np.concatenate(sets)
    begin = np.cumsum([0, *(len(s) for s in sets)])[:-1]
    out = np.empty((HASHES, len(sets)), np.uint16)
    for k in range(HASHES):
        least = np.minimum.reduceat((flat ^ _FLIP[k]) * _FACTOR[k], begin)
        out[k] = (mix64(least) >> _U(48)).astype(np.uint16)
    return np.ascontiguousarray(out.T)


def least_matches(n: int, percent: int, miss: float = MISS) -> int:
    """The smallest m for which m of n equal hashes leave a similarity of ``percent`` or more a
    posterior of at least ``miss``."""
    t, total = percent / 100, 0.0
    for m in range(n + 1):
        total += math.comb(n + 1, m) * t**m * (1 - t)**(n + 1 - m)
        if total >= miss:
            return m
    return n


def matches(x: np.ndarray, y: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """For rows of signatures: whether each pair passes all batches, and its equal hashes."""
    live, equal = np.arange(len(x)), np.zeros(len(x), np.int64)
    for n in range(STEP, HASHES + 1, STEP):
        for at in range(0, len(live), CHUNK // STEP):
            rows = live[at:at + CHUNK // STEP]
            equal[rows] += (x[rows, n - STEP:n] == y[rows, n - STEP:n]).sum(axis=1)
        live = live[equal[live] >= least_matches(n, percent)]
    keep = np.zeros(len(x), bool)
    keep[live] = True
    return keep, equal


def _rows(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, HASHES)


class Bitmaps:
    """Parity bitmaps of many sets; their widths are powers of two, and a wider one folds to a
    narrower one by XOR of its halves."""

    def __init__(self, raw: list[bytes], n: np.ndarray, percent: int):
        self.n, self.percent = n, percent
        self.words = np.array([len(x) // 8 for x in raw], np.int64)
        self.at: dict[int, np.ndarray] = {}
        self.place = np.zeros(len(raw), np.int64)
        below = None
        for w in sorted(set(self.words.tolist()), reverse=True):  # rows of at least w words, folded to w
            own = np.flatnonzero(self.words == w)
            rows = np.frombuffer(b"".join(raw[i] for i in own), _U).reshape(-1, w)
            if below is not None:
                wide = self.at[below]
                while wide.shape[1] > w:
                    half = wide.shape[1] // 2
                    wide = wide[:, :half] ^ wide[:, half:]
                self.place[own] = len(wide) + np.arange(len(own))
                rows = np.concatenate([wide, rows])
            else:
                self.place[own] = np.arange(len(own))
            self.at[w], below = rows, w

    def allow(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether the sets x and y may be similar enough, pair by pair."""
        keep = np.zeros(len(x), bool)
        words = np.minimum(self.words[x], self.words[y])
        for w in np.unique(words).tolist():
            i = np.flatnonzero(words == w)
            bits = self.at[w]
            differ = np.bitwise_count(bits[self.place[x[i]]] ^ bits[self.place[y[i]]]).sum(axis=1)
            keep[i] = differ <= max_difference(self.n[x[i]] + self.n[y[i]], self.percent)
        return keep


def _sketches(width: int, percent: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("signature", pa.binary()),
                        ("bits", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(1))
            for part in blocks(texts):
                h, off = word_hashes([t.lower() for t in texts[part]])
                sets = [shingle_set(h[a:b], width) for a, b in zip(off[:-1], off[1:])]
                full = [i for i, s in enumerate(sets) if len(s)]
                digest, signed = [None] * len(sets), [None] * len(sets)
                for i, row in zip(full, signatures([sets[i] for i in full]) if full else ()):
                    digest[i], signed[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest(), row.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[part.start:part.stop], pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(digest, pa.binary()), pa.array(signed, pa.binary()),
                     pa.array([parity_bitmap(s, percent) if len(s) else None for s in sets], pa.binary())], schema=schema)

    return run


def _pruned(percent: int):
    """(a, b, m) of the pairs that sizes, the posterior and the bitmaps allow."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
            batch = batch.filter(pa.array(np.minimum(n, m) * 100 >= np.maximum(n, m) * percent))
            keep, equal = matches(_rows(batch.column("s_a")), _rows(batch.column("s_b")), percent)
            batch, equal = batch.filter(pa.array(keep)), equal[keep]
            rows = np.arange(batch.num_rows)
            bitmaps = Bitmaps(batch.column("bits_a").to_pylist() + batch.column("bits_b").to_pylist(),
                              np.concatenate([batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()]), percent)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(equal)], names=["a", "b", "m"]).filter(
                pa.array(bitmaps.allow(rows, rows + batch.num_rows)))

    return run


def _bucket_pairs(percent: int):
    """(a, b, m) of the pairs of different components in a block of a bucket that sizes, the
    posterior and the bitmaps allow, and that share no earlier band."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, ["key", "i", "j"]):
            node, label, n, block = (t.column(c).to_numpy() for c in ("node", "label", "n_shingles", "block"))
            i, j, band = (t.column(c)[0].as_py() for c in ("i", "j", "band"))
            signed, bitmaps = _rows(t.column("signature")), Bitmaps(t.column("bits").to_pylist(), n, percent)
            left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
            for x in left:
                y = right[(label[right] != label[x]) & (node[right] != node[x]) & ((i != j) | (right > x))]
                y = y[np.minimum(n[y], n[x]) * 100 >= np.maximum(n[y], n[x]) * percent]
                keep, equal = matches(np.broadcast_to(signed[x], (len(y), HASHES)), signed[y], percent)
                y, equal = y[keep], equal[keep]
                if len(y):
                    same = (signed[y] == signed[x]).reshape(-1, BANDS, ROWS).all(axis=2)
                    keep = ~same[:, :band].any(axis=1) & bitmaps.allow(np.full(len(y), x), y)
                    y, equal = y[keep], equal[keep]
                if len(y):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.minimum(node[y], node[x])), pa.array(np.maximum(node[y], node[x])), pa.array(equal)],
                        names=["a", "b", "m"])

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(1))
            for part in blocks(texts):
                h, off = word_hashes([t.lower() for t in texts[part]])
                sets = [shingle_set(h[a:b], width).tobytes() for a, b in zip(off[:-1], off[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(0)[part.start:part.stop], pa.array(sets, pa.binary())],
                                                 names=["node", "items"])

    return run


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("items_a").to_pylist(), batch.column("items_b").to_pylist()):
                x, y = np.frombuffer(x, _U), np.frombuffer(y, _U)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


class Verifier:
    """Exact checks of candidate pairs against the texts (node, text)."""

    def __init__(self, texts: DataFrame, width: int, percent: int):
        self.texts, self.width, self.percent = texts, width, percent

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose full sets are similar enough, written as a table."""
        ids = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        sets = self.texts.join(ids, "node", "left_semi").mapInArrow(_sets(self.width), "node long, items binary")
        both = pairs.select("a", "b").join(sets.toDF("a", "items_a"), "a").join(sets.toDF("b", "items_b"), "b")
        return written(both.mapInArrow(_confirmed(self.percent), "a long, b long").distinct(), "minhash-links")

    def linked(self, candidates: DataFrame, links: DataFrame) -> DataFrame:
        """``links`` and confirmed pairs of ``candidates`` (a, b, m) enough to connect all that
        the candidates connect."""
        if candidates.isEmpty():
            return links
        best = candidates.groupBy("b").agg(F.max(F.struct("m", (-F.col("a")).alias("less"))).alias("x"))
        links = links.unionByName(self.confirmed(best.select((-F.col("x.less")).alias("a"), "b")))
        label = connected_components(links)
        apart = (candidates.join(label.toDF("a", "of_a"), "a", "left").join(label.toDF("b", "of_b"), "b", "left")
                 .filter(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")))
        untried = written(apart.select("a", "b").join(best.select((-F.col("x.less")).alias("a"), "b"), ["a", "b"], "left_anti"), "minhash-apart")
        return links if untried.isEmpty() else links.unionByName(self.confirmed(untried))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row; component_id is the smallest id that
    links of at least ``percent`` Jaccard similarity over shingles of ``width`` words reach."""
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketch = written(slim.mapInArrow(_sketches(width, percent),
                                      "doc_id long, n_shingles long, digest binary, signature binary, bits binary"), "minhash-sketch")
    usable = sketch.filter("doc_id is not null and n_shingles > 0")
    classes = written(usable.groupBy("digest").agg(F.min(F.struct("doc_id", "n_shingles", "signature", "bits")).alias("x"))
                      .select("digest", F.col("x.doc_id").alias("node"), "x.n_shingles", "x.signature", "x.bits"), "minhash-classes")
    signed = classes.select("node", "n_shingles", "signature", "bits")
    bands = [F.xxhash64(F.lit(b), F.substring("signature", 2 * ROWS * b + 1, 2 * ROWS)) for b in range(BANDS)]
    rows = signed.select("node", F.posexplode(F.array(*bands)).alias("band", "key"))
    shared = written(rows.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"), "minhash-shared")
    release(spark)
    members = written(rows.join(shared, "key").select("key", "band", "size", "node"), "minhash-members")
    release(spark)

    weight = members.groupBy("node").agg(F.sum("size").alias("weight"))
    hubs = (members.join(weight, "node").groupBy("key").agg(F.max(F.struct("weight", (-F.col("node")).alias("less"))).alias("h"))
            .select("key", (-F.col("h.less")).alias("hub")))
    star = (members.join(hubs, "key").filter("hub != node").select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct())
    paired = star.join(signed.toDF("a", "n_a", "s_a", "bits_a"), "a").join(signed.toDF("b", "n_b", "s_b", "bits_b"), "b")
    near = written(paired.mapInArrow(_pruned(percent), "a long, b long, m long"), "minhash-near")

    links = written(same_id_links(usable, classes), "minhash-links")  # rows of one id are one node
    verifier = Verifier(slim.withColumnRenamed("doc_id", "node"), width, percent)
    links = verifier.linked(near, links)
    release(spark)
    known = members.join(connected_components(links), "node", "left").select(
        "key", "band", "node", F.coalesce("component", "node").alias("label"))
    mixed = (known.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"),
                                      F.ceil(F.count("*") / BLOCK_ROWS).cast("long").alias("blocks"))
             .filter("lo < hi").select("key", "blocks"))
    dealt = known.join(mixed, "key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))).join(signed, "node")
    each = dealt.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")).select(
        "key", "band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "block", "node", "label", "n_shingles", "signature", "bits")
    far = written(each.repartition(shuffle_partitions(spark), "key", "i", "j").sortWithinPartitions("key", "i", "j")
                  .mapInArrow(_bucket_pairs(percent), "a long, b long, m long"), "minhash-far")
    found = connected_components(verifier.linked(far, links))

    of_class = classes.join(found, "node", "left").select("digest", F.coalesce("component", "node").alias("component_id"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return (sketch.join(of_class, "digest", "left").select("doc_id", "n_shingles", component.alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
