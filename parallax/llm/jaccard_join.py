"""Exact n-gram Jaccard join: size-banded tiles, hashed bitmap signatures, exact check.

Texts become sorted arrays of distinct word-shingle hashes (64 bits).  Let t be the
threshold.  Two linked sets differ in at most (1-t)/(1+t) of the sum of their sizes, d at
most within a size band.  The hash range is cut into d + 1 slices, so linked sets agree on
at least one whole slice: (band, slice, content) is a tile key that no link can miss, and
that a shared passage seldom satisfies.  A set is in its own band and in those in which a
larger partner may lie.

Inside tiles a parity bitmap per set is compared first: the bit count of the XOR of two
bitmaps is at most the size of the symmetric difference, which bounds the overlap from
above.  Survivors are checked by intersection of the sorted arrays.

A tile is worked in two rounds, so a group of N copies costs N comparisons and not N^2:
1. every member is compared with one hub of the tile, and components are formed;
2. only tiles that still hold several components compare the members of different ones, in
   blocks of bounded size (a hot tile becomes many blocks).
A pair that neither round compares lies in one component already, so components are exact.

Slices that are empty in a set say little, and many sets share them.  Linked sets agree on some
slice that is not empty unless the hashes fall most unevenly; a band has so many slices, d + 1 at
least, that the chance of that is below ``CHANCE``, about that of two shingles with one 64-bit
hash.  Where three times d + 1 slices would not do (small sets), empty slices are keys as well, and
nothing is left to chance.

Results for odd input: null, empty or blank text has no shingle and no link; a null id takes
no part in links and gets a null component; rows that repeat an id are one node, with the links
of all its texts, and each row is returned; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parallax.llm.common import blocks, freed, keep, mix64, release, shingle_set, utf8, word_hashes, written
from parallax.llm.components import connected_components
from parallax.operators.ordering import sized_broadcast

CHANCE = 2.0**-64
BLOCK_ROWS = 4096
HUB_ROWS = 256
_U = np.uint64
_SALT = _U(0x5851F42D4C957F2D)


def band_edges(limit: int) -> list[int]:
    """Lower sizes of the bands: each is half as large again as the one before."""
    edges = [1]
    while edges[-1] <= limit:
        edges.append(max(edges[-1] + 1, edges[-1] * 3 // 2))
    return edges


_EDGES = np.array(band_edges(1 << 40), np.int64)


def max_difference(total: int, percent: int) -> int:
    """Largest symmetric difference of two linked sets whose sizes add up to ``total``."""
    return total * (100 - percent) // (100 + percent)


@lru_cache(maxsize=4096)
def _band(band: int, percent: int) -> tuple[int, bool]:
    """The number of slices of a band, and whether empty ones are keys.  The smallest sets keyed
    in the band are most at risk: of two that differ in d elements, a slice is untouched with the
    chance (1 - 1/k)^d, and holds one of the common elements with 1 - (1 - 1/k)^common."""
    d = max_difference(2 * (int(_EDGES[band + 1]) - 1), percent)
    least = max(1, int(_EDGES[band]) * percent // 100)
    for k in range(d + 1, 3 * d + 4):
        left = 1 - 1 / k
        if (1 - left**d * (1 - left**(least - min(d, least) // 2)))**k < CHANCE:
            return k, False
    return d + 1, True


def _tiles(n: int, percent: int) -> list[tuple[int, int, bool]]:
    """(band, number of slices, whether empty ones are keys) of a set of n shingles."""
    own, last = (int(np.searchsorted(_EDGES, x, side="right")) - 1 for x in (n, n * 100 // percent))
    return [(b, *_band(b, percent)) for b in range(own, last + 1)]


def tile_keys(s: np.ndarray, percent: int) -> np.ndarray:
    """64-bit tile keys of a sorted set."""
    sums = np.append(_U(0), np.cumsum(mix64(s ^ _SALT), dtype=_U))
    out = []
    for band, k, empty in _tiles(len(s), percent):
        step = (1 << 64) // k + 1
        cuts = np.arange(1, k, dtype=_U) * _U(step & ((1 << 64) - 1)) if k > 1 else np.zeros(0, _U)
        at = np.concatenate(([0], np.searchsorted(s, cuts), [len(s)]))
        size = np.diff(at)
        slot = np.arange(k, dtype=_U) + _U(band << 44)
        key = mix64(mix64(slot + _SALT) + (sums[at[1:]] - sums[at[:-1]]) + size.astype(_U))
        out.append(key if empty else key[size > 0])
    return np.concatenate(out)


def parity_bitmap(s: np.ndarray, percent: int) -> bytes:
    """One bit for each hash slot, flipped by every element; sixteen bits for each element by
    which the set may differ from a partner.  Widths are powers of two, so that a wider one
    folds to a narrower one by XOR of its halves."""
    width = 64
    while width < 16 * max_difference(2 * len(s), percent):
        width *= 2
    at = (mix64(s + _SALT) >> _U(32)).astype(np.int64) & (width - 1)
    return np.packbits((np.bincount(at, minlength=width) & 1).astype(np.uint8), bitorder="little").tobytes()


def _folded(bits: np.ndarray, words: int) -> np.ndarray:
    """Rows of 64-bit words folded to ``words`` words."""
    while bits.shape[1] > words:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def _sketches(width: int, percent: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()),
                        ("bits", pa.binary()), ("keys", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), utf8(batch.column(1))
            for part in blocks(texts):
                h, off = word_hashes([t.lower() for t in texts[part]])
                n, digest, bits, keys = [], [], [], []
                for a, b in zip(off[:-1], off[1:]):
                    s = shingle_set(h[a:b], width)
                    n.append(len(s))
                    digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    bits.append(parity_bitmap(s, percent) if len(s) else None)
                    keys.append(tile_keys(s, percent).view(np.int64) if len(s) else np.zeros(0, np.int64))
                sizes = np.append(0, np.cumsum([len(k) for k in keys])).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.concatenate(keys)))
                yield pa.RecordBatch.from_arrays(
                    [ids[part.start:part.stop], pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                     pa.array(bits, pa.binary()), lists], schema=schema)

    return run


def _sets(width: int):
    schema = pa.schema([("node", pa.int64()), ("items", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), utf8(batch.column(1))
            for part in blocks(texts):
                h, off = word_hashes([t.lower() for t in texts[part]])
                sets = [shingle_set(h[a:b], width).tobytes() for a, b in zip(off[:-1], off[1:])]
                yield pa.RecordBatch.from_arrays([ids[part.start:part.stop], pa.array(sets, pa.binary())],
                                                 schema=schema)

    return run


def _overlap_bound(percent: int):
    """Keeps the pairs whose bitmaps allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
            most = (n + m) * (100 - percent) // (100 + percent)
            keep = np.minimum(n, m) * 100 >= np.maximum(n, m) * percent
            pairs = zip(batch.column("bits_a").to_pylist(), batch.column("bits_b").to_pylist())
            for i, (x, y) in enumerate(pairs):
                if keep[i]:
                    x, y = np.frombuffer(x, _U)[None], np.frombuffer(y, _U)[None]
                    words = min(x.shape[1], y.shape[1])
                    keep[i] = np.bitwise_count(_folded(x, words) ^ _folded(y, words)).sum() <= most[i]
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows of equal keys from sorted batches; a run may span batches."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        cols = [table.column(k).to_numpy() for k in keys]
        change = np.zeros(table.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), table.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            key = tuple(c[a] for c in cols)
            if held and key != last:
                yield pa.concat_tables(held)
                held = []
            held.append(table.slice(a, b - a))
            last = key
    if held:
        yield pa.concat_tables(held)


def _tile_pairs(percent: int):
    """Pairs of different components in a block of a tile that their bitmaps allow."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, ["key", "i", "j"]):
            node, label, n = (t.column(c).to_numpy() for c in ("node", "label", "n_shingles"))
            block = t.column("block").to_numpy()
            i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
            raw = t.column("bits").to_pylist()
            words = min(len(x) for x in raw) // 8
            bits = np.concatenate([_folded(np.frombuffer(x, _U)[None], words) for x in raw])
            left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
            for x in left:
                ok = (label[right] != label[x]) & (node[right] != node[x])
                if i == j:
                    ok &= right > x
                y = right[ok]
                lo, hi = np.minimum(n[y], n[x]), np.maximum(n[y], n[x])
                y = y[lo * 100 >= hi * percent]
                if len(y):
                    diff = np.bitwise_count(bits[y] ^ bits[x]).sum(axis=1)
                    y = y[diff <= (n[y] + n[x]) * (100 - percent) // (100 + percent)]
                if len(y):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.minimum(node[y], node[x])), pa.array(np.maximum(node[y], node[x]))], schema=schema)

    return run


def _verified(percent: int):
    """Exact intersections: each run holds one set of id a (member null) and its partners."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, ["a", "salt"]):
            member, items = t.column("member").to_pylist(), t.column("items").to_pylist()
            hubs = [np.frombuffer(x, _U) for m, x in zip(member, items) if m is None]
            links = set()
            for m, x in zip(member, items):
                if m is not None:
                    s = np.frombuffer(x, _U)
                    for hub in hubs:
                        shared = len(np.intersect1d(hub, s, assume_unique=True))
                        if 100 * shared >= percent * (len(hub) + len(s) - shared):
                            links.add(m)
            if links:
                a = t.column("a")[0].as_py()
                b = sorted(links)
                yield pa.RecordBatch.from_arrays([pa.array([a] * len(b), pa.int64()), pa.array(b, pa.int64())],
                                                 schema=schema)

    return run


def _links(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets pass the exact check.  The sets are made again from the
    texts of the ids concerned; a hub with many partners is repeated for each ``HUB_ROWS``."""
    ids = written(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "jaccard-ids")
    sets = (texts.join(sized_broadcast(ids), texts["node"] == ids["node"], "left_semi")
            .mapInArrow(_sets(width), "node long, items binary").distinct())
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / HUB_ROWS).cast("long").alias("parts"))
    salted = pairs.join(parts, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).alias("salt"))
    member = salted.join(sets.withColumnRenamed("node", "b"), "b").select(
        "a", "salt", F.col("b").alias("member"), "items")
    hub = (parts.join(sets.withColumnRenamed("node", "a"), "a")
           .select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("salt"),
                   F.lit(None).cast("long").alias("member"), "items"))
    rows = hub.unionByName(member).repartition("a", "salt").sortWithinPartitions("a", "salt")
    return rows.mapInArrow(_verified(percent), "a long, b long")


def same_id_links(usable: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): links between the classes of rows that share an id but not their set; ``usable``
    has (doc_id, digest), ``classes`` (digest, node)."""
    of_row = usable.join(classes.select("digest", "node"), "digest").select("doc_id", "node").filter("doc_id != node").distinct()
    stands = of_row.join(classes.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi").select(
        F.least("doc_id", "node").alias("a"), F.greatest("doc_id", "node").alias("b"))
    again = of_row.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a < z").select("doc_id", "a")
    return of_row.join(again, "doc_id").select("a", F.col("node").alias("b")).filter("a < b").unionByName(stands).distinct()


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """One row for each input row: (doc_id, n_shingles, component_id); component_id is the
    smallest id that links of at least ``percent`` Jaccard similarity over shingles of
    ``width`` words reach.  Words are lower-cased (A-Z)."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketch = written(slim.mapInArrow(
        _sketches(width, percent),
        "doc_id long, n_shingles long, digest binary, bits binary, keys array<long>")
        .withColumn("row", F.monotonically_increasing_id()), "jaccard-sketch")
    spark = docs.sparkSession
    usable = sketch.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    # texts with one set are one class; the row of its smallest id stands for it
    classes = written(usable.groupBy("digest").agg(F.min(F.struct("doc_id", "row")).alias("x"))
                      .select("digest", F.col("x.doc_id").alias("node"), "x.row"), "jaccard-classes")
    reps = (usable.join(sized_broadcast(classes.select("row")), "row", "left_semi")
            .select(F.col("doc_id").alias("node"), "n_shingles", "bits", "keys"))
    rows = reps.select("node", F.explode("keys").alias("key"))
    # keys that only one set has end here
    shared = written(rows.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"), "jaccard-shared")
    release(spark)
    members = written(rows.join(shared, "key").select("key", "size", "node"), "jaccard-members")
    release(spark)
    sizes = reps.select("node", "n_shingles", "bits")
    texts = slim.withColumnRenamed("doc_id", "node")

    # a tile's hub is the member that shares most tiles with most others: the text that the
    # copies were made of, if it is there
    weight = members.groupBy("node").agg(F.sum("size").alias("weight"))
    hubs = members.join(weight, "node").groupBy("key").agg(
        F.max(F.struct("weight", (-F.col("node")).alias("n"))).alias("h")).select("key", (-F.col("h.n")).alias("hub"))
    star = (members.join(hubs, "key").filter("hub != node")
            .select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct())
    near = (star.join(sizes.toDF("a", "n_a", "bits_a"), "a").join(sizes.toDF("b", "n_b", "bits_b"), "b")
            .select("a", "b", "n_a", "n_b", "bits_a", "bits_b")
            .mapInArrow(_overlap_bound(percent), "a long, b long"))
    links = written(_links(written(near, "jaccard-near").distinct(), texts, width, percent).unionByName(
        same_id_links(usable, classes)).distinct(), "jaccard-links")
    labels = connected_components(links)
    release(spark)

    known = members.join(labels, "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("label"))
    mixed = (known.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"),
                                      F.ceil(F.count("*") / BLOCK_ROWS).cast("long").alias("blocks"))
             .filter("lo < hi").select("key", "blocks"))
    dealt = known.join(mixed, "key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    tiled = (dealt.join(sizes, "node")
             .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
             .select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                     "block", "node", "label", "n_shingles", "bits"))
    far = (tiled.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
           .mapInArrow(_tile_pairs(percent), "a long, b long").distinct())
    more = _links(written(far, "jaccard-far"), texts, width, percent)
    found = connected_components(links.unionByName(more))

    of_class = classes.select("digest", "node").join(found, "node", "left").select(
        "digest", F.coalesce("component", "node").alias("component_id"))
    return sketch.join(of_class, "digest", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row with the
    smallest id stays; rows of no component all stay, as do rows without id or shingle.  Of
    rows that repeat both id and text one stays."""
    with freed(docs.sparkSession):
        found = keep(jaccard_components(docs, width, percent), "jaccard-found")
    # ids whose rows go, and ids of several rows; other rows need no look at all
    marked = written(found.groupBy("doc_id").agg((F.min("component_id") < F.col("doc_id")).alias("gone"), (F.count("*") > 1).alias("again"))
                     .filter("doc_id is not null and (gone or again)"), "jaccard-marked")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    kept = rows.join(sized_broadcast(marked), "doc_id", "left").filter("not coalesce(gone, false)")
    repeated = kept.filter("again").dropDuplicates(["doc_id", "text"])
    return kept.filter("not coalesce(again, false)").unionByName(repeated).select("row.*")
