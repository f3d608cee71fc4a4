"""Ranked lexical search of many queries at once, with the work that queries share done once.

A term is a maximal run of ASCII letters, digits and characters beyond ASCII; only A-Z are
lower-cased.  The score of a document for a query is a sum over the query's terms, so a term
set that several queries hold needs one partial accumulator by document, whatever the number
of its queries.  For a block of queries ``share`` mines such sets:

1. terms held by exactly the same queries form one atom;
2. the pair of nodes that most queries hold together becomes a node of its own, in place of
   both in those queries, again and again while a pair has two queries.

The result is a directed graph: atoms at the bottom, pairs above them, queries on top.  Spark
reads the documents once for the block's statistics and postings (terms of the block only,
written as a table) and once more for the accumulators: a task takes some documents, sums
their contributions by atom, adds nodes in the order of the graph, and adds the queries up
from their nodes.  Each node is materialised once for those documents.  Tasks keep the best
``k`` rows for each query among their own documents; a salted ranking takes the best of all.

Queries come to the driver a block at a time: a block ends when the squares of its queries'
numbers of terms add up to ``SQUARES`` (so mining is bounded) or its terms to ``TERMS``.

Results for odd input: null or empty texts have no term and are never ranked; a query without
terms or without id has no row; rows that repeat an item id are one query with the terms of
all; each row of the documents is ranked, also rows that repeat an id (equal ones are
interchangeable); a null document id comes after all others of its score; without documents
or queries the result is empty; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parallax.llm.common import LOWER, UPPER, utf8, written
from parallax.operators.ordering import top_k_per_group

SQUARES = 4_000_000
TERMS = 200_000
CELLS = 2_000_000
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


@dataclass
class Shared:
    """A block of queries: ``atom`` is the atom of each term by the term's place, ``pairs`` the
    two nodes that each further node adds, ``nodes`` the nodes of each query."""
    items: list[int]
    vocabulary: list[bytes]
    atom: np.ndarray
    pairs: list[tuple[int, int]]
    nodes: list[list[int]]

    @property
    def size(self) -> int:
        return len(self.pairs) + (int(self.atom.max()) + 1 if len(self.atom) else 0)


def share(queries: list[tuple[int, set[bytes]]]) -> Shared:
    """Mines the term sets that the queries (id, terms) share."""
    holders: dict[bytes, list[int]] = defaultdict(list)
    for q, (_, words) in enumerate(queries):
        for w in words:
            holders[w].append(q)
    groups: dict[tuple[int, ...], list[bytes]] = defaultdict(list)
    for w in sorted(holders):
        groups[tuple(holders[w])].append(w)
    of = [set(g) for g in groups]
    nodes: list[set[int]] = [set() for _ in queries]
    for a, held in enumerate(of):
        for q in held:
            nodes[q].add(a)
    vocabulary = [w for g in groups.values() for w in g]
    atom = np.repeat(np.arange(len(groups)), [len(g) for g in groups.values()])

    many = {a for a, held in enumerate(of) if len(held) > 1}
    together = Counter(p for n in nodes for p in combinations(sorted(n & many), 2))
    queue = [(-c, *p) for p, c in together.items() if c > 1]
    heapq.heapify(queue)
    pairs = []
    while queue:
        c, i, j = heapq.heappop(queue)
        both = of[i] & of[j]
        if len(both) < 2:
            continue
        if len(both) < -c:  # some of these queries have another node by now
            heapq.heappush(queue, (-len(both), i, j))
            continue
        new = len(of)
        pairs.append((i, j))
        of.append(both)
        of[i], of[j] = of[i] - both, of[j] - both
        for q in both:
            nodes[q] -= {i, j}
        for n, c in Counter(n for q in both for n in nodes[q] if len(of[n]) > 1).items():
            if c > 1:
                heapq.heappush(queue, (-c, n, new))
        for q in both:
            nodes[q].add(new)
    return Shared([i for i, _ in queries], vocabulary, atom, pairs, [sorted(n) for n in nodes])


def _blocks(rows: Iterable) -> Iterator[list[tuple[int, set[bytes]]]]:
    """Queries of the rows (item_id, text), which come in the order of their ids, by block."""
    block: list[tuple[int, set[bytes]]] = []
    for r in rows:
        words = set(terms((r.text or "").encode()))
        if block and block[-1][0] == r.item_id:
            block[-1][1].update(words)
            continue
        sizes = [len(w) for _, w in block]
        if block and (sum(n * n for n in sizes) > SQUARES or sum(sizes) > TERMS):
            yield block
            block = []
        block.append((r.item_id, words))
    if block:
        yield block


def _postings(shared):
    """(doc_id, n, terms, tfs) of (doc_id, text): n counts all terms, the lists hold the places
    and frequencies of those in the vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {w: i for i, w in enumerate(shared.value)}
        for batch in batches:
            n, found = [], []
            for t in utf8(batch.column(1)):
                words = terms(t)
                n.append(len(words))
                tf = Counter(map(place.get, words))
                tf.pop(None, None)
                found.append(tf)
            off = pa.array(np.append(0, np.cumsum([len(f) for f in found])), pa.int32())
            lists = (pa.ListArray.from_arrays(off, pa.array([x for f in found for x in get(f)], pa.int32()))
                     for get in (Counter.keys, Counter.values))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), *lists],
                                             names=["doc_id", "n", "terms", "tfs"])

    return run


class _Best:
    """The best k (score, id) of each query so far; equal scores by id, null ids last."""

    def __init__(self, queries: int, k: int):
        self.k, self.floor = k, np.ones(queries, np.int64)
        self.held = [np.zeros(0, np.int64) for _ in range(4)]  # query, score, id, id is null
        self.new: list[list[np.ndarray]] = []

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        q, d = np.nonzero(scores >= self.floor[:, None])
        self.new.append([q, scores[q, d], ids[d], null[d]])
        if sum(len(x[0]) for x in self.new) > 4 * self.k * len(self.floor):
            self.reduce()

    def reduce(self) -> list[np.ndarray]:
        q, s, i, z = (np.concatenate(x) for x in zip(self.held, *self.new))
        order = np.lexsort((i, z, -s, q))
        first = np.searchsorted(q[order], np.arange(len(self.floor)))
        order = order[np.arange(len(order)) - first[q[order]] < self.k]
        self.held, self.new = [x[order] for x in (q, s, i, z)], []
        per = np.bincount(self.held[0], minlength=len(self.floor))
        last = np.cumsum(per)[per == self.k] - 1
        self.floor[per == self.k] = self.held[1][last]
        return self.held


def _ranked(shared, k: int):
    """The best rows (item_id, doc_id, score) of a task's postings."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, weight, docs, length = shared.value
        atoms = plan.size - len(plan.pairs)
        rows = max(16, CELLS // max(plan.size, 1))
        flat = np.array([n for nodes in plan.nodes for n in nodes], np.int64)
        begin = np.cumsum([0, *(len(n) for n in plan.nodes)])[:-1]
        best = _Best(len(plan.nodes), k)
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                n, term, tf = part.column(1).to_numpy(), part.column(2), part.column(3)
                doc = np.repeat(np.arange(part.num_rows), np.diff(term.offsets.to_numpy()))
                term, tf = term.flatten().to_numpy(), tf.flatten().to_numpy().astype(np.int64)
                m = 50 + 50 * n * docs // length
                acc = np.zeros((plan.size, part.num_rows), np.int64)
                np.add.at(acc, (plan.atom[term], doc), weight[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[doc])))
                for node, (i, j) in enumerate(plan.pairs, atoms):
                    np.add(acc[i], acc[j], out=acc[node])
                ids = part.column(0)
                best.add(np.add.reduceat(acc[flat], begin, axis=0), ids.fill_null(0).to_numpy(),
                         ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64))
        q, s, i, null = best.reduce()
        if len(q):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(plan.items, np.int64)[q]), pa.array(i, mask=null.astype(bool)), pa.array(s)],
                names=["item_id", "doc_id", "score"])

    return run


def _best_of_block(docs: DataFrame, queries: list[tuple[int, set[bytes]]], k: int) -> DataFrame | None:
    spark = docs.sparkSession
    plan = share([q for q in queries if q[1]])
    if not plan.items:
        return None
    words = spark.sparkContext.broadcast(plan.vocabulary)
    postings = written(docs.mapInArrow(_postings(words), "doc_id long, n long, terms array<int>, tfs array<int>"), "search-postings")
    n, length = postings.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(plan.vocabulary), np.int64)
    for r in postings.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # one row for each term of the block
        df[r.t] = r["count"]
    weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    shared = spark.sparkContext.broadcast((plan, weight, n, max(length, 1)))
    hits = postings.filter(F.size("terms") > 0)
    return hits.mapInArrow(_ranked(shared, k), "item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of the highest score above 0 for each
    item, equal scores by ascending id."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = (items.filter("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
               .orderBy("item_id").toLocalIterator())
    parts = [p for block in _blocks(ordered) if (p := _best_of_block(slim, block, k)) is not None]
    if not parts:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    best = top_k_per_group(reduce(DataFrame.unionAll, parts), ["item_id"], order, k, "doc_id")
    return best.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


ORACLE_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents),
size AS (SELECT r, doc_id, len(ts)::BIGINT AS n FROM d WHERE len(ts) > 0),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS len FROM size),
q AS (
  SELECT DISTINCT item_id,
         unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE item_id IS NOT NULL),
tf AS (
  SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ts) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY r, term),
w AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term), total),
s AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // len))))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN size USING (r), total
  GROUP BY item_id, r, doc_id),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score
  FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""
