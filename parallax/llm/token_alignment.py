"""Alignment of two tokenizers over the same texts.

Tokenizer A is a byte-level BPE of the tokenizers library and reads " " + text; tokenizer B is
a sentencepiece model and adds that space itself.  Tokens are byte strings.  Offsets at which
a token of A and one of B both end cut the tokens into groups; the two tokens that end at a
cut are linked.  The count of an id pair is the number of its links in all rows.

Copies are worked once: rows are shuffled by their whole text and counted, each distinct text
is tokenized and aligned once by one task (which keeps what it knows of words), its pair counts enter the corpus counts times its number
of copies, and its measures are joined to the ids of its rows (by SHA-256 of the text, so that
the join moves no text).

Pair counts are looked up in two tiers.  Pairs with over a ``FREQUENT``-th of all links are
fewer than ``FREQUENT``, three numbers each, and are broadcast; occurrences of other pairs are
joined by shuffle.  The highest count of each id of B has one row for each id of its vocabulary.

Results for odd input: null and empty texts, and texts whose tokens of either side do not give
back the bytes of " " + text (among them texts that hold U+2581), have no tokens: zeros and an
empty digest.  Strings of special tokens are plain text.  Rows that repeat an id or a text each
get a row; null ids are kept; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parallax.llm.common import blocks, written
from parallax.llm.token_output import Encoder, has_odd_space

FREQUENT = 1 << 19
KEPT = 400_000
_EMPTY = np.zeros(0, np.int64)


def byte_level_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable bytes are
    written as themselves, the others in order as U+0100, U+0101, ..."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_level_tokens(vocabulary: dict[str, int]) -> list[bytes]:
    byte = byte_level_alphabet()
    out = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        out[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
    return out


def piece_tokens(model: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    return [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i)
            else model.id_to_piece(i).replace("▁", " ").encode() for i in range(model.get_piece_size())]


class Aligner:
    """Aligns texts by their parts, cut before each space that follows something else: no token
    of a byte-level vocabulary has a space behind another character, so no merge of A spans such
    a cut, and none of B does if its vocabulary has no such piece either.  Parts are aligned
    once and kept, up to ``KEPT`` of them; texts with other white space at a cut, and those
    with a part whose tokens do not give it back, are aligned as a whole."""

    def __init__(self, path_a: str, path_b: str, kept: int = KEPT):
        self.encoder, self.kept = Encoder(path_a), kept
        self.model = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.a = byte_level_tokens(self.encoder.tokenizer.get_vocab())
        self.b = piece_tokens(self.model)
        self.len_a, self.len_b = [len(t) for t in self.a], [len(t) for t in self.b]
        self.by_parts = all(t.rfind(b" ") <= 0 or not t.strip(b" ") for t in self.b)
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.names: list[bytes] = []  # groups of each part
        self.n_a, self.n_b, self.n_links = (np.zeros(0, np.int64) for _ in range(3))
        self.bad, self.pairs = np.zeros(0, bool), np.zeros(0, np.int64)

    def align(self, a: list[int], b: list[int], whole: bytes) -> tuple[bytes, list[int]] | None:
        """The groups ``a1,a2|b1;a3|b2,b3`` and the links as pairs a * size of B + b; None if
        the tokens do not join to ``whole``."""
        if b"".join(map(self.a.__getitem__, a)) != whole or b"".join(map(self.b.__getitem__, b)) != whole:
            return None
        groups, links = [], []
        i = j = from_a = from_b = 0
        end_a, end_b = self.len_a[a[0]], self.len_b[b[0]]
        while True:
            if end_a == end_b:
                groups.append(f"{','.join(map(str, a[from_a:i + 1]))}|{','.join(map(str, b[from_b:j + 1]))}")
                links.append(a[i] * len(self.b) + b[j])
                i, j = i + 1, j + 1
                if i == len(a):
                    return ";".join(groups).encode(), links
                from_a, from_b = i, j
                end_a += self.len_a[a[i]]
                end_b += self.len_b[b[j]]
            elif end_a < end_b:
                i += 1
                end_a += self.len_a[a[i]]
            else:
                j += 1
                end_b += self.len_b[b[j]]

    def _ids_a(self, data: bytes) -> list[int]:
        return np.frombuffer(data, self.encoder.dtype).tolist()

    def _learn(self, parts: set[str]) -> None:
        new = [p for p in parts if p not in self.index]
        if len(self.index) + len(new) > self.kept:
            self._clear()
            new = list(parts)
        if not new:
            return
        self.encoder.encode(["x " + " ".join(new)])  # keeps the ids of every part after a space
        n_a, n_b, n_links, bad, pairs = [], [], [], [], []
        for p, b in zip(new, self.model.encode(new, num_threads=1)):
            a = self._ids_a(self.encoder.spaced[p])
            found = self.align(a, b, b" " + p.encode())
            groups, links = found or (b"", [])
            self.names.append(groups)
            n_a.append(len(a))
            n_b.append(len(b))
            n_links.append(len(links))
            bad.append(found is None)
            pairs += links
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
        self.n_a, self.n_b, self.n_links, self.pairs = (
            np.append(x, np.array(y, np.int64)) for x, y in ((self.n_a, n_a), (self.n_b, n_b), (self.n_links, n_links), (self.pairs, pairs)))
        self.bad = np.append(self.bad, bad)

    def _whole(self, text: str):
        a = self._ids_a(self.encoder.encode([" " + text])[0])
        b = self.model.encode(text)
        found = self.align(a, b, b" " + text.encode())
        return (0, 0, _EMPTY, None) if found is None else (len(a), len(b), np.array(found[1], np.int64), found[0])

    def texts(self, texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, bytes | None]]:
        """(tokens of A, tokens of B, links, groups) of each text; no groups if it has no tokens."""
        split = [t.split(" ") if self.by_parts and not has_odd_space(t) else None for t in texts]
        self._learn({p for s in split if s for p in s})
        begin = np.cumsum(self.n_links) - self.n_links
        for t, s in zip(texts, split):
            at = np.fromiter(map(self.index.__getitem__, s), np.int64, len(s)) if s else None
            if at is None or self.bad[at].any():
                yield self._whole(t)
                continue
            per = self.n_links[at]
            place = np.repeat(begin[at] - (np.cumsum(per) - per), per) + np.arange(int(per.sum()))
            yield int(self.n_a[at].sum()), int(self.n_b[at].sum()), self.pairs[place], b";".join(map(self.names.__getitem__, at.tolist()))


@lru_cache(maxsize=1)
def _aligner(path_a: str, path_b: str) -> Aligner:
    """One for all tasks of a Python worker, with the parts it keeps."""
    return Aligner(path_a, path_b)


def _aligned(path_a: str, path_b: str):
    """By distinct text (digest, copies, text): its measures, and its pairs of ids
    (a * size of B + b) with the number of their links."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(path_a, path_b)
        for batch in batches:
            raw = batch.column(2).cast("binary").to_pylist()
            for part in blocks(raw):
                texts = batch.column(2)[part.start:part.stop].to_pylist()
                sizes, digests, pairs, times = [], [], [], []
                for n_a, n_b, links, groups in aligner.texts(texts):
                    pair, many = np.unique(links, return_counts=True)
                    sizes.append((n_a, n_b, len(links)))
                    digests.append("" if groups is None else hashlib.sha256(groups).hexdigest())
                    pairs.append(pair)
                    times.append(many)
                off = pa.array(np.append(0, np.cumsum([len(p) for p in pairs])), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[part.start:part.stop], batch.column(1)[part.start:part.stop],
                     *(pa.array(s, pa.int64()) for s in zip(*sizes)), pa.array(digests, pa.string()),
                     pa.ListArray.from_arrays(off, pa.array(np.concatenate(pairs), pa.int64())),
                     pa.ListArray.from_arrays(off, pa.array(np.concatenate(times), pa.int32()))],
                    names=["digest", "copies", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"])

    return run


def aligned_texts(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row for each distinct text, written as a table."""
    texts = docs.filter("text is not null and text != ''").groupBy("text").agg(F.count("*").alias("copies"))
    return written(texts.select(F.unhex(F.sha2("text", 256)).alias("digest"), "copies", "text").mapInArrow(
        _aligned(path_a, path_b),
        "digest binary, copies long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, times array<int>"),
        "aligned-texts")


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """(pair, n, best): links of each id pair in all rows, and whether no pair of its id of B has
    more."""
    each = aligned.select("copies", F.inline(F.arrays_zip("pairs", "times")))
    counts = written(each.groupBy(F.col("pairs").alias("pair")).agg(F.sum(F.col("times") * F.col("copies")).alias("n")), "aligned-pairs")
    of_b = F.pmod("pair", F.lit(size_b)).alias("b")
    most = counts.groupBy(of_b).agg(F.max("n").alias("most"))  # a row for each id of B
    return counts.withColumn("b", of_b).join(F.broadcast(most), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def measures(aligned: DataFrame, counted: DataFrame) -> DataFrame:
    """(digest, n_best, count_sum) of each text with links."""
    total = aligned.agg(F.coalesce(F.sum(F.col("n_groups") * F.col("copies")), F.lit(0))).first()[0]
    frequent = F.col("n") * FREQUENT > total
    each = aligned.select("digest", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    top = F.broadcast(counted.filter(frequent))
    found = each.join(top, "pair").select("digest", "times", "n", "best")
    rest = counted.filter(~frequent)
    if not rest.isEmpty():
        found = found.unionByName(each.join(top, "pair", "left_anti").join(rest, "pair").select("digest", "times", "n", "best"))
    return found.groupBy("digest").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                                       F.sum(F.col("times") * F.col("n")).alias("count_sum"))


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each row."""
    size_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    aligned = aligned_texts(docs, path_a, path_b)
    counted = written(pair_counts(aligned, size_b), "aligned-counts")
    by_text = aligned.select("digest", "n_a", "n_b", "n_groups", "groups_sha256").join(measures(aligned, counted), "digest", "left")
    rows = docs.select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest")).join(by_text, "digest", "left")
    number = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return rows.select("doc_id", *(number(c).alias(c) for c in ("n_a", "n_b", "n_groups")), number("n_groups").alias("n_links"),
                       *(number(c).alias(c) for c in ("n_best", "count_sum")), F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
