"""H1 segmentation of text without spaces: a unigram model over pieces (Kudo 2018).

A script run (Han, Hiragana, Katakana, which Japanese words mix) is a lattice whose edges are
pieces of up to ``max_piece`` characters.  Its segmentation is the path of the highest product
of piece probabilities; equal paths are told apart by the longer last piece.

Training is expectation maximisation over the distinct runs of the corpus: Spark counts runs
and their substrings, the best ``vocab_size`` substrings by count x length are the first
pieces, and each round sums the expected piece counts of all runs (forward-backward in each
task, one partial sum for each piece, then one aggregation).  The piece table holds at most
``vocab_size`` rows of at most ``max_piece`` characters, so it is broadcast; a single character
that is no piece has the probability ``FLOOR``.

A stand-in for a dictionary: pieces are what repeats in the corpus, not morphemes, so this
segmentation differs from that of a morphological analyser.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parallax.functions.text import register_tokenizer
from parallax.session import scratch_path

VOCAB_SIZE, MAX_PIECE, ROUNDS = 8000, 6, 3
FLOOR = -25.0  # natural logarithm
KEPT = 200_000
_UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}ー"
RUN = f"[{_UNSPACED}]+"
LETTERS = rf"[^\p{{P}}\p{{S}}\p{{Z}}\p{{C}}{_UNSPACED}]+"
PATTERN = rf"{RUN}|{LETTERS}|[^\p{{L}}\p{{M}}\p{{N}}\s]"


class Lattice:
    """Piece probabilities (natural logarithms) and the sums over paths they give."""

    def __init__(self, pieces: dict[str, float]):
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)

    def edges(self, run: str, end: int) -> Iterator[tuple[int, str, float]]:
        """(start, piece, log probability) of the edges that end at a place, shortest first."""
        for start in range(end - 1, max(end - self.longest, 0) - 1, -1):
            piece = run[start:end]
            p = self.pieces.get(piece, FLOOR if end - start == 1 else None)
            if p is not None:
                yield start, piece, p

    def best(self, run: str) -> list[str]:
        score, back = [0.0], [0]
        for end in range(1, len(run) + 1):
            top, at = -math.inf, end - 1
            for start, _, p in self.edges(run, end):
                if score[start] + p >= top:
                    top, at = score[start] + p, start
            score.append(top)
            back.append(at)
        out, end = [], len(run)
        while end:
            out.append(run[back[end]:end])
            end = back[end]
        return out[::-1]

    def expected(self, run: str, weight: float, into: dict[str, float]) -> float:
        """Adds the expected count of each piece, times ``weight``; the log probability of the run."""
        n = len(run)
        found = [list(self.edges(run, end)) for end in range(1, n + 1)]
        alpha = [0.0]
        for edges in found:
            alpha.append(_log_sum([alpha[start] + p for start, _, p in edges]))
        behind: list[list[float]] = [[] for _ in range(n)] + [[0.0]]
        for end in range(n, 0, -1):
            beta = _log_sum(behind[end])
            for start, piece, p in found[end - 1]:
                behind[start].append(p + beta)
                into[piece] = into.get(piece, 0.0) + weight * math.exp(alpha[start] + p + beta - alpha[n])
        return alpha[n]


def _log_sum(terms: list[float]) -> float:
    most = max(terms)
    return most + math.log(sum(math.exp(t - most) for t in terms))


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_counts(texts: DataFrame, text_col: str, pattern: str = RUN) -> DataFrame:
    """(run, n): the distinct runs of the texts."""
    runs = F.regexp_extract_all(F.col(text_col), F.lit(pattern), F.lit(0))
    return texts.select(F.explode(runs).alias("run")).groupBy("run").agg(F.count("*").alias("n"))


def first_pieces(runs: DataFrame, vocab_size: int, max_piece: int) -> DataFrame:
    """(piece, n): substrings of the runs, the best by count x length; longer ones occur twice at
    least."""
    ends = F.transform(F.sequence(F.lit(1), F.length("run")), lambda i: F.transform(
        F.sequence(F.lit(1), F.least(F.lit(max_piece), F.length("run") - i + 1)), lambda k: F.substr(F.col("run"), i, k)))
    counts = runs.select("n", F.explode(F.flatten(ends)).alias("piece")).groupBy("piece").agg(F.sum("n").alias("n"))
    return (counts.filter((F.length("piece") == 1) | (F.col("n") > 1))
            .orderBy((F.col("n") * F.length("piece")).desc(), "piece").limit(vocab_size))


def _expected(shared):
    """(piece, n) of (run, n); the row of the empty piece has the log likelihood."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, total, loss = Lattice(shared.value), {}, 0.0
        for batch in batches:
            for text, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                loss += n * lattice.expected(text, n, total)
        total[""] = loss
        yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.float64())], names=["piece", "n"])

    return run


def train_pieces(texts: DataFrame, text_col: str, pattern: str = RUN, vocab_size: int = VOCAB_SIZE, max_piece: int = MAX_PIECE,
                 rounds: int = ROUNDS) -> tuple[dict[str, float], list[float]]:
    """The pieces with their log probabilities, and the log likelihood before each round.
    Without runs there is no piece, and every character stands alone."""
    spark = texts.sparkSession
    runs = _written(run_counts(texts, text_col, pattern), "lattice-runs")
    counts = {r.piece: float(r.n) for r in first_pieces(runs, vocab_size, max_piece).collect()}  # vocab_size rows at most
    likelihood = []
    for _ in range(rounds if counts else 0):
        shared = spark.sparkContext.broadcast(_logs(counts))
        sums = runs.mapInArrow(_expected(shared), "piece string, n double").groupBy("piece").agg(F.sum("n").alias("n"))
        found = {r.piece: r.n for r in sums.collect()}  # pieces, and single characters that are none
        likelihood.append(found.pop("", 0.0))
        counts = {p: found[p] for p in counts if found.get(p, 0.0) > 1e-6}
        shared.unpersist()
    return _logs(counts), likelihood


def _logs(counts: dict[str, float]) -> dict[str, float]:
    total = sum(counts.values())
    return {p: max(math.log(n / total), FLOOR) for p, n in counts.items()}


def lattice_tokenizer(spark, pieces: dict[str, float], every: bool = False) -> Callable[[Column], Column]:
    """A tokenizer (I1): runs of the unspaced scripts, with ``every`` all runs of letters and
    digits, are segmented; other runs and single symbols are tokens.  A null text has none."""
    shared = spark.sparkContext.broadcast(pieces)

    @F.pandas_udf("array<string>")
    def split(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        lattice, known = Lattice(shared.value), {}
        for tokens, whole in batches:
            out = []
            for row, flags in zip(tokens, whole):
                if row is None:
                    out.append(None)
                    continue
                parts: list[str] = []
                for token, flag in zip(row, flags):
                    if flag:
                        parts.append(token)
                        continue
                    if token not in known:
                        if len(known) >= KEPT:
                            known.clear()
                        known[token] = lattice.best(token)
                    parts += known[token]
                out.append(np.array(parts, object))
            yield pd.Series(out, dtype=object)

    def tokenize(text: Column) -> Column:
        tokens = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))
        if every:  # only single characters can be symbols
            return split(tokens, F.transform(tokens, lambda t: (F.length(t) == 1) & ~t.rlike(f"^({RUN}|{LETTERS})$")))
        return split(tokens, F.transform(tokens, lambda t: ~t.rlike(f"^{RUN}$")))

    return tokenize


def register_lattice(texts: DataFrame, text_col: str, name: str = "lattice", every: bool = False, **training) -> None:
    """Trains on the texts and registers the tokenizer under ``name``."""
    pattern = f"{RUN}|{LETTERS}" if every else RUN
    pieces, _ = train_pieces(texts, text_col, pattern, **training)
    register_tokenizer(name, lattice_tokenizer(texts.sparkSession, pieces, every))
