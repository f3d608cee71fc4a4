"""Helpers shared by the operators of this subpackage.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and
carriage return; ``bytes.split`` and ``bytes.lower`` have exactly these rules.  The NumPy
kernels work on blocks of about one MiB, so memory follows the block and not the column;
a long text is cut at white space into several blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parallax.session import release, scratch_path  # noqa: F401

BLOCK_BYTES = 1 << 20
WORD_RE = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, 9, 10, 11, 12, 13]] = False
_U = np.uint64
_SLOTS = np.zeros(0, _U)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def crc_remainder(col: str, n: int) -> Column:
    """crc32 of the column as text, mod n; null for null."""
    return F.pmod(F.crc32(F.col(col).cast("string")), F.lit(n))


_HELD: list[list[str]] = []


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The table written as Parquet (with its ``options``) under the shared checkpoint folder and
    read again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if _HELD:
        _HELD[-1].append(path)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Tables that ``written`` makes inside are deleted at the end; what is needed later must
    be written outside, and before."""
    _HELD.append([])
    try:
        yield
    finally:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for path in map(jvm.org.apache.hadoop.fs.Path, _HELD.pop()):
            path.getFileSystem(conf).delete(path, True)


def keep(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``written``, but not deleted by the innermost ``freed``."""
    held = _HELD.pop() if _HELD else None
    try:
        return written(df, name, **options)
    finally:
        if held is not None:
            _HELD.append(held)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _slots(n: int) -> np.ndarray:
    """Odd pseudo-random factors by position inside a word."""
    global _SLOTS
    if len(_SLOTS) < n:
        _SLOTS = mix64((np.arange(max(n, 4096), dtype=_U) + _U(1)) * _U(0x9E3779B97F4A7C15)) | _U(1)
    return _SLOTS


def _block_words(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start offsets and 64-bit hashes of the words of a block."""
    buf = np.frombuffer(block, np.uint8)
    inside = _IS_WORD[buf]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return starts, np.zeros(0, _U)
    lens = ends - starts
    first = np.cumsum(lens) - lens
    body = buf[inside].astype(_U)
    pos = np.arange(len(body)) - np.repeat(first, lens)
    sums = np.add.reduceat(_slots(int(lens.max()))[pos] * (body + _U(1)), first)
    return starts, mix64(sums + lens.astype(_U) * _U(0xD6E8FEB86659FD93))


def _pieces(texts: list[bytes]) -> Iterator[tuple[int, bytes]]:
    """(text number, piece): texts over a block are cut at white space."""
    for i, t in enumerate(texts):
        at = 0
        while len(t) - at > BLOCK_BYTES:
            cut = at + BLOCK_BYTES
            while cut < len(t) and _IS_WORD[t[cut]]:
                cut += 1
            yield i, t[at:cut]
            at = cut
        yield i, t[at:]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, and offsets (one more than texts) by text."""
    counts, out, block, owners, size = np.zeros(len(texts), np.int64), [], [], [], 0

    def flush() -> None:
        starts, h = _block_words(b"\n".join(block))
        begins = np.cumsum([0, *(len(b) + 1 for b in block)])[:-1]
        per = np.diff(np.append(np.searchsorted(starts, begins), len(starts)))
        np.add.at(counts, owners, per)
        out.append(h)

    for i, piece in _pieces(texts):
        if block and size + len(piece) > BLOCK_BYTES:
            flush()
            block, owners, size = [], [], 0
        block.append(piece)
        owners.append(i)
        size += len(piece) + 1
    if block:
        flush()
    return (np.concatenate(out) if out else np.zeros(0, _U)), np.append(0, np.cumsum(counts))


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words (none if there are fewer words)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, _U)
    acc = np.zeros(n, _U)
    for k in range(width):
        acc = mix64(acc * _U(0x9FB21C651E98DF25) + h[k:k + n])
    return acc


def shingle_set(h: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes; with fewer than ``width`` words the whole sequence is
    one shingle, without words the set is empty."""
    return np.unique(window_hashes(h, min(width, len(h)))) if len(h) else h


def utf8(column) -> list[bytes]:
    """An Arrow string column as bytes; null is empty."""
    return [t or b"" for t in column.cast("binary").to_pylist()]


def blocks(texts: list[bytes], limit: int = BLOCK_BYTES) -> Iterator[slice]:
    """Consecutive slices of about ``limit`` bytes, at least one text each."""
    begin = size = 0
    for i, t in enumerate(texts):
        if i > begin and size + len(t) > limit:
            yield slice(begin, i)
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield slice(begin, len(texts))
