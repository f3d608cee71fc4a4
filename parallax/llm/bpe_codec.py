"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Texts over ``SEGMENT`` characters are cut where a pre-token must end whatever follows:
before white space that follows something else, or between letters and digits.  No match of
the pattern spans such a place and none looks behind it, so the ids of the parts are the
ids of the text.  A run without such a place stays whole.  White space of ``LONG`` characters or more is not
given to the pattern, whose look-ahead needs memory for each character of it: all of the run, or
all but the last character if something follows, is one match by the pattern's rule, and is
encoded by the ranks as one.  Ids decode to raw bytes; a token
may hold part of a character.

Results for odd input: null text is empty and gives no id; special tokens do not exist, so
their strings are ordinary text; repeated rows are encoded alike; ids outside the ranks
raise an error; other columns are kept.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEGMENT = 200_000
LONG = 100_000
_SAFE = regex.compile(r"(?<=\S)(?=\s)|(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})")


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def segments(text: str, limit: int = SEGMENT) -> Iterator[str]:
    """The text in parts of at least ``limit`` characters, cut at safe places only."""
    at = 0
    while len(text) - at > limit:
        cut = _SAFE.search(text, at + limit)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


def _encode_part(enc: tiktoken.Encoding, part: str) -> list[int]:
    """Ids of a part; a long run of white space ends it or stands before a single match."""
    ids, at = [], 0
    for run in regex.finditer(rf"\p{{White_Space}}{{{LONG},}}", part):
        end = run.end() if run.end() == len(part) else run.end() - 1
        ids += enc.encode_ordinary(part[at:run.start()])
        ids += enc._encode_single_piece(part[run.start():end])
        at = end
    return ids + enc.encode_ordinary(part[at:])


def encode_text(enc: tiktoken.Encoding, text: str) -> list[int]:
    """Ids of a text; the pattern is one whose white space is ``\\s+(?!\\S)|\\s+`` behind an
    optional space of other matches, as in ``public_tokenizers.PATTERN``."""
    if len(text) <= LONG:
        return enc.encode_ordinary(text)
    return [i for part in segments(text) for i in _encode_part(enc, part)]


def _encoded(path: str, pattern: str, decode: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [encode_text(enc, t or "") for t in part.column(part.num_columns - 1).to_pylist()]
                off = np.append(0, np.cumsum([len(x) for x in ids])).astype(np.int32)
                flat = np.concatenate([np.array(x, np.int32) for x in ids])
                cols = [pa.ListArray.from_arrays(pa.array(off), pa.array(flat))]
                if decode:
                    cols.append(pa.array([enc.decode_bytes(x) for x in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *cols],
                                                 names=[*part.schema.names[:-1], "ids", "decoded"][:len(part.columns) - 1 + len(cols)])

    return run


def _ddl(df: DataFrame) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema)


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """(row, ids): each row as a struct, and the ids of its text."""
    rows = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("_text"))
    return rows.mapInArrow(_encoded(path, pattern, False), _ddl(rows.select("row")) + "ids array<int>")


def encode_decode(docs: DataFrame, path: str, pattern: str, keys: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keys`` with the ids of the text and the bytes that the ids decode to."""
    rows = docs.select(*keys, F.col(text_col).alias("_text"))
    return rows.mapInArrow(_encoded(path, pattern, True), _ddl(docs.select(*keys)) + "ids array<int>, decoded binary")


def decode(encoded: DataFrame, path: str, pattern: str, keys: list[str], ids_col: str = "ids") -> DataFrame:
    """The columns ``keys`` with the raw bytes of the ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path, pattern)
        for batch in batches:
            raw = [enc.decode_bytes(x or []) for x in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(raw, pa.binary())],
                                             names=[*batch.schema.names[:-1], "decoded"])

    rows = encoded.select(*keys, F.col(ids_col).alias("_ids"))
    return rows.mapInArrow(run, _ddl(encoded.select(*keys)) + "decoded binary")


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each row."""
    out = encode_decode(docs, path, pattern, ["doc_id"])
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))
