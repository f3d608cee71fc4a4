"""Token-ID output as length-delimited binary records.

A record file holds frames: length of the payload (8 bytes), masked CRC-32 of those bytes
(4), payload, masked CRC-32 of the payload (4), all little-endian.  The mask rotates the
checksum by 15 bits and adds a constant, so that data holding its own checksum is told
apart.  A payload is a flag for a null id (1 byte), the document id (8), the width of an id
(1; 2 or 4 bytes) and the ids.  Beside each ``part-N.rec`` lies ``part-N.idx``: for each
record its byte offset and the ids before it in the file (8 bytes each), then the file's
totals.  With it, readers take records in any order or range.

Writing sorts by document id over range partitions: part numbers, and records in a part,
ascend.  A part is written under a name of its own and then renamed, so a lost or repeated
task leaves whole files.  Files go to any store that Arrow's file systems reach, in a folder
shared by all executors.

Encoding uses the tokenizers library.  Byte-level BPE never joins a character to a
following space, so a text's ids are those of its parts cut before each space that follows a
character other than white space; the parts (mostly words) are encoded once and kept, up to
``KEPT`` of them in each worker.  Parts after a space are encoded ``JOINED`` at a time, as
one text; each begins at an id whose bytes begin with that space.

Results for odd input: null text is empty and gives the end id only; null ids come first;
rows that repeat an id stay in an order set by their text; special tokens in a text are
ordinary text; a damaged file raises an error; other columns are not read.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parallax.llm.common import written
from parallax.session import scratch_path

KEPT = 600_000
CHUNK = 2_000
JOINED = 50
_MASK = 0xA282EAD8
_CUT = re.compile(r"(?<=\S)(?= )")
_AFTER_SPACE = re.compile(r" (?<=\s )")


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + _MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return b"".join((head, struct.pack("<I", masked(head)), payload, struct.pack("<I", masked(payload))))


def unframe(data: bytes, at: int) -> tuple[bytes, int]:
    """The payload of the frame at an offset, and the offset after it."""
    head = data[at:at + 8]
    if len(head) < 8 or struct.unpack_from("<I", data, at + 8)[0] != masked(head):
        raise ValueError(f"damaged length at byte {at}")
    end = at + 12 + struct.unpack("<Q", head)[0]
    payload = data[at + 12:end]
    if struct.unpack_from("<I", data, end)[0] != masked(payload):
        raise ValueError(f"damaged record at byte {at}")
    return payload, end + 4


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def has_odd_space(text: str) -> bool:
    """A space first or after other white space, or white space last."""
    return text[:1] == " " or text[-1:].isspace() or _AFTER_SPACE.search(text) is not None


class Encoder:
    """Ids of texts as little-endian bytes of ``width`` bytes each."""

    def __init__(self, path: str, kept: int = KEPT):
        self.tokenizer = _tokenizer(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        vocabulary = self.tokenizer.get_vocab()
        self.begins = np.zeros(max(vocabulary.values()) + 1, bool)  # byte-level vocabularies write a space as U+0120
        self.begins[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True
        self.kept = kept
        self.first: dict[str, bytes] = {}   # parts as they stand
        self.spaced: dict[str, bytes] = {}  # parts after a space that is not written here

    def _missing(self, parts: set[str], cache: dict[str, bytes]) -> list[str]:
        todo = [p for p in parts if p not in cache]
        if len(cache) + len(todo) > self.kept:
            cache.clear()
            todo = list(parts)
        return todo

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_first(self, parts: set[str]) -> None:
        todo = self._missing(parts, self.first)
        self.first.update(zip(todo, (i.tobytes() for i in self._ids(todo))))

    def _learn_spaced(self, parts: set[str]) -> None:
        todo = self._missing(parts, self.spaced)
        groups = [todo[i:i + JOINED] for i in range(0, len(todo), JOINED)]
        size = self.dtype.itemsize
        for group, ids in zip(groups, self._ids([" " + " ".join(g) for g in groups])):
            data, at = ids.tobytes(), (size * np.flatnonzero(self.begins[ids])).tolist()
            self.spaced.update(zip(group, (data[a:b] for a, b in zip(at, [*at[1:], len(data)])), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        plain, split = [], []
        for t in texts:
            odd = has_odd_space(t)
            plain.append(not odd)
            split.append(_CUT.split(t) if odd else t.split(" "))
        first = {s[0] for s in split if s[0]}
        spaced: set[str] = set()
        for s, p in zip(split, plain):
            (spaced if p else first).update(s[1:])
        self._learn_first(first)
        self._learn_spaced(spaced)
        self.first[""] = b""
        out = []
        for s, p in zip(split, plain):
            if p:
                get = self.spaced.__getitem__
                out.append(self.first[s[0]] + b"".join(map(get, s[1:])))
            else:
                out.append(b"".join(map(self.first.__getitem__, s)))
        return out


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    """One encoder for all tasks of a Python worker, with the parts it keeps."""
    return Encoder(path)


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _writer(folder: str, path: str, end_id: int):
    schema = pa.schema([("part", pa.int64()), ("n_records", pa.int64()), ("n_tokens", pa.int64()), ("n_bytes", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        encoder = _encoder(path)
        width, end = encoder.dtype.itemsize, np.array([end_id], encoder.dtype).tobytes()
        out, part, at, tokens, index = None, None, 0, 0, []
        own = f"{base}/.{uuid.uuid4().hex}"
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                rows = batch.slice(i, 256)
                if out is None:
                    part = rows.column(0)[0].as_py()
                    out = store.open_output_stream(own + ".rec", compression=None)
                ids = rows.column(1).to_pylist()
                for doc, data in zip(ids, encoder.encode([t or "" for t in rows.column(2).to_pylist()])):
                    index.append((at, tokens))
                    record = frame(struct.pack("<?qB", doc is None, doc or 0, width) + data + end)
                    out.write(record)
                    at += len(record)
                    tokens += len(data) // width + 1
        if out is None:
            return
        out.close()
        index.append((at, tokens))
        with store.open_output_stream(own + ".idx", compression=None) as f:
            f.write(np.array(index, "<u8").tobytes())
        name = f"{base}/part-{part:06d}"
        store.move(own + ".idx", name + ".idx")
        store.move(own + ".rec", name + ".rec")
        yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in (part, len(index) - 1, tokens, at)], schema=schema)

    return run


def write_records(docs: DataFrame, folder: str, path: str, end_id: int = 0) -> DataFrame:
    """Writes the records of (doc_id, text) and returns the manifest (part, n_records,
    n_tokens, n_bytes, start); start counts the ids in all parts before."""
    store, base = _store(folder)
    store.create_dir(base)
    keys = [F.col("doc_id"), F.xxhash64("text")]
    ordered = (docs.select("doc_id", "text").repartitionByRange(*keys).sortWithinPartitions(*keys)
               .select(F.spark_partition_id().cast("long").alias("part"), "doc_id", "text"))
    made = written(ordered.mapInArrow(_writer(folder, path, end_id), "part long, n_records long, n_tokens long, n_bytes long"),
                   "record-parts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    return made.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")))


def _reader(folder: str):
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary()), ("width", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        for batch in batches:
            for r in batch.to_pylist():
                name = f"{base}/part-{r['part']:06d}"
                with store.open_input_file(name + ".idx") as f:
                    n = min(CHUNK, r["n_records"] - r["first"])
                    index = np.frombuffer(f.read_at((n + 1) * 16, r["first"] * 16), "<u8").reshape(-1, 2)
                with store.open_input_file(name + ".rec") as f:
                    data = f.read_at(int(index[-1, 0] - index[0, 0]), int(index[0, 0]))
                docs, ids, widths = [], [], []
                for at in (index[:-1, 0] - index[0, 0]).tolist():
                    payload, _ = unframe(data, at)
                    null, doc, width = struct.unpack_from("<?qB", payload)
                    docs.append(None if null else doc)
                    widths.append(width)
                    ids.append(payload[10:])
                starts = index[:-1, 1].astype(np.int64) + r["start"]
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(starts), pa.array(ids, pa.binary()),
                                                  pa.array(widths, pa.int64())], schema=schema)

    return run


def read_records(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, ids, width) of all records, in ranges of ``CHUNK`` dealt to all tasks
    at random; ids are little-endian bytes of the given width."""
    ranges = (manifest.withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_records") - 1, F.lit(CHUNK).cast("long"))))
              .select("part", "n_records", "start", "first"))
    return ranges.repartition("part", "first").mapInArrow(_reader(folder), "doc_id long, start long, ids binary, width long")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, crc = [], []
        for ids, width in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            n.append(len(ids) // width)
            crc.append(zlib.crc32(np.frombuffer(ids, f"<u{width}").astype("<u4").tobytes()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(crc, pa.int64())],
                                         names=["doc_id", "start", "n_tokens", "ids_crc32"])


def report(docs: DataFrame, path: str, end_id: int = 0) -> DataFrame:
    """Writes the records to a new folder under the shared one and returns (doc_id, start,
    n_tokens, ids_crc32) as read back."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "records")
    manifest = write_records(docs, folder, path, end_id)
    return read_records(spark, folder, manifest).mapInArrow(_digests, "doc_id long, start long, n_tokens long, ids_crc32 long")
