"""Binary token records: ids against the library on whole texts, order, checksums, reads."""

import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from parallax.llm import token_output as O
from parallax.llm.common import documents
from parallax.session import scratch_path

PATH = P.path("byte_bpe_50k.json")
ODD = ["", " ", "  a", "a  b\n\n c\t d ", " lead", "tail ", "it's I'LL we've\n 'tis", "a\n b", "a \nb", "日本語 テキスト",
       "\U0001F600é x", "<|endoftext|> x", "\x1c a\x1c b", "a  b", "x" * 3000, "a" * 5 + " " * 9 + "b", "  x"]


def library(texts):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("kept", [3, 10_000])
def test_parts_give_the_ids_of_the_text(spark, kept):
    from conftest import SF_SMALL
    texts = ODD + [r.text for r in documents(spark, SF_SMALL).select("text").limit(60).collect()]
    encoder = O.Encoder(PATH, kept)
    got = [np.frombuffer(b, encoder.dtype).tolist() for b in encoder.encode(texts)]
    assert got == library(texts)


def test_odd_space():
    rng = random.Random(1)
    for _ in range(20_000):
        t = "".join(rng.choice("ab \n\t\x1c\x85\xa0\u3000") for _ in range(rng.randrange(8)))
        assert O.has_odd_space(t) == (re.search(r"\s(?: |$)|^ ", t) is not None), repr(t)


def test_frames():
    data = O.frame(b"one") + O.frame(b"") + O.frame(b"x" * 1000)
    first, at = O.unframe(data, 0)
    second, at = O.unframe(data, at)
    third, at = O.unframe(data, at)
    assert (first, second, third, at) == (b"one", b"", b"x" * 1000, len(data))
    for i in (0, 9, 13, 16):
        bad = bytearray(data)
        bad[i] ^= 1
        with pytest.raises(ValueError):
            O.unframe(bytes(bad), 0)


def test_report_matches_the_library(spark):
    from conftest import SF_SMALL
    extra = spark.createDataFrame([(None, "null id"), (-5, None), (-4, "")] + [(-3, t) for t in ODD], "doc_id long, text string")
    docs = documents(spark, SF_SMALL).select("doc_id", "text").unionByName(extra).repartition(5).withColumn("part", F.lit("p"))
    rows = docs.select("doc_id", "text").collect()
    ids = library([r.text or "" for r in rows])
    want = sorted((str(r.doc_id), len(x) + 1, zlib.crc32(np.array([*x, 0], "<u4").tobytes())) for r, x in zip(rows, ids))
    got = O.report(docs, PATH).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == want
    got.sort(key=lambda r: r.start)
    assert [r.doc_id is not None for r in got] == [False] + [True] * (len(got) - 1)
    assert [r.doc_id for r in got[1:]] == sorted(r.doc_id for r in got[1:])
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got]).tolist()[:-1]]


def test_empty_and_damaged(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert O.report(empty, PATH).collect() == []
    folder = scratch_path(spark, "damaged")
    manifest = O.write_records(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), folder, PATH)
    store, base = O._store(folder)
    name = next(f.path for f in store.get_file_info(O.fs.FileSelector(base)) if f.path.endswith(".rec"))
    with store.open_input_file(name) as f:
        data = bytearray(f.read())
    data[14] ^= 255
    with store.open_output_stream(name) as f:
        f.write(bytes(data))
    with pytest.raises(Exception, match="damaged record"):
        O.read_records(spark, folder, manifest).collect()
