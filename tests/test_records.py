"""Records with quoted line breaks over many splits, against a plain CSV reader."""

import csv
import io
import random

import pytest

from parallax.session import scratch_path
from parallax.sources import files as FS
from parallax.sources import records as R


def put(spark, texts):
    """One file for each text, byte by byte."""
    path = scratch_path(spark, "records")
    jvm = spark._jvm
    for i, t in enumerate(texts):
        p = jvm.org.apache.hadoop.fs.Path(f"{path}/f{i}.csv")
        out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
        out.write(bytearray(t.encode()))
        out.close()
    return path


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.openCostInBytes", "0")

    def size(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    yield size
    for k, v in old.items():
        spark.conf.set(k, v)


def rows_of(rng, n):
    words = ["a", "b,c", 'd"e', "f\ng", "\n\n", '"', "", "é日本", "x" * 30, " y ", '","', "\r\nz", "\tq"]
    return [["".join(rng.choices(words, k=rng.randrange(0, 4))) for _ in range(3)] for _ in range(n)]


@pytest.mark.parametrize("split", [7, 40, 300])
@pytest.mark.parametrize("sep", [",", "\t"])
def test_one_file_by_many_tasks(spark, small_splits, split, sep):
    rng = random.Random(split)
    rows = rows_of(rng, 30 if split < 10 else 120)
    texts = []
    for part in (rows[:25], rows[25:]):
        out = io.StringIO()
        csv.writer(out, delimiter=sep, quoting=csv.QUOTE_ALL, lineterminator="\n").writerows(part)
        texts.append(out.getvalue())
    path = put(spark, texts)
    small_splits(split)
    assert R.lines(spark, path).rdd.getNumPartitions() > 4
    got = R.read_delimited(spark, path, 3, sep=sep, header=False)
    assert sorted(tuple(v or "" for v in r.f) for r in got.collect()) == sorted(map(tuple, rows))
    assert {r["size"] for r in got.collect()} == {3}
    back = FS.read_tsv(spark, path, {0: "x", 2: "z"}, 3) if sep == "\t" else None
    if back is not None:
        assert sorted((r.x or "", r.z or "") for r in back.collect()) == sorted((r[0], r[2]) for r in rows)


@pytest.mark.parametrize("split", [5, 64, 100_000])
def test_equal_to_the_multi_line_reader(spark, small_splits, split):
    """Quotes in unquoted fields, short and blank rows, and files without rows."""
    rng = random.Random(split)
    lines = ["a,b"] + [rng.choice(['x"y,z', '"p\nq",r', "short", '"s ""t"" u",v', 'it"s', ',"w\n\n,x"', 'é,"日\r\n本"', "k,l"]) for _ in range(40 if split < 10 else 150)]
    path = put(spark, ["\n".join(lines) + "\n", "a,b\n1,2\n", "a,b"])
    small_splits(split)
    got = FS.read_csv_badlines(spark, path, ["a", "b"])[0]
    plain = spark.read.schema("a string, b string").csv(path, header=True, multiLine=True, escape='"', quote='"')
    normal = lambda df: sorted(((r.a or "").replace("\r\n", "\n"), (r.b or "").replace("\r\n", "\n")) for r in df.collect())
    assert normal(got) == normal(plain)


def test_quarantine_over_splits(spark, small_splits):
    path = put(spark, ['h1,h2\na,b,c\n"x\ny",z,\nok,"1\n2"\n,,\nlast,"open\nend'])
    for split in (4, 11, 1000):
        small_splits(split)
        kept, gone = FS.read_csv_badlines(spark, path, ["h1", "h2"])
        assert [(r.h1, r.h2) for r in kept.collect()] == [("ok", "1\n2")]
        assert sorted(r.raw for r in gone.collect()) == ['"x\ny",z,', ",,", "a,b,c", 'last,"open\nend']


def test_line_states():
    assert not R.ends_inside('a"b,c', False, ",") and R.ends_inside('a,"b', False, ",")
    assert not R.ends_inside('b",c', True, ",") and R.ends_inside('b""', True, ",") and R.ends_inside('x","y', True, ",")
    assert not R.ends_inside('"a""b",c"d', False, ",") and R.ends_inside("", True, ",") and not R.ends_inside("", False, ",")


def test_empty_folder_and_files(spark):
    path = put(spark, ["", "h\n", "\n\n"])
    assert R.read_delimited(spark, path, 1).collect() == []
