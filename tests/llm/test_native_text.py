"""Line dedup and benchmark decontamination: brute force and odd input."""

import re

from pyspark.sql import functions as F

from parallax.llm import decontaminate as D
from parallax.llm import line_dedup as L

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def doc(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], DOCS)


def test_line_dedup_ratio_and_odd_rows(spark):
    rows = [(i, f"menu \n\nown line {i}", "a") for i in range(40)]
    rows += [(100 + i, f"rare\nown {i}", "a") for i in range(4)]
    rows += [(200, None, "a"), (201, "", "a"), (202, "menu\nmenu", "a"), (203, "menu\nx", None), (None, "menu", "b")]
    df = doc(spark, rows)
    for c in ("host", "lines", "line", "row", "page", "_common", "_host", "_before"):
        df = df.withColumn(c, F.lit(c))
    out = L.drop_boilerplate(df, "source")
    assert out.columns == df.columns
    got = {(r.doc_id, r.source): r.text for r in out.collect()}
    assert got[(3, "a")] == "\nown line 3" and got[(101, "a")] == "rare\nown 1"
    assert got[(200, "a")] is None and got[(201, "a")] == "" and got[(202, "a")] == ""
    assert got[(203, None)] == "menu\nx" and got[(None, "b")] == "menu"
    assert all(r.lines == "lines" and r.row == "row" and r.n_chars == 0 for r in out.collect())
    report = {r.doc_id: (r.n_lines, r.n_dropped) for r in L.report(df).collect()}
    assert report[3] == (2, 1) and report[200] == (0, 0) and report[202] == (2, 2)


def test_line_dedup_in_the_pipeline_keeps_groups_of_copies(spark):
    import corpus_pipeline
    rows = [(i, f"menu\nown line {i}", "a") for i in range(40)] + [(100 + i, "copied\ntext", "a") for i in range(20)]
    rows += [(200 + i, "copied\ntext", None) for i in range(9)]
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.lines(spark, doc(spark, rows), "").collect()}
    assert got[3] == ("own line 3", 10)
    assert {got[i] for i in (*range(100, 120), *range(200, 209))} == {("copied\ntext", 0)}


def test_line_dedup_empty(spark):
    assert L.report(spark.createDataFrame([], DOCS)).collect() == []


def words(t):
    return [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]


def shingle(t):
    w = words(t)
    return {" ".join(w[i:i + D.WIDTH]) for i in range(max(len(w) - D.WIDTH + 1, 1))} if w else set()


def test_decontamination_matches_brute_force(spark):
    base = [f"w{i}" for i in range(60)]
    item = " ".join(base[10:40])
    rows = [(1, " ".join(base), "a"), (2, " ".join(base[12:40]), "a"), (3, " ".join(base[:25]), "a"),
            (4, item.upper().replace(" ", ",\n"), "a"), (4, item, "a"), (5, None, "a"), (6, "", "a"), (7, "w1 w2", "a"),
            (None, "so " + item, "a"), (8, " ".join(f"z{i}" for i in range(50_000)) + " " + item, "a"),
            (9, " ".join([*base[10:24], "odd", *base[25:40]]), "a")]
    items = [(1, item), (1, item), (2, "W1, w2"), (3, ""), (4, None), (5, "..."), (6, "q " * 20), (7, "z1 z2 z3 z4 z5 z6 z7")]
    docs = doc(spark, rows).withColumn("key", F.lit(0)).withColumn("found", F.lit(0)).withColumn("item_id", F.lit(5))
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = []
    for i, t, _ in rows:
        for k, x in sorted({k: x for k, x in items}.items()):
            need, have = shingle(x), shingle(t)
            if need and 100 * len(need & have) >= D.PERCENT * len(need):
                want.append((i, k, len(need), len(need & have)))
    got = [tuple(r) for r in D.leaks(docs, bench).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    left = D.drop_contaminated(docs, bench)
    assert left.columns == docs.columns
    bad = {(i, t) for i, t, _ in rows if any(w[0] == i for w in want)}
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(i) for i, t, _ in rows if (i, t) not in bad)


def test_decontamination_empty(spark):
    docs, bench = doc(spark, [(1, "a b c", "s")]), spark.createDataFrame([], "item_id long, text string")
    assert D.leaks(docs, bench).collect() == [] and D.drop_contaminated(docs, bench).count() == 1
    assert D.leaks(docs.limit(0), spark.createDataFrame([(1, "a b c")], "item_id long, text string")).collect() == []
