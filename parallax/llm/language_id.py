"""Language ID by hierarchical discrimination: linear support vector machines predict the
family first (one against the rest), then one-versus-one machines separate the languages
of that family, by wins and then by margin.

Features are hashed character n-grams (1 to 3) of the whole lower-cased text, letters only,
as square roots of their frequencies with unit length.  The machines (squared hinge loss,
L2 penalty, accelerated gradient descent) are fitted on at most about ``TRAIN_ROWS`` rows,
an equal share of each language, drawn by a hash; counting languages and predicting cover
all rows.  A language that ``FAMILY`` does not name is a family of its own.

Results for odd input: null text or text without a letter is ``und`` with score 0; rows with
a null language or null id are not learned from; without any row to learn from every
prediction is ``und``; with one language it is predicted with score 1; repeated rows are
predicted alike; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parallax.llm.common import crc_remainder, written
from parallax.operators.ordering import sized_broadcast

TRAIN_ROWS = 6000
BITS = 12
ORDERS = 3
PENALTY = 1e-4
STEPS = 150
UNKNOWN = "und"
CHARS = 1 << 20

# Families of languages by ISO 639-1 code.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "iranian": "fa ku ps tg",
    "indo-aryan": "bn gu hi mr ne pa si ur",
    "dravidian": "kn ml ta te",
    "uralic": "et fi hu",
    "turkic": "az kk ky tk tr uz",
    "semitic": "am ar he mt",
    "austronesian": "id jv mg ms tl",
}
FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes.split()}


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point to its lower-case letter, 0 if it is none."""
    table = np.zeros(0x110000, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def gram_counts(text: str) -> np.ndarray | None:
    """Hashed n-gram counts; None without a letter.  Long texts are worked in parts that
    overlap by ORDERS - 1 characters, so every n-gram counts once."""
    total = np.zeros(1 << BITS)
    some = False
    for at in range(0, len(text), CHARS):
        begin = max(0, at - ORDERS + 1)
        c = _letters()[np.frombuffer(text[begin:at + CHARS].encode("utf-32-le", "replace"), np.uint32)]
        some = some or bool(c[at - begin:].any())
        acc = np.zeros(len(c), np.uint32)
        for k in range(ORDERS):
            acc = (acc[:len(c) - k] * np.uint32(0x9E3779B1)) + c[k:]
            own = acc[max(0, at - begin - k):] + np.uint32(k)
            total += np.bincount((own * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS), minlength=1 << BITS)
    return total if some else None


def features(text: str | None) -> np.ndarray | None:
    n = gram_counts(text) if text else None
    if n is None:
        return None
    x = np.sqrt(n)
    return (x / np.sqrt((x * x).sum())).astype(np.float32)


def linear_svm(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights (last: bias) that separate y = 1 from y = -1; classes weigh alike."""
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w = np.zeros(x.shape[1] + 1, np.float32)
    ahead, t = w, 1.0
    rate = 0.25
    for _ in range(STEPS):
        gap = np.maximum(0, 1 - y * (x @ ahead[:-1] + ahead[-1]))
        g = -2 * weight * y * gap
        grad = np.append(x.T @ g, g.sum()) + 2 * PENALTY * ahead
        new = (ahead - rate * grad).astype(np.float32)
        t, last = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead = new + np.float32((last - 1) / t) * (new - w)
        w = new
    return w


class Hierarchy:
    def __init__(self, x: np.ndarray, lang: np.ndarray):
        self.languages = sorted(set(lang.tolist()))
        self.family = {c: FAMILY.get(c, c) for c in self.languages}
        self.families = sorted(set(self.family.values()))
        of = np.array([self.family[c] for c in lang])
        columns = []
        if len(self.families) > 1:
            columns += [linear_svm(x, np.where(of == f, 1, -1).astype(np.float32)) for f in self.families]
        self.pairs = []
        for f in self.families:
            for a, b in combinations([c for c in self.languages if self.family[c] == f], 2):
                rows = (lang == a) | (lang == b)
                self.pairs.append((a, b))
                columns.append(linear_svm(x[rows], np.where(lang[rows] == a, 1, -1).astype(np.float32)))
        self.weights = np.stack(columns, axis=1) if columns else np.zeros((x.shape[1] + 1, 0), np.float32)

    def predict(self, x: np.ndarray) -> list[tuple[str, float]]:
        margins = x @ self.weights[:-1] + self.weights[-1]
        out = []
        n = len(self.families) if len(self.families) > 1 else 0
        for m in margins.astype(float):
            family, score = self.families[0], 1.0
            if n:
                order = np.argsort(-m[:n], kind="stable")
                family = self.families[order[0]]
                score = 1 / (1 + np.exp(-2 * (m[order[0]] - m[order[1]])))
            members = [c for c in self.languages if self.family[c] == family]
            wins = {c: [0, 0.0] for c in members}
            for (a, b), v in zip(self.pairs, m[n:]):
                if a in wins:
                    wins[a][1] += v
                    wins[b][1] -= v
                    wins[a if v >= 0 else b][0] += 1
            best = max(members, key=lambda c: (wins[c][0], wins[c][1]))
            if len(members) > 1:
                score *= 1 / (1 + np.exp(-2 * wins[best][1] / (len(members) - 1)))
            out.append((best, float(min(1.0, max(0.0, score)))))
        return out


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x = features(text)
            if x is not None:
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang]),
                                                  "x": pa.array([x.astype(np.float16).tobytes()], pa.binary())})


def train(rows: DataFrame, rows_limit: int = TRAIN_ROWS) -> Hierarchy | None:
    """Fits on a share of ``rows`` (id, lang, text) drawn by hash: about ``rows_limit``
    rows, divided among the languages."""
    # one row for each language, written so that its size is known: rows are drawn where they are
    counts = written(rows.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    shares = counts.select(F.col("lang").alias("_l"), (F.lit(rows_limit) / max(counts.count(), 1) / F.col("n")).alias("share"))
    draw = F.pmod(F.xxhash64("id", F.lit("draw")), F.lit(1 << 30)) / (1 << 30)
    sample = (rows.join(sized_broadcast(shares), F.col("lang") == F.col("_l"))
              .filter(draw < F.col("share")).select("lang", "text")
              .mapInArrow(_vectors, "lang string, x binary").toArrow())
    if not sample.num_rows:
        return None
    lang = np.array(sample.column("lang").to_pylist())
    raw = sample.column("x").to_pylist()
    order = np.array(sorted(range(len(raw)), key=lambda i: (lang[i], raw[i])))  # alike whatever the partitions
    x = np.stack([np.frombuffer(raw[i], np.float16) for i in order]).astype(np.float32)
    return Hierarchy(x, lang[order])


def _predicted(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * part.num_rows
                xs = [features(t) for t in part.column(part.num_columns - 1).to_pylist()]
                rows = [i for i, x in enumerate(xs) if x is not None]
                if model is not None and rows:
                    for i, p in zip(rows, model.predict(np.stack([xs[i] for i in rows]))):
                        out[i] = p
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array([p for p, _ in out]), pa.array([s for _, s in out], pa.float64())],
                    names=[*part.schema.names[:-1], "lang_pred", "score"])

    return run


def predict(docs: DataFrame, model: Hierarchy | None, keys: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keys`` with lang_pred and score of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    head = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*keys).schema)
    return docs.select(*keys, F.col(text_col).alias("_text")).mapInArrow(
        _predicted(shared), head + "lang_pred string, score double")


def held_out() -> Column:
    return F.coalesce(crc_remainder("doc_id", 4) == 2, F.lit(False))


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score); learns from rows that are not held out."""
    rows = docs.filter(~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull()).select(
        F.col("doc_id").alias("id"), "lang", "text")
    marked = docs.select("doc_id", held_out().alias("held_out"), "text")
    return predict(marked, train(rows), ["doc_id", "held_out"])
