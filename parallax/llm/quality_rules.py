"""Quality rules and n-gram perplexity bands.

Rules on whole texts: too few words, or too many words in repeated five-word windows.

Perplexity: a modified Kneser-Ney model (Chen and Goodman 1999: three discounts by count,
continuation counts below the top order, interpolation) over characters, order
``ORDER``.  All characters are told apart: a symbol is a UTF-16 unit (white space is one symbol), so
an n-gram is one 64-bit code.  Spark counts the n-grams of all texts: a task adds up its own counts
and the sums are one partial aggregation.  A model of up to ``KEPT`` n-grams is sent to every task
as sorted arrays.  A larger one stays in tables, made by joins: tasks get its frequent n-grams, and
the others of each distinct text meet the tables by a join.

A document is rejected if its log perplexity for each character is outside its language's
band: the median of the language, and to either side ``SPREAD`` times the median absolute deviation
and ``SHORT`` / sqrt(characters), as the mean of a short text varies more.  Median and
deviation are taken over all documents that pass the rules.

Results for odd input: null text has no words and fails; a null language has a band of its
own; a language without deviation keeps what is within the short-text allowance; repeated
rows are judged alike; other columns are kept (filter) or not read (report).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parallax.llm.common import blocks, utf8, window_hashes, word_hashes, written
from parallax.operators.ordering import sized_broadcast

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
ORDER = 4
KEPT = 1 << 20  # n-grams that are sent to every task
HELD = 1 << 21  # distinct n-grams that a task counts before it hands them on
UNIT = 16  # bits of a symbol
SYMBOLS = 64  # of a small alphabet, with its bits
SPREAD = 1.0
SHORT = 3.5
BITS = 6
SPACE = 1  # of a small alphabet: white space and what precedes a text

_WORD_BYTE = np.ones(256, bool)
_WORD_BYTE[[0x20, 9, 10, 11, 12, 13]] = False
_FIRST_BYTE = np.array([(b & 0xC0) != 0x80 for b in range(256)])
_SYMBOL = np.zeros(256, bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True
RULES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def repeat_words(h: np.ndarray) -> int:
    """Words in windows that occur twice or more."""
    w = window_hashes(h, WINDOW)
    if not len(w):
        return 0
    _, back, count = np.unique(w, return_inverse=True, return_counts=True)
    at = np.flatnonzero(count[back] > 1)
    edge = np.zeros(len(h) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    return int((np.cumsum(edge) > 0).sum())


def dup_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def rule_counts(texts: list[bytes]) -> list[list[int]]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of each text."""
    h, off = word_hashes(texts)
    out = []
    for t, a, b in zip(texts, off[:-1], off[1:]):
        buf = np.frombuffer(t, np.uint8)
        out.append([int(b - a), int((_WORD_BYTE & _FIRST_BYTE)[buf].sum()), int(_SYMBOL[buf].sum()),
                    dup_lines(t), repeat_words(h[a:b])])
    return out


def symbols(texts: list[bytes], alphabet: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Symbol codes of the texts (UTF-16 units with one for white space, or what an alphabet has for
    each character), ORDER - 1 spaces before each, and the offsets of the texts."""
    parts = [" " * (ORDER - 1) + t.decode("utf-8", "replace") for t in texts]
    if alphabet is not None:
        codes = alphabet[np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)]
        return codes.astype(np.int64), np.append(0, np.cumsum([len(p) for p in parts]))
    units = [p.encode("utf-16-le") for p in parts]
    codes = np.frombuffer(b"".join(units), np.uint16).astype(np.int64)
    codes[(codes >= 9) & (codes <= 13)] = 32
    return codes, np.append(0, np.cumsum([len(u) // 2 for u in units]))


def grams(codes: np.ndarray, off: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the n-grams that end in each text's own characters, and their offsets."""
    acc = np.zeros(max(0, len(codes) - ORDER + 1), np.int64)
    for k in range(ORDER):
        acc = (acc << bits) | codes[k:k + len(acc)]
    ends = np.arange(len(acc)) + ORDER - 1
    text = np.searchsorted(off, ends, side="right") - 1
    own = ends - off[text] >= ORDER - 1
    per = np.bincount(text[own], minlength=len(off) - 1)
    return acc[own], np.append(0, np.cumsum(per))


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    code, back = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    n = np.zeros(len(code), np.int64)
    np.add.at(n, back, np.concatenate([k for _, k in parts]))
    return code, n


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts, held = [], 0
    for batch in batches:
        texts = utf8(batch.column(0))
        for part in blocks(texts):
            parts.append(np.unique(grams(*symbols(texts[part]), UNIT)[0], return_counts=True))
            held += len(parts[-1][0])
            if held > 2 * HELD:
                parts = [_summed(parts)]
                held = len(parts[0][0])
                if held > HELD:
                    yield _counted(*parts.pop())
                    held = 0
    if parts:
        yield _counted(*_summed(parts))


def _counted(code: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"code": pa.array(code, pa.int64()), "n": pa.array(n, pa.int64())})


def discounts(counts: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts of 1, 2 and 3 or more (index 0 is unused)."""
    return _discounts([int((counts == k).sum()) for k in (1, 2, 3, 4)])


def _discounts(n: list[int]) -> np.ndarray:
    if min(n) == 0:
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = n[0] / (n[0] + 2 * n[1])
    return np.clip([0.0, 1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]], 0.0, [1, 1, 2, 3])


class KneserNey:
    """Sorted n-gram codes of each order with natural log probabilities, and the log weights
    of what their contexts leave to the next lower order."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, bits: int = BITS, symbols_: int = SYMBOLS):
        self.bits, self.symbols = bits, symbols_
        codes = codes.astype(np.uint64)  # a code may use all 64 bits
        order = np.argsort(codes)
        tables = [(codes[order], counts[order])]
        for k in range(ORDER - 1, 0, -1):  # continuation counts: distinct symbols to the left
            tables.append(np.unique(self._low(tables[-1][0], k), return_counts=True))
        self.levels = []
        for k, (c, n) in zip(range(1, ORDER + 1), reversed(tables)):
            d = discounts(n)[np.minimum(n, 3)]
            ctx = c >> np.uint64(bits)
            first = np.flatnonzero(np.append(True, ctx[1:] != ctx[:-1])[:len(ctx)])
            total = np.add.reduceat(n, first) if len(c) else n
            left = np.add.reduceat(d, first) / total if len(c) else d
            of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(c))))
            low = np.exp(self._log(self._low(c, k - 1), k - 1))
            p = (n - d) / total[of] + left[of] * low if len(c) else n
            self.levels.append((c, np.log(p), ctx[first], np.log(np.maximum(left, 1e-300))))

    def _low(self, codes: np.ndarray, k: int) -> np.ndarray:
        """The last ``k`` symbols of n-gram codes."""
        return codes & np.uint64((1 << (self.bits * k)) - 1)

    def _log(self, codes: np.ndarray, k: int) -> np.ndarray:
        if k == 0:
            return np.full(len(codes), -np.log(self.symbols))
        codes = codes.astype(np.uint64)
        grams_, logs, contexts, weights = self.levels[k - 1]
        if not len(grams_):
            return self._log(self._low(codes, k - 1), k - 1)
        at = np.minimum(np.searchsorted(grams_, codes), len(grams_) - 1)
        hit = grams_[at] == codes
        out = logs[at]
        miss = np.flatnonzero(~hit)
        if len(miss):
            ctx = codes[miss] >> np.uint64(self.bits)
            where = np.minimum(np.searchsorted(contexts, ctx), len(contexts) - 1)
            known = contexts[where] == ctx
            out[miss] = np.where(known, weights[where], 0.0) + self._log(self._low(codes[miss], k - 1), k - 1)
        return out

    def log_prob(self, codes: np.ndarray) -> np.ndarray:
        """Natural log probability of the last symbol of each n-gram code."""
        new, back = np.unique(codes, return_inverse=True)
        return self._log(new, ORDER)[back]


class Frequent:
    """The n-grams of a larger model that tasks hold; the log probability of others is nan."""

    def __init__(self, codes: np.ndarray, logs: np.ndarray):
        order = np.argsort(codes)
        self.codes, self.logs = codes[order], logs[order]

    def log_prob(self, codes: np.ndarray) -> np.ndarray:
        if not len(self.codes):
            return np.full(len(codes), np.nan)
        new, back = np.unique(codes, return_inverse=True)
        at = np.minimum(np.searchsorted(self.codes, new), len(self.codes) - 1)
        return np.where(self.codes[at] == new, self.logs[at], np.nan)[back]


@dataclass
class Model:
    """What tasks hold, the number of symbols and, if that is not the whole model, by order the tables
    (code, n, p) of its n-grams and (ctx, left) of what their contexts leave to the next lower order."""
    held: KneserNey | Frequent
    symbols: int
    levels: list[tuple[DataFrame, DataFrame]] | None = None

    def logs(self, codes: DataFrame) -> DataFrame:
        """(code, log) of distinct codes."""
        log, x = F.lit(-float(np.log(self.symbols))), codes
        for k, (table, contexts) in enumerate(self.levels, 1):
            low = _last("code", k)
            x = (x.withColumn(f"_g{k}", low).join(table.select(F.col("code").alias(f"_g{k}"), F.col("p").alias(f"_p{k}")), f"_g{k}", "left")
                 .withColumn(f"_c{k}", F.shiftrightunsigned(low, UNIT))
                 .join(contexts.select(F.col("ctx").alias(f"_c{k}"), F.col("left").alias(f"_l{k}")), f"_c{k}", "left"))
            left = F.when(F.col(f"_l{k}").isNull(), 0.0).otherwise(F.log(F.greatest(f"_l{k}", F.lit(1e-300))))
            log = F.coalesce(F.log(f"_p{k}"), left + log)
        return x.select("code", log.alias("log"))


def _last(code: str, k: int):
    """The last ``k`` symbols of an n-gram code."""
    return F.col(code) if k == ORDER else F.col(code).bitwiseAND(F.lit((1 << (UNIT * k)) - 1))


def _levels(counts: DataFrame) -> tuple[list[tuple[DataFrame, DataFrame]], int]:
    """The tables of ``KneserNey`` as Spark tables, and the number of symbols."""
    tables = [counts]
    for k in range(ORDER - 1, 0, -1):
        tables.append(written(tables[-1].select(_last("code", k).alias("code")).groupBy("code").agg(F.count("*").alias("n")), "quality-lower"))
    symbols_, levels, n = tables[-1].count() + 1, [], F.col("n")
    for k, t in zip(range(1, ORDER + 1), reversed(tables)):
        times = t.agg(*(F.count_if(n == i) for i in (1, 2, 3, 4))).first()
        _, one, two, more = _discounts([int(x) for x in times]).tolist()
        t = t.withColumn("ctx", F.shiftrightunsigned("code", UNIT))
        contexts = written(t.groupBy("ctx").agg(
            F.sum("n").alias("total"), (one * F.count_if(n == 1) + two * F.count_if(n == 2) + more * F.count_if(n > 2)).alias("left"))
            .withColumn("left", F.col("left") / F.col("total")), "quality-contexts")
        t = t.join(contexts, "ctx").withColumn("_low", _last("code", k - 1))
        t = t.withColumn("_p", F.lit(1.0 / symbols_)) if k == 1 else t.join(
            levels[-1][0].select(F.col("code").alias("_low"), F.col("p").alias("_p")), "_low")
        less = F.when(n == 1, one).when(n == 2, two).otherwise(more)
        p = (n - less) / F.col("total") + F.col("left") * F.col("_p")
        levels.append((written(t.select("code", "n", p.alias("p")), "quality-model"), contexts.select("ctx", "left")))
    return levels, symbols_


def train(texts: DataFrame, text_col: str = "text") -> Model:
    """Model of all texts and all their characters.  What reaches the driver is bounded: ``KEPT``
    n-grams at most."""
    counts = written(texts.select(text_col).mapInArrow(_gram_counts, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")),
                     "quality-grams")
    if counts.count() <= KEPT:
        found = counts.toArrow()
        codes, n = (found.column(c).to_numpy() for c in ("code", "n"))
        symbols_ = len(np.unique(codes & ((1 << UNIT) - 1))) + 1
        return Model(KneserNey(codes, n, UNIT, symbols_), symbols_)
    levels, symbols_ = _levels(counts)
    top, often = levels[-1][0], F.floor(F.log2("n"))
    cut, total = 64, 0
    for step, n in sorted(((r.b, r["count"]) for r in top.groupBy(often.alias("b")).count().collect()), reverse=True):
        total += n
        if total > KEPT:
            break
        cut = step
    found = top.filter(often >= cut).select("code", F.log("p").alias("log")).toArrow()
    return Model(Frequent(found.column("code").to_numpy(), found.column("log").to_numpy()), symbols_, levels)


def _text_key(text: bytes) -> bytes:
    return hashlib.blake2b(text, digest_size=16).digest()


def _others(shared):
    """(_text, code, k): the n-grams of each text that tasks do not hold, and how often it has them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(0))
            for part in blocks(texts):
                g, off = grams(*symbols(texts[part]), UNIT)
                at = np.flatnonzero(np.isnan(shared.value.log_prob(g)))
                code, back = np.unique(g[at], return_inverse=True)
                text = np.searchsorted(off, at, side="right") - 1
                pair, k = np.unique(text * max(len(code), 1) + back, return_counts=True)
                keys = [_text_key(t) for t in texts[part]]
                yield pa.RecordBatch.from_pydict({
                    "_text": pa.array([keys[i] for i in (pair // max(len(code), 1)).tolist()], pa.binary()),
                    "code": pa.array(code[pair % max(len(code), 1)], pa.int64()), "k": pa.array(k, pa.int64())})

    return run


def _measured(shared, keyed: bool):
    types = [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
             ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = utf8(batch.column(batch.num_columns - 1))
            rules, chars, logs = [], [], []
            for part in blocks(texts):
                rules += rule_counts(texts[part])
                codes, begin = symbols(texts[part])
                g, off = grams(codes, begin, UNIT)
                sums = np.append(0.0, np.cumsum(np.nan_to_num(model.log_prob(g)))) if len(g) else np.zeros(1)
                second = np.append(0, np.cumsum((codes >= 0xDC00) & (codes < 0xE000)))  # units of one character
                chars += (np.diff(off) - np.diff(second[begin])).tolist()
                logs += (sums[off[1:]] - sums[off[:-1]]).tolist()
            cols = [pa.array([r[i] for r in rules], t) for i, (_, t) in enumerate(types)]
            names = [*batch.schema.names[:-1], *(n for n, _ in types), "n_chars", "_log"]
            cols = [*batch.columns[:-1], *cols, pa.array(chars, pa.int64()), pa.array(logs, pa.float64())]
            if keyed:
                names, cols = [*names, "_text"], [*cols, pa.array([_text_key(t) for t in texts], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def measure(docs: DataFrame, keys: list[str], text_col: str = "text", model: Model | None = None) -> DataFrame:
    """The columns ``keys`` with the rule counts, n_chars and log_ppl of each text, by ``model``
    or one trained on these texts."""
    model = model or train(docs, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model.held)
    head = docs.select(*keys).schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in head)
    out = docs.select(*keys, text_col).mapInArrow(_measured(shared, model.levels is not None),
                                                  f"{fields}, {RULES}, n_chars long, _log double" + (", _text binary" if model.levels else ""))
    if model.levels:  # copies of a text count once
        others = written(docs.select(text_col).mapInArrow(_others(shared), "_text binary, code long, k long")
                         .groupBy("_text", "code").agg(F.max("k").alias("k")), "quality-others")
        logs = others.join(model.logs(others.select("code").distinct()), "code")
        sums = written(logs.groupBy("_text").agg(F.sum(F.col("k") * F.col("log")).alias("_more")), "quality-sums")
        out = out.join(sums, "_text", "left").withColumn("_log", F.col("_log") + F.coalesce("_more", F.lit(0.0))).drop("_text", "_more")
    ppl = F.when(F.col("n_chars") > 0, -F.col("_log") / F.col("n_chars"))
    return out.withColumn("log_ppl", ppl).drop("_log")


def _failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def bands(measured: DataFrame, lang_col: str = "lang") -> DataFrame:
    """(_lang, _mid, _mad): the band of each language, from ``measured`` (a written table)."""
    good = measured.filter(~_failed()).select(F.coalesce(F.col(lang_col), F.lit("")).alias("_lang"), "log_ppl")
    # written, so that its size is known: beside a broadcast table the second pass adds up each
    # task's part of a language before the shuffle
    middle = written(good.groupBy("_lang").agg(F.percentile_approx("log_ppl", 0.5, 10_000).alias("_mid")), "quality-middle")
    spread = (good.join(sized_broadcast(middle), "_lang").groupBy("_lang")
              .agg(F.first("_mid").alias("_mid"),
                   F.percentile_approx(F.abs(F.col("log_ppl") - F.col("_mid")), 0.5, 10_000).alias("_mad")))
    return written(spread, "quality-bands")


def judged(measured: DataFrame, bands_: DataFrame, lang_col: str = "lang") -> DataFrame:
    """``measured`` with base_failed, the band and kept."""
    m = measured.withColumn("base_failed", _failed()).withColumn("_lang", F.coalesce(F.col(lang_col), F.lit("")))
    allowed = F.lit(SPREAD) * F.col("_mad") + F.lit(SHORT) / F.sqrt(F.col("n_chars"))
    inside = F.abs(F.col("log_ppl") - F.col("_mid")) <= allowed
    return (m.join(sized_broadcast(bands_), "_lang", "left").withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False)))
            .drop("_lang"))


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, the rule counts, base_failed, kept, log_ppl) of each row."""
    slim = docs.select("doc_id", "lang", "text")
    m = written(measure(slim, ["doc_id", "lang"]), "quality")
    return judged(m, bands(m)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                            "base_failed", "kept", "log_ppl")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the report keeps, with their columns.  Texts are measured twice,
    for the bands and for the verdict, so that no copy of them is written between."""
    model = train(docs)
    m = written(measure(docs.select("lang", "text"), ["lang"], model=model), "quality")
    row = docs.select(F.struct("*").alias("row"), F.col("lang").alias("lang"), F.col("text").alias("text"))
    return judged(measure(row, ["row", "lang"], model=model), bands(m)).filter("kept").select("row.*")
