"""Text Column helpers: tokenizers (H1, H2), special markers (H4), detokenize (H5),
missing-value normalization (A3) and the tokenizer registry (I1).

All tokenizers here are native regular-expression Column expressions, so they run
inside whole-stage codegen; a user tokenizer can be registered as an Arrow
``pandas_udf`` returning ``array<string>``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must match the behaviour being reproduced) -------------------------
# Missing-value tokens that a pandas CSV read turns into null (exact match, no trimming).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# Special tokens and their fixed ids.  Source vocabulary: <unk>, <pad>.  Target vocabulary
# adds <sos>, <eos>.
UNK, PAD, SOS, EOS = "<unk>", "<pad>", "<sos>", "<eos>"
UNK_ID, PAD_ID, SOS_ID, EOS_ID = 0, 1, 2, 3
SRC_SPECIALS = [UNK, PAD]
TGT_SPECIALS = [UNK, PAD, SOS, EOS]
# ----------------------------------------------------------------------------------------

# Word runs (letters, marks, digits) or single non-space symbols.  Same pattern is valid
# in Java regex (Spark) and RE2 (DuckDB oracle).
WORD_PATTERN = r"[\p{L}\p{M}\p{N}]+|[^\p{L}\p{M}\p{N}\s]"

# Script-run segmentation for Japanese-like text: Han runs, Hiragana runs, Katakana runs
# (with the prolonged-sound mark), other letter/digit runs, single symbols.  "Other
# letter/digit" = letters, marks, digits outside the three scripts, written without
# class intersection as "not punctuation, symbol, separator, other, or one of the
# scripts" (the seven general categories partition Unicode), so the same pattern runs in
# Java regex (Spark) and, with script names spelled without ``Is``, in RE2 (DuckDB).
SCRIPT_PATTERN = (
    r"\p{IsHan}+|\p{IsHiragana}+|[\p{IsKatakana}ー]+"
    r"|[^\p{P}\p{S}\p{Z}\p{C}\p{IsHan}\p{IsHiragana}\p{IsKatakana}ー]+"
    r"|[^\p{L}\p{M}\p{N}\s]"
)
SCRIPT_PATTERN_RE2 = SCRIPT_PATTERN.replace(r"\p{Is", r"\p{")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokenize(text) -> Column:
    """H2: word/symbol tokenizer, no case folding.  null text -> null."""
    return F.regexp_extract_all(_c(text), F.lit(WORD_PATTERN), 0)


def tokenize_script(text) -> Column:
    """H1: script-run tokenizer (a stand-in for dictionary segmentation)."""
    return F.regexp_extract_all(_c(text), F.lit(SCRIPT_PATTERN), 0)


TOKENIZERS: dict[str, Callable[[Column], Column]] = {
    "words": tokenize,
    "script": tokenize_script,
}


def register_tokenizer(name: str, fn: Callable[[Column], Column]) -> None:
    """Register a Column -> array<string> function (native expression or pandas_udf)."""
    TOKENIZERS[name] = fn


def get_tokenizer(name_or_fn) -> Callable[[Column], Column]:
    """Name, callable, or None (the column already holds token arrays)."""
    if name_or_fn is None:
        return lambda c: c
    if callable(name_or_fn):
        return name_or_fn
    return TOKENIZERS[name_or_fn]


def na_normalize(c) -> Column:
    """A3: null out the CSV missing-value tokens (exact match)."""
    col = _c(c)
    return F.when(~col.isin(NA_TOKENS), col)


def with_markers(tokens) -> Column:
    """H4: <sos> + tokens + <eos>."""
    return F.concat(F.array(F.lit(SOS)), _c(tokens), F.array(F.lit(EOS)))


def detokenize(tokens) -> Column:
    """H5: tokens joined with one space."""
    return F.array_join(_c(tokens), " ")


def ids_text(ids) -> Column:
    """Array of ids as a space-joined string (stable across engines)."""
    return F.array_join(F.transform(_c(ids), lambda x: x.cast("string")), " ")
