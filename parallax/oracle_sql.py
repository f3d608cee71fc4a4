"""DuckDB SQL that states each registered query independently of the Spark code.

The fragments are common table expressions over the pre-registered views
(``conversations``, ``documents``, ``embeddings``, ``events``...).  ``with_(...)``
joins the fragments a query needs into one WITH clause.
"""

from __future__ import annotations

from parallax.functions.text import NA_TOKENS, SCRIPT_PATTERN_RE2, WORD_PATTERN

TOK = f"'{WORD_PATTERN}'"
NA_LIST = ", ".join("'" + t.replace("'", "''") + "'" for t in NA_TOKENS)


def na(expr: str) -> str:
    return f"CASE WHEN {expr} IN ({NA_LIST}) THEN NULL ELSE {expr} END"


def tok(expr: str) -> str:
    return f"regexp_extract_all({expr}, {TOK}, 0)"


def tok_script(expr: str) -> str:
    return f"regexp_extract_all({expr}, '{SCRIPT_PATTERN_RE2}', 0)"


FRAG: dict[str, str] = {}

FRAG["pa_raw"] = """
pa_raw AS (
  SELECT conv_id, turn, role, text,
         lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role,
         lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next_text
  FROM conversations)"""

FRAG["pairs_a"] = f"""
pairs_a AS (
  SELECT * FROM (
    SELECT 'c:' || CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS pair_id,
           {na('text')} AS src, {na('next_text')} AS tgt
    FROM pa_raw WHERE role = 'user' AND next_role = 'assistant')
  WHERE pair_id IS NOT NULL AND src IS NOT NULL AND tgt IS NOT NULL)"""

FRAG["pb_raw"] = """
pb_raw AS (
  SELECT 'd:' || CAST(doc_id AS VARCHAR) || ':' || CAST(i AS VARCHAR) AS pair_id,
         arr[i + 1] AS line, arr[i + 2] AS next_line
  FROM (SELECT doc_id, arr, unnest(range(len(arr))) AS i
        FROM (SELECT doc_id, string_split(text, chr(10)) AS arr FROM documents WHERE text IS NOT NULL)))"""

FRAG["pairs_b"] = f"""
pairs_b AS (
  SELECT * FROM (SELECT pair_id, {na('line')} AS src, {na('next_line')} AS tgt FROM pb_raw)
  WHERE pair_id IS NOT NULL AND src IS NOT NULL AND tgt IS NOT NULL)"""

FRAG["pairs_union"] = """
pairs_union AS (SELECT pair_id, src, tgt FROM pairs_a UNION ALL SELECT pair_id, src, tgt FROM pairs_b)"""

FRAG["split"] = """
split_rank AS (
  SELECT pair_id, src, tgt,
         row_number() OVER (ORDER BY md5('42:' || pair_id), pair_id) AS rn,
         count(*) OVER () AS n
  FROM pairs_union),
split AS (
  SELECT pair_id, src, tgt, CAST(rn AS BIGINT) AS rn,
         CASE WHEN rn <= floor(CAST(n AS DOUBLE) * 0.6::DOUBLE) THEN 'train'
              WHEN rn <= floor(CAST(n AS DOUBLE) * 0.8::DOUBLE) THEN 'val' ELSE 'test' END AS split
  FROM split_rank)"""

FRAG["side_tokens"] = f"""
side_tokens AS (
  SELECT pair_id, split, 'src' AS side, t.pos - 1 AS pos, t.token
  FROM split, unnest({tok('src')}) WITH ORDINALITY AS t(token, pos)
  UNION ALL
  SELECT pair_id, split, 'tgt' AS side, t.pos - 1 AS pos, t.token
  FROM split, unnest({tok('tgt')}) WITH ORDINALITY AS t(token, pos))"""

FRAG["vocabs"] = """
vocab_counts AS (
  SELECT side, token, count(*) AS freq FROM side_tokens
  WHERE split IN ('train', 'val') GROUP BY side, token),
vocab_src AS (
  SELECT * FROM (VALUES (0::BIGINT, '<unk>', 0::BIGINT), (1::BIGINT, '<pad>', 0::BIGINT)) v(id, token, freq)
  UNION ALL
  SELECT CAST(1 + row_number() OVER (ORDER BY freq DESC, token) AS BIGINT), token, CAST(freq AS BIGINT)
  FROM vocab_counts WHERE side = 'src'),
vocab_tgt AS (
  SELECT * FROM (VALUES (0::BIGINT, '<unk>', 0::BIGINT), (1::BIGINT, '<pad>', 0::BIGINT),
                        (2::BIGINT, '<sos>', 0::BIGINT), (3::BIGINT, '<eos>', 0::BIGINT)) v(id, token, freq)
  UNION ALL
  SELECT CAST(3 + row_number() OVER (ORDER BY freq DESC, token) AS BIGINT), token, CAST(freq AS BIGINT)
  FROM vocab_counts WHERE side = 'tgt'),
vocab_all AS (
  SELECT 'src' AS side, id, token FROM vocab_src UNION ALL SELECT 'tgt' AS side, id, token FROM vocab_tgt)"""

# encoded ids per pair of the split table (C1): lists ordered by position
FRAG["encoded"] = """
enc_long AS (
  SELECT s.pair_id, s.side, s.pos, COALESCE(v.id, 0) AS id
  FROM side_tokens s LEFT JOIN vocab_all v ON s.side = v.side AND s.token = v.token),
encoded AS (
  SELECT p.pair_id, p.split,
         COALESCE((SELECT list(e.id ORDER BY e.pos) FROM enc_long e WHERE e.pair_id = p.pair_id AND e.side = 'src'),
                  []::BIGINT[]) AS src_ids,
         list_concat([2::BIGINT],
                     COALESCE((SELECT list(e.id ORDER BY e.pos) FROM enc_long e WHERE e.pair_id = p.pair_id AND e.side = 'tgt'),
                              []::BIGINT[]),
                     [3::BIGINT]) AS tgt_ids
  FROM split p)"""

DEPS = {
    "pa_raw": [], "pairs_a": ["pa_raw"], "pb_raw": [], "pairs_b": ["pb_raw"],
    "pairs_union": ["pairs_a", "pairs_b"], "split": ["pairs_union"],
    "side_tokens": ["split"], "vocabs": ["side_tokens"], "encoded": ["vocabs"],
}


def with_(*names: str, extra: str = "", recursive: bool = False) -> str:
    """WITH clause holding the named fragments (and their dependencies) plus ``extra``."""
    order: list[str] = []

    def visit(n):
        for d in DEPS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    parts = [FRAG[n].strip() for n in order]
    if extra.strip():
        parts.append(extra.strip())
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n"


def register(name: str, sql: str, deps=()) -> None:
    FRAG[name] = sql
    DEPS[name] = list(deps)
