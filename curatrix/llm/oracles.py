"""DuckDB SQL for the operators' queries that SQL can express."""

from __future__ import annotations

from .quality import COMMON_SHARE, LANGUAGE_SHARE, MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE, MIN_CHARS, MIN_WORDS, N_COMMON, OTHER

WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP1_SQL = f"""
WITH w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
grams AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)),
least AS (SELECT k, min(doc_id) AS least FROM grams GROUP BY k),
hit AS (SELECT DISTINCT doc_id, j FROM (SELECT g.doc_id, unnest(range(i, i + 13)) AS j FROM grams g JOIN least l ON g.k = l.k WHERE least < doc_id)),
words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS j FROM w),
kept AS (SELECT words.doc_id, count(hit.j) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY words.j) FILTER (hit.j IS NULL), '') AS kept FROM words LEFT JOIN hit ON words.doc_id = hit.doc_id AND words.j = hit.j GROUP BY 1)
SELECT w.doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""


def _js(p: list[str], q: list[str]) -> str:
    """Jensen-Shannon distance of two lists of counts."""
    n, m = f"({' + '.join(p)})", f"({' + '.join(q)})"
    term = lambda u, v: f"CASE WHEN {u} > 0 THEN {u} * log2(2 * {u} / ({u} + {v})) ELSE 0.0::DOUBLE END"
    shares = [(f"({a}::DOUBLE / {n})", f"({b}::DOUBLE / {m})") for a, b in zip(p, q, strict=True)]
    total = " + ".join(term(u, v) + " + " + term(v, u) for u, v in shares)
    return f"CASE WHEN {n} > 0 AND {m} > 0 THEN sqrt(greatest(0.0::DOUBLE, ({total}) / 2)) END"


_C, _W = [f"c{i}" for i in range(6)], [f"w{i}" for i in range(N_COMMON + 1)]

OP9_SQL = rf"""
WITH named AS (SELECT lang FROM documents WHERE lang IS NOT NULL GROUP BY lang HAVING count(*) >= {LANGUAGE_SHARE} * (SELECT count(*) FROM documents)),
t AS (SELECT doc_id, coalesce(text, '') AS text, CASE WHEN lang IN (SELECT lang FROM named) THEN lang ELSE '{OTHER}' END AS lk, {WORDS} AS ws FROM documents),
counts AS (SELECT lk, w, count(*) AS n FROM (SELECT lk, unnest(list_distinct(ws)) AS w FROM t) GROUP BY 1, 2),
sizes AS (SELECT lk, count(*) AS total FROM t GROUP BY 1),
ranked AS (SELECT lk, w, row_number() OVER (PARTITION BY lk ORDER BY n DESC, w) AS place FROM counts JOIN sizes USING (lk) WHERE n >= {COMMON_SHARE} * total AND regexp_full_match(w, '\p{{L}}+')),
commons AS (SELECT lk AS ck, list(w ORDER BY place) AS common FROM ranked WHERE place <= {N_COMMON} GROUP BY 1),
grams AS (SELECT doc_id, i, array_to_string(ws[i:i + 2], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM t WHERE len(ws) >= 3)),
twice AS (SELECT doc_id, k FROM grams GROUP BY 1, 2 HAVING count(*) > 1),
rep AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT g.doc_id, unnest(range(i, i + 3)) AS j FROM grams g JOIN twice USING (doc_id, k)) GROUP BY 1),
lines AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM t),
f AS (SELECT t.doc_id, lk, ws, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
  length(regexp_replace(text, '\P{{L}}+', '', 'g')) AS letters, length(regexp_replace(text, '\P{{Lu}}+', '', 'g')) AS capitals, length(regexp_replace(text, '[^0-9]+', '', 'g')) AS digits, length(text) AS chars, coalesce(common, []) AS common
  FROM t JOIN lines ON t.doc_id = lines.doc_id LEFT JOIN rep ON t.doc_id = rep.doc_id LEFT JOIN commons ON ck = lk),
h AS (SELECT *, letters - capitals AS c0, capitals AS c1, digits AS c2, n_symbols AS c3, word_chars - letters - digits - n_symbols AS c4, chars - word_chars AS c5,
  {', '.join(f"len(list_filter(ws, lambda x: x = common[{i + 1}])) AS w{i}" for i in range(N_COMMON))}, len(list_filter(ws, lambda x: NOT list_contains(common, x))) AS w{N_COMMON} FROM f),
r AS (SELECT lk AS rk, {', '.join(f"sum({c}) AS r{c}" for c in [*_C, *_W])} FROM h WHERE NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) GROUP BY 1),
j AS (SELECT h.*, {_js(_C, [f"r{c}" for c in _C])} AS cd, {_js(_W, [f"r{c}" for c in _W])} AS wd, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM h LEFT JOIN r ON lk = rk)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (n_words >= {MIN_WORDS} AND word_chars >= {MIN_CHARS} AND (coalesce(cd > {MAX_CHAR_DISTANCE}, false) OR coalesce(wd > {MAX_WORD_DISTANCE}, false))) AS kept,
  round(cd, 4) AS char_distance, round(wd, 4) AS word_distance FROM j
"""
