"""The corpus queries that SQL can express, as DuckDB SQL over the same tables.

The others hash texts by functions that SQL does not have, learn from labels, or read markup; tests
compare those with brute force.
"""

from __future__ import annotations

_LEVELS = {"own": "lang, source", "lang": "lang, NULL", "whole": "NULL, NULL"}
_MARGIN = {"symbol": 52, "upper": 154, "dup_line": 512, "length": 64}


def _level(name: str, columns: str) -> str:
    lang, source = columns.split(", ")
    return f"SELECT '{name}' AS level, {lang} AS lang, {source} AS source, measure, bin FROM sketched"


_HIGH = ", ".join(
    f"max(CASE WHEN measure = '{m}' THEN mid + greatest({margin}, 6 * (mid - low)) END) AS {m}_hi" for m, margin in _MARGIN.items()
)
_CUTOFFS = [f"{m}_hi" for m in _MARGIN] + ["length_lo"]
_CHOSEN = ", ".join(
    f"(g.total * g.{c} + 100 * {f'((l.total * l.{c} + 100 * a.{c}) // (l.total + 100))' if c in ('symbol_hi', 'dup_line_hi') else f'l.{c}'})"
    f" // (g.total + 100) AS {c}"
    for c in _CUTOFFS
)

QUALITY = rf"""
WITH split AS (
  SELECT row_number() OVER () AS row, doc_id, lang, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT row, i, words[i] || chr(0) || words[i + 1] || chr(0) || words[i + 2] AS win
  FROM (SELECT row, words, unnest(range(1, len(words) - 1)) AS i FROM split WHERE len(words) >= 4)
), repeated AS (
  SELECT row, count(DISTINCT i + k) AS n_repeat_words
  FROM (SELECT row, i, count(*) OVER (PARTITION BY row, win) AS n FROM windows) CROSS JOIN range(3) AS steps(k)
  WHERE n > 1 GROUP BY row
), measured AS (
  SELECT row, doc_id, lang, source, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
         length(regexp_replace(text, '[^A-Z]+', '', 'g')) AS n_upper, len(lines) AS n_lines,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM split LEFT JOIN repeated USING (row)
), binned AS (
  SELECT *, coalesce(n_symbols * 1024 // nullif(word_chars, 0), 0) AS symbol,
         coalesce(n_upper * 1024 // nullif(word_chars, 0), 0) AS upper_,
         coalesce(n_dup_lines * 1024 // nullif(n_lines, 0), 0) AS dup_line,
         least(coalesce(word_chars * 16 // nullif(n_words, 0), 0), 1024) AS length_
  FROM measured
), sketched AS (
  SELECT lang, source, unnest(['symbol', 'upper', 'dup_line', 'length']) AS measure,
         unnest([symbol, upper_, dup_line, length_]) AS bin
  FROM binned WHERE n_words >= 50
), merged AS ({" UNION ALL ".join(_level(name, columns) for name, columns in _LEVELS.items())}),
ranked AS (
  SELECT *, count(*) OVER (PARTITION BY level, lang, source, measure ORDER BY bin) AS upto,
         count(*) OVER (PARTITION BY level, lang, source, measure) AS total FROM merged
), quantiles AS (
  SELECT level, lang, source, measure, max(total) AS total, min(bin) FILTER (upto * 10 >= total) AS low,
         min(bin) FILTER (upto * 2 >= total) AS mid
  FROM ranked GROUP BY level, lang, source, measure
), cutoffs AS (
  SELECT level, lang, source, max(total) AS total, {_HIGH},
         max(CASE WHEN measure = 'length' THEN greatest(mid - greatest(64, 6 * (mid - low)), 0) END) AS length_lo
  FROM quantiles GROUP BY level, lang, source
), chosen AS (
  SELECT g.lang, g.source, {_CHOSEN}
  FROM (SELECT * FROM cutoffs WHERE level = 'own') g
  JOIN (SELECT * FROM cutoffs WHERE level = 'lang') l ON g.lang IS NOT DISTINCT FROM l.lang
  CROSS JOIN (SELECT * FROM cutoffs WHERE level = 'whole') a
), failed AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM binned
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND coalesce(symbol <= symbol_hi AND upper_ <= upper_hi AND dup_line <= dup_line_hi
                                    AND length_ BETWEEN length_lo AND length_hi, false) AS kept
FROM failed f LEFT JOIN chosen c ON f.lang IS NOT DISTINCT FROM c.lang AND f.source IS NOT DISTINCT FROM c.source"""

VECTORS = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS row, vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
), usable AS (
  SELECT * FROM v WHERE label IS NOT NULL AND len(list_filter(x, lambda e: e IS NULL OR NOT isfinite(e))) = 0
    AND len(list_filter(x, lambda e: e <> 0)) > 0
), link AS (
  SELECT a.row AS a, b.row AS b, b.vec_id FROM usable a JOIN usable b ON a.label = b.label AND a.row <> b.row AND len(a.x) = len(b.x)
  WHERE list_dot_product(a.x, b.x) / (sqrt(list_dot_product(a.x, a.x)) * sqrt(list_dot_product(b.x, b.x))) >= 0.98
), reach AS (
  SELECT row AS a, row AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
), component AS (SELECT a, min(vec_id) AS component_id FROM reach JOIN v ON v.row = reach.b GROUP BY a),
counted AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN component ON component.a = v.row LEFT JOIN counted ON counted.a = v.row"""

_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

RANKED = f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS terms FROM documents
), i AS MATERIALIZED (
  SELECT row_number() OVER () AS item, item_id, list_distinct({_TERMS}) AS terms FROM benchmark
), wanted AS (SELECT item, item_id, unnest(terms) AS term FROM i),
sizes AS (SELECT row, doc_id, len(terms) AS n FROM d WHERE len(terms) > 0),
corpus AS (SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS length FROM sizes),
counts AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM d) GROUP BY row, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * documents + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counts CROSS JOIN corpus GROUP BY term, documents
), scored AS (
  SELECT item, item_id, doc_id, row,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * documents) // length)))) AS BIGINT) AS score
  FROM wanted JOIN counts USING (term) JOIN weights USING (term) JOIN sizes USING (row) CROSS JOIN corpus
  GROUP BY item, item_id, doc_id, row
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10"""

_WHOLE = """
  SELECT row_number() OVER () AS row, vec_id, {label} AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""
_MOVED = "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"
_SCORE = "CAST(list_dot_product({a}.v, {b}.v) AS BIGINT)"

NEGATIVES = f"""
WITH e AS MATERIALIZED ({_WHOLE.format(label=_MOVED)} AND label IS NOT NULL),
p AS (
  SELECT a.vec_id AS anchor_id, a.row AS anchor, a.label, a.v, b.vec_id AS positive_id, {_SCORE.format(a="a", b="b")} AS positive_score,
         row_number() OVER (PARTITION BY a.row ORDER BY {_SCORE.format(a="a", b="b")} DESC, b.vec_id) AS nth
  FROM e a JOIN e b ON a.label = b.label AND a.row <> b.row AND len(a.v) = len(b.v)
  WHERE a.vec_id % 100 = 0 QUALIFY nth <= 5
), n AS (
  SELECT anchor_id, anchor, nth, positive_id, positive_score, e.vec_id AS negative_id, {_SCORE.format(a="p", b="e")} AS negative_score
  FROM p JOIN e ON p.label <> e.label AND len(p.v) = len(e.v)
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor, nth ORDER BY negative_score DESC, negative_id) AS INTEGER) AS rank,
       negative_id, positive_score, negative_score
FROM n WHERE 80 * positive_score <= 100 * negative_score AND 100 * negative_score <= 100 * positive_score QUALIFY rank <= 5"""

NEAREST = f"""
WITH e AS MATERIALIZED ({_WHOLE.format(label="0")})
SELECT q.vec_id AS query_id,
       CAST(row_number() OVER (PARTITION BY q.row ORDER BY {_SCORE.format(a="q", b="c")} DESC, c.vec_id) AS INTEGER) AS rank,
       c.vec_id, {_SCORE.format(a="q", b="c")} AS score
FROM e q JOIN e c ON q.row <> c.row AND len(q.v) = len(c.v)
WHERE q.vec_id % 50 = 0 QUALIFY rank <= 5"""

SQL: dict[str, str] = {
    "op7_quality_rules": QUALITY,
    "op10_embedding_dedup": VECTORS,
    "op11_ranked_search": RANKED,
    "op12_hard_negatives": NEGATIVES,
    "op13_exact_top_k": NEAREST,
}
