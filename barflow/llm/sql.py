"""DuckDB SQL that must give the same rows as the queries."""

from __future__ import annotations

from barflow.llm.licenses import CONTAINMENT, TEMPLATES
from barflow.llm.quality import RULES, STOP_WORDS

_WORDS = r"list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
_RULES = " AND ".join(
    f"{rule.measure} {sign} {bound}"
    for rule in RULES
    for sign, bound in ((">=", rule.low), ("<=", rule.high))
    if bound is not None
)

QUALITY_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, {_WORDS} AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
win AS (SELECT r, i, list_slice(words, i, i + 7) AS g
        FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM w)),
again AS (SELECT r, unnest(list(i)) AS i FROM win GROUP BY r, g HAVING count(*) > 1),
covered AS (SELECT r, count(DISTINCT i + j) AS n_repeat_words
            FROM again, (SELECT unnest(range(0, 8)) AS j) GROUP BY r),
m AS (SELECT r, doc_id, len(words) AS n_words,
        length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
        len(list_filter(words, lambda x: lower(x) IN ({_STOP}))) AS n_stop_words FROM w),
a AS (SELECT m.*, coalesce(n_repeat_words, 0) AS n_repeat_words,
        CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word_chars,
        CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbol_ratio,
        CASE WHEN n_words > 0 THEN n_stop_words / n_words ELSE 0 END AS stop_word_ratio,
        CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_ratio
      FROM m LEFT JOIN covered USING (r)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND ({_RULES}) AS kept
FROM b
"""

_NOTICES = ", ".join(
    "('{}', '{}')".format(name, text.replace("'", "''")) for name, texts in TEMPLATES.items() for text in texts
)
_CLEAN = "regexp_split_to_array(trim(regexp_replace(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g')), ' ')"

#: A notice is in a text if a stretch of the words that a window of its class may have holds the share of
#: its shingles. Stretches that hold it and overlap are one match.
LICENSE_SQL = f"""
WITH notices AS (SELECT row_number() OVER () AS t, name, text FROM (VALUES {_NOTICES}) v(name, text)),
tw AS (SELECT t, name, {_CLEAN} AS w FROM notices),
ts AS (SELECT DISTINCT t, name, len(w) AS n, list_slice(w, i, i + 2) AS g
       FROM (SELECT *, unnest(range(1, len(w) - 1)) AS i FROM tw)),
tn AS (SELECT t, count(*) AS m FROM ts GROUP BY t),
d AS (SELECT row_number() OVER () AS r, doc_id, {_CLEAN} AS w FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)),
ds AS (SELECT r, i, list_slice(w, i, i + 2) AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
hit AS (SELECT r, t, name, n, i, g FROM ds JOIN ts USING (g)),
near AS (SELECT a.r, a.t, a.name, a.i AS start, max(b.i) + 3 AS stop, count(DISTINCT b.g) AS k
         FROM hit a JOIN hit b ON a.r = b.r AND a.t = b.t AND b.i >= a.i AND b.i < a.i + a.n
         GROUP BY a.r, a.t, a.name, a.i),
held AS (SELECT DISTINCT r, name, start, stop FROM near JOIN tn USING (t) WHERE k >= {CONTAINMENT} * m),
fresh AS (SELECT *, CASE WHEN start < max(stop) OVER (PARTITION BY r, name ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                    THEN 0 ELSE 1 END AS f FROM held),
per AS (SELECT r, sum(f)::BIGINT AS n_matches, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses FROM fresh GROUP BY r)
SELECT doc_id, coalesce(n_matches, 0) AS n_matches, coalesce(licenses, '') AS licenses FROM d LEFT JOIN per USING (r)
"""

TOP_K_SQL = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e
           FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 100 = 0),
o AS (SELECT *, (row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id))::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM o WHERE rank <= 10
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Every pair that shares a shingle is counted; links are followed to all that can be reached.
NEAR_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array({_LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT r, CASE WHEN len(w) >= 3 THEN list_slice(w, i, i + 2) ELSE w END AS g
      FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY 1),
shared AS (SELECT a.r AS x, b.r AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.r < b.r GROUP BY 1, 2),
links AS (SELECT x, y FROM shared JOIN n a ON a.r = x JOIN n b ON b.r = y WHERE 100 * k >= 85 * (a.n + b.n - k)),
edges AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (SELECT r AS x, r AS y FROM d UNION SELECT reach.x, edges.y FROM reach JOIN edges ON edges.x = reach.y),
least AS (SELECT x AS r, min(d.doc_id) AS component_id FROM reach JOIN d ON d.r = reach.y GROUP BY 1)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM d JOIN least USING (r) LEFT JOIN n USING (r)
"""
