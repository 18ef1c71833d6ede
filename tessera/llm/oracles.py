"""SQL (DuckDB's dialect) for the queries that SQL can express, written without the operators' methods."""

from __future__ import annotations

from tessera.llm import warc

_WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: All pairs that share a shingle, their overlap, and the closure of the links.
JACCARD = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(list_slice(w, i, i + 4), ' ')) END) AS s FROM w),
h AS (SELECT doc_id, md5(s) AS s FROM g),
n AS (SELECT doc_id, count(*) AS n FROM h GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM h x JOIN h y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a, min(b) AS m FROM r GROUP BY a) ON a = d.doc_id
"""

#: Every window of 50 words by a hash that doubles: 1, 2, 4, 8, 16, 32, 48 and 50 words.
SUFFIX = rf"""
WITH t AS (SELECT doc_id, regexp_extract_all(text, '{_WORD}') AS w, regexp_extract_all(text, '[\x20\x09-\x0D]+') AS s, NOT regexp_matches(text, '^[\x20\x09-\x0D]') AS bare FROM documents WHERE text IS NOT NULL),
u AS (SELECT doc_id, len(w) AS size, unnest(generate_series(1, len(w))) AS i, unnest(w) AS w, unnest(CASE WHEN bare THEN list_concat([''], s) ELSE s END[1:len(w)]) AS gap FROM t WHERE len(w) >= 50),
e AS (SELECT doc_id, size, i, length(w) AS n, sum(length(gap) + length(w)) OVER (PARTITION BY doc_id ORDER BY i) AS "end", md5(w) AS h1 FROM u),
h2 AS (SELECT *, md5(h1 || lead(h1, 1) OVER o) AS h2 FROM e WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
h4 AS (SELECT * EXCLUDE (h1), md5(h2 || lead(h2, 2) OVER o) AS h4 FROM h2 WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
h8 AS (SELECT * EXCLUDE (h4), md5(h4 || lead(h4, 4) OVER o) AS h8 FROM h4 WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
h16 AS (SELECT * EXCLUDE (h8), md5(h8 || lead(h8, 8) OVER o) AS h16 FROM h8 WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
h32 AS (SELECT *, md5(h16 || lead(h16, 16) OVER o) AS h32 FROM h16 WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
g AS (SELECT doc_id, size, i, md5(h32 || lead(h16, 32) OVER o || lead(h2, 48) OVER o) AS h FROM h32 WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
m AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS d, count(*) OVER (PARTITION BY h) AS c, min(i) OVER (PARTITION BY h, doc_id) AS f FROM g WHERE i + 49 <= size),
x AS (SELECT doc_id, i, doc_id = d AND i = f AS is_first, CASE WHEN i > f THEN doc_id ELSE d END AS of FROM m WHERE c > 1),
y AS (SELECT *, coalesce(i - lag(i) OVER (PARTITION BY doc_id, is_first ORDER BY i) > 50, true) AS new FROM x),
z AS (SELECT *, sum(CASE WHEN new THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, is_first ORDER BY i ROWS UNBOUNDED PRECEDING) AS island FROM y),
r AS (SELECT doc_id, is_first, min(i) AS lo, max(i) AS hi, min(of) AS first_doc_id FROM z GROUP BY doc_id, is_first, island)
SELECT r.doc_id, CAST(a."end" - a.n AS BIGINT) AS "start", CAST(b."end" AS BIGINT) AS "end", CAST(hi - lo + 50 AS BIGINT) AS words, is_first, first_doc_id
FROM r JOIN e a ON a.doc_id = r.doc_id AND a.i = lo JOIN e b ON b.doc_id = r.doc_id AND b.i = hi + 49
"""

#: The measures by lists, the sketches as counts by bucket on three levels, their quantiles drawn to the wider ones.
QUALITY = rf"""
WITH w AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
v AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM (
    SELECT doc_id, unnest(generate_series(1, len(w) - 7)) AS i, unnest(list_transform(generate_series(1, len(w) - 7), lambda i: md5(array_to_string(list_slice(w, i, i + 7), ' ')))) AS k FROM w WHERE len(w) >= 8)),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + 7)) AS p FROM v WHERE c > 1) GROUP BY doc_id),
m AS (SELECT w.doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
    CAST(len(lines) AS BIGINT) AS n_lines, length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_capitals FROM w LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m),
q AS (SELECT doc_id, lang, source, unnest(['word_length', 'symbols', 'dup_lines', 'repeats', 'capitals']) AS ratio, unnest([750, 900, 990, 990, 950]) AS level, unnest([8, 2, 2, 2, 4]) AS times,
    unnest([word_chars, n_symbols, n_dup_lines, n_repeat_words, n_capitals]) AS a, unnest([n_words, n_words, n_lines, n_words, word_chars]) AS b FROM b WHERE NOT base_failed),
k AS (SELECT *, CASE WHEN a > 0 THEN CAST(ceil(ln(a / b) / ln(1.01::DOUBLE / 0.99::DOUBLE)) AS BIGINT) END AS bucket FROM q),
c AS (SELECT 0 AS depth, lang, source, ratio, level, bucket, count(*) AS n FROM k GROUP BY ALL UNION ALL SELECT 1, lang, '', ratio, level, bucket, count(*) FROM k GROUP BY ALL UNION ALL SELECT 2, '', '', ratio, level, bucket, count(*) FROM k GROUP BY ALL),
u AS (SELECT *, sum(n) OVER (PARTITION BY depth, lang, source, ratio ORDER BY bucket NULLS FIRST) AS upto, sum(n) OVER (PARTITION BY depth, lang, source, ratio) AS total,
    CASE WHEN bucket IS NULL THEN 0.0::DOUBLE ELSE 2 * pow(1.01::DOUBLE / 0.99::DOUBLE, bucket) / (1.01::DOUBLE / 0.99::DOUBLE + 1) END AS value FROM c),
f AS (SELECT depth, lang, source, ratio, max(total)::DOUBLE AS n, min(value) FILTER (1000 * upto >= (1000 - level) * total) AS low, min(value) FILTER (1000 * upto >= 500 * total) AS mid, min(value) FILTER (1000 * upto >= level * total) AS high FROM u GROUP BY ALL),
l AS (SELECT l.lang, l.ratio, (l.n * l.low + 100 * e.low) / (l.n + 100) AS low, (l.n * l.mid + 100 * e.mid) / (l.n + 100) AS mid, (l.n * l.high + 100 * e.high) / (l.n + 100) AS high
    FROM f l JOIN f e ON e.depth = 2 AND e.ratio = l.ratio WHERE l.depth = 1),
o AS (SELECT o.lang, o.source, o.ratio, (o.n * o.low + 100 * l.low) / (o.n + 100) AS low, (o.n * o.mid + 100 * l.mid) / (o.n + 100) AS mid, (o.n * o.high + 100 * l.high) / (o.n + 100) AS high
    FROM f o JOIN l ON l.lang = o.lang AND l.ratio = o.ratio WHERE o.depth = 0),
x AS (SELECT doc_id, bool_or(a > (mid + times * (high - mid)) * b + 1 OR (k.ratio = 'word_length' AND a < (mid + times * (low - mid)) * b - 1)) AS bad FROM k
    JOIN o ON o.lang = k.lang AND o.source = k.source AND o.ratio = k.ratio GROUP BY doc_id)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT coalesce(bad, false) AS kept, n_lines, n_capitals FROM b LEFT JOIN x USING (doc_id)
"""

ORACLE_SQL = {"op2_quality": QUALITY, "op3_suffix_dedup": SUFFIX, "op6_ngram_jaccard": JACCARD, "op9_warc": warc.ORACLE_SQL}
