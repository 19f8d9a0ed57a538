"""Checking SQL (DuckDB) of the corpus queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op2_decontaminate"] = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS win
  FROM (SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT k FROM windows
), doc_windows AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS win
  FROM (SELECT doc_id, w, k, unnest(range(1, greatest(len(w) - k + 2, 1))) AS i FROM words, sizes)
), met AS (SELECT d.doc_id, d.k, d.i, x.item_id FROM doc_windows d JOIN windows x USING (k, win)
), hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM met) GROUP BY 1
), found AS (
  SELECT doc_id, count(*) AS n, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM met) GROUP BY 1
)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(f.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(f.ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM words w LEFT JOIN hit h USING (doc_id) LEFT JOIN found f USING (doc_id)
"""

ORACLES["op3_quality_rules"] = r"""
WITH base AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), runs AS (
  SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM base)
), again AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 3)) AS p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM runs) WHERE c > 1) GROUP BY 1
), lines AS (
  SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM base) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1
), m AS (
  SELECT b.doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(list_sum(list_transform(w, lambda x: length(x))) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(l.n, 0) AS BIGINT) AS n_lines, CAST(coalesce(l.dup, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(a.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(list_filter(w, lambda x: length(regexp_replace(x, '[^A-Za-z]', '', 'g')) >= 2 AND NOT regexp_matches(x, '[a-z]'))) AS BIGINT) AS n_caps
  FROM base b LEFT JOIN again a USING (doc_id) LEFT JOIN lines l USING (doc_id)
), long AS (
  SELECT doc_id, lang, source, n_words, unnest([
    {'m': 'symbols', 'v': CASE WHEN n_words > 0 THEN 1000 * n_symbols // n_words ELSE 0 END, 's': 40},
    {'m': 'dup_lines', 'v': CASE WHEN n_lines > 0 THEN 1000 * n_dup_lines // n_lines ELSE 0 END, 's': 60},
    {'m': 'repeats', 'v': CASE WHEN n_words > 0 THEN 1000 * n_repeat_words // n_words ELSE 0 END, 's': 60},
    {'m': 'caps', 'v': CASE WHEN n_words > 0 THEN 1000 * n_caps // n_words ELSE 0 END, 's': 40},
    {'m': 'word_size', 'v': CASE WHEN n_words > 0 THEN 1000 * word_chars // n_words ELSE 0 END, 's': 800}], recursive := true)
  FROM m
), bucketed AS (SELECT lang, source, m, s, v - v % CAST(1::BIGINT << greatest(length(bin(v)) - 7, 0) AS BIGINT) AS b FROM long WHERE n_words >= 50
), fine AS (SELECT lang, source, m, count(*) AS n, quantile_disc(b, 0.25) AS q1, quantile_disc(b, 0.75) AS q3, any_value(s) AS s FROM bucketed GROUP BY 1, 2, 3
), by_lang AS (SELECT lang, m, count(*) AS n, quantile_disc(b, 0.25) AS q1, quantile_disc(b, 0.75) AS q3, any_value(s) AS s FROM bucketed GROUP BY 1, 2
), whole AS (SELECT m, quantile_disc(b, 0.25) AS q1, quantile_disc(b, 0.75) AS q3, any_value(s) AS s FROM bucketed GROUP BY 1
), fences AS (
  SELECT f.lang, f.source, f.m, CASE WHEN f.n >= 200 THEN f.q3 + 3 * greatest(f.q3 - f.q1, f.s) WHEN l.n >= 200 THEN l.q3 + 3 * greatest(l.q3 - l.q1, l.s) ELSE g.q3 + 3 * greatest(g.q3 - g.q1, g.s) END AS fence
  FROM fine f JOIN by_lang l ON f.lang IS NOT DISTINCT FROM l.lang AND f.m = l.m JOIN whole g ON f.m = g.m
), beyond AS (
  SELECT x.doc_id, count(*) AS n FROM long x JOIN fences f ON x.lang IS NOT DISTINCT FROM f.lang AND x.source IS NOT DISTINCT FROM f.source AND x.m = f.m AND x.v > f.fence GROUP BY 1
)
SELECT m.doc_id, n_words, coalesce(word_chars, 0) AS word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND b.n IS NULL AS kept
FROM m LEFT JOIN beyond b USING (doc_id)
"""

ORACLES["op1_chat"] = r"""
WITH raw AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), t AS (
  SELECT *, row_number() OVER w AS n, lag(role) OVER w IS DISTINCT FROM role AS head FROM raw WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(CASE WHEN head THEN 6 + length(replace(replace(replace(replace(role, '\', '\\'), '#', '\#'), '</turn>', '<\/turn>'), chr(10), '\' || chr(10))) ELSE 0 END
         + length(replace(replace(replace(text, '\', '\\'), '#', '\#'), '</turn>', '<\/turn>')) + 8) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

ORACLES["op12_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('20250117:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS place FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS z, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w FROM d GROUP BY source
), o AS (
  SELECT *, coalesce(sum(3 * z) OVER b, 0) AS c, coalesce(sum(w) OVER b, 0) AS v, sum(w) OVER () AS all_w, sum(z) OVER () AS t
  FROM s WINDOW b AS (ORDER BY CAST(z AS DOUBLE) / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), clamped AS (SELECT *, w * (t - c) > 3 * z * (all_w - v) AS full_ FROM o
), level AS (SELECT any_value(t) - coalesce(sum(3 * z) FILTER (WHERE full_), 0) AS words, any_value(all_w) - coalesce(sum(w) FILTER (WHERE full_), 0) AS weight FROM clamped
), shared AS (
  SELECT source, z, CASE WHEN full_ THEN CAST(3 * z AS DOUBLE) ELSE CAST(w * words AS DOUBLE) / CAST(weight AS DOUBLE) END AS target FROM clamped, level
), r AS (
  SELECT source, z, target, CASE WHEN z > 0 THEN CAST(floor(target) AS BIGINT) // z ELSE 0 END AS whole, CASE WHEN z > 0 THEN CAST(floor(target) AS BIGINT) % z ELSE 0 END AS rest FROM shared
), placed AS (SELECT d.*, z, target, whole, rest, sum(size) OVER (PARTITION BY d.source ORDER BY place) AS upto FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, z AS source_size, target, CAST(whole * size + greatest(least(rest - (upto - size), size), 0) AS BIGINT) AS taken FROM placed
"""

ORACLES["op11_runs"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
           lambda acc, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, xor(acc, b)), 4294967295), 4294967295) AS h
  FROM documents
), e AS (
  SELECT r, doc_id, w, CAST(len(w) AS BIGINT) AS n, h, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d
), f AS (
  SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(0, n), lambda i: w[1 + CASE WHEN i >= a THEN a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) ELSE i END]) ELSE w END AS w FROM e
), grams AS (
  SELECT r, n, i, w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] AS g FROM (SELECT *, unnest(range(0, n - 2)) AS i FROM f WHERE n >= 6)
), pairs AS (
  SELECT x.r, y.i - x.i AS q, x.i FROM grams x JOIN grams y ON x.r = y.r AND x.g = y.g AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
), islands AS (
  SELECT r, q, min(i) AS s, count(*) + 2 + q AS l FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM pairs) GROUP BY r, q, k
), runs AS (
  SELECT r, s, l, min(q) AS q FROM islands WHERE l >= greatest(6, 4 * q) GROUP BY r, s, l
), digest AS (
  SELECT r, count(*) AS n_runs, max({'l': l, 's': -s, 'q': -q}) AS top, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM runs GROUP BY r
), gone AS (SELECT DISTINCT r, unnest(range(s + q, s + l)) AS i FROM runs
), kept AS (
  SELECT p.r, string_agg(word, ' ' ORDER BY p.i) AS t FROM (SELECT r, unnest(w) AS word, unnest(range(0, n)) AS i FROM f) p ANTI JOIN gone ON p.r = gone.r AND p.i = gone.i GROUP BY p.r
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(-top.s AS BIGINT) AS start, CAST(top.l AS BIGINT) AS length, CAST(-top.q AS BIGINT) AS period,
       CAST((1000 * top.l) // -top.q AS BIGINT) AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM f LEFT JOIN digest USING (r) LEFT JOIN kept USING (r)
"""
