"""DuckDB SQL of the operator queries that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLES: dict[str, str] = {}

ORACLES["op7_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h,
         length(coalesce(text, '')) AS n
  FROM documents),
w AS (
  SELECT *, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY h) AS group_size
  FROM d WINDOW best AS (PARTITION BY h ORDER BY n DESC, doc_id))
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM w
"""

ORACLES["op10_quality_rules"] = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
g AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS times
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
r AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM g, (SELECT unnest([0, 1, 2]) AS k)
  WHERE times > 1 GROUP BY doc_id),
m AS (
  SELECT d.doc_id, t, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         coalesce(r.n, 0) AS n_repeat_words
  FROM d LEFT JOIN r USING (doc_id)),
f AS (
  SELECT *, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed
            OR 10 * n_symbols > n_words
            OR 5 * length(regexp_replace(t, '[^!]', '', 'g')) > n_words
            OR 100 * length(regexp_replace(t, '[^\p{{Lu}}]', '', 'g')) > 50 * length(t)
            OR word_chars < 2 * n_words OR word_chars > 20 * n_words
            OR 2 * n_dup_lines > len(lines)) AS kept
FROM f
"""

ORACLES["op8_mixing"] = rf"""
WITH d AS (SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5.0, 2.0, 1.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)]::DOUBLE AS weight
  FROM d GROUP BY source),
c AS (
  SELECT *, 3 * source_size AS cap,
         (CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
          / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS level
  FROM s WINDOW w AS (ORDER BY 3 * source_size / weight, source NULLS LAST)),
l AS (SELECT min(level) AS level FROM (
  SELECT level FROM c WHERE level * weight <= cap ORDER BY cap / weight, level LIMIT 1)),
g AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), l.level * weight) AS target FROM c, l),
p AS (
  SELECT doc_id, size, source_size, target, d.source AS source,
         row_number() OVER (PARTITION BY d.source ORDER BY size, doc_id NULLS LAST) AS k,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
o AS (
  SELECT source, j, (CAST('0x' || substr(md5('17:' || j || ':' || coalesce('=' || source, 'null')), 1, 7) AS BIGINT)
                     + 0.5::DOUBLE) / 268435456.0::DOUBLE AS u
  FROM g, (SELECT unnest(range(16)) AS j)),
x AS (
  SELECT doc_id, size, source_size, target, p.source AS source, j,
         CAST(floor(k * rate + u) - floor((k - 1) * rate + u) AS BIGINT) * size AS taken
  FROM p JOIN o ON p.source IS NOT DISTINCT FROM o.source),
b AS (
  SELECT source, j FROM (SELECT source, j, abs(sum(taken) - any_value(target)) AS gap FROM x GROUP BY source, j)
  QUALIFY row_number() OVER (PARTITION BY source ORDER BY gap, j) = 1)
SELECT doc_id, size, source_size, target, taken
FROM x JOIN b ON x.source IS NOT DISTINCT FROM b.source AND x.j = b.j
"""
