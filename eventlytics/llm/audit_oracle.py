"""DuckDB SQL of the filter audit, from its definition: every order applied
from the left to every document."""

SQL = r"""
WITH RECURSIVE
d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic
      FROM labels GROUP BY doc_id),
fails AS (
  SELECT d.doc_id, part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         map {'A': len(w) < 100,
              'B': 100 * len(list_distinct(w)) < 80 * len(w),
              'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text),
              'D': regexp_matches(text, '[#$%&*|]'),
              'E': coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY text), false)} AS f
  FROM d LEFT JOIN l ON l.doc_id = d.doc_id),
orders(o) AS (
  SELECT '' UNION ALL
  SELECT o || f FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f) WHERE NOT contains(o, f)),
masks AS (SELECT part, f, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
          FROM fails GROUP BY part, f),
steps AS (
  SELECT part, o, k, o[k] AS f, n, good, toxic, f[o[k]] AS hit,
         len(list_filter(range(1, k), lambda j: f[o[j]])) > 0 AS gone,
         len(list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: f[x])) = 1 AS sole
  FROM masks, (SELECT o, unnest(range(1, 6)) AS k FROM orders WHERE length(o) = 5)),
counts AS (
  SELECT part, o, k, f,
         coalesce(sum(n) FILTER (NOT gone AND NOT hit), 0) AS kept,
         coalesce(sum(n) FILTER (NOT gone AND hit), 0) AS removed,
         coalesce(sum(n) FILTER (gone AND hit), 0) AS redundant,
         coalesce(sum(n) FILTER (hit AND sole), 0) AS unique_fails,
         coalesce(sum(good) FILTER (NOT gone AND hit), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (NOT gone AND hit), 0) AS toxic_lost
  FROM (SELECT * REPLACE (coalesce(hit, false) AS hit) FROM steps) GROUP BY part, o, k, f)
SELECT part, o AS filter_order, k::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM counts
"""
