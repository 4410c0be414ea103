"""DuckDB SQL of the removal of repeated passages, from its definition: all
windows of 20 words as texts."""

SQL = r"""
WITH
d AS (SELECT row_number() OVER () AS rid, doc_id,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT rid, doc_id, s, md5(array_to_string(w[s:s + 19], ' ')) AS g
            FROM (SELECT rid, doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d WHERE len(w) >= 20)),
firsts AS (SELECT g, min((doc_id, s)) AS f FROM windows GROUP BY g),
later AS (SELECT rid, s FROM windows JOIN firsts USING (g) WHERE (doc_id, s) > f),
gone AS (SELECT DISTINCT rid, unnest(range(s, s + 20)) AS p FROM later),
places AS (SELECT rid, doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT places.rid, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
         FROM places ANTI JOIN gone USING (rid, p) GROUP BY places.rid)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""
