"""DuckDB SQL of the Jaccard join, from its definition: all pairs of texts
that share a five-word shingle, and the closure of the links."""

SQL = r"""
WITH RECURSIVE
d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
t AS (SELECT text, min(doc_id) AS text_id, count(*) AS n_copies FROM d GROUP BY text),
w AS (SELECT text_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM t),
s AS (SELECT text_id, unnest(
        CASE WHEN len(w) >= 5 THEN list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)])
             WHEN len(w) > 0 THEN [chr(1) || array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT text_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT x.text_id AS a, y.text_id AS b, count(*) AS c
      FROM s AS x JOIN s AS y USING (g) WHERE x.text_id < y.text_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n AS p ON p.text_id = a JOIN n AS q ON q.text_id = b WHERE 5 * c >= 4 * (p.n + q.n - c)),
links AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach(node, other) AS (
  SELECT text_id, text_id FROM t
  UNION SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.other),
classes AS (SELECT node, min(other) AS class_id FROM reach GROUP BY node),
degree AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT d.doc_id, class_id, text_id, n_copies, coalesce(n_links, 0) AS n_links
FROM d JOIN t USING (text) JOIN classes ON classes.node = text_id LEFT JOIN degree ON degree.a = text_id
"""
