"""DuckDB SQL of the spelling variants, from the definition: CRC-32 bit by bit
(its reflected polynomial is the fixed value), near words by equal texts after
one deletion."""

SQL = r"""
WITH RECURSIVE
crc AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
          lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{00C0}-\x{00FF}]+')),
                                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
counted AS (SELECT run, hex(coalesce(doc_id::VARCHAR, '') || ':' || run) AS x, count(*) AS n FROM runs
            WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT,
           list_transform(range(1, length(x), 2), lambda i: ('0x' || substr(x, i, 2))::BIGINT)),
           lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295) AS h
  FROM counted, crc),
typed AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
                      ELSE run END AS word, n FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM typed WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cuts AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
         FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
replaced AS (SELECT a.word, b.word AS other, b.n AS other_n FROM cuts AS a JOIN cuts AS b USING (i, rest)
             WHERE a.word <> b.word),
shorter AS (SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM cuts AS a JOIN words AS b ON a.rest = b.word),
near AS (SELECT * FROM replaced UNION SELECT word, other, other_n FROM shorter UNION SELECT other, word, n FROM shorter),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, encode(other)) AS other,
                max(other_n) AS other_n FROM near GROUP BY word),
forms AS (SELECT words.word, n, coalesce(n_near, 0) AS n_near,
                 CASE WHEN other_n >= 5 * n THEN other END AS form, CASE WHEN other_n >= 5 * n THEN other_n END AS form_n
          FROM words LEFT JOIN best USING (word)),
walk(word, here) AS (
  SELECT word, word FROM forms
  UNION ALL SELECT walk.word, form FROM walk JOIN forms ON forms.word = walk.here WHERE form IS NOT NULL),
roots AS (SELECT walk.word, walk.here AS root FROM walk JOIN forms ON forms.word = walk.here WHERE form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
"""
