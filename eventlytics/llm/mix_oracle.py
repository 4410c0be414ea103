"""DuckDB SQL of the source mix, from the method's description: budgets down
the tree by capped proportional shares, then a running sum per leaf."""

from __future__ import annotations


def _level(name: str, path: list[str], weight: str, above: str | None) -> str:
    """One level's budgets: children that are full get their capacity, the
    others share the rest by weight."""
    keys = ", ".join(path)
    parent = path[:-1]
    source = (f"(SELECT {keys}, sum(supply) * 2 AS cap FROM supply GROUP BY ALL)")
    budget = "(SELECT sum(supply) * 50 // 100 FROM supply)"
    join = f"JOIN (SELECT {', '.join(parent)}, budget AS pb FROM {above}) USING ({', '.join(parent)})" if parent else ""
    pb = "pb" if parent else f"{budget} AS pb"
    part = f"PARTITION BY {', '.join(parent)}" if parent else ""
    return f"""
{name}_n AS (SELECT {keys}, cap, {weight} AS w, {pb} FROM {source} {join}),
{name}_o AS (SELECT *, coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left
  FROM {name}_n WINDOW o AS ({part} ORDER BY cap / w, {keys})),
{name}_f AS (SELECT *, cap * w_left <= w * (pb - before) AS is_full FROM {name}_o),
{name} AS (SELECT {keys}, CASE WHEN is_full THEN cap ELSE w * (pb - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER p)
    // nullif(sum(CASE WHEN is_full THEN 0 ELSE w END) OVER p, 0) END AS budget
  FROM {name}_f WINDOW p AS ({part})),"""


SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
    CASE WHEN substr(md5(coalesce(source, '(none)')), 1, 1) < '6' THEN 'web'
         WHEN substr(md5(coalesce(source, '(none)')), 1, 1) < 'b' THEN 'forum' ELSE 'books' END AS domain,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS tokens,
    md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS digest
  FROM documents),
supply AS (SELECT domain, lang, source, sum(tokens) AS supply FROM docs GROUP BY ALL),
""" + _level("l1", ["domain"], "CASE domain WHEN 'web' THEN 5 WHEN 'forum' THEN 3 ELSE 2 END", None) + _level(
    "l2", ["domain", "lang"], "CASE lang WHEN 'en' THEN 4 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 WHEN 'es' THEN 2 ELSE 1 END",
    "l1") + _level("l3", ["domain", "lang", "source"], "1", "l2") + """
plan AS (SELECT domain, lang, source, least(budget // supply, 2) AS whole,
    budget - least(budget // supply, 2) * supply AS rest
  FROM l3 JOIN supply USING (domain, lang, source) WHERE supply > 0),
keyed AS (SELECT *, md5('7:' || (whole + 1)::BIGINT::VARCHAR || ':' || digest) AS key
  FROM docs JOIN plan USING (domain, lang, source)),
summed AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY key) AS upto FROM keyed),
taken AS (SELECT *, (whole + CASE WHEN whole < 2 AND upto <= rest THEN 1 ELSE 0 END)::BIGINT AS copies FROM summed)
SELECT doc_id, domain, lang, source, tokens, unnest(range(1, copies + 1))::INTEGER AS epoch FROM taken
"""
