"""The driver's gate: each registered query, batch and stream, against its
DuckDB SQL at sf0.01 (row count, column names, value multiset)."""

import duckdb
import pytest

import __spark_entry__ as E

from conftest import SF01

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
OWN = [n for n in E.queries() if n not in E.LLM_QUERIES]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return c


def _multiset(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple("\0" if r[i] is None else str(r[i]) for i in order) for r in rows)


def test_every_query_has_an_oracle():
    assert set(E.oracle_sql()) - set(E.LLM_ORACLES) == set(OWN)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["window_end", "rank", "item_id", "cnt"] and df.count() > 0


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF01)
    got = _multiset(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert got == _multiset(cols, res.fetchall())
