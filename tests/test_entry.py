"""Driver contract and the SQL oracles on the smallest scale."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tessera.queries import ORACLES
from tests.conftest import SF_SMALL

TABLES = "events documents benchmark labels conversations customer lineitem".split()


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["split", "source", "n_rows"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, (list, tuple)):
        return repr([_norm(x) for x in v])
    return repr(v)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    s_rows = sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    res = duck.execute(ORACLES[name])
    d_cols = [c[0] for c in res.description]
    assert sorted(d_cols) == cols
    idx = [d_cols.index(c) for c in cols]
    d_rows = sorted(tuple(_norm(r[i]) for i in idx) for r in res.fetchall())
    assert s_rows == d_rows
