import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF
from tamis import queries as core
from tamis import run_queries  # noqa: F401


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in os.listdir(SF):
        c.execute(f"CREATE VIEW {t.split('.')[0]} AS SELECT * FROM read_parquet('{SF}/{t}')")
    return c


def plain(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(core.QUERIES))
def test_query_against_sql(spark, con, name):
    df = core.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(v) for v in r) for r in df.select(*cols).collect()), key=repr)
    if name not in core.ORACLES:
        return
    cur = con.execute(core.ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in cur.fetchall()), key=repr)


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 200


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
