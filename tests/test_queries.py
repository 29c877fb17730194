"""Every registered query beside its SQL on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from compare import rows_of  # noqa: E402

from postgrove.plans.registry import ORACLE, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for f in os.listdir(sf):
        c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{sf}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    got = rows_of(df.columns, df.collect())
    if name in ORACLE:
        cur = con.execute(ORACLE[name])
        names = [x[0] for x in cur.description]
        assert sorted(names) == sorted(df.columns)
        assert got == rows_of(names, cur.fetchall())


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
