"""Every registered query against its DuckDB oracle on sf0.001 (the driver's
gate runs the same comparison on sf0.01)."""

import collections

import duckdb
import pytest

import __spark_entry__ as E
from strata.plans import registry
from strata.sources.tables import TABLES
from tools.oracle_check import norm

from conftest import SF_SMALL

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return collections.Counter(tuple(norm(r[i]) for i in order) for r in rows)


def test_every_query_has_an_oracle():
    assert not set(registry.QUERIES) - set(ORACLE)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_revenue_usd" in df.columns


@pytest.mark.parametrize("name", sorted(set(ORACLE) & set(registry.QUERIES)))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(ocols)
    assert _bag(sdf.columns, srows) == _bag(ocols, orows)
