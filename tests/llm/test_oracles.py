"""Operators that SQL can express, against DuckDB."""

import duckdb
import pytest

from strata.llm.queries import ORACLE_SQL, QUERIES

from llm_helpers import SF_SMALL


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    cur = con.execute(ORACLE_SQL[name])
    cols = [d[0] for d in cur.description]
    want = sorted(cur.fetchall())
    got = QUERIES[name](spark, SF_SMALL)
    assert got.columns == cols and sorted(map(tuple, got.collect())) == want
