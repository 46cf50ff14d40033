"""The operators that SQL can express, against DuckDB on the given tables."""

import duckdb
import pytest

from branchbook.llm import registry

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = registry.QUERIES[name](spark, SF)
    cur = con.execute(registry.ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, df.select(*names).collect()), key=key) == sorted(cur.fetchall(), key=key)
