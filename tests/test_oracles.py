"""Every registered query against its SQL oracle on the sf0.01 tables (the
driver's correctness gate), plus the smoke entry point."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from branchbook.plans import oracle, queries
from branchbook.sources.scratch import RunFolder

SF = "/root/testdata/sf0.01"


def _rows(rows):
    def k(r):
        return tuple((0, "") if x is None else (1, str(x)) for x in r)
    out = []
    for r in rows:
        out.append(tuple(("nan" if isinstance(x, float) and math.isnan(x) else
                          x.isoformat() if hasattr(x, "isoformat") else x) for x in r))
    return sorted(out, key=k)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_report_query_has_an_oracle(spark):
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(oracle.oracle_sql()) == set(queries.QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    cols = df.columns
    got = _rows([tuple(r[c] for c in cols) for r in df.collect()])
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(ocols)
    idx = [ocols.index(c) for c in cols]
    exp = _rows([tuple(r[i] for i in idx) for r in cur.fetchall()])
    assert len(got) == len(exp)
    assert got == exp


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["month_key", "id", "area_code", "amount"]
    assert len(rows) > 0 and {r.id for r in rows} == {3}


def test_profile_outliers_matches_exact_quantiles_on_small_data(spark):
    import numpy as np
    from branchbook.operators import checks
    vals = [float(v) for v in np.random.default_rng(3).normal(100, 10, 500).round(2)] + [1000.0, -500.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = checks.profile_outliers(df, "t", ["x"], RunFolder(spark).write).collect()[0]
    s = sorted(vals)
    n = len(s)
    q1 = s[math.ceil(0.25 * n) - 1]
    q3 = s[math.ceil(0.75 * n) - 1]
    assert (r.q1, r.q3) == (q1, q3)
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    assert r.n_outliers == sum(1 for v in vals if v < lo or v > hi)
