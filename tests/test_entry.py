import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from shelfwise.plans import PLANS

TABLES = ["part", "orders", "lineitem", "customer"]


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "product1" and df.count() > 0


def test_every_query_has_name_and_most_have_oracles():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q) and set(PLANS) <= set(q)
    assert len([p for p in PLANS.values() if not p.sql]) <= 6


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    return v


@pytest.mark.parametrize("name", sorted(n for n, p in PLANS.items() if p.sql))
def test_query_matches_oracle_small(spark, name):
    if not os.path.exists(SF_SMALL):
        pytest.skip("test data missing")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    sdf = entry.queries()[name](spark, SF_SMALL)
    res = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    scols = sorted(sdf.columns)
    srows = sorted(tuple(str(_norm(r[c])) for c in scols) for r in sdf.collect())
    idx = [dcols.index(c) for c in scols]
    drows = sorted(tuple(str(_norm(r[i])) for i in idx) for r in res.fetchall())
    assert srows == drows
