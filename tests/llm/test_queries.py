"""Every registered query with SQL equals it; the package is optional."""
import os
import subprocess
import sys

import duckdb
import pytest
from llm_fixtures import SF as SF_SMALL

from shelfwise.llm.queries import ORACLES, QUERIES

TABLES = ["documents", "embeddings", "labels", "conversations", "pages", "benchmark"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    want = con.execute(ORACLES[name])
    cols = [d[0] for d in want.description]
    got = QUERIES[name](spark, SF_SMALL)
    assert sorted(got.columns) == sorted(cols)
    assert sorted(map(str, (tuple(r[c] for c in cols) for r in got.collect()))) == sorted(map(str, want.fetchall()))


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_nothing_else_imports_the_package():
    code = ("import sys; sys.modules['shelfwise.llm'] = None; import __spark_entry__ as e;"
            "q = e.queries(); assert q and not any(n.startswith('op') or n == 'pipeline' for n in q); e.oracle_sql()")
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
