"""Every registered query against its DuckDB oracle (the correctness gate)."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from oracle.compare import compare, connect
from tremor.plans.queries import QUERIES as CORE

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

QUERIES = entry.queries()
SQL = entry.oracle_sql()


def test_registry_complete():
    assert set(CORE) <= set(QUERIES)
    assert set(CORE) - set(SQL) == set()          # every query of the library has its SQL
    assert set(SQL) <= set(QUERIES)


def test_entry_survives_a_missing_library():
    code = ("import sys; sys.modules['ahocorasick'] = None; import __spark_entry__ as e; "
            "print(len(e.queries()), len(e.oracle_sql()))")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=ROOT)
    assert out.stdout.split() == [str(len(CORE))] * 2, out.stderr


@pytest.fixture(scope="module")
def con(sf_small):
    return connect(sf_small)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, sf_small, con, name):
    ok, msg = compare(QUERIES[name](spark, sf_small), con, SQL[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 10 and df.columns == ["state", "earthquake_count"]
