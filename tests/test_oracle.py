"""Every query with an SQL twin equals DuckDB exactly (sf0.001 here; the driver uses sf0.01)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import compare, duck  # noqa: E402
from conftest import SF001  # noqa: E402

SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    problems, ns, nd = compare(df, con, SQL[name])
    assert not problems, problems


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"segment", "region", "net_revenue", "pct_of_total_revenue"} <= set(df.columns)


def test_every_key_is_callable():
    assert set(SQL) <= set(E.queries())
