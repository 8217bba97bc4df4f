"""Every registered query against its DuckDB oracle at sf0.001 (the driver's gate)."""

import pytest

import __spark_entry__ as E
from conftest import SF0001
from skylane.checks.compare import compare, duck_connect

SQL = E.oracle_sql()
# the corpus operators have tests of their own
NAMES = [n for n in E.queries() if n in SQL and n not in E.LLM_QUERIES]


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF0001)


def test_every_query_registered_with_callable():
    qs = E.queries()
    assert qs and all(callable(f) for f in qs.values())
    assert set(SQL) <= set(qs)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(E.queries()[name](spark, SF0001), SQL[name], SF0001, con)
    assert res["ok"], res


def test_entry_runs(spark):
    rows = E.entry(spark).collect()
    assert len(rows) == 10
