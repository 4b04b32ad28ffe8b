import pytest

import __spark_entry__ as entry_point
from subtide.plans.queries import ORACLES, QUERIES
from tests.compare import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert entry_point.queries().keys() >= QUERIES.keys()
    assert entry_point.oracle_sql().keys() >= ORACLES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, sf_dir, con, name):
    problem, rows, _, _ = compare(spark, con, name, QUERIES[name], ORACLES[name], sf_dir)
    assert problem is None
    assert rows > 0


def test_entry_runs(spark):
    assert "roll_forward_variance" in entry_point.entry(spark).columns
