"""Every query against its SQL on DuckDB."""

import pytest

from compare import connect, difference
from millrace.suite.oracles import oracles
from millrace.suite.queries import queries

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = queries(), oracles()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, SF), duck, ORACLES[name]) is None


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())
