"""Every query of the pitch engine against its SQL, whole tables, every value.
Queries of installed extras are tested beside them, some of them without SQL."""

import pytest

import __spark_entry__ as contract
from checks import oracle, queries
from checks.compare import differences, oracle_connection
from conftest import SF_DIR

QUERIES = queries.queries()
ORACLES = oracle.statements()


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, connection, name):
    assert differences(QUERIES[name](spark, SF_DIR), connection, ORACLES[name]) == []
