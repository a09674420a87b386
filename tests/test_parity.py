"""Every registered query against its SQL oracle on the smallest tables."""

import pytest
from tests.parity import connect, differences

from __spark_entry__ import entry, oracle_sql, queries
from creditloom.plans.oracles import ORACLES
from creditloom.plans.queries import QUERIES
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) == []


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry(spark).count() == 7
