"""Every registered query equals its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
from compare import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    result = contract.queries()[name](spark, SF_DIR)
    assert compare(result, duck, contract.oracle_sql()[name]) == []


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0
