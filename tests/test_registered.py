"""Every registered query against its SQL, on the smallest test tables."""
import pytest

import __spark_entry__ as contract
from checks.compare import connect, difference
from checks.oracle import ORACLE
from checks.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, tables, name):
    assert difference(spark, tables, SF_DIR, name) is None


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["id", "cid"]
    assert result.count() == 3
