"""Every registered query against its SQL on whole tables."""

import pytest
from compare import connect, difference, duck_rows, spark_rows
from conftest import SMALL

import __spark_entry__ as entry
from meterhouse.plans import catalog

QUERIES = catalog.queries()
ORACLES = catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = spark_rows(QUERIES[name](spark, SMALL))
    assert name in ORACLES
    assert difference(result, duck_rows(duck, ORACLES[name])) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
