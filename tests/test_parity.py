"""Every registered query gives the rows its SQL gives."""

import pytest

import __spark_entry__ as contract
from parity.compare import difference
from parity.oracle import oracle_queries
from parity.spark_queries import QUERIES


def test_every_query_has_sql():
    assert QUERIES.keys() == oracle_queries().keys()
    assert QUERIES.keys() <= contract.queries().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    assert difference(spark, duck, sf_dir, name) is None


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() == 174
