"""Every registered query against independent SQL on DuckDB."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from carepulse.registry import QUERIES
from compare import connect, difference

CHECKS = oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("key", list(CHECKS))
def test_matches_sql(spark, sf_dir, con, key):
    assert difference(queries()[key](spark, sf_dir), con, CHECKS[key]) is None


def test_entry_has_rows(spark):
    assert entry(spark).limit(1).count() == 1


def test_every_query_has_a_check():
    """Queries of the training-data operators without SQL are tested beside those operators."""
    assert set(CHECKS) <= set(queries())
    assert not set(QUERIES) - set(CHECKS)
