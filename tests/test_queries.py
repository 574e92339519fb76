"""Every registered query against its SQL, on the smallest tables."""

import pytest

from check_oracles import compare, oracle_connection
from __spark_entry__ import entry, oracle_sql, queries
from basketflow.queries.registry import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_sql_only_for_known_queries():
    assert set(oracle_sql()) <= set(queries())


def test_every_query_is_registered():
    assert set(REGISTRY) <= set(queries())


# The operators for training data have tests of their own.
@pytest.mark.parametrize("name", REGISTRY)
def test_query(spark, connection, name):
    ok, message = compare(spark, connection, name, SF)
    assert ok, message
