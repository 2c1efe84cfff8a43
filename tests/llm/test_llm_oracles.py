"""Queries of the training-data operators against their SQL on the smallest tables."""

import pytest

from checks.compare import database, difference
from lexispark.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return database(FOLDER)


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_sql(spark, connection, name):
    assert difference(spark, connection, QUERIES[name], ORACLES[name], FOLDER) is None
