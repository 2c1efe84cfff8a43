"""Every registered query that SQL can express against its SQL, on the smallest tables."""

import pytest

from checks.catalog import ORACLES, QUERIES
from checks.compare import database, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return database(FOLDER)


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_sql(spark, connection, name):
    assert difference(spark, connection, QUERIES[name], ORACLES[name], FOLDER) is None


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
