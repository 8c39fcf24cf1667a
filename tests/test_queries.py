"""Every registered query against its SQL; those without SQL must return rows."""

import pytest

from cadastra.checks.compare import check, connect
from cadastra.checks.oracles import ORACLES
from cadastra.checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, connection, name):
    assert check(spark, connection, SF_DIR, name) is None


def test_sql_names_are_queries():
    assert set(ORACLES) <= set(QUERIES)
