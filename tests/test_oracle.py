"""Each registered query against its SQL on the small driver tables."""

import pytest

from tableward.registry import registered
from tests.compare import TESTDATA, compare, connection

SF = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connection(SF)


@pytest.mark.parametrize("name", [n for n, (_, sql) in registered().items() if sql])
def test_query_matches_sql(spark, con, name):
    run, sql = registered()[name]
    problems, _ = compare(spark, SF, run, sql, con)
    assert not problems


def test_every_query_has_sql():
    assert [n for n, (_, sql) in registered().items() if sql is None] == []
