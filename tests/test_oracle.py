"""Every query with a SQL twin, compared value by value on the driver tables."""

import pytest

from verification.compare import compare, connect
from verification.oracle import ORACLE
from verification.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, con, sf_dir, name):
    assert compare(spark, con, name, sf_dir) == ""


def test_every_twin_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
