"""Every registered query of the core against its SQL, at the smallest scale."""

import pytest

from rimecast.plans.queries import ORACLES, QUERIES

from .compare import check, connect


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, sf, con, name):
    check(QUERIES[name](spark, sf), con, ORACLES[name])
