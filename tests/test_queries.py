"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import check_queries
from tallymark.plans.queries import REGISTRY
from tests.conftest import SF


@pytest.fixture(scope="module")
def duck():
    return check_queries.connect(SF)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_matches_sql(spark, duck, name):
    query = REGISTRY[name]
    line = check_queries.compare(spark, duck, name, query.run, query.sql, SF)
    assert not line.startswith("FAIL"), line
    assert "EMPTY" not in line or name == "r08_pending_chunks", line


def test_every_query_has_sql():
    assert [n for n, q in REGISTRY.items() if q.sql is None] == []
