"""Every registered query against its SQL twin, on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from campanile.plans import oracle, registry
from tests.oracle_check import difference, duck

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = registry.all_queries(), oracle.all_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert difference(name, QUERIES[name](spark, FOLDER), con, SQL[name]) is None


def test_entry_runs(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["campaign_id", "impressions", "clicks", "conversions", "spend_usd", "ctr"]
    assert 0 < frame.count() <= 15
