"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tillstream.plans import oracles, registry
from tools.compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


def test_every_query_has_sql():
    assert set(registry.registered()) == set(oracles.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries()) >= set(registry.registered())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(registry.registered()))
def test_query(spark, connection, name):
    matches, note = compare(spark, connection, SF, name)
    assert matches, note


def test_entry(spark):
    assert entry.entry(spark).columns == ["window_start", "window_end", "store_id", "total_revenue", "total_quantity"]
