"""Every registered query against its SQL."""

from __future__ import annotations

import pytest
from compare import connect, differences

import __spark_entry__ as entry_points
from checks import all_oracles, all_queries

QUERIES = all_queries()
ORACLES = all_oracles()


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, db, name):
    assert differences(QUERIES[name](spark, sf_dir), db, ORACLES[name]) == []


def test_entry(spark):
    rows = {row.SNAPSHOT_DATE: row.records for row in entry_points.entry(spark).collect()}
    assert set(rows) == {"20240115", "20240131"}
    assert all(rows.values())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"source_row_count", "fetch_size_plan"}))
def test_no_cross_join(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan
