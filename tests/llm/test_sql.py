"""Registered queries against their SQL."""

from __future__ import annotations

import pytest
from compare import connect, differences

import __spark_entry__ as entry_points
from millrace.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) == []


def test_all_are_registered():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql())
