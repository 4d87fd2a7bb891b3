"""Equi-depth splits, with Spark in the place of the source."""

from __future__ import annotations

import re
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from checks.scans import QUERIES
from millrace.sources.dialects import Dialect, number_literal
from millrace.sources.splits import DEALT, ROW_COLUMN, SPLIT_COLUMN, Histogram, cuts_between, even_parts


class Spoken(Dialect):
    def timestamp(self, ts):
        return f"TIMESTAMP_NTZ '{ts}'"


def literal(value):
    return Spoken().timestamp(value) if isinstance(value, datetime) else f"CAST('{number_literal(value)}' AS DOUBLE)" if isinstance(
        value, float) else number_literal(value)


def sizes(spark, df, parts, by_row=True):
    """Rows of each part, after checking that every row is in one."""
    df = df.selectExpr("k", f"PMOD(XXHASH64(id), {DEALT}) AS {ROW_COLUMN}")
    df.createOrReplaceTempView("split_rows")
    queries = []

    def run(query):
        queries.append(query)
        return spark.sql(query).collect()

    found = even_parts(Histogram(run, literal, "split_rows", "k"), "k", parts, by_row)
    if found is None:
        return None
    flags = ", ".join(f"CASE WHEN {p} THEN 1 ELSE 0 END" for p in found.predicates)
    rows = spark.sql(f"SELECT array({flags}) AS f FROM (SELECT k AS {SPLIT_COLUMN}, {ROW_COLUMN} FROM split_rows)").collect()
    assert all(sum(r.f) == 1 for r in rows)
    assert len(queries) < 13
    return [sum(column) for column in zip(*(r.f for r in rows), strict=True)]


SKEWED = {
    "even": "id",
    "squares": "id * id * id",
    "powers": "CAST(POW(10, id % 17) AS BIGINT) + id",
    "a third in one value": "CASE WHEN id % 3 = 0 THEN 77 ELSE id END",
    "a third null": "CASE WHEN id % 3 = 0 THEN NULL ELSE id * id END",
    "decimals": "CAST(EXP(id / 1000) AS DECIMAL(38,10))",
    "doubles": "EXP(id / 20D) * CASE WHEN id % 2 = 0 THEN -1 ELSE 1 END",
    "times": "CAST(TIMESTAMP '2020-01-01 00:00:00' + MAKE_INTERVAL(0, 0, 0, 0, 0, 0, POW(id, 2)) AS TIMESTAMP_NTZ)",
    "days": "DATE_ADD(DATE '2020-01-01', CAST(SQRT(id) AS INT))",
}


@pytest.mark.parametrize("name", SKEWED)
def test_parts_are_even_and_hold_every_row_once(spark, name):
    df = spark.range(6000).selectExpr("id", f"{SKEWED[name]} AS k")
    found = sizes(spark, df, 8)
    assert 5 <= len(found) <= 11 and sum(found) == 6000
    assert max(found) <= 1.5 * 6000 / len(found)


def test_a_view_keeps_a_value_in_one_part(spark):
    df = spark.range(3000).selectExpr("id", f"{SKEWED['a third in one value']} AS k")
    found = sizes(spark, df, 8, by_row=False)
    assert max(found) >= 1000 and sum(found) == 3000


def test_nothing_to_split(spark):
    assert sizes(spark, spark.range(0).selectExpr("id", "id AS k"), 8) is None
    assert sizes(spark, spark.range(50).selectExpr("id", "'a' AS k"), 8) is None
    assert sizes(spark, spark.range(50).selectExpr("id", "id AS k"), 1) is None
    assert sizes(spark, spark.range(50).selectExpr("id", "7 AS k"), 4, by_row=False) is None
    assert sum(sizes(spark, spark.range(500).selectExpr("id", "7 AS k"), 4)) == 500
    assert sum(sizes(spark, spark.range(500).selectExpr("id", "CAST(NULL AS INT) AS k"), 4)) == 500


def test_cuts():
    assert cuts_between(1, 4, 255) == [2, 3, 4]
    assert cuts_between(0, 10, 2) == [5, 10]
    assert cuts_between(3, 3, 9) == []
    assert cuts_between(Decimal("0.5"), Decimal("1.5"), 2) == [Decimal("1.0"), Decimal("1.5")]
    day = datetime(2024, 1, 1)
    assert cuts_between(day, day + timedelta(seconds=2, microseconds=5), 9) == [day + timedelta(seconds=s) for s in (1, 2)]


def test_split_plan_of_large_keys(spark, tmp_path):
    """Powers of keys beyond 2,097,151 are beyond a long."""
    lines = spark.range(6000).selectExpr("id * 1501 AS l_orderkey", "CAST(id % 7 AS INT) AS l_linenumber", "id AS l_partkey",
                                         "CAST(DATE_ADD(DATE '1995-01-01', CAST(id % 900 AS INT)) AS TIMESTAMP_NTZ) AS l_shipdate")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    plan = QUERIES["split_plan"](spark, str(tmp_path))
    found = plan.groupBy("key", "n_parts", "even").count().collect()
    told = plan._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    sent = re.findall(r"BroadcastExchange\nInput \[\d+\]: \[(.*?)\]", told)
    assert len(sent) == 2 and not any("l_orderkey" in columns for columns in sent)  # no lines
    assert sorted(map(tuple, found)) == [("power", 1, True, 6000), ("shipped", 1, True, 6000)]
