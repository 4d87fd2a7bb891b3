"""Evolution of nested columns."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from millrace.operators.landing import SchemaConflict, land, merged_schema
from millrace.session import scratch_table


def merged(old, new):
    return merged_schema(T.StructType.fromDDL(f"c {old}"), T.StructType.fromDDL(f"c {new}"))["c"].dataType.simpleString()


@pytest.mark.parametrize("old, new, want", [
    ("struct<a: int>", "struct<b: string, A: bigint>", "struct<a:bigint,b:string>"),
    ("struct<a: bigint, b: string>", "struct<a: int>", "struct<a:bigint,b:string>"),
    ("array<int>", "array<decimal(12,2)>", "array<decimal(12,2)>"),
    ("array<struct<x: struct<y: date>>>", "array<struct<x: struct<y: timestamp, z: int>>>", "array<struct<x:struct<y:timestamp,z:int>>>"),
    ("map<string, struct<a: int>>", "map<string, struct<b: int>>", "map<string,struct<a:int,b:int>>"),
    ("map<int, float>", "map<bigint, double>", "map<bigint,double>"),
    ("date", "timestamp", "timestamp"),
    ("timestamp_ntz", "date", "timestamp_ntz"),
])
def test_types_are_merged_part_by_part(spark, old, new, want):
    assert merged(old, new) == want


@pytest.mark.parametrize("old, new", [
    ("struct<a: int>", "struct<a: string>"), ("struct<a: int>", "int"), ("array<int>", "array<boolean>"),
    ("map<string, int>", "map<int, int>"), ("array<int>", "map<int, int>"), ("timestamp", "int"),
])
def test_types_that_no_type_holds_are_refused(spark, old, new):
    with pytest.raises(SchemaConflict):
        merged(old, new)


def test_old_rows_are_null_in_new_fields(spark):
    table = scratch_table(spark, "nested")
    old = spark.sql("SELECT * FROM VALUES (1, named_struct('a', 1, 'b', array(named_struct('x', 1)))), (2, NULL) AS t(id, s)")
    new = spark.sql("SELECT 3 AS id, named_struct('b', array(named_struct('y', 'q', 'x', 5000000000), NULL), 'c', map('k', 1), 'a', NULL) AS s")
    land(old, table, load_date="")
    with pytest.raises(SchemaConflict, match="rewritten"):
        land(new, table, load_date="")
    land(new, table, load_date="", widen=True)
    land(old, table, load_date="")  # narrower rows fit without a rewrite
    rows = sorted(spark.table(table).collect(), key=lambda r: r.id)
    assert [r.id for r in rows] == [1, 1, 2, 2, 3]
    for row in rows[:2]:
        assert row.s.asDict(recursive=True) == {"a": 1, "b": [{"x": 1, "y": None}], "c": None}
    assert rows[2].s is None and rows[3].s is None
    assert rows[4].s.asDict(recursive=True) == {"a": None, "b": [{"x": 5000000000, "y": "q"}, None], "c": {"k": 1}}


def test_a_struct_in_another_order_needs_no_rewrite(spark):
    table = scratch_table(spark, "nested")
    land(spark.sql("SELECT named_struct('a', 1, 'b', 'x') AS s"), table, load_date="")
    land(spark.sql("SELECT named_struct('B', 'y', 'A', 2) AS s"), table, load_date="")
    assert sorted((r.s.a, r.s.b) for r in spark.table(table).collect()) == [(1, "x"), (2, "y")]
