from __future__ import annotations

import re

import pytest
from hypothesis import given
from hypothesis import strategies as st

from millrace.functions.names import (
    rename_safe,
    safe_names,
    sanitize_name,
    sanitized,
    select_list,
    select_lists,
    with_select_items,
)

GOLDEN = [
    ("First Name", "First_Name"),
    ("col-1@x", "col_1_x"),
    ("  a   b  ", "a_b"),
    ("a_b_c", "a_b_c"),
    ("a  b", "a_b"),
    ("A-B/C", "A_B_C"),
    ("__x__ y__", "x_y"),
    ("Größe", "Gr_e"),
    ("###", ""),
]


@pytest.mark.parametrize(("raw", "safe"), GOLDEN)
def test_golden(raw, safe):
    assert sanitize_name(raw) == safe


def test_column_form_agrees(spark):
    df = spark.createDataFrame(GOLDEN, "raw string, safe string").select("raw", "safe", sanitized("raw").alias("got"))
    assert [(row.raw, row.got) for row in df.collect()] == GOLDEN


@given(st.text())
def test_idempotent_and_clean(name):
    safe = sanitize_name(name)
    assert sanitize_name(safe) == safe
    assert re.fullmatch("([A-Za-z0-9]+(_[A-Za-z0-9]+)*)?", safe)


@given(st.lists(st.text(alphabet="aA -_2#", max_size=5), max_size=12))
def test_names_of_a_table_never_collide(names):
    safe = safe_names(names)
    assert len({name.lower() for name in safe}) == len(names)
    assert all(safe)


def test_collisions_take_the_ordinal():
    assert safe_names(["a b", "a-b", "A_B", "a_b_2", "#"]) == ["a_b", "a_b__2", "A_B__3", "a_b_2", "col"]


def test_select_list():
    assert select_list(["First Name", "id"]) == "[First Name] as First_Name,[id] as id"
    assert select_list(["C1"]) == "[C1] as C1"
    assert select_list(["odd]name"]) == "[odd]]name] as odd_name"
    assert select_list([]) == ""


def test_catalogue_form_agrees_with_list_form(spark):
    tables = {"t1": ["a b", "a-b", "A_B", "x"], "t2": ["a b", "#", "##", "odd]name"]}
    rows = [(t, name, i) for t, names in tables.items() for i, name in enumerate(names, start=1)]
    df = spark.createDataFrame(rows, "table_name string, column_name string, ordinal_position int")
    found = with_select_items(df, ["table_name"]).orderBy("table_name", "ordinal_position").collect()
    for t, names in tables.items():
        own = [row for row in found if row.table_name == t]
        assert [row.safe_name for row in own] == safe_names(names)
        assert ",".join(row.select_item for row in own) == select_list(names)


def test_null_table_key_keeps_its_rows(spark):
    rows = [(None, "a b", 2), (None, "a-b", 1), ("t", "x", 1)]
    df = spark.createDataFrame(rows, "table_name string, column_name string, ordinal_position int")
    assert sorted(row.safe_name for row in with_select_items(df, ["table_name"]).collect()) == ["a_b", "a_b__2", "x"]
    lists = {row.table_name: row.select_list for row in select_lists(df, ["table_name"]).collect()}
    assert lists == {None: "[a-b] as a_b,[a b] as a_b__2", "t": "[x] as x"}


def test_rename_safe(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int")
    assert rename_safe(df).columns == ["a_b", "a_b__2"]
