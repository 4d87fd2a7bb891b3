"""Windows merged by key."""

from __future__ import annotations

import random
from datetime import datetime

import pytest

from millrace.model import RunContext, TableJob
from millrace.operators.landing import SchemaConflict, land, merge
from millrace.plans.table_load import Target, load_table
from millrace.session import scratch_table, shared_dir
from millrace.sources.lake import LakeSource

SCHEMA = "k bigint, v string, p string"


def rows_of(spark, table):
    return sorted(map(tuple, spark.table(table).select("k", "v", "p").collect()), key=str)


def files_of(spark, table, p):
    return sorted(spark.table(table).where(f"p <=> {p}").inputFiles())


@pytest.mark.parametrize("external", [False, True])
def test_only_touched_partitions_are_written(spark, external):
    table = scratch_table(spark, "merge")
    if external:
        spark.sql(f"CREATE TABLE {table} ({SCHEMA}) USING parquet PARTITIONED BY (p) LOCATION '{shared_dir(spark, 'merge')}'")
    first = [(i, "old", p) for i, p in enumerate(["a", "a", "b", "b", "c", "d e:", None, None])] + [(None, "old", "a")]
    land(spark.createDataFrame(first, SCHEMA), table, load_date="", partition_by="p")
    before = {p: files_of(spark, table, p) for p in ("'a'", "'b'", "'c'")}
    changed = [(0, "new", "a"), (4, "new", "b"), (5, "new", "x"), (6, "new", "x"), (7, "new", "x"), (9, "new", "b"), (None, "new", "a")]
    landed = merge(spark.createDataFrame(changed, SCHEMA), table, ["K"], load_date="", partition_by="p")
    assert landed.rows == 7
    want = [(1, "old", "a"), (2, "old", "b"), (3, "old", "b"), *changed]
    assert rows_of(spark, table) == sorted(want, key=str)
    assert set(before["'b'"]) < set(files_of(spark, table, "'b'"))  # rows were only added
    assert not set(before["'a'"]) & set(files_of(spark, table, "'a'")) and files_of(spark, table, "'c'") == []
    merge(spark.createDataFrame(changed, SCHEMA), table, ["k"], load_date="", partition_by="p")
    assert rows_of(spark, table) == sorted(want, key=str)
    assert not spark.catalog.tableExists(f"{table}__changes")


@pytest.mark.parametrize("by", [None, "p"])
def test_merges_equal_a_dictionary(spark, by):
    rnd, table, known = random.Random(4), scratch_table(spark, "merge"), {}
    for step in range(4):
        rows = {(rnd.randrange(12), rnd.choice("xy")): (f"{step}", rnd.choice(["a", "b", None])) for _ in range(8)}
        known.update(rows)
        df = spark.createDataFrame([(k, s, v, p) for (k, s), (v, p) in rows.items()], "k bigint, s string, v string, p string")
        merge(df, table, ["k", "s"], load_date="", partition_by=by)
    found = {(r.k, r.s): (r.v, r.p) for r in spark.table(table).collect()}
    assert found == known and spark.table(table).count() == len(known)


def test_a_merge_brings_columns_and_wider_types(spark):
    table = scratch_table(spark, "merge")
    land(spark.createDataFrame([(1, "a"), (2, "b")], "k int, p string"), table, load_date="", partition_by="p")
    wide = spark.createDataFrame([(2**40, "n", "b"), (2, "n", "b")], "k bigint, v string, p string")
    with pytest.raises(SchemaConflict):
        merge(wide, table, ["k"], load_date="", partition_by="p")
    merge(wide, table, ["k"], load_date="", partition_by="p", widen=True)
    assert rows_of(spark, table) == sorted([(1, None, "a"), (2**40, "n", "b"), (2, "n", "b")], key=str)


def test_a_key_that_is_missing_is_an_error(spark):
    with pytest.raises(ValueError, match="merge key z"):
        merge(spark.range(3), scratch_table(spark, "merge"), ["z"], load_date="")


@pytest.mark.parametrize("cut", [None, "landed", "marked"])
def test_windows_are_merged_by_the_job_option(spark, cut):
    schema, name = scratch_table(spark, "merge").split(".")
    job = TableJob("J", "s", "t", schema, name, load_type="INCREMENTAL", cdc_type="TIMESTAMP", cdc_modified_date_column="ts",
                   target_table_options={"millrace.merge_key": " id "})
    target = Target(spark, scratch_table(spark, "tracker"))
    rows = [(1, "one", "2024-01-01 01:00:00"), (2, "two", "2024-01-01 02:00:00")]
    later = [(1, "ONE", "2024-01-01 05:00:00"), rows[1], (3, "three", "2024-01-01 06:00:00")]

    def load(data, hour, cut=None):
        def step(name):
            if name == cut:
                raise KeyboardInterrupt

        target.progress = step
        df = spark.createDataFrame(data, "id bigint, v string, ts string").selectExpr("id", "v", "CAST(ts AS timestamp_ntz) AS ts")
        return load_table(job, LakeSource(spark, lambda schema, table: df), target, RunContext("r", "b", "a", "d", datetime(2024, 1, 1, hour)))

    load(rows, 4)
    if cut:
        with pytest.raises(KeyboardInterrupt):
            load(later, 8, cut)
    load(later, 8)
    assert sorted((r.id, r.v) for r in spark.table(target.table(job)).collect()) == [(1, "ONE"), (2, "two"), (3, "three")]
