from __future__ import annotations

from datetime import datetime
from types import SimpleNamespace
from unittest.mock import MagicMock

import pytest

from millrace.model import LEDGER_SCHEMA, RunContext
from millrace.operators import ledger as ops
from millrace.operators.ledger import (
    batch_summary,
    completion_rows,
    consolidate,
    failed_jobs,
    initial_rows,
    jobs_failed_last,
    jobs_to_rerun,
    ledger_rows,
    run_id_of_batch,
    union_by_name,
    update_rows,
    with_run,
    write_ledger,
)
from millrace.operators.schema_diff import NO_CHANGE, change_text, schema_diff
from millrace.session import scratch_table

START = datetime(2025, 1, 1)
END = datetime(2025, 1, 1, 0, 5)
RUN = RunContext("r1", "2025010100", "app-1", "daily", START)


def row(run_id="r1", batch_id="2025010100", job_id="J1", **values):
    known = {"run_id": run_id, "batch_id": batch_id, "job_id": job_id, "run_group": "daily", **values}
    return tuple(known.get(name) for name in LEDGER_SCHEMA.fieldNames())


def ledger(spark, *rows):
    return spark.createDataFrame(list(rows), LEDGER_SCHEMA)


def initial(spark, *jobs):
    schema = "job_id string, target_table string, start_time timestamp"
    frame = spark.createDataFrame([(job, f"t{job}", START) for job in jobs], schema)
    return initial_rows(with_run(frame, RUN))


def test_initial_row(spark):
    found = initial(spark, "J1")
    assert [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in LEDGER_SCHEMA]
    first = found.first()
    assert (first.status, first.dlh_layer, first.column_count, first.records_processed) == ("STARTED", "staging", 0, 0)
    assert first.end_time is None and first.table_name == "tJ1" and first.start_time == START


def test_update_row_ends_only_when_finished(spark):
    states = spark.createDataFrame(
        [(s, 3, None, "it's", None, START, END, "J", "t") for s in ("STARTED", "COMPLETED", "FAILED")],
        "status string, column_count int, records_processed bigint, error_message string, load_date string, "
        "start_time timestamp, end_time timestamp, job_id string, table_name string",
    )
    found = {r.status: r for r in update_rows(with_run(states, RUN)).collect()}
    assert found["STARTED"].end_time is None and found["FAILED"].end_time == found["COMPLETED"].end_time == END
    assert found["FAILED"].error_message == "its" and found["FAILED"].records_processed == 0
    assert found["FAILED"].load_date == ""


OUTCOME = "job_id string, target_schema string, target_table string, has_data boolean, column_count int, " \
          "records_processed bigint, start_time timestamp, end_time timestamp, error_message string, load_date string"


def test_completion_rows(spark):
    outcomes = spark.createDataFrame(
        [("J1", "ts", "tt", True, 2, 10, START, END, None, "20240101"),
         ("J2", "ts", "tu", False, 2, 10, START, END, "err", None)], OUTCOME,
    )
    done, failed = completion_rows(with_run(outcomes, RUN)).orderBy("job_id").collect()
    assert (done.status, done.records_processed, done.column_count, done.load_date) == ("COMPLETED", 10, 2, "20240101")
    assert (failed.status, failed.records_processed, failed.error_message, failed.load_date) == ("FAILED", 0, "err", "")
    assert done.table_name == "ts.tt" and done.run_group is None and done.dlh_layer is None


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, id int")
    assert sorted(map(tuple, union_by_name(a, b).collect())) == [(1, "x", None), (2, None, "y")]


def test_consolidate_equals_outer_join(spark):
    left = initial(spark, "J1", "J2")
    outcomes = spark.createDataFrame(
        [("J2", "s", "t2", True, 4, 9, START, END, None, None),
         ("J3", "s", "t3", False, 0, 0, START, END, "bad", None)],
        OUTCOME,
    )
    right = completion_rows(with_run(outcomes, RUN))
    found = sorted(map(tuple, consolidate(left, right).collect()), key=str)
    left.createOrReplaceTempView("i")
    right.createOrReplaceTempView("u")
    columns = ", ".join(f"coalesce(u.{c}, i.{c}) AS {c}" for c in LEDGER_SCHEMA.fieldNames())
    joined = spark.sql(f"SELECT {columns} FROM i FULL OUTER JOIN u ON i.job_id = u.job_id")
    assert found == sorted(map(tuple, joined.collect()), key=str)
    by_job = {r[5]: r for r in found}
    assert by_job["J2"][3] == "daily" and by_job["J3"][3] is None


def test_consolidate_takes_the_latest_of_repeated_rows(spark):
    first = row(status="FAILED", start_time=START, end_time=START, error_message="e")
    again = row(status="COMPLETED", start_time=START, end_time=END)
    found = consolidate(initial(spark, "J1"), ledger(spark, first, again)).collect()
    assert len(found) == 1
    assert (found[0].status, found[0].dlh_layer, found[0].error_message) == ("COMPLETED", "staging", "")


def test_run_id_of_batch(spark):
    rows = [row("late", start_time=END), row("first", start_time=START), row("other", "2025010101", start_time=END)]
    found = {r.batch_id: r.run_id for r in run_id_of_batch(ledger(spark, *rows)).collect()}
    assert found == {"2025010100": "first", "2025010101": "other"}
    assert run_id_of_batch(ledger(spark)).count() == 0


def failures(spark):
    return ledger(
        spark,
        row(job_id="J1", batch_id="2025010100", status="FAILED", start_time=START, spark_app_id="a1"),
        row(job_id="J1", batch_id="2025010101", status="COMPLETED", start_time=END, spark_app_id="a2"),
        row(job_id="J2", batch_id="2025010100", status="FAILED", start_time=START, spark_app_id="a1"),
        row(job_id="J2", batch_id="2025010101", status="FAILED", start_time=END, spark_app_id="a0"),
        row(job_id="J3", status="FAILED", start_time=END, run_group="hourly"),
    )


def test_rerun_selection(spark):
    rows = failures(spark)
    assert sorted(map(tuple, failed_jobs(rows, "daily").collect())) == [
        ("J1", "2025010100", "a1"), ("J2", "2025010101", "a1")
    ]
    assert sorted(map(tuple, jobs_failed_last(rows, "daily").collect())) == [("J2", "2025010101", "a0")]
    config = spark.createDataFrame([("J1",), ("J2",), ("J3",)], "job_id string")
    assert [r.job_id for r in jobs_to_rerun(config, rows, "daily").collect()] == ["J2"]


def test_batch_summary_counts_a_job_in_both(spark):
    first = batch_summary(failures(spark)).first()
    assert tuple(first) == (1, 3, 3, "Successful: 1 Fail: 3 Total: 3")
    assert tuple(batch_summary(ledger(spark)).first()) == (0, 0, 0, "Successful: 0 Fail: 0 Total: 0")


def test_write_twice_keeps_one_copy_and_other_runs(spark):
    table = scratch_table(spark, "ledger")
    write_ledger(ledger(spark, row("r1", status="STARTED"), row("r1", job_id="J2")), table)
    write_ledger(ledger(spark, row("r2", status="STARTED")), table)
    write_ledger(ledger(spark, row("r1", status="FAILED"), row("r1", job_id="J2")), table)
    found = sorted((r.run_id, r.job_id, r.status) for r in spark.table(table).collect())
    assert [f[:2] for f in found] == [("r1", "J1"), ("r1", "J2"), ("r2", "J1")]
    assert found[0][2] == "FAILED"
    assert dict(spark.table(table).dtypes)["batch_id"] == "string"


def test_write_never_empties_a_ledger_without_partitions(spark):
    table = scratch_table(spark, "ledger")
    ledger(spark, row("old")).write.saveAsTable(table)
    with pytest.raises(ValueError, match="not partitioned"):
        write_ledger(ledger(spark, row("r1")), table, max_retries=1)
    assert spark.table(table).count() == 1


@pytest.mark.parametrize(
    ("exists", "partitions", "call"),
    [(False, [], "create"), (True, ["batch_id", "run_id"], "overwritePartitions"), (True, ["batch_id"], "append")],
)
def test_atomic_ledger_chooses_its_write(spark, exists, partitions, call):
    """Only the choice of the write; the connectors are not installed here."""
    rows = MagicMock()
    rows.sparkSession.catalog.tableExists.return_value = exists
    lines = ["run_id", "batch_id", "# Partition Information", "# col_name", *partitions]
    rows.sparkSession.sql.return_value.collect.return_value = [SimpleNamespace(col_name=line) for line in lines]
    writer = rows.writeTo.return_value.using.return_value
    writer.partitionedBy.return_value = writer
    ops._write_atomic(rows, "c.s.t", "iceberg")
    called = {name for name in ("create", "overwritePartitions", "append") if getattr(writer, name).called}
    assert called == {call}


def test_write_retries_and_gives_up(spark, monkeypatch):
    calls, naps = [], []
    real = ops.insert

    def flaky(*args, **kwargs):
        calls.append(1)
        if len(calls) < 3:
            raise OSError("storage busy")
        return real(*args, **kwargs)

    monkeypatch.setattr(ops, "insert", flaky)
    monkeypatch.setattr(ops, "time", SimpleNamespace(sleep=naps.append))
    table = scratch_table(spark, "ledger")
    write_ledger(ledger(spark, row()), table, retry_delay=7)
    assert len(calls) == 3 and naps == [7, 7] and spark.table(table).count() == 1

    calls.clear()
    with pytest.raises(OSError):
        write_ledger(ledger(spark, row()), table, max_retries=2, retry_delay=0)
    assert len(calls) == 2


def test_text_times_are_cast(spark):
    df = spark.createDataFrame([("J", "2025-01-01 00:00:00")], "job_id string, start_time string")
    found = ledger_rows(df)
    assert dict(found.dtypes)["start_time"] == "timestamp" and found.first().start_time == START


def test_schema_diff_and_text(spark):
    old = spark.createDataFrame([("a", "int"), ("b", "int"), ("c", "string")], "column_name string, data_type string")
    new = spark.createDataFrame([("a", "int"), ("b", "double"), ("d", "date")], "column_name string, data_type string")
    diff = schema_diff(old, new, ["column_name"])
    assert {r.column_name: r.change for r in diff.collect()} == {
        "a": "SAME", "b": "TYPE_CHANGED", "c": "DROPPED", "d": "ADDED"
    }
    assert change_text(diff) == "TYPE_CHANGED b (int -> double); DROPPED c; ADDED d"
    assert change_text(schema_diff(old, old, ["column_name"])) == NO_CHANGE


def test_a_job_reported_very_often_is_one_row(spark):
    """A third of all rows belong to one job; it shrinks before the shuffle."""
    many = spark.range(30000, numPartitions=4).selectExpr(
        "'r1' AS run_id", "'2025010100' AS batch_id", "'daily' AS run_group",
        "IF(id % 3 = 0, 'hot', string(id)) AS job_id", "IF(id = 29997, 'FAILED', 'COMPLETED') AS status",
        "TIMESTAMP'2025-01-01 00:00:00' + MAKE_INTERVAL(0, 0, 0, 0, 0, 0, id) AS start_time",
    )
    rows = ledger_rows(many)
    found = consolidate(ledger(spark), rows)
    assert found.count() == 20001
    assert [(r.job_id, r.status) for r in found.where("job_id = 'hot'").collect()] == [("hot", "FAILED")]
    assert [r.job_id for r in jobs_failed_last(rows, "daily").collect()] == ["hot"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "SortAggregate" not in plan


def test_ledger_aggregates_by_hash(spark):
    rows = ledger(spark)
    assert "Window" not in failed_jobs(rows, "daily")._jdf.queryExecution().executedPlan().toString()  # combined map-side
    frames = [consolidate(rows, rows), jobs_failed_last(rows, "daily"), run_id_of_batch(rows)]
    for found in frames:
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and ("WindowGroupLimit" in plan or "HashAggregate" in plan)


def test_rerun_reads_from_a_stated_batch(spark):
    old, new = (ledger_rows(spark.sql(f"""SELECT 'r' AS run_id, '{batch}' AS batch_id, 'daily' AS run_group, '{job}' AS job_id,
        'FAILED' AS status, TIMESTAMP'2025-01-01 00:00:00' AS start_time""")) for batch, job in (("2025010100", "A"), ("2025020100", "B")))
    rows = old.union(new)
    assert {r.job_id for r in jobs_failed_last(rows, "daily").collect()} == {"A", "B"}
    assert {r.job_id for r in jobs_failed_last(rows, "daily", "2025010200").collect()} == {"B"}


def test_presence_of_a_column_is_not_its_type(spark):
    old = spark.createDataFrame([("a", None), ("b", "int")], "column_name string, data_type string")
    new = spark.createDataFrame([("a", None), ("b", None)], "column_name string, data_type string")
    assert {r.column_name: r.change for r in schema_diff(old, new, ["column_name"]).collect()} == {"a": "SAME", "b": "TYPE_CHANGED"}
