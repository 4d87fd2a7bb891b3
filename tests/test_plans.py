"""Loads and batches from frames that stand for the source tables."""

from __future__ import annotations

from datetime import datetime

import pytest

from millrace.model import INGEST_CONFIG_SCHEMA, RunContext, TableJob
from millrace.plans import batch as batch_module
from millrace.plans import table_load
from millrace.plans.batch import run_batch
from millrace.plans.table_load import Target, load_table
from millrace.session import scratch_database, scratch_table, shared_dir
from millrace.sources.lake import LakeSource

RUNS = [datetime(2024, 1, 1, 10, 30), datetime(2024, 1, 1, 12, 45), datetime(2024, 1, 2, 0, 1)]


def source(spark, **tables):
    def read(schema, name):
        if name not in tables:
            raise RuntimeError(f"ORA-00942: table or view does not exist: {name}")
        return tables[name]

    return LakeSource(spark, read)


def stamped(spark, *hours):
    rows = [(i, f"2024-01-01 {hour}") for i, hour in enumerate(hours)]
    return spark.createDataFrame(rows, "id bigint, ts string").selectExpr("id", "CAST(ts AS timestamp) AS ts")


@pytest.fixture
def place(spark):
    schema, table = scratch_table(spark, "t").split(".")
    return Target(spark, scratch_table(spark, "tracker")), schema, table


def load(target, job, origin, run_ts):
    return load_table(job, origin, target, RunContext("r", "b", "a", "daily", run_ts))


def test_runs_have_their_own_ids(spark):
    one, two = (RunContext.start(spark, "daily", RUNS[0]) for _ in range(2))
    assert one.run_id != two.run_id and one.batch_id == two.batch_id == "2024010110"
    assert one.load_date == "20240101" and one.spark_app_id == spark.sparkContext.applicationId


def test_incremental_runs_meet(spark, place):
    target, schema, table = place
    job = TableJob("J", "s", "ev", schema, table, load_type="INCREMENTAL", cdc_type="TIMESTAMP",
                   cdc_modified_date_column="ts", target_partition_by="SNAPSHOT_DATE")
    data = source(spark, ev=stamped(spark, "09:00:00", "10:00:00", "11:59:59", "12:00:00", "23:59:59"))
    outcomes = [load(target, job, data, run_ts) for run_ts in [*RUNS, RUNS[2]]]
    assert [outcome.records_processed for outcome in outcomes] == [1, 2, 2, 0]
    assert outcomes[0].load_date == "20240101" and outcomes[2].load_date == "20240102"
    assert [row.ts_hour for row in spark.table(target.tracker).orderBy("ts_hour").collect()] == [
        "2024010110", "2024010112", "2024010200", "2024010200"
    ]
    assert spark.table(target.table(job)).count() == 5


def test_append_key_runs(spark, place):
    target, schema, table = place
    job = TableJob("J", "s", "t", schema, table, load_type="INCREMENTAL", cdc_type="APPEND_KEY",
                   cdc_append_key_column="id")
    small, large = spark.range(0, 11).toDF("id"), spark.range(0, 1200).toDF("id")
    counts = [load(target, job, source(spark, t=rows), RUNS[0]).records_processed for rows in (small, large, large)]
    assert counts == [11, 1189, 0]
    assert max(row.key_value for row in spark.table(target.tracker).collect()) == 1199


def test_tracker_with_untyped_watermarks_goes_on(spark, place):
    target, schema, table = place
    spark.sql(f"CREATE TABLE {target.tracker} (job_id string, source_table string, updated_at string) USING parquet")
    spark.sql(f"INSERT INTO {target.tracker} VALUES ('J', 'ev', '2024010110')")
    job = TableJob("J", "s", "ev", schema, table, load_type="INCREMENTAL", cdc_type="TIMESTAMP",
                   cdc_modified_date_column="ts")
    data = source(spark, ev=stamped(spark, "09:00:00", "10:00:00", "11:59:59", "12:00:00"))
    assert [load(target, job, data, run_ts).records_processed for run_ts in RUNS[1:]] == [2, 1]
    assert spark.table(target.tracker).count() == 3


def test_windows_never_overwrite_partitions(spark, place):
    """Two windows of one day share a snapshot; the second must not drop the first."""
    target, schema, table = place
    job = TableJob("J", "s", "ev", schema, table, load_type="INCREMENTAL", cdc_type="TIMESTAMP",
                   cdc_modified_date_column="ts", target_partition_by="SNAPSHOT_DATE", target_partition_overwrite="Y")
    data = source(spark, ev=stamped(spark, "09:00:00", "11:00:00"))
    for run_ts in RUNS[:2]:
        load(target, job, data, run_ts)
    assert spark.table(target.table(job)).count() == 2


def test_failed_landing_leaves_the_watermark(spark, place):
    target, schema, table = place
    job = TableJob("J", "s", "ev", schema, table, load_type="INCREMENTAL", cdc_type="TIMESTAMP",
                   cdc_modified_date_column="ts", target_partition_by="nope")
    with pytest.raises(ValueError):
        load(target, job, source(spark, ev=stamped(spark, "09:00:00")), RUNS[0])
    assert spark.table(target.tracker).count() == 0


def test_full_load_modes(spark, place):
    target, schema, table = place
    rows = source(spark, t=spark.range(3).toDF("id"))
    plain = TableJob("J", "s", "t", schema, table)
    assert [load(target, plain, rows, RUNS[0]).records_processed for _ in range(2)] == [3, 3]
    assert spark.table(target.table(plain)).count() == 6
    load(target, TableJob("J", "s", "t", schema, table, target_truncate="y"), rows, RUNS[0])
    assert spark.table(target.table(plain)).count() == 3
    load(target, TableJob("J", "s", "t", schema, table, target_recreate="N"), rows, RUNS[0])
    assert spark.table(target.table(plain)).count() == 6
    load(target, TableJob("J", "s", "t", schema, table, target_recreate="Y"), rows, RUNS[0])
    assert spark.table(target.table(plain)).count() == 3


def test_missing_load_type_is_full(spark, place):
    target, schema, table = place
    job = TableJob("J", "s", "ev", schema, table, cdc_type="TIMESTAMP", cdc_modified_date_column="ts")
    data = source(spark, ev=stamped(spark, "09:00:00", "23:00:00"))
    assert load(target, job, data, RUNS[0]).records_processed == 2


def test_schema_changes_are_reported(spark, place):
    target, schema, table = place
    job = TableJob("J", "s", "t", schema, table)
    first = load(target, job, source(spark, t=spark.range(3).toDF("id")), RUNS[0])
    grown = load(target, job, source(spark, t=spark.range(3).selectExpr("id", "'x' AS note")), RUNS[0])
    assert first.comments == "No schema changes detected." and grown.comments == "ADDED note"
    gone = load(target, job, source(spark, t=spark.range(3).selectExpr("'y' AS note", "1 AS more")), RUNS[0])
    assert gone.comments == "DROPPED id; ADDED more"


def test_derived_columns_are_no_schema_change(spark, place):
    target, schema, table = place
    for spec in ("SNAPSHOT_DATE", "SNAPSHOT_DATE"):
        job = TableJob("J", "s", "t", schema, table, target_partition_by=spec)
        assert load(target, job, source(spark, t=spark.range(3).toDF("id")), RUNS[0]).comments == "No schema changes detected."


def test_one_tracker_aggregate_for_a_batch(spark, place, monkeypatch):
    target, schema, table = place
    jobs = [TableJob(f"J{i}", "s", "ev", schema, f"{table}_{i}", load_type="INCREMENTAL", cdc_type="TIMESTAMP",
                     cdc_modified_date_column="ts") for i in range(3)]
    data = source(spark, ev=stamped(spark, "09:00:00", "10:00:00", "11:59:59"))
    seen = []
    real = table_load.marks
    monkeypatch.setattr(table_load, "marks", lambda rows, wanted: seen.append(len(wanted)) or real(rows, wanted))
    monkeypatch.setattr(table_load, "TRACKER_FILES", 2)
    for i, run_ts in enumerate(RUNS[:2]):
        run = RunContext(f"r{i}", "b", "a", "daily", run_ts)
        batch_module.run_jobs(spark, jobs, data, target, run, f"{target.tracker}_ledger", batch_module.RunLog())
    assert seen == [3, 3]
    assert [spark.table(target.table(job)).count() for job in jobs] == [3, 3, 3]
    assert spark.table(target.tracker).count() == 6
    target.tracked(jobs)
    assert len(spark.table(target.tracker).inputFiles()) == 1 and spark.table(target.tracker).count() == 6


def test_tracker_of_whole_keys_takes_fractions(spark, place):
    target, schema, table = place
    spark.sql(f"CREATE TABLE {target.tracker} (job_id string, source_table string, ts_hour string, key_value bigint) USING parquet")
    spark.sql(f"INSERT INTO {target.tracker} VALUES ('J', 't', NULL, 2)")
    job = TableJob("J", "s", "t", schema, table, load_type="INCREMENTAL", cdc_type="APPEND_KEY", cdc_append_key_column="k")
    rows = spark.createDataFrame([(1.0,), (2.0,), (3.5,)], "k double")
    assert [load(target, job, source(spark, t=rows), RUNS[0]).records_processed for _ in range(2)] == [1, 0]


def test_no_columns(spark, place):
    target, schema, table = place
    empty = spark.createDataFrame([()], "")
    with pytest.raises(ValueError, match="has no columns"):
        load(target, TableJob("J", "s", "t", schema, table), source(spark, t=empty), RUNS[0])


@pytest.fixture
def pipeline(spark):
    """A pipeline of three tables in one database; gives the name of its settings table."""
    database = scratch_database(spark)
    names = {stem: scratch_table(spark, stem).split(".")[1] for stem in ("alerts", "ingest", "ledger", "tracker")}
    fields = INGEST_CONFIG_SCHEMA.fieldNames()
    rows = [
        {"job_id": job, "source_schema": "s", "source_table": table, "target_schema": database,
         "target_table": f"{table}_{names['ingest']}", "app_pipeline": "p", "run_group": "daily",
         "is_enabled": enabled, "is_active": "Y", "load_type": "FULL", "target_truncate": "Y"}
        for job, table, enabled in (("J1", "a", "Y"), ("J2", "b", "Y"), ("J3", "c", "Y"), ("J4", "d", "N"))
    ]
    config = spark.createDataFrame([tuple(row.get(f) for f in fields) for row in rows], INGEST_CONFIG_SCHEMA)
    config.write.saveAsTable(f"{database}.{names['ingest']}")
    logs = shared_dir(spark, "logs")
    spark.createDataFrame(
        [("p", "daily", "Y", {"tbl_schema": database}, names["ingest"], names["ledger"], names["tracker"],
          f"{logs}/", "ref/", 2)],
        "app_pipeline string, run_group string, is_active string, schema_config map<string,string>, "
        "ingest_tbl string, job_status_tbl string, cdc_tracker_tbl string, log_bucket string, "
        "log_reference string, max_workers int",
    ).write.saveAsTable(f"{database}.{names['alerts']}")
    return f"{database}.{names['alerts']}", f"{database}.{names['ledger']}", f"{logs}/ref/"


def test_batch_isolates_failures_and_reruns_only_them(spark, pipeline):
    alerts, ledger, logs = pipeline
    a, b, c = (spark.range(n).toDF("id") for n in (3, 4, 5))
    first = run_batch(spark, alerts, "p", "daily", source=source(spark, a=a, c=c), run_ts=RUNS[0])
    assert first.code == 0 and first.summary == "Successful: 2 Fail: 1 Total: 3"
    found = {row.job_id: row for row in first.ledger.collect()}
    assert set(found) == {"J1", "J2", "J3"}
    assert (found["J1"].status, found["J1"].records_processed, found["J1"].run_group) == ("COMPLETED", 3, "daily")
    assert found["J2"].status == "FAILED" and found["J2"].error_message.startswith("ORA-00942")
    assert found["J2"].comments == "NON_CRITICAL: Table or view does not exist"
    assert found["J2"].dlh_layer == "staging" and found["J2"].end_time >= found["J2"].start_time

    again = run_batch(spark, alerts, "p", "daily", rerun=True, source=source(spark, a=a, b=b, c=c), run_ts=RUNS[1])
    assert again.code == 0 and again.summary == "Successful: 1 Fail: 0 Total: 1"
    assert [row.job_id for row in again.ledger.collect()] == ["J2"]
    assert spark.table(ledger).count() == 4

    nothing = run_batch(spark, alerts, "p", "daily", rerun=True, source=source(spark), run_ts=RUNS[2])
    assert nothing.code == 0 and nothing.ledger is None
    assert "nothing to rerun" in nothing.log.content()

    lines = [row.value for row in spark.read.text(logs + "log_date=*").collect()]
    assert sum("Successful: 2 Fail: 1 Total: 3" in line for line in lines) == 1
    reports = spark.read.option("header", True).csv(logs + "p/20240101/reports/*/*/jobs")
    assert reports.count() == 4 and reports.where("failure_reason <> 'N/A'").count() == 1
    tables = spark.read.option("header", True).csv(logs + "p/20240101/reports/*/*/tables")
    assert tables.count() == 4


def test_two_runs_of_one_hour_keep_their_rows(spark, pipeline):
    alerts, ledger, _ = pipeline
    tables = source(spark, **{name: spark.range(2).toDF("id") for name in "abc"})
    for _ in range(2):
        run_batch(spark, alerts, "p", "daily", source=tables, run_ts=RUNS[0])
    assert spark.table(ledger).count() == 6


def test_batch_that_cannot_run(spark, pipeline):
    alerts, _, _ = pipeline
    unknown = run_batch(spark, alerts, "p", "hourly", source=source(spark))
    assert unknown.code == 1 and "no active settings" in unknown.log.content()
    assert run_batch(spark, "no_such_database.alerts", "p", "daily").code == 1


def test_unwritable_ledger_is_code_one(spark, pipeline, monkeypatch):
    alerts, _, _ = pipeline

    def refuse(*args, **kwargs):
        raise OSError("storage gone")

    monkeypatch.setattr(batch_module, "write_ledger", refuse)
    tables = source(spark, **{name: spark.range(2).toDF("id") for name in "abc"})
    result = run_batch(spark, alerts, "p", "daily", source=tables, run_ts=RUNS[0])
    assert result.code == 1 and "storage gone" in result.log.content()


def test_jobs_with_one_target_take_turns(spark, place):
    target, schema, table = place
    jobs = [TableJob(f"J{i}", "s", "t", schema, table) for i in range(4)]
    rows = source(spark, t=spark.range(100).toDF("id"))
    run = RunContext.start(spark, "daily", RUNS[0])
    ledger = batch_module.run_jobs(spark, jobs, rows, target, run, scratch_table(spark, "ledger"), batch_module.RunLog())
    assert {row.status for row in ledger.collect()} == {"COMPLETED"}
    assert spark.table(target.table(jobs[0])).count() == 400
