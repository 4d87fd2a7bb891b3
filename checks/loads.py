"""Whole loads and a batch."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.tables import source
from millrace.model import ALERT_CONFIG_SCHEMA, INGEST_CONFIG_SCHEMA, RunContext, TableJob
from millrace.operators.landing import land
from millrace.plans.batch import run_batch
from millrace.plans.table_load import Target, load_table
from millrace.session import scratch_database, scratch_table
from millrace.sources.lake import LakeSource

RUNS = [datetime(2024, 1, 12, 8, 30), datetime(2024, 1, 31, 23, 5)]


def _load(spark: SparkSession, sf_dir: str, job: dict, runs: list[datetime]) -> DataFrame:
    schema, table = scratch_table(spark, job["source_table"]).split(".")
    typed = TableJob("J1", "given", job.pop("source_table"), schema, table, **job)
    target = Target(spark, scratch_table(spark, "tracker"))
    for run_ts in runs:
        load_table(typed, source(spark, sf_dir), target, RunContext.start(spark, "daily", run_ts))
    return spark.table(target.table(typed))


def load_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full load with stamp, fields and condition, run twice with truncate."""
    job = {
        "source_table": "orders",
        "load_type": "FULL",
        "source_fields": "o_orderkey, o_custkey, o_totalprice, o_orderdate",
        "source_where_clause": "o_orderstatus <> 'P'",
        "target_partition_by": "SNAPSHOT_DATE",
        "target_truncate": "Y",
    }
    return _load(spark, sf_dir, job, RUNS)


def load_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two hour windows; the second begins where the first ended."""
    job = {
        "source_table": "events",
        "load_type": "INCREMENTAL",
        "cdc_type": "TIMESTAMP",
        "cdc_modified_date_column": "ts",
        "target_partition_by": "SNAPSHOT_DATE",
    }
    return _load(spark, sf_dir, job, RUNS)


def load_append_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs by append key; the second finds nothing new."""
    job = {
        "source_table": "events",
        "load_type": "INCREMENTAL",
        "cdc_type": "APPEND_KEY",
        "cdc_append_key_column": "event_id",
        "source_where_clause": "event_type = 'click' OR event_type = 'error'",
    }
    return _load(spark, sf_dir, job, RUNS)


class Cut(Exception):
    """The end of a load that a query cuts."""


def load_exactly_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads cut at each of their steps, some with half of their rows left in the table, and repeated; the rows, once each."""
    events = source(spark, sf_dir).read("given", "events").withColumn("key", F.col("event_id"))
    schema, landed = scratch_table(spark, "once").split(".")
    rules = [
        {"load_type": "INCREMENTAL", "cdc_type": "TIMESTAMP", "cdc_modified_date_column": "ts", "target_partition_by": "event_type"},
        {"load_type": "INCREMENTAL", "cdc_type": "APPEND_KEY", "cdc_append_key_column": "event_id"},
        {"target_table_options": {"millrace.widen": "Y"}, "load_type": "INCREMENTAL", "cdc_type": "TIMESTAMP",
         "cdc_modified_date_column": "ts"},
    ]
    cuts = [("planned", "landed", "marked"), ("planned", "done"), ("landed", "marked")]
    found = None
    for number, rule in enumerate(rules):
        job = TableJob(f"J{number}", "given", "events", schema, f"{landed}_{number}", **rule)
        target = Target(spark, scratch_table(spark, "tracker"))

        def load(run_ts: datetime, rows: DataFrame, cut: str | None = None, target=target, job=job) -> None:
            def step(name: str) -> None:
                if name == cut:
                    if name == "planned" and number < 2:  # what a write leaves that dies before its end
                        left = target.pending([job])[job.job_id, job.source_table][0]
                        land(rows.where("event_id % 2 = 0"), target.table(job), load_date="", partition_by=job.target_partition_by,
                             load_id=left.load_id)
                    raise Cut(name)

            target.progress = step
            try:
                load_table(job, LakeSource(spark, lambda schema, table: rows), target, RunContext.start(spark, "daily", run_ts))
            except Cut:
                pass

        first = events.where(f"ts < TIMESTAMP_NTZ'{RUNS[0]:%Y-%m-%d %H:00:00}'")
        if number == 2:
            first = first.withColumn("key", F.col("key").cast("int"))  # the second load must rewrite the table
        for cut in cuts[number]:
            load(RUNS[0], first, cut)
        for cut in cuts[number]:
            load(RUNS[1], events, cut)
        one = spark.table(target.table(job)).select(F.lit(number).alias("job"), "event_id", "ts", "event_type", "value",
                                                    F.col("key").cast("long").alias("key"))
        found = one if found is None else found.unionAll(one)
    return found


def load_schema_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders, then orders without a column and with another: what the second load reports."""
    orders = source(spark, sf_dir).read("given", "orders")
    other = orders.drop("o_orderpriority").withColumn("o_note", F.col("o_orderstatus"))
    schema, table = scratch_table(spark, "changing").split(".")
    job = TableJob("J1", "given", "orders", schema, table, target_partition_by="SNAPSHOT_DATE")
    target = Target(spark, scratch_table(spark, "tracker"))
    outcomes = [
        load_table(job, LakeSource(spark, lambda schema, name, rows=rows: rows), target, RunContext.start(spark, "daily", ts))
        for rows, ts in zip((orders, other), RUNS, strict=True)
    ]
    found = [(i, o.records_processed, o.column_count, o.comments) for i, o in enumerate(outcomes)]
    return spark.createDataFrame(found, "load int, records_processed bigint, column_count int, comments string")


def batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four tables of one pipeline, of which one does not exist and one is disabled."""
    database = scratch_database(spark)
    alerts, ingest, ledger, tracker = (
        scratch_table(spark, stem).split(".")[1] for stem in ("alerts", "ingest", "ledger", "tracker")
    )
    jobs = [
        {"job_id": "J1", "source_table": "lineitem", "target_partition_by": "SNAPSHOT_DATE"},
        {"job_id": "J2", "source_table": "events", "load_type": "INCREMENTAL", "cdc_type": "TIMESTAMP",
         "cdc_modified_date_column": "ts"},
        {"job_id": "J3", "source_table": "no_such_table"},
        {"job_id": "J4", "source_table": "orders", "is_enabled": "N"},
    ]
    suffix = ingest.rsplit("_", 1)[1]
    common = {"source_schema": "given", "target_schema": database, "app_pipeline": "p", "run_group": "daily",
              "is_enabled": "Y", "is_active": "Y"}
    rows = [{**common, "target_table": f"{job['source_table']}_{suffix}", **job} for job in jobs]
    names = INGEST_CONFIG_SCHEMA.fieldNames()
    config = spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], INGEST_CONFIG_SCHEMA)
    config.write.saveAsTable(f"{database}.{ingest}")
    settings = {"app_pipeline": "p", "run_group": "daily", "is_active": "Y", "schema_config": {"tbl_schema": database},
                "ingest_tbl": ingest, "job_status_tbl": ledger, "cdc_tracker_tbl": tracker}
    row = tuple(settings.get(name) for name in ALERT_CONFIG_SCHEMA.fieldNames())
    spark.createDataFrame([row], ALERT_CONFIG_SCHEMA).write.saveAsTable(f"{database}.{alerts}")
    result = run_batch(spark, f"{database}.{alerts}", "p", "daily", source=source(spark, sf_dir), run_ts=RUNS[0])
    return result.ledger.select(
        "job_id", "batch_id", "run_group", "dlh_layer", "status", "column_count", "records_processed",
        "records_rejected", "load_date", "comments", F.lit(result.summary).alias("summary"),
    )


QUERIES = {
    "load_full": load_full,
    "load_incremental": load_incremental,
    "load_append_key": load_append_key,
    "load_exactly_once": load_exactly_once,
    "load_schema_change": load_schema_change,
    "run_batch": batch,
}

ORACLES = {
    "load_full": """
        SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, '20240131' AS SNAPSHOT_DATE
        FROM orders WHERE o_orderstatus <> 'P'""",
    "load_incremental": """
        SELECT *, CASE WHEN strftime(ts, '%Y%m%d%H') < '2024011208' THEN '20240112' ELSE '20240131' END
                  AS SNAPSHOT_DATE
        FROM events WHERE strftime(ts, '%Y%m%d%H') < '2024013123'""",
    "load_append_key": "SELECT * FROM events WHERE event_type = 'click' OR event_type = 'error'",
    "load_exactly_once": """
        SELECT CAST(0 AS INTEGER) AS job, event_id, ts, event_type, value, event_id AS key FROM events
        WHERE strftime(ts, '%Y%m%d%H') < '2024013123'
        UNION ALL
        SELECT 1, event_id, ts, event_type, value, event_id FROM events
        WHERE event_id <= (SELECT max(event_id) FROM events WHERE strftime(ts, '%Y%m%d%H') < '2024011208')
          AND strftime(ts, '%Y%m%d%H') < '2024011208'
           OR event_id > (SELECT max(event_id) FROM events WHERE strftime(ts, '%Y%m%d%H') < '2024011208')
        UNION ALL
        SELECT 2, event_id, ts, event_type, value, event_id FROM events WHERE strftime(ts, '%Y%m%d%H') < '2024013123'""",
    "load_schema_change": """
        SELECT CAST(0 AS INTEGER) AS load, count(*) AS records_processed, CAST(6 AS INTEGER) AS column_count,
               'No schema changes detected.' AS comments FROM orders
        UNION ALL
        SELECT 1, count(*), 6, 'ADDED o_note; DROPPED o_orderpriority' FROM orders""",
    "run_batch": """
        SELECT job_id, '2024011208' AS batch_id, 'daily' AS run_group, 'staging' AS dlh_layer, status,
               CAST(column_count AS INTEGER) AS column_count, records_processed,
               CAST(0 AS BIGINT) AS records_rejected, load_date, comments,
               'Successful: 2 Fail: 1 Total: 3' AS summary
        FROM (SELECT 'J1' AS job_id, 'COMPLETED' AS status, 11 AS column_count, count(*) AS records_processed,
                     '20240112' AS load_date, 'No schema changes detected.' AS comments FROM lineitem
              UNION ALL
              SELECT 'J2', 'COMPLETED', 6, count(*), '', 'No schema changes detected.'
              FROM events WHERE strftime(ts, '%Y%m%d%H') < '2024011208'
              UNION ALL
              SELECT 'J3', 'FAILED', 0, 0, '', 'NON_CRITICAL: Error occurred')""",
}
