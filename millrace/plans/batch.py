"""A batch: the enabled tables of a pipeline, loaded side by side, and their ledger rows."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.errors import classify
from millrace.model import OUTCOME_SCHEMA, PipelineConfig, RunContext, TableJob, is_yes
from millrace.operators.cdc import Mark
from millrace.operators.filelog import steady
from millrace.operators.intents import DONE, Intent
from millrace.operators.landing import ATOMIC_FORMATS
from millrace.operators.ledger import (
    batch_summary,
    completion_rows,
    consolidate,
    ensure_states,
    initial_rows,
    jobs_to_rerun,
    note_states,
    state_table,
    with_run,
    write_ledger,
)
from millrace.operators.profiles import ProfileStore
from millrace.operators.reports import RunLog, batch_tables, job_report, write_csv
from millrace.plans.table_load import Outcome, Target, load_table
from millrace.plans.workers import side_by_side
from millrace.sources.lake import Source, enabled_jobs, open_source, pipeline_config


@dataclass(frozen=True)
class BatchResult:
    code: int
    run: RunContext | None
    ledger: DataFrame | None
    summary: str
    log: RunLog


def attempt(job: TableJob, source: Source, target: Target, run: RunContext, log: RunLog,
            mark: Mark | None = None, pending: list[Intent] | None = None,
            ended: list[Intent] | None = None) -> Outcome:
    """The outcome of a load; a failure is one too, so that the other tables go on."""
    started = datetime.now()
    try:
        outcome = load_table(job, source, target, run, mark, pending, ended)
        log.log(f"{job.job_id}: {outcome.records_processed} rows landed in {target.table(job)}")
        return outcome
    except Exception as error:
        log.log(f"{job.job_id}: {error}", "ERROR")
        return Outcome(job, started, datetime.now(), False, error_message=str(error))


def ledger_of(spark: SparkSession, outcomes: list[Outcome], run: RunContext) -> DataFrame:
    """The consolidated rows of a run; a failure carries its class as comment."""
    rows = with_run(spark.createDataFrame([outcome.row() for outcome in outcomes], OUTCOME_SCHEMA), run)
    classed = classify(rows, "error_message").withColumn(
        "comments",
        F.when(F.col("has_data"), F.col("comments")).otherwise(F.concat_ws(": ", "error_type", "description")),
    )
    return consolidate(initial_rows(rows), completion_rows(classed))


def run_jobs(
    spark: SparkSession,
    jobs: list[TableJob],
    source: Source,
    target: Target,
    run: RunContext,
    ledger_table: str,
    log: RunLog,
    max_workers: int = 5,
    deadline: float | None = None,
) -> DataFrame:
    """Loads every job, writes the ledger and returns the run's ledger rows.

    The watermarks of all jobs are looked up at once, and so are loads that broke off. Threads only submit Spark jobs; a load
    that takes more than ``deadline`` seconds is stopped and fails, without the others. The latest state of each job goes to a
    table beside the ledger, before the ledger, so that a rerun never reads the history.
    """
    changing = [job for job in jobs if job.change_rule]
    known = target.tracked(changing) if changing else {}
    pending = target.pending(jobs)
    ended: list[Intent] = []

    def run_one(job: TableJob) -> Outcome:
        own = (job.job_id, job.source_table)
        return attempt(job, source, target, run, log, known.get(own, Mark()), pending.get(own, []), ended)

    def too_late(job: TableJob) -> Outcome:
        message = f"timeout: the load of {target.table(job)} took more than {deadline:g} seconds"
        log.log(f"{job.job_id}: {message}", "ERROR")
        return Outcome(job, started, datetime.now(), False, error_message=message)

    started = datetime.now()
    outcomes = side_by_side(spark, jobs, run_one, too_late, max_workers, deadline, target.table)
    target.note(ended, DONE)
    rows = ledger_of(spark, outcomes, run)
    ensure_states(spark, ledger_table, target.fmt)
    note_states(rows, state_table(ledger_table), target.fmt)
    write_ledger(rows, ledger_table, target.fmt)
    own = (F.col("batch_id") == run.batch_id) & (F.col("run_id") == run.run_id)
    return spark.table(ledger_table).where(own)


def run_batch(
    spark: SparkSession,
    alerts: str,
    app_pipeline: str,
    run_group: str,
    *,
    rerun: bool = False,
    rerun_since: str | None = None,
    source: Source | None = None,
    fmt: str = "parquet",
    run_ts: datetime | None = None,
    table_deadline: float | None = None,
) -> BatchResult:
    """Runs the active pipeline of a run group; with ``rerun`` only the tables that failed last.

    ``rerun_since`` is the first batch that a rerun looks at. ``table_deadline`` is how many seconds a table may take.

    ``alerts`` names the table of pipeline settings. The code is 0 when the batch ran, whatever became
    of single tables, and 1 when it could not run. The config rows are the one thing that the driver
    holds.
    """
    log = RunLog()
    pipeline: PipelineConfig | None = None
    run = ledger = None
    summary, code = "", 0
    try:
        pipeline = pipeline_config(spark.table(alerts), app_pipeline, run_group)
        run = RunContext.start(spark, run_group, run_ts)
        ledger_table = pipeline.table(pipeline.job_status_tbl)
        config = enabled_jobs(spark.table(pipeline.table(pipeline.ingest_tbl)), app_pipeline, run_group)
        # Read once: a rerun's selection changes as soon as the new rows are written.
        if rerun:
            ensure_states(spark, ledger_table, fmt)
            rows = steady(spark, state_table(ledger_table), lambda known: jobs_to_rerun(config, known, run_group, rerun_since).collect())
        else:
            rows = config.collect()
        config = spark.createDataFrame(rows, config.schema)
        jobs = [TableJob.from_row(row) for row in rows]
        if not jobs:
            log.log("nothing to rerun" if rerun else "no enabled jobs")
        else:
            log.log(f"batch {run.batch_id}, run {run.run_id}: {len(jobs)} jobs")
            tracker = pipeline.table(pipeline.cdc_tracker_tbl)
            profiles = None if fmt in ATOMIC_FORMATS else ProfileStore(spark, f"{tracker}_profiles", fmt)
            origin = source or open_source(spark, pipeline.source_db_config, pipeline.dbpass, profiles)
            target = Target(spark, tracker, pipeline.catalog_name, fmt)
            reports = bool(pipeline.log_bucket) and is_yes(pipeline.statusEmails)
            if reports:
                write_csv(batch_tables(config), f"{pipeline.report_folder(run)}/tables")
            ledger = run_jobs(spark, jobs, origin, target, run, ledger_table, log, pipeline.max_workers, table_deadline)
            if reports:
                write_csv(job_report(ledger, config), f"{pipeline.report_folder(run)}/jobs")
            summary = batch_summary(ledger).first().jobs_status
            log.log(summary)
    except Exception as error:
        message = str(error).replace("\n", " ")
        log.log(f"the batch could not run: {message}", "ERROR")
        code = 1
    if pipeline is not None and pipeline.log_bucket:
        log.save(spark, pipeline.log_folder)
    return BatchResult(code, run, ledger, summary, log)
