"""The job ledger: status rows, consolidation, rerun selection, summaries and the ledger table."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.errors import scrubbed
from millrace.model import COMPLETED, FAILED, LAYER, LEDGER_SCHEMA, STARTED, RunContext
from millrace.operators.filelog import add, compact
from millrace.operators.landing import ATOMIC_FORMATS, create_table, insert, partition_columns

# One row of the ledger; none of these may be null.
LEDGER_KEY = ["run_id", "batch_id", "job_id"]
LEDGER_PARTITIONS = ["batch_id", "run_id"]
# What decides between rows of equal start.
STATE_ORDER = ["batch_id", "run_id", "status", "spark_app_id"]
# The latest state of a job.
STATE_SCHEMA = T.StructType([LEDGER_SCHEMA[name] for name in ("run_group", "job_id", "start_time", *STATE_ORDER)])
# The property of a table of states that has all of its ledger's history.
HISTORY_READ = "millrace.history_read"


def with_run(df: DataFrame, run: RunContext) -> DataFrame:
    """The values of a run on every row."""
    return df.withColumns(
        {
            "run_id": F.lit(run.run_id),
            "batch_id": F.lit(run.batch_id),
            "spark_app_id": F.lit(run.spark_app_id),
            "run_group": F.lit(run.run_group),
        }
    )


def ledger_rows(df: DataFrame, **given: Column) -> DataFrame:
    """The 17 typed ledger columns: given expressions, else the frame's own column, else empty."""
    empty = {
        "dlh_layer": F.lit(LAYER),
        "column_count": F.lit(0),
        "records_processed": F.lit(0),
        "records_rejected": F.lit(0),
        "schema": F.lit(""),
        "error_message": F.lit(""),
        "load_date": F.lit(""),
        "comments": F.lit(""),
    }
    chosen = []
    for field in LEDGER_SCHEMA.fields:
        value = given.get(field.name)
        if value is None:
            value = F.col(field.name) if field.name in df.columns else empty.get(field.name, F.lit(None))
        chosen.append(value.cast(field.dataType).alias(field.name))
    return df.select(*chosen)


def initial_rows(jobs: DataFrame) -> DataFrame:
    """STARTED rows for config rows that carry the run's values and a start time."""
    zero, blank = F.lit(0), F.lit("")
    return ledger_rows(
        jobs.select("run_id", "batch_id", "spark_app_id", "run_group", "job_id", "target_table", "start_time"),
        table_name=F.col("target_table"),
        status=F.lit(STARTED),
        column_count=zero,
        records_processed=zero,
        load_date=blank,
    )


def update_rows(states: DataFrame) -> DataFrame:
    """Rows for reported states; only a finished state has an end time, and missing values are empty."""
    finished = F.col("status").isin(COMPLETED, FAILED)
    return ledger_rows(
        states,
        end_time=F.when(finished, F.col("end_time")),
        records_processed=F.coalesce("records_processed", F.lit(0)),
        error_message=F.coalesce(F.replace("error_message", F.lit("'"), F.lit("")), F.lit("")),
        load_date=F.coalesce("load_date", F.lit("")),
    )


def completion_rows(outcomes: DataFrame) -> DataFrame:
    """Final rows for load outcomes; run group and layer stay null and come from the initial row."""
    loaded = F.col("has_data")
    return ledger_rows(
        outcomes,
        run_group=F.lit(None),
        dlh_layer=F.lit(None),
        table_name=F.concat_ws(".", "target_schema", "target_table"),
        status=F.when(loaded, F.lit(COMPLETED)).otherwise(F.lit(FAILED)),
        column_count=F.when(loaded, F.col("column_count")).otherwise(F.lit(0)),
        records_processed=F.when(loaded, F.col("records_processed")).otherwise(F.lit(0)),
        error_message=F.coalesce(scrubbed("error_message"), F.lit("")),
        load_date=F.coalesce("load_date", F.lit("")),
        comments=F.coalesce("comments", F.lit("")) if "comments" in outcomes.columns else F.lit(""),
    )


def union_by_name(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows; a column that one frame lacks is null there."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def _picked(df: DataFrame, keys: list[str], at: Column, rest: list[str], latest: bool = True) -> DataFrame:
    """One row per key: that of the latest (or earliest) time, of equal ones that with the largest (smallest) ``rest``.

    The first row of a window is limited map-side too, so a key with very many rows shrinks before the shuffle. A missing
    time is the earliest.
    """
    order = [F.desc_nulls_last(c) if latest else F.asc_nulls_first(c) for c in ("_at", *rest)]
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_at", at).withColumn("_number", number).where("_number = 1").drop("_number", "_at")


def consolidate(initial: DataFrame, updated: DataFrame) -> DataFrame:
    """One row per run, batch and job, each column from the updated row where it has a value.

    Of several rows of a side the latest counts; the two sides meet in a full outer join on the key.
    """
    names = LEDGER_SCHEMA.fieldNames()
    rest = [name for name in names if name not in LEDGER_KEY]
    at = F.coalesce("end_time", "start_time")
    sides = [_picked(side.select(*names), LEDGER_KEY, at, rest) for side in (initial, updated)]
    old, new = (side.select(*LEDGER_KEY, *[F.col(n).alias(f"_{i}_{n}") for n in rest]) for i, side in enumerate(sides))
    both = old.join(new, LEDGER_KEY, "full_outer")
    return both.select(
        *[F.col(n) if n in LEDGER_KEY else F.coalesce(f"_1_{n}", f"_0_{n}").alias(n) for n in names]
    )


def run_id_of_batch(ledger: DataFrame) -> DataFrame:
    """The run that started first, for every batch."""
    rows = ledger.select("batch_id", "run_id", "start_time")
    return _picked(rows, ["batch_id"], F.col("start_time"), ["run_id"], latest=False).select("batch_id", "run_id")


def failed_jobs(ledger: DataFrame, run_group: str) -> DataFrame:
    """Jobs of a run group with any failure, with their largest batch and application."""
    failed = ledger.where((F.col("run_group") == run_group) & (F.col("status") == FAILED))
    return failed.groupBy("job_id").agg(F.max("batch_id").alias("batch_id"), F.max("spark_app_id").alias("spark_app_id"))


def jobs_failed_last(ledger: DataFrame, run_group: str, since: str | None = None) -> DataFrame:
    """Jobs of a run group whose latest row is a failure, of the batches from ``since`` on.

    ``ledger`` may be the table of states, which has what is needed of the history.
    """
    own = ledger.where(F.col("run_group") == run_group)
    if since is not None:
        own = own.where(F.col("batch_id") >= since)  # a partition column: earlier batches are not read
    latest = _picked(own.select("job_id", "start_time", *STATE_ORDER), ["job_id"], F.col("start_time"), STATE_ORDER)
    return latest.where(F.col("status") == FAILED).select("job_id", "batch_id", "spark_app_id")


def latest_states(rows: DataFrame) -> DataFrame:
    """The latest row of every job of a run group, with what a rerun needs to know of it."""
    return _picked(rows.select(*STATE_SCHEMA.fieldNames()), ["run_group", "job_id"], F.col("start_time"), STATE_ORDER).select(
        *STATE_SCHEMA.fieldNames())


def state_table(ledger_table: str) -> str:
    """Where the latest states of a ledger's jobs are kept."""
    return f"{ledger_table}_state"


def note_states(rows: DataFrame, table: str, fmt: str = "parquet", most: int = 64) -> None:
    """Adds the states of ledger rows to a table of states, as one file, or several where they are many.

    Of several rows of a job the latest counts, in whatever order they came, so files may come one after the other and again.
    Beyond ``most`` additions the table shrinks to one row per job, so it follows the number of jobs, not of runs.
    """
    spark = rows.sparkSession
    create_table(spark, table, STATE_SCHEMA, fmt, [])
    if fmt in ATOMIC_FORMATS:
        insert(latest_states(rows), table)
        return
    add(latest_states(rows), table, whole=False)
    compact(spark, table, most, latest_states, whole=False)


def ensure_states(spark: SparkSession, ledger_table: str, fmt: str = "parquet") -> None:
    """The states of a ledger's jobs; until that is marked as done, read from its history, which adding twice does not change."""
    table = state_table(ledger_table)
    if not spark.catalog.tableExists(ledger_table):
        return
    if spark.catalog.tableExists(table) and not spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == HISTORY_READ).isEmpty():
        return
    note_states(spark.table(ledger_table), table, fmt)
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{HISTORY_READ}' = 'Y')")


def jobs_to_rerun(config: DataFrame, ledger: DataFrame, run_group: str, since: str | None = None) -> DataFrame:
    """The config rows of jobs that failed last."""
    return config.join(jobs_failed_last(ledger, run_group, since), "job_id", "left_semi")


def batch_summary(ledger: DataFrame) -> DataFrame:
    """Distinct jobs that completed, failed and occur at all; a job can count in both.

    Jobs are reduced to two flags first, so the rows are not expanded once per distinct count.
    """
    jobs = ledger.groupBy("job_id").agg(
        F.max(F.col("status") == COMPLETED).alias("completed"), F.max(F.col("status") == FAILED).alias("failed")
    )
    counts = jobs.agg(
        F.count_if("completed").alias("success_jobs"),
        F.count_if("failed").alias("fail_jobs"),
        F.count("job_id").alias("total_jobs"),
    )
    text = F.format_string("Successful: %d Fail: %d Total: %d", "success_jobs", "fail_jobs", "total_jobs")
    return counts.withColumn("jobs_status", text)


def _write_atomic(rows: DataFrame, table: str, fmt: str) -> None:
    spark = rows.sparkSession
    writer = rows.writeTo(table).using(fmt)
    if not spark.catalog.tableExists(table):
        writer.partitionedBy(*map(F.col, LEDGER_PARTITIONS)).create()
    elif set(LEDGER_PARTITIONS) <= set(partition_columns(spark, table)):
        writer.overwritePartitions()
    else:
        writer.append()


def write_ledger(rows: DataFrame, table: str, fmt: str = "parquet", max_retries: int = 50,
                 retry_delay: float = 5.0) -> None:
    """Writes the rows of whole runs, trying again on failure.

    Each run is a partition (batch_id, run_id) that a write replaces, so a retry after a late failure
    cannot duplicate rows. An existing atomic table with other partitions is appended to, as its
    commits are whole; a file table must have these partitions.
    """
    spark = rows.sparkSession
    typed = ledger_rows(rows).hint("rebalance", *map(F.col, LEDGER_PARTITIONS))
    for attempt in range(1, max_retries + 1):
        try:
            if fmt in ATOMIC_FORMATS:
                _write_atomic(typed, table, fmt)
            else:
                create_table(spark, table, LEDGER_SCHEMA, fmt, LEDGER_PARTITIONS)
                insert(typed, table, overwrite=LEDGER_PARTITIONS)
            return
        except Exception:
            if attempt == max_retries:
                raise
            time.sleep(retry_delay)
