"""The ledger, with orders as its rows: a customer is a job and an order one of its runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.tables import table
from millrace.model import LEDGER_SCHEMA
from millrace.operators.ledger import (
    batch_summary,
    completion_rows,
    consolidate,
    failed_jobs,
    initial_rows,
    jobs_failed_last,
    jobs_to_rerun,
    note_states,
    run_id_of_batch,
    union_by_name,
    update_rows,
    write_ledger,
)
from millrace.session import scratch_table

GROUP = "1-URGENT"


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run of a job knows: its ids, table, times, counts and message."""
    key = F.col("o_orderkey")
    start = F.col("o_orderdate").cast("timestamp")
    failed, done = F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "O"
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("run-"), key.cast("string")).alias("run_id"),
        F.date_format("o_orderdate", "yyyyMMddHH").alias("batch_id"),
        F.concat(F.lit("app-"), (key % 97).cast("string")).alias("spark_app_id"),
        F.col("o_orderpriority").alias("run_group"),
        F.col("o_custkey").cast("string").alias("job_id"),
        F.lit("lake").alias("target_schema"),
        F.concat(F.lit("t_"), F.col("o_custkey").cast("string")).alias("target_table"),
        F.when(failed, "FAILED").when(done, "COMPLETED").otherwise("STARTED").alias("status"),
        done.alias("has_data"),
        start.alias("start_time"),
        F.timestamp_add("SECOND", (key * 37 % 200000).cast("int"), start).alias("end_time"),
        F.lit(6).alias("column_count"),
        F.when(failed | done, F.floor("o_totalprice")).alias("records_processed"),
        F.when(failed, F.concat(F.lit("can't read\n"), "o_orderpriority")).alias("error_message"),
        F.when(done, F.date_format("o_orderdate", "yyyyMMdd")).alias("load_date"),
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = runs(spark, sf_dir)
    named = states.withColumn("table_name", F.concat_ws(".", "target_schema", "target_table"))
    return update_rows(named.drop("target_schema", "target_table", "has_data"))


def plain_times(df: DataFrame) -> DataFrame:
    """Times without zone, as the SQL side has them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start_time", "end_time")})


def ledger_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One STARTED row per customer, whose balance and segment stand for a config."""
    config = table(spark, sf_dir, "customer").select(
        F.lit("r1").alias("run_id"),
        F.lit("2024010212").alias("batch_id"),
        F.lit("app-1").alias("spark_app_id"),
        F.col("c_mktsegment").alias("run_group"),
        F.col("c_custkey").cast("string").alias("job_id"),
        F.lower("c_name").alias("target_table"),
        F.lit("2024-01-02 12:34:56").cast("timestamp").alias("start_time"),
    )
    return plain_times(initial_rows(config))


def ledger_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(ledger(spark, sf_dir))


def ledger_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(completion_rows(runs(spark, sf_dir).drop("status")))


def ledger_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two shapes: suppliers have no segment."""
    customers = table(spark, sf_dir, "customer").toDF("job_id", "name", "nation", "balance", "segment")
    suppliers = table(spark, sf_dir, "supplier").toDF("job_id", "name", "nation", "balance")
    return union_by_name(suppliers, customers)


def consolidated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order has started; those that are not pending have also ended."""
    states = runs(spark, sf_dir)
    ended = completion_rows(states.where("status <> 'STARTED'").drop("status"))
    return consolidate(initial_rows(states), ended)


def ledger_consolidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(consolidated(spark, sf_dir))


def ledger_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written twice, as by a retry: the second write replaces the first."""
    month = F.date_format("start_time", "yyyyMM")
    rows = ledger(spark, sf_dir).withColumns({"batch_id": month, "run_id": F.concat(F.lit("r"), month)})
    target = scratch_table(spark, "ledger")
    for _ in range(2):
        write_ledger(rows, target)
    return plain_times(spark.table(target).select(*LEDGER_SCHEMA.fieldNames()))


def run_id_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_id_of_batch(ledger(spark, sf_dir))


def rerun_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failed_jobs(ledger(spark, sf_dir), GROUP)


def rerun_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs_failed_last(ledger(spark, sf_dir), GROUP)


def rerun_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("job_id"), "c_name")
    return jobs_to_rerun(config, ledger(spark, sf_dir), GROUP)


def rerun_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The states after three runs, whose rows come late or early, shrunk to a row per job in between."""
    rows, state = ledger(spark, sf_dir), scratch_table(spark, "states")
    for part in range(3):
        note_states(rows.where(F.pmod(F.xxhash64("run_id"), F.lit(3)) == part), state, most=1)
    return jobs_failed_last(spark.table(state), GROUP)


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_summary(ledger(spark, sf_dir))


QUERIES = {
    "ledger_initial": ledger_initial,
    "ledger_update": ledger_update,
    "ledger_completion": ledger_completion,
    "ledger_union": ledger_union,
    "ledger_consolidate": ledger_consolidate,
    "ledger_write": ledger_write,
    "run_id_lookup": run_id_lookup,
    "rerun_failed": rerun_failed,
    "rerun_latest": rerun_latest,
    "rerun_jobs": rerun_jobs,
    "rerun_state": rerun_state,
    "batch_summary": summary,
}

COLUMNS = [field.name for field in LEDGER_SCHEMA.fields]

# The same runs in SQL.
RUNS = """
    SELECT 'run-' || CAST(o_orderkey AS VARCHAR) AS run_id, strftime(o_orderdate, '%Y%m%d%H') AS batch_id,
           'app-' || CAST(o_orderkey % 97 AS VARCHAR) AS spark_app_id, o_orderpriority AS run_group,
           CAST(o_custkey AS VARCHAR) AS job_id, 't_' || CAST(o_custkey AS VARCHAR) AS target_table,
           CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'O' THEN 'COMPLETED' ELSE 'STARTED' END AS status,
           o_orderdate AS start_time, o_orderdate + to_seconds(o_orderkey * 37 % 200000) AS end_time,
           CASE WHEN o_orderstatus <> 'P' THEN CAST(floor(o_totalprice) AS BIGINT) END AS records_processed,
           strftime(o_orderdate, '%Y%m%d') AS day, o_orderpriority AS priority
    FROM orders"""

LEDGER = f"""
    SELECT run_id, batch_id, spark_app_id, run_group, 'staging' AS dlh_layer, job_id,
           'lake.' || target_table AS table_name, '' AS schema, CAST(6 AS INTEGER) AS column_count, status,
           start_time, CASE WHEN status <> 'STARTED' THEN end_time END AS end_time,
           coalesce(records_processed, 0) AS records_processed, CAST(0 AS BIGINT) AS records_rejected,
           CASE WHEN status = 'FAILED' THEN 'cant read' || chr(10) || priority ELSE '' END AS error_message,
           CASE WHEN status = 'COMPLETED' THEN day ELSE '' END AS load_date, '' AS comments
    FROM ({RUNS})"""

COMPLETION = f"""
    SELECT run_id, batch_id, spark_app_id, CAST(NULL AS VARCHAR) AS run_group, CAST(NULL AS VARCHAR) AS dlh_layer,
           job_id, 'lake.' || target_table AS table_name, '' AS schema,
           CAST(CASE WHEN status = 'COMPLETED' THEN 6 ELSE 0 END AS INTEGER) AS column_count,
           CASE WHEN status = 'COMPLETED' THEN 'COMPLETED' ELSE 'FAILED' END AS status, start_time, end_time,
           CASE WHEN status = 'COMPLETED' THEN records_processed ELSE 0 END AS records_processed,
           CAST(0 AS BIGINT) AS records_rejected,
           CASE WHEN status = 'FAILED' THEN 'cant read ' || priority ELSE '' END AS error_message,
           CASE WHEN status = 'COMPLETED' THEN day ELSE '' END AS load_date, '' AS comments
    FROM ({RUNS})"""

INITIAL = f"""
    SELECT run_id, batch_id, spark_app_id, run_group, 'staging' AS dlh_layer, job_id, target_table AS table_name,
           '' AS schema, CAST(0 AS INTEGER) AS column_count, 'STARTED' AS status, start_time,
           CAST(NULL AS TIMESTAMP) AS end_time, CAST(0 AS BIGINT) AS records_processed,
           CAST(0 AS BIGINT) AS records_rejected, '' AS error_message, '' AS load_date, '' AS comments
    FROM ({RUNS})"""

LATEST = f"""
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY start_time DESC, batch_id DESC, run_id DESC) AS rn
        FROM ({LEDGER}) WHERE run_group = '{GROUP}')
    WHERE rn = 1 AND status = 'FAILED'"""

ENDED = f"SELECT * FROM ({COMPLETION}) WHERE run_id IN (SELECT run_id FROM ({RUNS}) WHERE status <> 'STARTED')"

ORACLES = {
    "ledger_initial": """
        SELECT 'r1' AS run_id, '2024010212' AS batch_id, 'app-1' AS spark_app_id, c_mktsegment AS run_group,
               'staging' AS dlh_layer, CAST(c_custkey AS VARCHAR) AS job_id, lower(c_name) AS table_name,
               '' AS schema, CAST(0 AS INTEGER) AS column_count, 'STARTED' AS status,
               TIMESTAMP '2024-01-02 12:34:56' AS start_time, CAST(NULL AS TIMESTAMP) AS end_time,
               CAST(0 AS BIGINT) AS records_processed, CAST(0 AS BIGINT) AS records_rejected,
               '' AS error_message, '' AS load_date, '' AS comments
        FROM customer""",
    "ledger_update": LEDGER,
    "ledger_completion": COMPLETION,
    "ledger_union": """
        SELECT s_suppkey AS job_id, s_name AS name, s_nationkey AS nation, s_acctbal AS balance,
               CAST(NULL AS VARCHAR) AS segment FROM supplier
        UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""",
    "ledger_consolidate": f"""
        SELECT {', '.join(f'coalesce(u.{c}, i.{c}) AS {c}' for c in COLUMNS)}
        FROM ({INITIAL}) i FULL OUTER JOIN ({ENDED}) u
        ON i.run_id = u.run_id AND i.batch_id = u.batch_id AND i.job_id = u.job_id""",
    "ledger_write": f"""
        SELECT * REPLACE (strftime(start_time, '%Y%m') AS batch_id, 'r' || strftime(start_time, '%Y%m') AS run_id)
        FROM ({LEDGER})""",
    "run_id_lookup": f"""
        SELECT batch_id, run_id FROM (
            SELECT batch_id, run_id, row_number() OVER (PARTITION BY batch_id ORDER BY start_time, run_id) AS rn
            FROM ({LEDGER})) WHERE rn = 1""",
    "rerun_failed": f"""
        SELECT job_id, max(batch_id) AS batch_id, max(spark_app_id) AS spark_app_id
        FROM ({LEDGER}) WHERE run_group = '{GROUP}' AND status = 'FAILED' GROUP BY job_id""",
    "rerun_latest": f"SELECT job_id, batch_id, spark_app_id FROM ({LATEST})",
    "rerun_state": f"SELECT job_id, batch_id, spark_app_id FROM ({LATEST})",
    "rerun_jobs": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS job_id, c_name FROM customer
        WHERE CAST(c_custkey AS VARCHAR) IN (SELECT job_id FROM ({LATEST}))""",
    "batch_summary": f"""
        SELECT *, 'Successful: ' || CAST(success_jobs AS VARCHAR) || ' Fail: ' || CAST(fail_jobs AS VARCHAR)
                  || ' Total: ' || CAST(total_jobs AS VARCHAR) AS jobs_status
        FROM (SELECT count(DISTINCT CASE WHEN status = 'COMPLETED' THEN job_id END) AS success_jobs,
                     count(DISTINCT CASE WHEN status = 'FAILED' THEN job_id END) AS fail_jobs,
                     count(DISTINCT job_id) AS total_jobs
              FROM ({LEDGER}))""",
}
