"""Reports and logs; files are written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.errors import MESSAGE_LIST, MESSAGES, message
from checks.ledger import LEDGER, ledger
from checks.tables import table
from millrace.functions.timekeys import elapsed_seconds, elapsed_text
from millrace.operators.reports import batch_tables, job_report, log_lines, numbered_log, write_csv, write_log, write_ordered_log
from millrace.session import shared_dir


def config(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("job_id"),
        F.col("c_mktsegment").alias("source_schema"),
        F.col("c_name").alias("source_table"),
        F.lit("lake").alias("target_schema"),
        F.lower("c_name").alias("target_table"),
    )


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The config lacks a seventh of the jobs; their lines stay."""
    return job_report(ledger(spark, sf_dir), config(spark, sf_dir).where("CAST(job_id AS BIGINT) % 7 <> 0"))


def through_csv(df: DataFrame, purpose: str) -> DataFrame:
    path = shared_dir(df.sparkSession, purpose)
    write_csv(df, path)
    return df.sparkSession.read.schema(df.schema).option("header", True).option("multiLine", True).csv(path)


def report_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return through_csv(report(spark, sf_dir), "report")


def table_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return through_csv(batch_tables(config(spark, sf_dir)), "tables")


def elapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the start of its day, and from a fixed day, to each event."""
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.date_trunc("SECOND", "ts").cast("timestamp_ntz").alias("second"),
        F.date_trunc("DAY", "ts").cast("timestamp_ntz").alias("day"),
        F.expr("TIMESTAMP_NTZ'2024-01-15 12:00:00'").alias("fixed"),
    )
    return events.select(
        "event_id",
        elapsed_seconds("day", "second").alias("seconds"),
        elapsed_text(elapsed_seconds("day", "second")).alias("since_midnight"),
        elapsed_text(elapsed_seconds("fixed", "second")).alias("since_fixed"),
    )


def log_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "ts",
        F.expr("CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'view' THEN 'info' ELSE event_type END").alias("level"),
        message().alias("message"),
    )


def log_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_lines(log_entries(spark, sf_dir))


def log_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "log")
    write_log(log_entries(spark, sf_dir), path)
    return spark.read.schema("value string, log_date string").text(path).withColumnRenamed("value", "line")


def log_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines in one order, by number and as the files have them."""
    entries, path = log_entries(spark, sf_dir), shared_dir(spark, "log")
    write_ordered_log(entries, path)
    written = spark.read.text(path).groupBy("value").agg(F.count(F.lit(1)).alias("times_written"))
    numbered = numbered_log(entries)
    return numbered.join(written, numbered.line == written.value).select("line_number", "severity", "line", "times_written")


QUERIES = {
    "job_report": report,
    "job_report_csv": report_csv,
    "batch_table_list": table_list,
    "elapsed_time": elapsed,
    "log_content": log_content,
    "log_sink": log_sink,
    "log_text": log_text,
}


def _elapsed(seconds: str) -> str:
    days = f"CAST(floor({seconds} / 86400.0) AS BIGINT)"
    rest = f"({seconds} - {days} * 86400)"
    clock = f"printf('%d:%02d:%02d', {rest} // 3600, ({rest} % 3600) // 60, {rest} % 60)"
    return f"""CASE WHEN {days} = 0 THEN {clock}
                    WHEN abs({days}) = 1 THEN CAST({days} AS VARCHAR) || ' day, ' || {clock}
                    ELSE CAST({days} AS VARCHAR) || ' days, ' || {clock} END"""


REPORT = f"""
    SELECT l.job_id, c.c_mktsegment AS source_schema, c.c_name AS source_table,
           CASE WHEN c.c_name IS NOT NULL THEN 'lake' END AS target_schema,
           lower(c.c_name) AS target_table, batch_id, run_id, spark_app_id, records_processed, status,
           strftime(start_time, '%Y-%m-%d %H:%M:%S') AS start_time,
           strftime(end_time, '%Y-%m-%d %H:%M:%S') AS end_time,
           {_elapsed("date_diff('second', start_time, end_time)")} AS elapsed_time,
           CASE WHEN error_message = '' THEN 'N/A' ELSE error_message END AS failure_reason
    FROM ({LEDGER}) l LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 7 <> 0) c
         ON l.job_id = CAST(c.c_custkey AS VARCHAR)"""


def _log(columns: str) -> str:
    return f"""
        WITH e AS (
            SELECT ts, CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'view' THEN 'info' ELSE event_type END AS level,
                   event_type || ' ' || list_extract([{MESSAGE_LIST}], user_id % {len(MESSAGES)} + 1)
                   || ' ' || props AS message FROM events)
        SELECT {columns}, strftime(ts, '%Y-%m-%d %H:%M:%S') || ' - ' || level || ' - ' || message AS line FROM e"""


ORACLES = {
    "job_report": REPORT,
    "job_report_csv": REPORT,
    "batch_table_list": """
        SELECT CAST(c_custkey AS VARCHAR) AS job_id, c_mktsegment AS source_schema, c_name AS source_table,
               'lake' AS target_schema, lower(c_name) AS target_table FROM customer""",
    "elapsed_time": f"""
        SELECT event_id, seconds, {_elapsed('seconds')} AS since_midnight, {_elapsed('fixed')} AS since_fixed
        FROM (SELECT event_id, date_diff('second', date_trunc('day', ts), date_trunc('second', ts)) AS seconds,
                     date_diff('second', TIMESTAMP '2024-01-15 12:00:00', date_trunc('second', ts)) AS fixed
              FROM events)""",
    "log_content": _log("ts, CASE WHEN level = 'ERROR' THEN 'ERROR' ELSE 'INFO' END AS severity"),
    "log_sink": _log("strftime(ts, '%Y%m%d') AS log_date"),
    "log_text": f"""
        SELECT row_number() OVER (ORDER BY ts NULLS FIRST, line, severity) AS line_number, severity, line,
               count(*) OVER (PARTITION BY line) AS times_written
        FROM ({_log("ts, CASE WHEN level = 'ERROR' THEN 'ERROR' ELSE 'INFO' END AS severity")})""",
}
