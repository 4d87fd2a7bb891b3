"""Job reports, batch table lists and logs, as frames and as files."""

from __future__ import annotations

from datetime import datetime
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.timekeys import elapsed_seconds, elapsed_text
from millrace.model import DAY_FORMAT, LOG_SCHEMA, SECOND_FORMAT
from millrace.session import shared_dir

# The known log levels; any other counts as INFO.
LOG_LEVELS = ["DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL"]


def job_report(ledger: DataFrame, config: DataFrame) -> DataFrame:
    """One line per ledger row with its source, target, counts, times and reason of failure.

    A job that the config no longer has keeps its line, without names.
    Spark broadcasts the config if it is known to be small; otherwise the adaptive join splits a job
    with very many rows.
    """
    names = config.select("job_id", "source_schema", "source_table", "target_schema", "target_table")
    seconds = elapsed_seconds("start_time", "end_time")
    return ledger.join(names, "job_id", "left").select(
        "job_id",
        "source_schema",
        "source_table",
        "target_schema",
        "target_table",
        "batch_id",
        "run_id",
        "spark_app_id",
        "records_processed",
        "status",
        F.date_format("start_time", SECOND_FORMAT).alias("start_time"),
        F.date_format("end_time", SECOND_FORMAT).alias("end_time"),
        elapsed_text(seconds).alias("elapsed_time"),
        F.coalesce(F.nullif("error_message", F.lit("")), F.lit("N/A")).alias("failure_reason"),
    )


def batch_tables(config: DataFrame) -> DataFrame:
    """The tables of a batch."""
    return config.select("job_id", "source_schema", "source_table", "target_schema", "target_table")


def write_csv(df: DataFrame, path: str) -> None:
    """A report as a folder of CSV files with header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def log_lines(entries: DataFrame) -> DataFrame:
    """``time - level - message`` lines, with the level reduced to a known one beside them."""
    known = F.upper("level").isin(LOG_LEVELS)
    return entries.select(
        "ts",
        F.when(known, F.upper("level")).otherwise(F.lit("INFO")).alias("severity"),
        F.concat_ws(" - ", F.date_format("ts", SECOND_FORMAT), "level", "message").alias("line"),
    )


def write_log(entries: DataFrame, path: str) -> None:
    """Appends log lines as text, one folder per day; the lines of a file are in order of time."""
    lines = log_lines(entries).select(F.date_format("ts", DAY_FORMAT).alias("log_date"), "ts", "line")
    spread = lines.hint("rebalance", F.col("log_date")).sortWithinPartitions("log_date", "ts")
    spread.drop("ts").write.mode("append").partitionBy("log_date").text(path)


def _ordered(entries: DataFrame) -> DataFrame:
    """Log lines dealt to ranges of time, each sorted; lines of one time go on by their text, equal ones by chance."""
    keys = ["ts", "line", "severity"]
    lines = log_lines(entries).withColumn("_chance", F.rand(7))
    return lines.repartitionByRange(*[F.asc_nulls_first(c) for c in keys], "_chance").sortWithinPartitions(
        *[F.asc_nulls_first(c) for c in keys]).drop("_chance")


def numbered_log(entries: DataFrame) -> DataFrame:
    """The text of a log: line_number from 1 without gaps in the order of time, then text.

    Ranges have sampled bounds and are sorted apart; a line's number is its place in its range after the rows of the ranges
    before. Only the sizes of the ranges reach the driver. The ranges are written first, so that places stay as they are.
    """
    spark = entries.sparkSession
    path = shared_dir(spark, "log")
    _ordered(entries).withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("_range", F.shiftright("_at", 33))
    sizes = sorted((r._range, r.n) for r in rows.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect())
    starts = accumulate((n for _, n in sizes), initial=0)
    before = spark.createDataFrame([(number, start) for (number, _), start in zip(sizes, starts)], "_range long, _before long")
    place = F.col("_at").bitwiseAND((1 << 33) - 1)
    return rows.join(F.broadcast(before), "_range").select((F.col("_before") + place + 1).alias("line_number"), "severity", "line")


def write_ordered_log(entries: DataFrame, path: str) -> None:
    """Writes a log as text files whose names and lines, one after the other, are in the order of time."""
    _ordered(entries).select("line").write.mode("overwrite").text(path)


class RunLog:
    """The entries of one run, kept by the program that submits its jobs."""

    def __init__(self) -> None:
        self.entries: list[tuple[datetime, str, str]] = []

    def log(self, message: str, level: str = "INFO") -> None:
        self.entries.append((datetime.now(), level, message))

    def content(self) -> str:
        return "\n".join(f"{ts:%Y-%m-%d %H:%M:%S} - {level} - {message}" for ts, level, message in self.entries)

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.entries, LOG_SCHEMA)

    def save(self, spark: SparkSession, path: str) -> bool:
        """Whether the log could be written; a failure is itself logged."""
        try:
            write_log(self.frame(spark), path)
            self.log(f"log saved to {path}")
            return True
        except Exception as error:
            self.log(f"log not saved: {error}", "ERROR")
            return False
