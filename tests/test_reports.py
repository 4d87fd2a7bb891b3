from __future__ import annotations

import os
import re
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from millrace.functions.timekeys import elapsed_seconds, elapsed_text
from millrace.model import LEDGER_SCHEMA, LOG_SCHEMA
from millrace.operators.reports import RunLog, job_report, log_lines, numbered_log, write_log, write_ordered_log
from millrace.session import shared_dir

START = datetime(2025, 1, 1)


def test_elapsed_text_like_a_duration(spark):
    seconds = [0, 59, 300, 3599, 3600, 86399, 86400, 90061, 172800, 10**7, -1, -86400, -90000]
    df = spark.createDataFrame([(s,) for s in seconds], "s bigint").select("s", elapsed_text(F.col("s")).alias("text"))
    assert all(row.text == str(timedelta(seconds=row.s)) for row in df.collect())


def test_elapsed_seconds(spark):
    df = spark.createDataFrame([(START, START + timedelta(minutes=5))], "a timestamp, b timestamp")
    assert df.select(elapsed_seconds("a", "b").alias("s")).first().s == 300


def test_job_report(spark):
    values = {"job_id": "J1", "status": "FAILED", "start_time": START, "end_time": START + timedelta(minutes=5),
              "error_message": ""}
    second = {"job_id": "J2", "error_message": "bad", "end_time": None}
    rows = [tuple(values.get(name) for name in LEDGER_SCHEMA.fieldNames()),
            tuple({**values, **second}.get(name) for name in LEDGER_SCHEMA.fieldNames())]
    config = spark.createDataFrame(
        [("J1", "s", "t", "x", "y"), ("J2", "s", "t2", "x", "y2")],
        "job_id string, source_schema string, source_table string, target_schema string, target_table string",
    )
    one, two = job_report(spark.createDataFrame(rows, LEDGER_SCHEMA), config).orderBy("job_id").collect()
    assert (one.elapsed_time, one.failure_reason, one.source_table) == ("0:05:00", "N/A", "t")
    assert (two.elapsed_time, two.end_time, two.failure_reason) == (None, None, "bad")


def test_job_that_left_the_config_keeps_its_line(spark):
    row = tuple({"job_id": "J9", "status": "FAILED"}.get(name) for name in LEDGER_SCHEMA.fieldNames())
    names = "job_id string, source_schema string, source_table string, target_schema string, target_table string"
    (line,) = job_report(spark.createDataFrame([row], LEDGER_SCHEMA), spark.createDataFrame([], names)).collect()
    assert (line.job_id, line.status, line.source_table) == ("J9", "FAILED", None)


def test_log_files_are_in_order_of_time(spark):
    path = shared_dir(spark, "log")
    rows = [(START + timedelta(seconds=(i * 7919) % 5000), "INFO", "m") for i in range(5000)]
    write_log(spark.createDataFrame(rows, LOG_SCHEMA).repartition(8), path)
    files = spark.read.text(path).inputFiles()
    assert files
    for file in files:
        lines = [row.value for row in spark.read.text(file).collect()]
        assert lines == sorted(lines)


def test_run_log(spark):
    log = RunLog()
    log.log("Test message", "INFO")
    log.log("odd", "CHATTY")
    lines = log.content().split("\n")
    assert re.fullmatch(r"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d - INFO - Test message", lines[0])
    found = log_lines(log.frame(spark)).orderBy("ts").collect()
    assert [row.line for row in found] == lines
    assert [row.severity for row in found] == ["INFO", "INFO"]


def test_log_sink_appends_by_day(spark):
    path = shared_dir(spark, "log")
    for day in (1, 1, 2):
        write_log(spark.createDataFrame([(datetime(2025, 1, day, 7), "INFO", "m")], LOG_SCHEMA), path)
    found = spark.read.schema("value string, log_date string").text(path)
    assert sorted((row.log_date, row.value) for row in found.collect()) == [
        ("20250101", "2025-01-01 07:00:00 - INFO - m"),
        ("20250101", "2025-01-01 07:00:00 - INFO - m"),
        ("20250102", "2025-01-02 07:00:00 - INFO - m"),
    ]


def test_save_tells_whether_it_worked(spark):
    log = RunLog()
    log.log("m")
    assert log.save(spark, shared_dir(spark, "log")) is True
    assert log.save(spark, "nosuchscheme://x/y") is False
    assert "log not saved" in log.content()


def test_a_log_is_one_text_in_order(spark):
    times = ["2024-01-02 00:00:01", "2024-01-01 00:00:00", None, "2024-01-02 00:00:01"]
    rows = [(times[i % 4], "INFO", f"m{i % 50:02}") for i in range(400)] + [(times[0], "ERROR", "same")] * 300
    entries = spark.createDataFrame(rows, "ts string, level string, message string").selectExpr("CAST(ts AS timestamp) AS ts", "level", "message")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = sorted(numbered_log(entries.repartition(5)).collect())
        path = shared_dir(spark, "ordered")
        write_ordered_log(entries.repartition(3), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = sorted((t or "", " - ".join(p for p in (t, level, message) if p)) for t, level, message in rows)
    assert [r.line_number for r in numbered] == list(range(1, 701)) and [r.line for r in numbered] == [line for _, line in want]
    folder = path.removeprefix("file:")
    files = sorted(f for f in os.listdir(folder) if f.startswith("part-"))
    text = "".join(open(f"{folder}/{f}").read() for f in files)
    assert len(files) > 1 and text.splitlines() == [line for _, line in want]
    assert numbered_log(entries.limit(0)).count() == 0
