"""Change windows and watermarks."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.tables import source, table
from millrace.functions.timekeys import hour_key
from millrace.model import TRACKER_SCHEMA, RunContext, TableJob
from millrace.operators.cdc import (
    KeyRange,
    changed_rows,
    hour_window,
    key_maximum,
    plan_window,
    watermark_row,
    watermarks,
)
from millrace.operators.filelog import compact
from millrace.operators.landing import create_table, insert
from millrace.plans.table_load import Target, load_table
from millrace.session import scratch_table
from millrace.sources.extract import Extract
from millrace.sources.lake import LakeSource

WATERMARK = "2024010106"
RUN_TS = datetime(2024, 1, 2, 12, 34, 56)
EVENTS = TableJob("J1", "web", "events", "lake", "events")
KEYED = TableJob("J2", "web", "events", "lake", "events", load_type="INCREMENTAL", cdc_type="APPEND_KEY",
                 cdc_append_key_column="event_id")
RUNS = [datetime(2024, 1, 10, 0, 15), datetime(2024, 1, 20, 6, 59, 59), datetime(2024, 2, 1)]


def ts_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changed_rows(table(spark, sf_dir, "events"), hour_window(["ts"], WATERMARK, RUN_TS))


def ts_window_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    window = hour_window(["ts"], WATERMARK, RUN_TS)
    wanted = Extract("event_id, event_type, value", "event_type = 'error' OR value > 20", window)
    return source(spark, sf_dir).extract(EVENTS, wanted)


def ts_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changed_rows(table(spark, sf_dir, "events"), hour_window(["ts"], None, RUN_TS))


def ts_window_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem")
    dated = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "o_orderdate"
    )
    window = hour_window(["l_shipdate", "o_orderdate"], "1998010100", datetime(1998, 3, 1))
    return changed_rows(dated, window)


def append_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return changed_rows(events, KeyRange("event_id", 2500, key_maximum(events, "event_id").first().max_value))


def append_key_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads by a key with fractions, of which the first sees half of the rows."""
    events = table(spark, sf_dir, "events").withColumn("key", F.expr("event_id + (event_id % 8) / 8D"))
    schema, landed = scratch_table(spark, "fractions").split(".")
    job = TableJob("J3", "web", "events", schema, landed, load_type="INCREMENTAL", cdc_type="APPEND_KEY",
                   cdc_append_key_column="key")
    target = Target(spark, scratch_table(spark, "tracker"))
    for known in (events.where("event_id % 8 < 4 AND ts < TIMESTAMP_NTZ'2024-01-15 00:00:00'"), events):
        load_table(job, LakeSource(spark, lambda schema, name, known=known: known), target,
                   RunContext.start(spark, "daily", RUNS[2]))
    return spark.table(target.table(job)).select("event_id", "key")


def watermark_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks written as day, hour, second and timestamp, all in one untyped column."""
    tracker = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("job_id"),
        F.col("o_orderstatus").alias("source_table"),
        F.expr("""CASE o_orderkey % 4 WHEN 0 THEN date_format(o_orderdate, 'yyyyMMdd')
                  WHEN 1 THEN date_format(o_orderdate, 'yyyyMMddHH')
                  WHEN 2 THEN date_format(o_orderdate, 'yyyyMMddHHmmss')
                  ELSE date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') END""").alias("updated_at"),
    )
    return watermarks(tracker).select("job_id", "source_table", "ts_hour", "bad_hours")


def watermark_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    tracker = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("job_id"),
        F.col("o_orderstatus").alias("source_table"),
        hour_key("o_orderdate").alias("ts_hour"),
        F.col("o_orderkey").alias("key_value"),
    )
    known = watermarks(tracker).withColumn("key_value", F.col("key_value").cast("long"))
    return known.select("job_id", "source_table", "ts_hour", "key_value")


def watermark_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs by append key, the first before the second half of the rows exists."""
    events = table(spark, sf_dir, "events")
    tracker = scratch_table(spark, "tracker")
    create_table(spark, tracker, TRACKER_SCHEMA, "parquet", [])
    for known, run_ts in ((events.where("ts < TIMESTAMP_NTZ'2024-01-15 00:00:00'"), RUNS[0]), (events, RUNS[2])):
        window = plan_window(KEYED, spark.table(tracker), run_ts,
                             lambda: key_maximum(known, "event_id").first().max_value)
        insert(watermark_row(spark.table(tracker), KEYED, window), tracker)
    return spark.table(tracker).select("job_id", "source_table", "ts_hour", F.col("key_value").cast("long").alias("key_value"))


def append_key_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads by a key of up to 27 digits, then one that finds nothing; the rows, and the mark that the tracker holds."""
    events = table(spark, sf_dir, "events").withColumn(
        "key", F.expr("CAST(event_id AS DECIMAL(15,0)) * 10000000000000000000000").cast("decimal(38,0)"))
    schema, landed = scratch_table(spark, "wide").split(".")
    job = TableJob("J4", "web", "events", schema, landed, load_type="INCREMENTAL", cdc_type="APPEND_KEY",
                   cdc_append_key_column="key")
    target = Target(spark, scratch_table(spark, "tracker"))
    for known in (events.where("ts < TIMESTAMP_NTZ'2024-01-15 00:00:00'"), events, events):
        load_table(job, LakeSource(spark, lambda schema, name, known=known: known), target,
                   RunContext.start(spark, "daily", RUNS[2]))
    mark = target.tracked([job])[job.job_id, job.source_table].key_value
    return spark.table(target.table(job)).select("event_id", "key", F.lit(str(mark)).alias("mark"))


def _added(target: Target, job: TableJob, *marks: int) -> None:
    for key in marks:
        target.mark(job, None, str(key), None)


def tracker_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tracker of many files, compacted while another batch adds marks, and once more; the marks and the files left."""
    events = table(spark, sf_dir, "events")
    low, high = events.agg(F.min("event_id"), F.max("event_id")).first()
    other = TableJob("J5", "web", "clicks", "lake", "clicks", load_type="INCREMENTAL", cdc_type="APPEND_KEY",
                     cdc_append_key_column="event_id")
    target = Target(spark, scratch_table(spark, "tracker"))
    target.ensure_tracker()
    _added(target, KEYED, low, low + 1, low + 2)
    steps = {"read": lambda: _added(target, other, high), "written": lambda: _added(target, KEYED, high - 1)}
    compact(spark, target.tracker, 2, DataFrame.distinct, lambda step: steps.get(step, lambda: None)())
    files = len(spark.table(target.tracker).inputFiles())
    found = target.tracked([KEYED, other])
    compact(spark, target.tracker, 2, DataFrame.distinct)
    left = len(spark.table(target.tracker).inputFiles())
    rows = [(*own, int(mark.key_value), files, left) for own, mark in found.items()]
    return spark.createDataFrame(rows, "job_id string, source_table string, key_value long, files int, files_left int")


def tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consecutive runs, each from the watermark that the one before left."""
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    watermark, tiles = None, []
    for run_ts in RUNS:
        window = hour_window(["ts"], watermark, run_ts)
        watermark = window.watermark["ts_hour"]
        tiles.append(changed_rows(events, window).withColumn("window_end", F.lit(watermark)))
    return reduce(DataFrame.union, tiles)


def hour_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", hour_key("ts").alias("hour_key"))


QUERIES = {
    "cdc_ts_window": ts_window,
    "cdc_ts_window_where": ts_window_where,
    "cdc_ts_first": ts_first,
    "cdc_ts_window_or": ts_window_or,
    "cdc_append_key": append_key,
    "cdc_append_key_decimal": append_key_decimal,
    "watermark_lookup": watermark_lookup,
    "watermark_texts": watermark_texts,
    "watermark_advance": watermark_advance,
    "append_key_wide": append_key_wide,
    "tracker_compact": tracker_compact,
    "cdc_tiling": tiling,
    "hour_key": hour_keys,
}

IN_WINDOW = "strftime(ts, '%Y%m%d%H') >= '2024010106' AND strftime(ts, '%Y%m%d%H') < '2024010212'"

ORACLES = {
    "cdc_ts_window": f"SELECT * FROM events WHERE {IN_WINDOW}",
    "cdc_ts_window_where": f"""
        SELECT event_id, event_type, value FROM events
        WHERE ({IN_WINDOW}) AND (event_type = 'error' OR value > 20)""",
    "cdc_ts_first": "SELECT * FROM events WHERE strftime(ts, '%Y%m%d%H') < '2024010212'",
    "cdc_ts_window_or": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, o_orderdate
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE (strftime(l_shipdate, '%Y%m%d%H') >= '1998010100'
               AND strftime(l_shipdate, '%Y%m%d%H') < '1998030100')
           OR (strftime(o_orderdate, '%Y%m%d%H') >= '1998010100'
               AND strftime(o_orderdate, '%Y%m%d%H') < '1998030100')""",
    "cdc_append_key": """
        SELECT * FROM events WHERE event_id > 2500 AND event_id <= (SELECT max(event_id) FROM events)""",
    # The first load ends at the largest key that it saw; the second brings what lies above.
    "cdc_append_key_decimal": """
        WITH keyed AS (SELECT event_id, event_id + (event_id % 8) / 8.0::DOUBLE AS key, ts FROM events),
        early AS (SELECT * FROM keyed WHERE event_id % 8 < 4 AND ts < TIMESTAMP '2024-01-15 00:00:00')
        SELECT event_id, key FROM early
        UNION ALL
        SELECT event_id, key FROM keyed WHERE key > (SELECT max(key) FROM early)""",
    "watermark_texts": """
        SELECT CAST(o_custkey AS VARCHAR) AS job_id, o_orderstatus AS source_table,
               max(CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y%m%d') || '00'
                   ELSE strftime(o_orderdate, '%Y%m%d%H') END) AS ts_hour, CAST(0 AS BIGINT) AS bad_hours
        FROM orders GROUP BY o_custkey, o_orderstatus""",
    "watermark_lookup": """
        SELECT CAST(o_custkey AS VARCHAR) AS job_id, o_orderstatus AS source_table,
               max(strftime(o_orderdate, '%Y%m%d%H')) AS ts_hour, max(o_orderkey) AS key_value
        FROM orders GROUP BY o_custkey, o_orderstatus""",
    "watermark_advance": """
        SELECT 'J2' AS job_id, 'events' AS source_table, CAST(NULL AS VARCHAR) AS ts_hour,
               max(event_id) AS key_value
        FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00'
        UNION ALL
        SELECT 'J2', 'events', CAST(NULL AS VARCHAR), max(event_id) FROM events""",
    "append_key_wide": """
        WITH keyed AS (SELECT event_id, CAST(event_id::HUGEINT * 10000000000000000000000::HUGEINT AS DECIMAL(38, 0)) AS key, ts
                       FROM events),
        early AS (SELECT * FROM keyed WHERE ts < TIMESTAMP '2024-01-15 00:00:00'),
        landed AS (SELECT event_id, key FROM early
                   UNION ALL SELECT event_id, key FROM keyed WHERE key > (SELECT max(key) FROM early))
        SELECT event_id, key, (SELECT CAST(max(key) AS VARCHAR) FROM keyed) AS mark FROM landed""",
    # Of the four files the three that were read have become one; the two that came meanwhile stay, and are read the next time.
    "tracker_compact": """
        SELECT 'J2' AS job_id, 'events' AS source_table, max(event_id) - 1 AS key_value, CAST(3 AS INTEGER) AS files,
               CAST(1 AS INTEGER) AS files_left FROM events
        UNION ALL
        SELECT 'J5', 'clicks', max(event_id), 3, 1 FROM events""",
    "cdc_tiling": """
        SELECT event_id, ts,
               CASE WHEN ts < TIMESTAMP '2024-01-10 00:00:00' THEN '2024011000'
                    WHEN ts < TIMESTAMP '2024-01-20 06:00:00' THEN '2024012006'
                    ELSE '2024020100' END AS window_end
        FROM events""",
    "hour_key": "SELECT event_id, strftime(ts, '%Y%m%d%H') AS hour_key FROM events",
}
