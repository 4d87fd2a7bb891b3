"""Scans: extracts, config rows, probes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.tables import NAMES, SOURCE_TYPES, source, table
from millrace.functions.typemap import numeric_scale_profile, schema_ddl, schema_map
from millrace.model import CATALOGUE_SCHEMA, TableJob
from millrace.operators.cdc import key_maximum
from millrace.sources.dialects import Dialect
from millrace.sources.extract import Extract, typed
from millrace.sources.jdbc import fetch_size
from millrace.sources.lake import empty_like, enabled_jobs
from millrace.sources.splits import DEALT, ROW_COLUMN, SPLIT_COLUMN, Histogram, even_parts

class SparkSql(Dialect):
    """Bounds as Spark writes them."""

    def timestamp(self, ts: datetime) -> str:
        return f"TIMESTAMP_NTZ '{ts}'"


ORDERS = TableJob("J1", "sales", "orders", "lake", "orders")
FIELDS = "o_orderkey, o_totalprice AS price, upper(o_orderpriority) AS priority"
WHERE = "o_orderstatus = 'F' OR o_totalprice > 400000"


def extract(fields: str | None = None, where: str | None = None):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return source(spark, sf_dir).extract(ORDERS, Extract(fields, where))

    return run


def typed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the types that their numbers' profile and their source types call for."""
    orders = table(spark, sf_dir, "orders")
    rows = [(name, SOURCE_TYPES[kind], i) for i, (name, kind) in enumerate(orders.dtypes, start=1)]
    catalogue = spark.createDataFrame(rows, CATALOGUE_SCHEMA)
    read = typed(orders, schema_ddl(schema_map(catalogue, numeric_scale_profile(orders))))
    return read.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


def split_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Splits of the lines by skewed keys: the parts that each line is in, and whether its part is within 1.5 times the mean.

    The keys: powers with a third of all rows in one value and some null, and a date. Powers of large keys are beyond a long.
    """
    lines = f"(SELECT *, pmod(xxhash64(l_orderkey, l_linenumber, l_partkey), {DEALT}) AS {ROW_COLUMN} FROM parquet.`{sf_dir}/lineitem.parquet`)"
    keys = {"power": "CASE WHEN l_orderkey % 3 = 0 THEN 5 WHEN l_orderkey % 11 > 0 THEN CAST(l_orderkey AS DOUBLE) * l_orderkey * l_orderkey END",
            "shipped": "l_shipdate"}
    found = None
    for name, key in keys.items():
        histogram = Histogram(lambda query: spark.sql(query).collect(), SparkSql().literal, f"{lines} l", key)
        parts = even_parts(histogram, key, 12, by_row=True).predicates
        split = spark.sql(f"SELECT l_orderkey, l_linenumber, l_partkey, {key} AS {SPLIT_COLUMN}, {ROW_COLUMN} FROM {lines} l")
        dealt = split.withColumn("parts", F.filter(F.array(*[F.when(F.expr(p), i) for i, p in enumerate(parts)]), F.isnotnull))
        sizes = dealt.select(F.explode("parts").alias("part")).groupBy("part").agg(F.count(F.lit(1)).alias("n"))
        even = sizes.select("part", (F.col("n") * len(parts) <= 1.5 * sizes.agg(F.sum("n")).scalar()).alias("even"))
        # A row per part; left to itself, Spark may broadcast the lines.
        one = dealt.join(F.broadcast(even), F.col("parts")[0] == F.col("part")).select(
            F.lit(name).alias("key"), "l_orderkey", "l_linenumber", F.size("parts").alias("n_parts"), "even")
        found = one if found is None else found.unionAll(one)
    return found


def config_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    config = customer.select(
        F.col("c_custkey").cast("string").alias("job_id"),
        F.col("c_name").alias("source_table"),
        F.col("c_mktsegment").alias("app_pipeline"),
        F.when(F.col("c_nationkey") < 12, "daily").otherwise("hourly").alias("run_group"),
        F.when(F.col("c_acctbal") >= 0, "Y").otherwise("N").alias("is_enabled"),
        F.when(F.col("c_acctbal") < 9000, "Y").otherwise("N").alias("is_active"),
    )
    return enabled_jobs(config, "MACHINERY", "daily")


def with_nothing_added(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.unionByName(empty_like(orders))


def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source(spark, sf_dir).row_counts("given", NAMES)


def fetch_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = row_counts(spark, sf_dir)
    return counts.select("table_name", "num_rows", fetch_size(F.col("num_rows")).alias("fetch_size"))


def append_key_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_maximum(table(spark, sf_dir, "events"), "event_id")


QUERIES = {
    "extract_all": extract(),
    "extract_fields": extract(fields=FIELDS),
    "extract_where": extract(where=WHERE),
    "extract_fields_where": extract(FIELDS, WHERE),
    "typed_scan": typed_scan,
    "config_scan": config_scan,
    "empty_like": with_nothing_added,
    "source_row_count": row_counts,
    "fetch_size_plan": fetch_sizes,
    "append_key_max": append_key_max,
    "split_plan": split_plan,
}

COUNTS = " UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS num_rows FROM {name}" for name in NAMES)

ORACLES = {
    "extract_all": "SELECT * FROM orders",
    "extract_fields": f"SELECT {FIELDS} FROM orders",
    "extract_where": f"SELECT * FROM orders WHERE {WHERE}",
    "extract_fields_where": f"SELECT {FIELDS} FROM orders WHERE {WHERE}",
    "typed_scan": "SELECT * REPLACE (CAST(o_totalprice AS DECIMAL(38, 2)) AS o_totalprice) FROM orders",
    "config_scan": """
        SELECT CAST(c_custkey AS VARCHAR) AS job_id, c_name AS source_table, c_mktsegment AS app_pipeline,
               'daily' AS run_group, 'Y' AS is_enabled, 'Y' AS is_active
        FROM customer
        WHERE c_mktsegment = 'MACHINERY' AND c_nationkey < 12 AND c_acctbal >= 0 AND c_acctbal < 9000""",
    "empty_like": "SELECT * FROM orders",
    "source_row_count": COUNTS,
    "fetch_size_plan": f"""
        SELECT table_name, num_rows,
               CAST(CASE WHEN num_rows = 0 THEN 20 WHEN num_rows <= 100 THEN 50 WHEN num_rows <= 500 THEN 100
                    WHEN num_rows <= 5000 THEN 200 WHEN num_rows <= 20000 THEN 500
                    WHEN num_rows <= 50000 THEN 1000 WHEN num_rows <= 100000 THEN 5000
                    ELSE 10000 END AS INTEGER) AS fetch_size
        FROM ({COUNTS})""",
    "append_key_max": "SELECT max(event_id) AS max_value FROM events",
    "split_plan": """
        SELECT key, l_orderkey, l_linenumber, CAST(1 AS INTEGER) AS n_parts, TRUE AS even
        FROM lineitem, (VALUES ('power'), ('shipped')) keys(key)""",
}
