"""Partition columns and landings; every landing is written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.tables import table
from millrace.operators.landing import land, merge
from millrace.operators.partitions import partitioned
from millrace.session import scratch_table, shared_dir

LOAD_DATE = "20240102"
YEAR_MONTH = "order_month=date_format(o_orderdate, 'yyyyMM')"


def with_partition(spec: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return partitioned(table(spark, sf_dir, "orders"), spec, LOAD_DATE).df

    return run


def partition_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    query = f"SELECT date_format(max(o_orderdate), 'yyyyMM') AS m FROM parquet.`{sf_dir}/orders.parquet`"
    return with_partition(f"LAST_MONTH=({query})")(spark, sf_dir)


def land_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, target = table(spark, sf_dir, "orders"), scratch_table(spark, "append")
    land(orders.where("o_orderstatus = 'F'"), target, load_date=LOAD_DATE)
    land(orders.where("o_orderstatus <> 'F'"), target, load_date=LOAD_DATE)
    return spark.table(target)


def land_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, target = table(spark, sf_dir, "orders"), scratch_table(spark, "overwrite")
    land(orders.withColumn("old", F.lit(1)), target, load_date=LOAD_DATE)
    land(orders, target, load_date=LOAD_DATE, recreate=True)
    return spark.table(target)


def land_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, target = table(spark, sf_dir, "orders"), scratch_table(spark, "truncate")
    for _ in range(2):
        land(orders, target, load_date=LOAD_DATE, truncate=True)
    return spark.table(target)


def land_truncate_external(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partitioned table with its own location, replaced twice; read through the location."""
    orders, target = table(spark, sf_dir, "orders"), scratch_table(spark, "external")
    place = shared_dir(spark, "external")
    columns = orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    spark.sql(f"""CREATE TABLE {target} (o_orderkey BIGINT, o_totalprice DOUBLE, o_orderstatus STRING) USING parquet
                  PARTITIONED BY (o_orderstatus) LOCATION '{place}' COMMENT 'orders by status'""")
    for rows in (columns, columns.where("o_orderstatus <> 'P'")):
        land(rows, target, load_date=LOAD_DATE, partition_by="o_orderstatus", truncate=True)
    return spark.read.schema(columns.schema).parquet(place)


def land_widen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers and short decimals first, then wider ones."""
    orders, target = table(spark, sf_dir, "orders"), scratch_table(spark, "widen")
    narrow = orders.selectExpr("CAST(o_orderkey AS INT) AS key", "CAST(o_orderkey % 100 / 10 AS DECIMAL(5, 2)) AS part")
    wide = orders.selectExpr("o_orderkey + 10000000000 AS key", "CAST(o_orderkey + 0.125 AS DECIMAL(20, 3)) AS part")
    for rows in (narrow, wide):
        land(rows, target, load_date=LOAD_DATE, widen=True)
    return spark.table(target)


def land_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, target = table(spark, sf_dir, "orders"), scratch_table(spark, "partitioned")
    land(orders, target, load_date=LOAD_DATE, partition_by=YEAR_MONTH)
    return spark.table(target)


def land_partition_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, target = table(spark, sf_dir, "orders"), scratch_table(spark, "by_column")
    land(orders, target, load_date=LOAD_DATE, partition_by="o_orderstatus")
    return spark.table(target)


def land_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, target = table(spark, sf_dir, "orders"), scratch_table(spark, "evolve")
    land(orders.drop("o_orderpriority"), target, load_date=LOAD_DATE)
    land(orders, target, load_date=LOAD_DATE)
    return spark.table(target)


def land_partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders, then the finished ones again with another price."""
    orders, target = table(spark, sf_dir, "orders"), scratch_table(spark, "by_partition")
    again = orders.where("o_orderstatus = 'F'").withColumn("o_totalprice", F.lit(0.0))
    for rows in (orders, again):
        land(rows, target, load_date=LOAD_DATE, partition_by="o_orderstatus", partition_overwrite=True)
    return spark.table(target)


def land_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by priority; then a tenth of two priorities changes its price, some of it its priority, and new ones come."""
    orders, target = table(spark, sf_dir, "orders"), scratch_table(spark, "merge")
    land(orders.where("o_orderkey % 7 <> 3"), target, load_date=LOAD_DATE, partition_by="o_orderpriority")
    changed = orders.where("o_orderpriority < '3' AND o_orderkey % 10 = 0 OR o_orderkey % 7 = 3").withColumns({
        "o_totalprice": F.lit(1.0),
        "o_orderpriority": F.expr("IF(o_orderkey % 4 = 0, '6-NEW', o_orderpriority)"),
    })
    for rows in (changed, changed):
        merge(rows, target, ["o_orderkey"], load_date=LOAD_DATE, partition_by="o_orderpriority")
    return spark.table(target)


def land_evolve_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with nested columns; then with more and wider fields in another order, and a date that has become a time."""
    orders, target = table(spark, sf_dir, "orders"), scratch_table(spark, "nested")
    first = orders.where("o_orderkey % 2 = 0").selectExpr(
        "o_orderkey", "CAST(o_orderdate AS DATE) AS day",
        "named_struct('cust', CAST(o_custkey AS INT), 'place', named_struct('status', o_orderstatus)) AS info",
        "array(named_struct('n', CAST(1 AS INT))) AS lines", "map('a', CAST(o_custkey AS INT)) AS counts")
    later = orders.where("o_orderkey % 2 = 1").selectExpr(
        "o_orderkey", "o_orderdate AS day",
        "named_struct('place', named_struct('prio', o_orderpriority, 'STATUS', o_orderstatus), 'cust', o_custkey + 10000000000) AS info",
        "array(named_struct('note', o_orderstatus, 'n', 10000000000)) AS lines", "map('a', o_custkey + 10000000000) AS counts")
    for rows in (first, later):
        land(rows, target, load_date=LOAD_DATE, widen=True)
    return spark.table(target).selectExpr(
        "o_orderkey", "CAST(day AS TIMESTAMP_NTZ) AS day", "info.cust AS cust", "info.place.status AS status", "info.place.prio AS prio",
        "lines[0].n AS n", "lines[0].note AS note", "counts['a'] AS a")


def load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts taken from the write itself."""
    landed = land(table(spark, sf_dir, "lineitem"), scratch_table(spark, "metrics"), load_date=LOAD_DATE,
                  partition_by="SNAPSHOT_DATE")
    rows = [(landed.rows, landed.columns, landed.load_date)]
    return spark.createDataFrame(rows, "records_processed bigint, column_count int, load_date string")


QUERIES = {
    "snapshot_stamp": with_partition("snapshot_date"),
    "partition_expr": with_partition(YEAR_MONTH),
    "partition_column": with_partition("o_orderstatus"),
    "partition_scalar": partition_scalar,
    "land_append": land_append,
    "land_overwrite": land_overwrite,
    "land_truncate": land_truncate,
    "land_truncate_external": land_truncate_external,
    "land_widen": land_widen,
    "land_partitioned": land_partitioned,
    "land_partition_column": land_partition_column,
    "land_evolve": land_evolve,
    "land_partition_overwrite": land_partition_overwrite,
    "land_merge": land_merge,
    "land_evolve_nested": land_evolve_nested,
    "load_metrics": load_metrics,
}

BY_MONTH = "SELECT *, strftime(o_orderdate, '%Y%m') AS order_month FROM orders"

ORACLES = {
    "snapshot_stamp": f"SELECT *, '{LOAD_DATE}' AS SNAPSHOT_DATE FROM orders",
    "partition_expr": BY_MONTH,
    "partition_column": "SELECT * FROM orders",
    "partition_scalar": """
        SELECT *, (SELECT strftime(max(o_orderdate), '%Y%m') FROM orders) AS LAST_MONTH FROM orders""",
    "land_append": "SELECT * FROM orders",
    "land_overwrite": "SELECT * FROM orders",
    "land_truncate": "SELECT * FROM orders",
    "land_truncate_external": "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'",
    "land_widen": """
        SELECT o_orderkey AS key, CAST((o_orderkey % 100) / 10.0 AS DECIMAL(20, 3)) AS part FROM orders
        UNION ALL
        SELECT o_orderkey + 10000000000, CAST(o_orderkey + 0.125 AS DECIMAL(20, 3)) FROM orders""",
    "land_partitioned": BY_MONTH,
    "land_partition_column": "SELECT * FROM orders",
    "land_evolve": """
        SELECT * FROM orders UNION ALL SELECT * REPLACE (CAST(NULL AS VARCHAR) AS o_orderpriority) FROM orders""",
    "land_partition_overwrite": """
        SELECT * REPLACE (CASE WHEN o_orderstatus = 'F' THEN 0.0::DOUBLE ELSE o_totalprice END AS o_totalprice)
        FROM orders""",
    "land_evolve_nested": """
        SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS day, o_custkey AS cust, o_orderstatus AS status,
               CAST(NULL AS VARCHAR) AS prio, CAST(1 AS BIGINT) AS n, CAST(NULL AS VARCHAR) AS note, o_custkey AS a
        FROM orders WHERE o_orderkey % 2 = 0
        UNION ALL
        SELECT o_orderkey, o_orderdate, o_custkey + 10000000000, o_orderstatus, o_orderpriority, 10000000000, o_orderstatus,
               o_custkey + 10000000000
        FROM orders WHERE o_orderkey % 2 = 1""",
    "land_merge": """
        SELECT * EXCLUDE (changed)
               REPLACE (CASE WHEN changed THEN 1.0::DOUBLE ELSE o_totalprice END AS o_totalprice,
                        CASE WHEN changed AND o_orderkey % 4 = 0 THEN '6-NEW' ELSE o_orderpriority END AS o_orderpriority)
        FROM (SELECT *, o_orderpriority < '3' AND o_orderkey % 10 = 0 OR o_orderkey % 7 = 3 AS changed FROM orders)""",
    "load_metrics": f"""
        SELECT count(*) AS records_processed, CAST(11 AS INTEGER) AS column_count, '{LOAD_DATE}' AS load_date
        FROM lineitem""",
}
