"""Names, types and schema changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.tables import SOURCE_TYPES, table
from millrace.functions.names import rename_safe, sanitized, select_lists, with_select_items
from millrace.functions.typemap import numeric_scale_profile, schema_map
from millrace.model import CATALOGUE_SCHEMA
from millrace.operators.profiles import ProfileStore
from millrace.operators.schema_diff import schema_diff
from millrace.session import scratch_table


def sanitize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", "url", sanitized("url").alias("safe_name"))


def safe_select_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names at volume: every host is a table, and every address a column of it."""
    pages = table(spark, sf_dir, "pages").select(
        F.regexp_extract("url", "^https?://([^/]+)", 1).alias("table_name"),
        F.col("url").alias("column_name"),
        F.col("page_id").alias("ordinal_position"),
    )
    return with_select_items(pages, ["table_name"])


def select_list_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order is a table, and its few lines are the columns."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("table_key"),
        F.concat(F.lit("Col-"), (F.col("l_partkey") % 5).cast("string"), F.lit("]")).alias("column_name"),
        F.col("l_linenumber").alias("ordinal_position"),
    )
    return select_lists(lines, ["table_key"])


def renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    awkward = part.toDF("Part Key", "part-key", "p@brand", "  type  ", "size (cm)", "Größe/Preis")
    return rename_safe(awkward)


def scale_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numeric_scale_profile(table(spark, sf_dir, "lineitem"))


def mapped_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    rows = [(name, SOURCE_TYPES[kind], i) for i, (name, kind) in enumerate(lineitem.dtypes, start=1)]
    catalogue = spark.createDataFrame(rows, CATALOGUE_SCHEMA)
    return schema_map(catalogue, numeric_scale_profile(lineitem))


def diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that the users of two fortnights sent: the kind of event, typed by its values."""
    def seen(condition: str) -> DataFrame:
        kind = F.when(F.max("value") >= 50, "DECIMAL(38, 2)").otherwise("LONG")
        events = table(spark, sf_dir, "events").where(condition)
        return events.groupBy("user_id", "event_type").agg(kind.alias("data_type")).withColumnRenamed(
            "event_type", "column_name"
        )

    middle = "TIMESTAMP_NTZ'2024-01-15 00:00:00'"
    return schema_diff(seen(f"ts < {middle}"), seen(f"ts >= {middle}"), ["user_id", "column_name"])


def scale_profile_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of three windows of lines, kept one after the other and shrunk in between."""
    lines = table(spark, sf_dir, "lineitem")
    store = ProfileStore(spark, scratch_table(spark, "profiles"), most=1)
    merged = None
    for low, high in (("1900-01-01", "1994-01-01"), ("1994-01-01", "1994-01-02"), ("1994-01-02", "2100-01-01")):
        window = lines.where(f"l_shipdate >= TIMESTAMP_NTZ'{low} 00:00:00' AND l_shipdate < TIMESTAMP_NTZ'{high} 00:00:00'")
        merged = store.extend("given", "lineitem", numeric_scale_profile(window))
    return merged


QUERIES = {
    "sanitize_names": sanitize_names,
    "safe_select_list": safe_select_list,
    "select_list_text": select_list_text,
    "rename_safe": renamed,
    "numeric_scale_profile": scale_profile,
    "scale_profile_merge": scale_profile_merge,
    "schema_map": mapped_schema,
    "schema_diff": diff,
}

NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
           "l_tax"]


def _profile(column: str) -> str:
    exact = f"CAST({column} AS DECIMAL(38,10))"
    digits = f"length(rtrim(split_part(CAST({exact} AS VARCHAR), '.', 2), '0'))"
    return f"""SELECT '{column}' AS column_name,
                      count(*) FILTER (WHERE {exact} <> trunc({exact})) AS fractional_rows,
                      CAST(max({digits}) AS INTEGER) AS scale,
                      CAST(max(abs({column})) AS DOUBLE) AS max_abs
               FROM lineitem"""


PROFILE = " UNION ALL ".join(map(_profile, NUMBERS))
CATALOGUE = ", ".join(
    f"('{name}', '{kind}', {i})"
    for i, (name, kind) in enumerate(
        [(n, "NUMBER") for n in NUMBERS]
        + [("l_returnflag", "VARCHAR2"), ("l_linestatus", "VARCHAR2"), ("l_shipdate", "TIMESTAMP(6)")],
        start=1,
    )
)
SAFE_URL = "trim(regexp_replace(url, '[^A-Za-z0-9]+', '_', 'g'), '_')"


def _seen(condition: str) -> str:
    return f"""SELECT user_id, event_type AS column_name,
                      CASE WHEN max(value) >= 50 THEN 'DECIMAL(38, 2)' ELSE 'LONG' END AS data_type
               FROM events WHERE {condition} GROUP BY user_id, event_type"""


ORACLES = {
    "sanitize_names": f"SELECT page_id, url, {SAFE_URL} AS safe_name FROM pages",
    "safe_select_list": f"""
        WITH named AS (
            SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS table_name, url AS column_name,
                   page_id AS ordinal_position, {SAFE_URL} AS plain FROM pages),
        ranked AS (
            SELECT *, min(ordinal_position) OVER (PARTITION BY table_name, lower(plain)) AS first_ordinal
            FROM named),
        safe AS (
            SELECT table_name, column_name, ordinal_position,
                   CASE WHEN ordinal_position = first_ordinal THEN plain
                        ELSE plain || '__' || CAST(ordinal_position AS VARCHAR) END AS safe_name
            FROM ranked)
        SELECT *, '[' || replace(column_name, ']', ']]') || '] as ' || safe_name AS select_item FROM safe""",
    # The given lines repeat some numbers of an order, so the text decides between them.
    "select_list_text": """
        WITH named AS (
            SELECT l_orderkey AS table_key, l_linenumber AS ordinal_position,
                   CAST(l_partkey % 5 AS VARCHAR) AS digit FROM lineitem),
        ranked AS (
            SELECT *, min(ordinal_position) OVER (PARTITION BY table_key, digit) AS first_ordinal FROM named),
        items AS (
            SELECT table_key, ordinal_position, '[Col-' || digit || ']]] as Col_' || digit
                   || CASE WHEN ordinal_position = first_ordinal THEN ''
                           ELSE '__' || CAST(ordinal_position AS VARCHAR) END AS item
            FROM ranked)
        SELECT table_key, string_agg(item, ',' ORDER BY ordinal_position, item) AS select_list
        FROM items GROUP BY table_key""",
    "rename_safe": """
        SELECT p_partkey AS Part_Key, p_name AS part_key__2, p_brand AS p_brand, p_type AS type,
               p_size AS size_cm, p_retailprice AS Gr_e_Preis FROM part""",
    "numeric_scale_profile": PROFILE,
    "scale_profile_merge": PROFILE,
    "schema_map": f"""
        SELECT c.column_name, c.data_type, CAST(c.ordinal_position AS INTEGER) AS ordinal_position,
               CASE WHEN c.data_type = 'NUMBER' AND p.fractional_rows > 0
                         THEN 'DECIMAL(38, ' || CAST(p.scale AS VARCHAR) || ')'
                    WHEN c.data_type = 'NUMBER' THEN 'LONG'
                    WHEN c.data_type = 'VARCHAR2' THEN 'STRING'
                    ELSE 'TIMESTAMP' END AS spark_type,
               false AS is_fallback
        FROM (VALUES {CATALOGUE}) AS c(column_name, data_type, ordinal_position)
        LEFT JOIN ({PROFILE}) AS p ON p.column_name = c.column_name""",
    "schema_diff": f"""
        SELECT user_id, column_name, o.data_type AS old_type, n.data_type AS new_type,
               CASE WHEN o.data_type IS NULL THEN 'ADDED' WHEN n.data_type IS NULL THEN 'DROPPED'
                    WHEN o.data_type <> n.data_type THEN 'TYPE_CHANGED' ELSE 'SAME' END AS change
        FROM ({_seen("ts < TIMESTAMP '2024-01-15 00:00:00'")}) o
        FULL OUTER JOIN ({_seen("ts >= TIMESTAMP '2024-01-15 00:00:00'")}) n USING (user_id, column_name)""",
}
