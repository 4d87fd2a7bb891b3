"""Error messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.tables import table
from millrace.functions.errors import classify, classify_by_table, scrubbed

# What the events report, picked by user.
MESSAGES = [
    "ORA-01017: invalid username/password; logon denied",
    "Login failed for user",
    "connection refused after timeout",
    "read timeout",
    "ORA-01031: insufficient privileges",
    "ORA-00942: table or view does not exist",
    "ORA-00904: invalid column C1",
    "Timeout in upper case",
    "disk full",
]


def message() -> Column:
    picked = F.element_at(F.array(*map(F.lit, MESSAGES)), (F.col("user_id") % len(MESSAGES) + 1).cast("int"))
    return F.concat_ws(" ", "event_type", picked, "props")


def classify_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", message().alias("error_message"))
    return classify(events, "error_message")


def classify_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pattern table: nations by priority, whose names also begin the names of others."""
    patterns = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("prio"),
        F.concat("n_name", F.lit("|UNKNOWN")).alias("pattern"),
        F.when(F.col("n_regionkey") < 2, "CRITICAL").otherwise("NON_CRITICAL").alias("error_type"),
        F.concat(F.lit("refused by "), "n_name").alias("description"),
    )
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") < 0, "no nation")
        .otherwise(F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string"), F.lit(" refused")))
        .alias("error_message"),
    )
    return classify_by_table(customers, "error_message", patterns)


def classify_many_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two patterns for each of up to 10,000 codes, of which the first holds for finished orders only."""
    orders = table(spark, sf_dir, "orders").withColumn("code", F.format_string("ORA-%05d", F.col("o_orderkey") % 10000))
    codes = orders.select("code", (F.col("o_orderkey") % 10000).cast("int").alias("k")).distinct()
    kinds = [("[0-9]+ ended$", "k", "CRITICAL"), (r"\d+|TNS-", "k + 10000", "NON_CRITICAL")]
    patterns = [codes.select(F.expr(prio).alias("prio"), F.concat("code", F.lit(f": order {rest}")).alias("pattern"),
                             F.lit(kind).alias("error_type"), F.concat("code", F.lit(f" {kind}")).alias("description"))
                for rest, prio, kind in kinds]
    messages = orders.select("o_orderkey", F.concat(
        "code", F.lit(": order "), "o_custkey", F.when(F.col("o_orderstatus") == "F", " ended").otherwise(" runs")).alias("error_message"))
    return classify_by_table(messages, "error_message", patterns[0].unionAll(patterns[1]))


def scrub_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", scrubbed("text").alias("message"))


QUERIES = {
    "classify_errors": classify_errors,
    "classify_errors_table": classify_by_nation,
    "classify_many_patterns": classify_many_patterns,
    "scrub_messages": scrub_messages,
}

MESSAGE_LIST = ", ".join(f"'{text}'" for text in MESSAGES)

ORACLES = {
    "classify_errors": f"""
        WITH e AS (
            SELECT event_id, event_type || ' ' || list_extract([{MESSAGE_LIST}], user_id % {len(MESSAGES)} + 1)
                             || ' ' || props AS error_message FROM events),
        p(prio, pattern, error_type, description) AS (VALUES
            (1, 'ORA-01017|invalid username/password|Login failed', 'CRITICAL', 'Invalid Credentials'),
            (2, 'ORA-12541|no listener|connection refused', 'CRITICAL', 'Connection refused'),
            (3, 'timeout|connection reset|network error', 'CRITICAL', 'Network Connectivity issue'),
            (4, 'ORA-01031|insufficient privileges', 'CRITICAL', 'Insufficient permissions'),
            (5, 'ORA-00942|table or view does not exist|table not found', 'NON_CRITICAL',
                'Table or view does not exist'),
            (6, 'ORA-00904|invalid column', 'NON_CRITICAL', 'Invalid column'))
        SELECT event_id, error_message, coalesce(min_by(error_type, prio), 'NON_CRITICAL') AS error_type,
               coalesce(min_by(description, prio), 'Error occurred') AS description
        FROM e LEFT JOIN p ON regexp_matches(error_message, pattern) GROUP BY event_id, error_message""",
    "classify_errors_table": """
        WITH m AS (
            SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'no nation'
                                   ELSE 'NATION_' || CAST(c_nationkey AS VARCHAR) || ' refused' END AS error_message
            FROM customer)
        SELECT c_custkey, error_message,
               coalesce(min_by(CASE WHEN n_regionkey < 2 THEN 'CRITICAL' ELSE 'NON_CRITICAL' END, n_nationkey),
                        'NON_CRITICAL') AS error_type,
               coalesce(min_by('refused by ' || n_name, n_nationkey), 'Error occurred') AS description
        FROM m LEFT JOIN nation ON regexp_matches(error_message, n_name || '|UNKNOWN')
        GROUP BY c_custkey, error_message""",
    "classify_many_patterns": """
        SELECT o_orderkey, code || ': order ' || o_custkey || CASE WHEN o_orderstatus = 'F' THEN ' ended' ELSE ' runs' END
                           AS error_message,
               kind AS error_type, code || ' ' || kind AS description
        FROM (SELECT *, printf('ORA-%05d', o_orderkey % 10000) AS code,
                     CASE WHEN o_orderstatus = 'F' THEN 'CRITICAL' ELSE 'NON_CRITICAL' END AS kind FROM orders)""",
    "scrub_messages": "SELECT doc_id, replace(replace(text, '''', ''), chr(10), ' ') AS message FROM documents",
}
