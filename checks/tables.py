"""The given tables, as frames and as a source of loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.sources.lake import LakeSource

NAMES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

# The types that the given columns would have in a source database, by Spark type.
SOURCE_TYPES = {"bigint": "NUMBER", "int": "NUMBER", "double": "NUMBER", "string": "VARCHAR2",
                "timestamp_ntz": "TIMESTAMP(6)"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source(spark: SparkSession, sf_dir: str) -> LakeSource:
    return LakeSource(spark, lambda schema, name: table(spark, sf_dir, name))
