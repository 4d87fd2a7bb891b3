"""Tables that Spark reads itself: config tables, and lake tables as a source of loads."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.names import rename_safe
from millrace.model import PipelineConfig, TableJob
from millrace.operators.cdc import Key, key_maximum
from millrace.operators.profiles import ProfileStore
from millrace.sources.dialects import Oracle, SqlServer
from millrace.sources.extract import Extract, extract_from
from millrace.sources.jdbc import JdbcConnection, JdbcSource, SplitSettings


def matching(df: DataFrame, equal: Mapping[str, str]) -> DataFrame:
    """The rows in which every named column has the given value."""
    for name, value in equal.items():
        df = df.where(F.col(name) == F.lit(value))
    return df


def pipeline_config(alerts: DataFrame, app_pipeline: str, run_group: str) -> PipelineConfig:
    """The active settings of a pipeline and run group."""
    wanted = {"app_pipeline": app_pipeline, "run_group": run_group, "is_active": "Y"}
    rows = matching(alerts, wanted).take(1)
    if not rows:
        raise ValueError(f"no active settings for pipeline {app_pipeline} and run group {run_group}")
    return PipelineConfig.from_row(rows[0])


def enabled_jobs(config: DataFrame, app_pipeline: str, run_group: str) -> DataFrame:
    """The config rows to run."""
    wanted = {"app_pipeline": app_pipeline, "run_group": run_group, "is_enabled": "Y", "is_active": "Y"}
    return matching(config, wanted)


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, same schema."""
    return df.sparkSession.createDataFrame([], df.schema)


class LakeSource:
    """Loads from tables that Spark reads, by catalog name or by any other reader."""

    def __init__(self, spark: SparkSession, read: Callable[[str, str], DataFrame] | None = None):
        self.spark = spark
        self.read = read or (lambda schema, table: spark.table(f"{schema}.{table}"))

    def columns(self, job: TableJob) -> list[str]:
        return self.read(job.source_schema, job.source_table).columns

    def row_counts(self, schema: str, tables: list[str]) -> DataFrame:
        """table_name and num_rows, counted."""
        counts = [self.read(schema, name).agg(F.count(F.lit(1)).alias("num_rows")).select(
            F.lit(name).alias("table_name"), "num_rows") for name in tables]
        return reduce(DataFrame.union, counts)

    def key_max(self, job: TableJob) -> Key | None:
        df = self.read(job.source_schema, job.source_table)
        return key_maximum(df, job.cdc_append_key_column).first().max_value

    def extract(self, job: TableJob, extract: Extract) -> DataFrame:
        df = extract_from(self.read(job.source_schema, job.source_table), extract)
        return df if extract.fields else rename_safe(df)


Source = JdbcSource | LakeSource


def open_source(spark: SparkSession, config: Mapping[str, str], password: str,
                profiles: ProfileStore | None = None) -> JdbcSource:
    """The database that a pipeline's source settings name."""
    db_type = (config.get("db_type") or "").upper()
    splits = SplitSettings.of(config)
    if db_type == "ORACLE":
        return JdbcSource(spark, JdbcConnection.oracle(config, password), Oracle(), splits, profiles)
    if db_type == "MSSQL":
        return JdbcSource(spark, JdbcConnection.sql_server(config, password), SqlServer(), splits)
    raise ValueError(f"Unsupported source_db_type: {config.get('db_type')}")
