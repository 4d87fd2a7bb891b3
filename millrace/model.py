"""Schemas and typed settings."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field, fields
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# States, layer name and time formats of the ledger.
STARTED = "STARTED"
COMPLETED = "COMPLETED"
FAILED = "FAILED"
LAYER = "staging"
HOUR_FORMAT = "yyyyMMddHH"
DAY_FORMAT = "yyyyMMdd"
SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Append keys of the tracker: whole numbers of 20 digits, and fractions as exact as a double's shortest text. Other keys are
# kept as text.
KEY_TYPE = T.DecimalType(38, 18)

# The columns of the ledger.
LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("spark_app_id", T.StringType()),
        T.StructField("run_group", T.StringType()),
        T.StructField("dlh_layer", T.StringType()),
        T.StructField("job_id", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("schema", T.StringType()),
        T.StructField("column_count", T.IntegerType()),
        T.StructField("status", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("end_time", T.TimestampType()),
        T.StructField("records_processed", T.LongType()),
        T.StructField("records_rejected", T.LongType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("load_date", T.StringType()),
        T.StructField("comments", T.StringType()),
    ]
)

TRACKER_SCHEMA = T.StructType(
    [
        T.StructField("job_id", T.StringType()),
        T.StructField("source_table", T.StringType()),
        T.StructField("ts_hour", T.StringType()),
        T.StructField("key_value", KEY_TYPE),
        T.StructField("key_text", T.StringType()),
        T.StructField("load_id", T.StringType()),
    ]
)

# What appending loads were about to do.
LOADS_SCHEMA = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("load_id", "job_id", "source_table", "target_table", "state", "ts_hour", "key_text")
    ]
    + [T.StructField("at", T.TimestampType())]
)

CATALOGUE_SCHEMA = T.StructType(
    [
        T.StructField("column_name", T.StringType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("ordinal_position", T.IntegerType()),
    ]
)

# With the digits that a number is declared with.
DECLARED_SCHEMA = T.StructType(
    [*CATALOGUE_SCHEMA.fields, T.StructField("data_precision", T.IntegerType()), T.StructField("data_scale", T.IntegerType())]
)

PATTERN_SCHEMA = T.StructType(
    [
        T.StructField("prio", T.IntegerType()),
        T.StructField("pattern", T.StringType()),
        T.StructField("error_type", T.StringType()),
        T.StructField("description", T.StringType()),
    ]
)

LOG_SCHEMA = T.StructType(
    [
        T.StructField("ts", T.TimestampType()),
        T.StructField("level", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)

# What is known of the numbers of source tables.
PROFILE_SCHEMA = T.StructType(
    [
        T.StructField("source_table", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("fractional_rows", T.LongType()),
        T.StructField("scale", T.IntegerType()),
        T.StructField("max_abs", T.DoubleType()),
    ]
)

TEXT_MAP = T.MapType(T.StringType(), T.StringType())

# The columns of the settings and of the ingestion config. Settings of a pipeline: those of mail delivery are kept for existing tables and not used.
ALERT_CONFIG_SCHEMA = T.StructType(
    [
        T.StructField("app_pipeline", T.StringType()),
        T.StructField("run_group", T.StringType()),
        T.StructField("is_active", T.StringType()),
        T.StructField("log_bucket", T.StringType()),
        T.StructField("log_reference", T.StringType()),
        T.StructField("smtp_server", T.StringType()),
        T.StructField("smtp_port", T.IntegerType()),
        T.StructField("statusEmails", T.StringType()),
        T.StructField("retention_period", T.IntegerType()),
        T.StructField("alert_email_from", T.StringType()),
        T.StructField("success_email_to", T.StringType()),
        T.StructField("failure_email_to", T.StringType()),
        T.StructField("alert_type", T.StringType()),
        T.StructField("catalog_name", T.StringType()),
        T.StructField("schema_config", TEXT_MAP),
        T.StructField("ingest_tbl", T.StringType()),
        T.StructField("alert_tbl", T.StringType()),
        T.StructField("job_status_tbl", T.StringType()),
        T.StructField("cdc_tracker_tbl", T.StringType()),
        T.StructField("source_db_config", TEXT_MAP),
        T.StructField("dbpass", T.StringType()),
        T.StructField("max_workers", T.IntegerType()),
    ]
)

INGEST_CONFIG_SCHEMA = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "job_id",
            "source_schema",
            "source_table",
            "target_schema",
            "target_table",
            "app_pipeline",
            "run_group",
            "is_enabled",
            "is_active",
            "load_type",
            "cdc_type",
            "cdc_modified_date_column",
            "cdc_created_date_column",
            "cdc_append_key_column",
            "source_fields",
            "source_where_clause",
            "target_partition_by",
            "target_truncate",
            "target_partition_overwrite",
            "target_recreate",
        )
    ]
    + [T.StructField("target_table_options", TEXT_MAP)]
)

OUTCOME_SCHEMA = T.StructType(
    [
        T.StructField("job_id", T.StringType()),
        T.StructField("source_schema", T.StringType()),
        T.StructField("source_table", T.StringType()),
        T.StructField("target_schema", T.StringType()),
        T.StructField("target_table", T.StringType()),
        T.StructField("has_data", T.BooleanType()),
        T.StructField("column_count", T.IntegerType()),
        T.StructField("records_processed", T.LongType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("end_time", T.TimestampType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("load_date", T.StringType()),
        T.StructField("comments", T.StringType()),
    ]
)


def one_row(spark: SparkSession, schema: T.StructType, values: tuple) -> DataFrame:
    """One row of literals, which needs no Python worker."""
    return spark.range(1, numPartitions=1).select(
        *[F.lit(value).cast(field.dataType).alias(field.name) for field, value in zip(schema.fields, values, strict=True)]
    )


def is_yes(flag: Any) -> bool:
    return flag is not None and str(flag).strip().upper() == "Y"


def text_or_none(value: Any) -> str | None:
    """The stripped text, or None where it is missing or blank."""
    if value is None or not str(value).strip():
        return None
    return str(value).strip()


@dataclass(frozen=True)
class TableJob:
    """One row of the ingestion config."""

    job_id: str
    source_schema: str
    source_table: str
    target_schema: str
    target_table: str
    app_pipeline: str | None = None
    run_group: str | None = None
    load_type: str | None = None
    cdc_type: str | None = None
    cdc_modified_date_column: str | None = None
    cdc_created_date_column: str | None = None
    cdc_append_key_column: str | None = None
    source_fields: str | None = None
    source_where_clause: str | None = None
    target_partition_by: str | None = None
    target_truncate: str | None = None
    target_partition_overwrite: str | None = None
    target_recreate: str | None = None
    target_table_options: dict[str, str] | None = None

    @classmethod
    def from_row(cls, row: Row) -> TableJob:
        values = row.asDict(recursive=True)
        given = {f.name: values.get(f.name) for f in fields(cls)}
        for name, value in given.items():
            if name != "target_table_options":
                given[name] = text_or_none(value)
        return cls(**given)

    @property
    def incremental(self) -> bool:
        """A missing load type means a full load, on every source."""
        return (self.load_type or "").upper() == "INCREMENTAL"

    @property
    def change_rule(self) -> str | None:
        """TIMESTAMP, APPEND_KEY, or None where no usable rule is set."""
        rule = (self.cdc_type or "").upper()
        if not self.incremental:
            return None
        if rule == "TIMESTAMP" and (self.cdc_modified_date_column or self.cdc_created_date_column):
            return rule
        if rule == "APPEND_KEY" and self.cdc_append_key_column:
            return rule
        return None


@dataclass(frozen=True)
class RunContext:
    """Values fixed once at the start of a run, so that every table sees the same bounds."""

    run_id: str
    batch_id: str
    spark_app_id: str
    run_group: str
    run_ts: datetime

    @classmethod
    def start(cls, spark: SparkSession, run_group: str, run_ts: datetime | None = None) -> RunContext:
        now = run_ts or datetime.now()
        return cls(
            run_id=uuid.uuid4().hex,
            batch_id=now.strftime("%Y%m%d%H"),
            spark_app_id=spark.sparkContext.applicationId,
            run_group=run_group,
            run_ts=now,
        )

    @property
    def load_date(self) -> str:
        return self.run_ts.strftime("%Y%m%d")


@dataclass(frozen=True)
class PipelineConfig:
    """The active pipeline settings of one pipeline and run group."""

    app_pipeline: str
    run_group: str
    source_db_config: dict[str, str] = field(default_factory=dict)
    dbpass: str = field(default="", repr=False)
    catalog_name: str = ""
    tbl_schema: str = ""
    ingest_tbl: str = ""
    job_status_tbl: str = ""
    cdc_tracker_tbl: str = ""
    log_bucket: str = ""
    log_reference: str = ""
    statusEmails: str = "Y"
    max_workers: int = 5

    @classmethod
    def from_row(cls, row: Row) -> PipelineConfig:
        values = row.asDict(recursive=True)
        given = {f.name: values[f.name] for f in fields(cls) if values.get(f.name) is not None}
        if "max_workers" in given:
            given["max_workers"] = int(given["max_workers"])
        given["tbl_schema"] = (values.get("schema_config") or {}).get("tbl_schema", "")
        return cls(**given)

    def table(self, name: str) -> str:
        """The full name of one of the engine's own tables."""
        return ".".join(part for part in (self.catalog_name, self.tbl_schema, name) if part)

    @property
    def log_folder(self) -> str:
        return f"{self.log_bucket}{self.log_reference}"

    def report_folder(self, run: RunContext) -> str:
        """Where the reports of a batch go."""
        day = run.load_date
        return f"{self.log_folder}{self.app_pipeline}/{day}/reports/{run.batch_id}/{run.run_id}"
