"""What loads have found out about the numbers of source tables, kept so that later loads need not look again."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.typemap import PROFILE_COLUMNS, merged_profiles
from millrace.model import PROFILE_SCHEMA
from millrace.operators.filelog import add, compact, steady
from millrace.operators.landing import create_table


class ProfileStore:
    """Profile states of columns by source table, in one file table.

    A state is the profile of some rows; states of disjoint rows merge to the profile of all. A load that is repeated counts its
    rows with fractions again, which changes no type.
    """

    def __init__(self, spark: SparkSession, table: str, fmt: str = "parquet", most: int = 64):
        self.spark, self.table, self.fmt, self.most = spark, table, fmt, most
        self._lock = threading.Lock()

    def _ensure(self) -> None:
        create_table(self.spark, self.table, PROFILE_SCHEMA, self.fmt, [])

    def known(self, schema: str, table: str) -> DataFrame:
        """The merged profile of a source table's columns so far; its rows reach the driver, one per column."""
        with self._lock:
            self._ensure()
        name = f"{schema}.{table}"
        rows = steady(self.spark, self.table, lambda states: merged_profiles(states.where(F.col("source_table") == name)).collect())
        return self.spark.createDataFrame(rows, PROFILE_COLUMNS)

    def extend(self, schema: str, table: str, profile: DataFrame) -> DataFrame:
        """Adds the profile of a load's rows, and returns that of all rows so far."""
        known, fresh = self.known(schema, table), profile.select(*[f.split()[0] for f in PROFILE_COLUMNS.split(", ")])
        rows = fresh.collect()
        if rows:
            fresh = self.spark.createDataFrame(rows, PROFILE_COLUMNS)
            with self._lock:
                add(fresh.withColumn("source_table", F.lit(f"{schema}.{table}")), self.table)
                compact(self.spark, self.table, self.most, lambda states: merged_profiles(states, ["source_table"]))
        return merged_profiles(known.unionAll(fresh))
