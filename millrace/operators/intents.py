"""The intent log: what each appending load was about to do, so that a repeat after a crash lands no row twice.

A load notes its intent, lands rows in files that bear its id, writes its watermark with the same id, and notes its end. What
a broken load has left is known by its id: without watermark its files go, and the load is done anew.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.model import LOADS_SCHEMA, TableJob, one_row
from millrace.operators.cdc import Window, watermark_values

PLANNED, DONE = "PLANNED", "DONE"


@dataclass(frozen=True)
class Intent:
    """A load that has begun to append rows."""

    load_id: str
    job_id: str
    source_table: str
    target_table: str
    ts_hour: str | None = None
    key_text: str | None = None

    @classmethod
    def of(cls, job: TableJob, table: str, window: Window | None) -> Intent:
        hour, key = watermark_values(window) if window else (None, None)
        return cls(uuid.uuid4().hex, job.job_id, job.source_table, table, hour, key)

    @property
    def has_mark(self) -> bool:
        return self.ts_hour is not None or self.key_text is not None

    def rows(self, log: DataFrame, state: str) -> DataFrame:
        values = (self.load_id, self.job_id, self.source_table, self.target_table, state, self.ts_hour, self.key_text,
                  datetime.now())
        return one_row(log.sparkSession, LOADS_SCHEMA, values)


def unfinished(log: DataFrame) -> DataFrame:
    """The loads that were planned and have no end: one row each."""
    ended = log.where(F.col("state") == DONE).select("load_id").distinct()
    return log.where(F.col("state") == PLANNED).dropDuplicates(["load_id"]).join(ended, "load_id", "left_anti")


def open_intents(log: DataFrame, jobs: list[TableJob]) -> dict[tuple[str, str], list[Intent]]:
    """The unfinished loads of the given jobs by job and source table, in one query; the oldest first."""
    own = log.where(F.col("job_id").isin([job.job_id for job in jobs]))
    found: dict[tuple[str, str], list[Intent]] = {}
    for row in unfinished(own).orderBy("at", "load_id").collect():
        intent = Intent(row.load_id, row.job_id, row.source_table, row.target_table, row.ts_hour, row.key_text)
        found.setdefault((row.job_id, row.source_table), []).append(intent)
    return found
