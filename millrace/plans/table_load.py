"""The load of one table: window, extract, landing, watermark."""

from __future__ import annotations

import threading
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.model import LOADS_SCHEMA, TRACKER_SCHEMA, RunContext, TableJob, is_yes
from millrace.operators.cdc import Mark, mark_row, marks, plan_window, watermark_values
from millrace.operators.filelog import FILE_FORMATS, add, compact, place, steady
from millrace.operators.intents import DONE, PLANNED, Intent, open_intents, unfinished
from millrace.operators.landing import (
    ATOMIC_FORMATS,
    MERGE_KEY,
    add_columns,
    create_table,
    insert,
    land,
    merge,
    partition_columns,
    undo_load,
)
from millrace.operators.schema_diff import NO_CHANGE, change_list
from millrace.sources.extract import Extract
from millrace.sources.lake import Source


@dataclass(frozen=True)
class Outcome:
    """What became of one table."""

    job: TableJob
    start_time: datetime
    end_time: datetime
    has_data: bool
    column_count: int = 0
    records_processed: int = 0
    error_message: str | None = None
    load_date: str | None = None
    comments: str | None = None

    def row(self) -> tuple:
        """In the order of ``OUTCOME_SCHEMA``."""
        job = self.job
        return (
            job.job_id, job.source_schema, job.source_table, job.target_schema, job.target_table,
            self.has_data, self.column_count, self.records_processed, self.start_time, self.end_time,
            self.error_message, self.load_date, self.comments,
        )


#: Files of the tracker, and of the intent log, beyond which a batch compacts them, as each load adds some.
TRACKER_FILES = 64


def _quiet(step: str) -> None:
    """Takes no notice of a step."""


@dataclass
class Target:
    """Where the tables of a batch land. File formats take one writer per table at a time.

    The tracker and the intent log beside it (``<tracker>_loads``) take additions of several batches at once. ``progress`` is told
    each step of a load: planned, landed, marked, done.
    """

    spark: SparkSession
    tracker: str
    catalog: str = ""
    fmt: str = "parquet"
    progress: Callable[[str], None] = _quiet

    def __post_init__(self) -> None:
        self._guard = threading.Lock()
        self._locks: dict[str, threading.Lock] = {}

    def lock(self, table: str) -> threading.Lock:
        with self._guard:
            return self._locks.setdefault(table, threading.Lock())

    def table(self, job: TableJob) -> str:
        return ".".join(part for part in (self.catalog, job.target_schema, job.target_table) if part)

    @property
    def loads(self) -> str:
        return f"{self.tracker}_loads"

    def ensure_tracker(self) -> None:
        """The tracker, with the columns that an older one may lack."""
        spark = self.spark
        with self.lock(self.tracker):
            create_table(spark, self.tracker, TRACKER_SCHEMA, self.fmt, [])
            known = {f.name for f in spark.table(self.tracker).schema.fields}
            add_columns(spark, self.tracker, [f for f in TRACKER_SCHEMA.fields if f.name not in known])

    def tracked(self, jobs: list[TableJob]) -> dict[tuple[str, str], Mark]:
        """The marks of all jobs, by one aggregate over the tracker, which is compacted where it has many files."""
        self.ensure_tracker()
        with self.lock(self.tracker):
            compact(self.spark, self.tracker, TRACKER_FILES, DataFrame.distinct)
            return steady(self.spark, self.tracker, lambda rows: marks(rows, jobs))

    def pending(self, jobs: list[TableJob]) -> dict[tuple[str, str], list[Intent]]:
        """The loads of the jobs that broke off, by one query over the intent log."""
        if self.fmt in ATOMIC_FORMATS:
            return {}
        with self.lock(self.loads):
            create_table(self.spark, self.loads, LOADS_SCHEMA, self.fmt, [])
            compact(self.spark, self.loads, TRACKER_FILES, unfinished)
            return steady(self.spark, self.loads, lambda log: open_intents(log, jobs))

    def note(self, intents: list[Intent], state: str) -> None:
        """Adds a state of loads to the intent log, as one file."""
        if intents:
            with self.lock(self.loads):
                log = self.spark.table(self.loads)
                add(reduce(DataFrame.unionAll, [intent.rows(log, state) for intent in intents]), self.loads)

    def mark(self, job: TableJob, ts_hour: str | None, key: str | None, load_id: str | None) -> None:
        """Adds a watermark to the tracker."""
        with self.lock(self.tracker):
            row = mark_row(self.spark.table(self.tracker), job, ts_hour, key, load_id)
            _, fmt = place(self.spark, self.tracker)
            if fmt in FILE_FORMATS and not partition_columns(self.spark, self.tracker):
                add(row, self.tracker)
            else:
                insert(row, self.tracker)

    def settle(self, job: TableJob, intents: list[Intent]) -> bool:
        """Ends loads that broke off; True where a watermark was added.

        A load that has its watermark is over. Of any other the files are removed, unless its rows came in with a
        replacement of the table, when its watermark follows now.
        """
        marked = False
        for intent in intents:
            ended = intent.has_mark and steady(
                self.spark, self.tracker, lambda rows, i=intent: not rows.where(F.col("load_id") == i.load_id).isEmpty())
            if not ended:
                with self.lock(intent.target_table):
                    whole = undo_load(self.spark, intent.target_table, intent.load_id, self.fmt)
                if whole and intent.has_mark:
                    self.mark(job, intent.ts_hour, intent.key_text, intent.load_id)
                    marked = True
            self.note([intent], DONE)
        return marked


def changes(before: list[tuple[str, str]] | None, incoming: DataFrame, after: DataFrame, derived: list[str]) -> str:
    """What a load found changed: columns of the target that the source no longer has, new ones, other types.

    ``before`` has the target's columns and types before the load. Columns that the landing derives are
    left aside.
    """
    if before is None:
        return NO_CHANGE
    has = {name.lower() for name in incoming.columns}
    aside = {name.lower() for name in derived} - has
    now = {name.lower(): kind for name, kind in after.dtypes}
    old = [(name.lower(), kind) for name, kind in before if name.lower() not in aside]
    new = [(name, now[name]) for name in sorted(has)]
    if sorted(old) == new:
        return NO_CHANGE
    return change_list(dict(old), dict(new))


def load_table(job: TableJob, source: Source, target: Target, run: RunContext, mark: Mark | None = None,
               pending: list[Intent] | None = None, ended: list[Intent] | None = None) -> Outcome:
    """Loads one table in full or by its change window.

    ``mark`` is what the tracker knows of the job and ``pending`` its loads that broke off, where the batch has looked them up
    with those of the others.

    The watermark is written after the landing has committed, and holds the upper bound that the
    window used. The rows of a window are added to those of earlier ones, or with a merge key take the place of their older
    versions; partitions are overwritten only by a load that reads the whole table. A load that appends notes its intent first and its end last; if the
    process dies in between, the next load of the job takes back what it has landed without watermark. Where ``ended`` is given,
    it takes the loads with a watermark instead, for the batch to note at once; until then the watermark tells that they are over.
    """
    started = datetime.now()
    spark, own = target.spark, (job.job_id, job.source_table)
    if not source.columns(job):
        raise ValueError(f"{job.source_schema}.{job.source_table} has no columns")
    if pending is None:
        pending = target.pending([job]).get(own, [])
    if pending:
        target.ensure_tracker()
        if target.settle(job, pending):
            mark = None
    window = None
    if job.change_rule:
        if mark is None:
            mark = target.tracked([job]).get(own, Mark())
        window = plan_window(job, mark, run.run_ts, lambda: source.key_max(job))
    df = source.extract(job, Extract(job.source_fields, job.source_where_clause, window))

    table = target.table(job)
    replaces = is_yes(job.target_recreate) or is_yes(job.target_truncate)
    overwrite = is_yes(job.target_partition_overwrite) and window is None
    key = (job.target_table_options or {}).get(MERGE_KEY)
    merges = window is not None and not replaces and bool(key)
    intent = None
    if not replaces and not overwrite and not merges and target.fmt not in ATOMIC_FORMATS:
        intent = Intent.of(job, table, window)
        target.note([intent], PLANNED)
        target.progress("planned")
    with target.lock(table):
        exists = spark.catalog.tableExists(table)
        before = spark.table(table).dtypes if exists else None
        derived = partition_columns(spark, table) if exists else []
        given = {"load_date": run.load_date, "partition_by": job.target_partition_by, "fmt": target.fmt,
                 "options": job.target_table_options}
        if merges:
            landed = merge(df, table, [name.strip() for name in key.split(",")], **given)
        else:
            landed = land(
                df,
                table,
                recreate=is_yes(job.target_recreate),
                truncate=is_yes(job.target_truncate),
                partition_overwrite=overwrite,
                load_id=intent.load_id if intent else None,
                **given,
            )
    target.progress("landed")
    if window is not None:
        target.mark(job, *watermark_values(window), intent.load_id if intent else None)
        target.progress("marked")
    if intent and ended is not None and intent.has_mark:
        ended.append(intent)
    elif intent:
        target.note([intent], DONE)
        target.progress("done")
    derived += partition_columns(spark, table)
    comments = changes(before, df, spark.table(table), derived)
    return Outcome(job, started, datetime.now(), True, landed.columns, landed.rows,
                   load_date=landed.load_date, comments=comments)
