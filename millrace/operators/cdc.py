"""Change windows: which rows of a source are new since the stored watermark.

Lower bounds of hour windows are inclusive and upper bounds exclusive, so that consecutive runs meet
without gap or overlap. Hours are those of the source's own clock. Rows whose change columns are all
null belong to no window.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from datetime import datetime
from decimal import Context, Decimal
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.timekeys import ceil_day, floor_hour, format_hour, parse_hour
from millrace.model import HOUR_FORMAT, KEY_TYPE, TRACKER_SCHEMA, TableJob, one_row

Key = int | float | Decimal


def column_type(schema: T.StructType, name: str) -> T.DataType:
    dtype = next((f.dataType for f in schema.fields if f.name.lower() == name.lower()), None)
    if dtype is None:
        raise ValueError(f"the change column {name} is not in the table")
    return dtype


def exact_key(value: Key) -> Decimal:
    """A key without loss, a double by its shortest text; one that is no number is an error."""
    key = Decimal(repr(value)) if isinstance(value, float) else Decimal(value)
    if not key.is_finite():
        raise ValueError(f"the tracker cannot hold the key {value}")
    return key


def key_text(value: Key) -> str:
    """A key in plain digits, the same text for equal keys."""
    text = format(exact_key(value), "f")
    return text.rstrip("0").rstrip(".") if "." in text else text


def holds(dtype: T.DataType, key: Decimal) -> bool:
    """Whether a column of a whole or decimal type keeps the key exactly."""
    if isinstance(dtype, T.DecimalType):
        digits = 10 ** (dtype.precision - dtype.scale)
        scaled = key.scaleb(dtype.scale, Context(prec=1000))
        return abs(key) < digits and scaled == scaled.to_integral_value(context=Context(prec=1000))
    bits = {T.ByteType(): 7, T.ShortType(): 15, T.IntegerType(): 31, T.LongType(): 63}.get(dtype)
    return bits is not None and key == int(key) and abs(key) < 2**bits


def plain_key(value: Decimal | None) -> Key | None:
    """A whole key as int."""
    return int(value) if value is not None and value == value.to_integral_value() else value


@dataclass(frozen=True)
class HourWindow:
    """``lo <= t < hi`` on any of the columns; without ``lo`` it is the first load."""

    columns: tuple[str, ...]
    lo: datetime | None
    hi: datetime

    def __post_init__(self) -> None:
        if not self.columns:
            raise ValueError("an hour window needs at least one column")

    def predicate(self, schema: T.StructType) -> Column:
        """Plain comparisons of the stored columns, which reach the scan as pushed filters."""
        return reduce(or_, (self._one(name, schema) for name in self.columns))

    def _one(self, name: str, schema: T.StructType) -> Column:
        dtype = column_type(schema, name)

        def bound(ts: datetime) -> Column:
            if isinstance(dtype, T.DateType):
                return F.lit(ceil_day(ts).date())
            return F.lit(ts.strftime("%Y-%m-%d %H:%M:%S")).cast(dtype)

        upper = F.col(name) < bound(self.hi)
        return upper if self.lo is None else (F.col(name) >= bound(self.lo)) & upper

    @property
    def watermark(self) -> dict:
        return {"ts_hour": format_hour(self.hi), "key_value": None}


@dataclass(frozen=True)
class KeyRange:
    """``lo < key <= hi``; without ``lo`` everything up to ``hi``, the source's own largest key."""

    column: str
    lo: Key | None
    hi: Key

    def predicate(self, schema: T.StructType) -> Column:
        dtype = column_type(schema, self.column)
        upper = F.col(self.column) <= self._bound(self.hi, dtype)
        return upper if self.lo is None else (F.col(self.column) > self._bound(self.lo, dtype)) & upper

    @staticmethod
    def _bound(value: Key, dtype: T.DataType) -> Column:
        """In the column's own type where that keeps the value, so that the comparison reaches the scan."""
        if isinstance(dtype, T.IntegralType):
            return F.lit(math.floor(value))  # the same rows of a whole column lie on either side of it
        if isinstance(dtype, T.FractionalType) and not isinstance(dtype, T.DecimalType):
            return F.lit(float(value)).cast(dtype)
        exact = Decimal(repr(value)) if isinstance(value, float) else Decimal(value)
        fits = isinstance(dtype, T.DecimalType) and exact.normalize().as_tuple().exponent >= -dtype.scale
        return F.lit(exact).cast(dtype) if fits else F.lit(exact)

    @property
    def watermark(self) -> dict:
        return {"ts_hour": None, "key_value": exact_key(self.hi)}


Window = HourWindow | KeyRange


def hour_window(columns: list[str | None], watermark: str | None, run_ts: datetime) -> HourWindow:
    """The window from the watermark's hour up to the hour of the run."""
    given = tuple(c for c in columns if c)
    return HourWindow(given, parse_hour(watermark) if watermark else None, floor_hour(run_ts))


def changed_rows(df: DataFrame, window: Window) -> DataFrame:
    return df.where(window.predicate(df.schema))


def key_maximum(df: DataFrame, column: str) -> DataFrame:
    """One row with the largest key, null where there is none."""
    return df.agg(F.max(column).alias("max_value"))


def hour_mark(text: Column) -> Column:
    """The hour that a watermark's text names, null for a text of no known form.

    Known are 8 digits (a day), 10 (an hour), 14 (a second) and a timestamp's text. Parts of an hour are cut, so a window may
    begin earlier than its mark but never later.
    """
    digits = (
        F.when(text.rlike("^[0-9]{8}$"), F.concat(text, F.lit("00")))
        .when(text.rlike("^[0-9]{10}([0-9]{4})?$"), F.substring(text, 1, 10))
        .when(
            text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?)?$"),
            F.date_format(text.try_cast("timestamp_ntz"), HOUR_FORMAT),
        )
    )
    return F.when(F.try_to_timestamp(digits, F.lit(HOUR_FORMAT)).isNotNull(), digits)


def tracker_rows(tracker: DataFrame) -> DataFrame:
    """Tracker rows with typed watermarks, also of a tracker that keeps one untyped ``updated_at``.

    ``bad_hour`` and ``bad_key`` mark a text that cannot be read as the one or the other. A number that
    names an hour is no key: the tracker does not say which it is. Keys beyond ``KEY_TYPE`` stay text (``key_text``).
    """
    untyped = F.lit(None).cast("string")
    if "updated_at" in tracker.columns:
        kind = dict(tracker.dtypes)["updated_at"]
        untyped = F.col("updated_at").cast("string")
        if kind.startswith(("timestamp", "date")):
            untyped = F.date_format("updated_at", HOUR_FORMAT)
        elif kind != "string":
            untyped = F.regexp_replace(untyped, "[.]0*$", "")
    hours = F.coalesce("ts_hour", untyped) if "ts_hour" in tracker.columns else untyped
    typed = F.col("key_value").cast(KEY_TYPE) if "key_value" in tracker.columns else F.lit(None).cast(KEY_TYPE)
    read_key = F.when(hour_mark(untyped).isNull(), untyped.try_cast(KEY_TYPE))
    text = F.col("key_text") if "key_text" in tracker.columns else F.lit(None).cast("string")
    return tracker.select(
        "job_id",
        "source_table",
        hour_mark(hours).alias("ts_hour"),
        F.coalesce(typed, read_key).alias("key_value"),
        (hours.isNotNull() & hour_mark(hours).isNull()).alias("bad_hour"),
        F.when(text.try_cast("double").isNotNull(), text).alias("key_text"),
        ((untyped.isNotNull() & typed.isNull() & read_key.isNull())
         | (text.isNotNull() & text.try_cast("double").isNull())).alias("bad_key"),
    )


def _by_size(text: Column) -> Column:
    """What orders keys in plain digits as numbers: as doubles, then by all digits before the point, then after it."""
    fraction = F.concat(F.lit("0."), F.regexp_extract(text, r"[.]([0-9]+)$", 1), F.lit("0")).try_cast("decimal(38,38)")
    whole = F.substring_index(text, ".", 1).try_cast("decimal(38,0)")
    return F.struct(text.try_cast("double"), whole, F.when(text.startswith("-"), -fraction).otherwise(fraction))


def watermarks(tracker: DataFrame) -> DataFrame:
    """The current watermark of every job, in one pass over the tracker, how many texts are none, and how many keys are text.

    Hour marks all have ten digits, so their maximum is taken as a number, which Spark aggregates by
    hash; text it would sort first.
    """
    return tracker_rows(tracker).groupBy("job_id", "source_table").agg(
        F.max(F.col("ts_hour").cast("long")).cast("string").alias("ts_hour"),
        F.max("key_value").alias("key_value"),
        F.count("key_text").alias("text_keys"),
        F.count_if("bad_hour").alias("bad_hours"),
        F.count_if("bad_key").alias("bad_keys"),
    )


@dataclass(frozen=True)
class Mark:
    """What the tracker knows of a job; nothing where it never ran."""

    ts_hour: str | None = None
    key_value: Key | None = None
    bad_hours: int = 0
    bad_keys: int = 0


def marks(tracker: DataFrame, jobs: list[TableJob]) -> dict[tuple[str, str], Mark]:
    """The marks of the given jobs, by job and source table, in one aggregate; a row per job reaches the driver."""
    own = tracker.where(F.col("job_id").isin([job.job_id for job in jobs]))
    rows = watermarks(own).collect()
    texts = {}
    if any(row.text_keys for row in rows):
        texts = {(row.job_id, row.source_table): row.key_text for row in text_marks(own).collect()}
    return {
        own: Mark(row.ts_hour, _largest(row.key_value, texts.get(own)), row.bad_hours, row.bad_keys)
        for row in rows for own in [(row.job_id, row.source_table)]
    }


def text_marks(tracker: DataFrame) -> DataFrame:
    """The largest of each job's keys that are kept as text."""
    kept = tracker_rows(tracker).where("key_text IS NOT NULL")
    return kept.groupBy("job_id", "source_table").agg(F.max_by("key_text", _by_size(F.col("key_text"))).alias("key_text"))


def _largest(value: Decimal | None, text: str | None) -> Key | None:
    keys = [Decimal(key) for key in (value, text) if key is not None]
    return plain_key(max(keys, default=None))


def watermark_of(tracker: DataFrame, job: TableJob) -> Mark:
    return marks(tracker, [job]).get((job.job_id, job.source_table), Mark())


def watermark_values(window: Window) -> tuple[str | None, str | None]:
    """The upper bound of a window, as the text of an hour or of a key."""
    mark = window.watermark
    return mark["ts_hour"], None if mark["key_value"] is None else key_text(mark["key_value"])


def mark_row(tracker: DataFrame, job: TableJob, ts_hour: str | None, key: str | None, load_id: str | None = None) -> DataFrame:
    """A tracker row; a key that the tracker's own type does not hold goes in as text."""
    dtype = column_type(tracker.schema, "key_value") if "key_value" in tracker.columns else None
    typed = key is not None and dtype is not None and holds(KEY_TYPE, Decimal(key)) and holds(dtype, Decimal(key))
    values = (job.job_id, job.source_table, ts_hour, Decimal(key) if typed else None, None if typed else key, load_id)
    return one_row(tracker.sparkSession, TRACKER_SCHEMA, values)


def watermark_row(tracker: DataFrame, job: TableJob, window: Window, load_id: str | None = None) -> DataFrame:
    """The tracker row that a landed window leaves behind: its own upper bound."""
    return mark_row(tracker, job, *watermark_values(window), load_id)


def plan_window(job: TableJob, known: DataFrame | Mark, run_ts: datetime, key_max) -> Window | None:
    """The window of an incremental job, None where the whole table is to be read.

    ``known`` is the tracker, or what it says of the job. A mark that cannot be read by the job's rule
    is an error: taken as none, it would load the table again. ``key_max`` is called only for an append
    key; it returns the source's largest key, which is None for a source without any.
    """
    if job.change_rule is None:
        return None
    mark = known if isinstance(known, Mark) else watermark_of(known, job)
    if job.change_rule == "TIMESTAMP":
        if mark.bad_hours:
            raise ValueError(f"the tracker has {mark.bad_hours} watermarks of {job.job_id} that name no hour")
        columns = [job.cdc_modified_date_column, job.cdc_created_date_column]
        return hour_window(columns, mark.ts_hour, run_ts)
    if mark.bad_keys:
        raise ValueError(
            f"the tracker has {mark.bad_keys} watermarks of {job.job_id} that are no key, or name an hour; "
            "write them to key_value"
        )
    largest = key_max()
    if largest is None:
        return None
    exact_key(plain_key_of(largest))  # before anything is read or landed
    return KeyRange(job.cdc_append_key_column, mark.key_value, plain_key_of(largest))


def plain_key_of(value) -> Key:
    """A source's key as it comes, whole decimals as int; anything but a number is an error."""
    if isinstance(value, bool) or not isinstance(value, (int, float, Decimal)):
        raise ValueError(f"an append key must be a number, not {value!r}")
    return plain_key(value) if isinstance(value, Decimal) else value
