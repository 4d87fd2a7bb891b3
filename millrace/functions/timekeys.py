"""Hour keys and elapsed times."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.model import HOUR_FORMAT


def hour_key(ts: Column | str) -> Column:
    """The hour as ``yyyyMMddHH`` text."""
    return F.date_format(ts, HOUR_FORMAT)


def floor_hour(ts: datetime) -> datetime:
    return ts.replace(minute=0, second=0, microsecond=0)


def format_hour(ts: datetime) -> str:
    return ts.strftime("%Y%m%d%H")


def parse_hour(key: str) -> datetime:
    """The start of the hour that a ``yyyyMMddHH`` key names; a key without hour names midnight."""
    return datetime.strptime(key.ljust(10, "0"), "%Y%m%d%H")


def elapsed_seconds(start: str, end: str) -> Column:
    return F.timestamp_diff("SECOND", F.col(start), F.col(end))


def elapsed_text(seconds: Column) -> Column:
    """Seconds as ``[D day[s], ]H:MM:SS``."""
    days = F.floor(seconds / F.lit(86400))
    rest = F.pmod(seconds, F.lit(86400))
    hours, minutes = F.floor(rest / 3600), F.floor(F.pmod(rest, F.lit(3600)) / 60)

    def two_digits(number: Column) -> Column:
        return F.lpad(number.cast("string"), 2, "0")

    clock = F.concat_ws(":", hours.cast("string"), two_digits(minutes), two_digits(F.pmod(rest, F.lit(60))))
    unit = F.when(F.abs(days) == 1, F.lit(" day, ")).otherwise(F.lit(" days, "))
    return F.when(days == 0, clock).otherwise(F.concat(days.cast("string"), unit, clock))


def ceil_day(ts: datetime) -> datetime:
    """The first midnight that is not before ``ts``."""
    day = ts.replace(hour=0, minute=0, second=0, microsecond=0)
    return day if day == ts else day + timedelta(days=1)
