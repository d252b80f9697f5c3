"""Date and cursor expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def compact_date(stamp: Column) -> Column:
    """Day of a compact stamp (YYYYMMDDTHHMMSS, YYYYMMDDTHHMM or YYYYMMDD); NULL when unreadable."""
    text = stamp.cast("string")
    day = F.when(F.length(text).isin(13, 15), F.substring(text, 1, 8)).otherwise(text)
    return F.try_to_date(day, "yyyyMMdd")


def iso_date(text: Column) -> Column:
    """Day of a YYYY-MM-DD string; NULL when unreadable."""
    return F.try_to_date(text, "yyyy-MM-dd")


def api_stamp(day: Column) -> Column:
    """Cursor form of a day, YYYYMMDDT0000."""
    return F.date_format(day, "yyyyMMdd'T'HHmm")


def cursor_day_floor(stamp: Column) -> Column:
    """Cursor at the start of the day of a YYYYMMDDTHHMMSS stamp."""
    return F.concat(stamp.substr(F.lit(1), F.length(stamp) - 6), F.lit("0000"))


def day_of_week(day: Column) -> Column:
    """Monday = 0 to Sunday = 6."""
    return F.weekday(day)


def as_timestamp(value: Column) -> Column:
    return value.try_cast("timestamp_ntz")


def next_day(day: Column) -> Column:
    return F.date_add(day, 1)
