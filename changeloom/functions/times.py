"""Times: epoch numbers, ISO text and event time."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, functions as F

#: Integers above this are microseconds, below it milliseconds.  1e14 ms is the year 5138.
MICROS_FROM = 10**14

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def as_timestamp(value: Column | datetime | str) -> Column:
    """Literal or column as TIMESTAMP."""
    if isinstance(value, Column):
        return value.cast("timestamp")
    if isinstance(value, datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(value).cast("timestamp")


def parse_iso(text: Column) -> Column:
    """ISO-8601 text, with or without ``Z``; null when it is no time."""
    return F.try_to_timestamp(text)


def parse_time(text: Column) -> Column:
    """Time sent as epoch digits (µs or ms) or as ISO text."""
    number = text.try_cast("bigint")
    epoch = F.when(number > MICROS_FROM, F.timestamp_micros(number)).otherwise(
        F.timestamp_millis(number)
    )
    return F.when(number.isNotNull(), epoch).otherwise(parse_iso(text))


def created_date(text: Column, as_of: date | str) -> Column:
    """Day of a ``created_at`` wire value; a missing value counts for ``as_of``."""
    number = text.try_cast("bigint")
    day = F.when(number.isNotNull(), F.to_date(parse_time(text))).otherwise(
        F.substring(text, 1, 10).try_cast("date")
    )
    return F.coalesce(day, F.lit(str(as_of)).cast("date"))


def iso(ts: Column, pattern: str = ISO_SECONDS) -> Column:
    return F.date_format(ts, pattern)


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def whole_days(later: Column, earlier: Column) -> Column:
    """Whole days between two times, rounded down."""
    gap = F.unix_micros(later) - F.unix_micros(earlier)
    return F.floor(gap / F.lit(86_400_000_000)).cast("bigint")


_UNITS = {
    "second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6, "day": 86400 * 10**6,
    "millisecond": 1000, "microsecond": 1,
}


def duration_micros(text: str) -> int:
    """``'5 minutes'`` as microseconds."""
    number, unit = text.split()
    return int(number) * _UNITS[unit.rstrip("s")]
