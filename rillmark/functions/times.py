"""Time expressions. The session zone applies unless a zone is given."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"


def millis_to_date(epoch_ms: Column) -> Column:
    """Epoch milliseconds -> ``yyyy-MM-dd`` text."""
    return F.date_format(F.timestamp_millis(epoch_ms), DATE_FORMAT)


def parse_datetime(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` -> TIMESTAMP, NULL when it does not parse."""
    return F.try_to_timestamp(text, F.lit(DATETIME_FORMAT))


def parse_date_prefix(text: Column) -> Column:
    """The leading ``yyyy-MM-dd`` of a longer text -> TIMESTAMP at midnight."""
    return F.try_to_timestamp(F.substring(text, 1, 10), F.lit(DATE_FORMAT))


def datetime_to_millis(text: Column, zone: str | None = None) -> Column:
    """Datetime text -> epoch milliseconds, read in ``zone`` (for example ``+08:00``)."""
    ts = parse_datetime(text)
    return F.unix_millis(F.to_utc_timestamp(ts, zone) if zone else ts)


def millis_to_datetime(epoch_ms: Column, zone: str | None = None) -> Column:
    """Epoch milliseconds -> datetime text in ``zone``: the inverse of ``datetime_to_millis``."""
    ts = F.timestamp_millis(epoch_ms)
    return F.date_format(F.from_utc_timestamp(ts, zone) if zone else ts, DATETIME_FORMAT)


def event_time(create_time: Column, record_time: Column) -> Column:
    """Parsed event time, or the broker's record time when the text does not parse."""
    return F.coalesce(parse_datetime(create_time), record_time)


def age_on(birthday: Column, asof: Column | date) -> Column:
    """Full years by year difference and day-of-year; NULL for bad or future birthdays."""
    born = F.try_to_timestamp(birthday.cast("string").substr(1, 10), F.lit(DATE_FORMAT)).cast("date")
    day = asof if isinstance(asof, Column) else F.lit(asof)
    years = F.year(day) - F.year(born) - (F.dayofyear(day) < F.dayofyear(born)).cast("int")
    return F.when(born <= day, years)


def micros(delta: timedelta) -> int:
    """A duration in whole microseconds."""
    return delta // timedelta(microseconds=1)


def as_interval(delta: timedelta) -> str:
    """A duration as the text Spark's window and watermark functions take."""
    return f"{micros(delta)} microseconds"


def epoch_micros(ts: Column) -> Column:
    """Microseconds since the epoch for TIMESTAMP or TIMESTAMP_NTZ read in the session zone."""
    return F.unix_micros(ts.cast("timestamp"))
