"""Time conversions; all of them follow the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def parse_time(text: Column) -> Column:
    """Text ``yyyy-MM-dd HH:mm:ss`` to timestamp; unreadable text gives null, not a failed job."""
    return F.try_to_timestamp(text, F.lit(TIME_FORMAT))


def time_text(ts: Column) -> Column:
    return F.date_format(ts, TIME_FORMAT)


def day_of_millis(ms: Column, fmt: str = "yyyy-MM-dd") -> Column:
    return F.date_format(F.timestamp_millis(ms), fmt)


def millis_of_text(text: Column) -> Column:
    return F.unix_millis(parse_time(text))


def millis_to_second(ms: Column) -> Column:
    """Epoch millis to a timestamp cut to whole seconds."""
    return F.timestamp_seconds(F.call_function("div", ms - F.pmod(ms, F.lit(1000)), F.lit(1000)))


def age_years(birthday: Column, as_of: Column) -> Column:
    """Whole days divided by 365, rounded down."""
    return F.floor(F.datediff(as_of, birthday) / F.lit(365)).cast("int")


def processing_time_millis() -> Column:
    return F.unix_millis(F.current_timestamp())
