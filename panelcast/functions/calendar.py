"""Time parsing, calendar parts, day arithmetic and date labels."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Label formats (fixed values).
ISO_LABEL = "yyyy-MM-dd"
SHORT_LABEL = "EEE, MMM dd"
LONG_LABEL = "EEEE, MMM dd"


def parse_time(text: Column | str) -> Column:
    """ISO text such as ``2024-01-01T05:00`` as a zone-free timestamp."""
    return (F.col(text) if isinstance(text, str) else text).cast("timestamp_ntz")


def time_text(time: Column | str) -> Column:
    """A zone-free time as ISO text to the minute, the inverse of ``parse_time``."""
    text = (F.col(time) if isinstance(time, str) else time).cast("string")
    return F.translate(F.substring(text, 1, 16), " ", "T")


def day_of(time: Column | str) -> Column:
    return F.to_date(time)


def hour_start(time: Column | str) -> Column:
    """The time cut to its hour, still zone-free (``date_trunc`` would not be)."""
    return F.to_date(time).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(time))


def hour_of_day(time: Column | str) -> Column:
    return F.hour(time).cast("bigint")


def day_of_week(time: Column | str) -> Column:
    """Monday is 0."""
    return F.weekday(time).cast("bigint")


def month_of_year(time: Column | str) -> Column:
    return F.month(time).cast("bigint")


def day_literal(as_of: dt.date | dt.datetime | str) -> dt.date:
    """The calendar day of a job's as-of moment, so that no job reads the clock."""
    if isinstance(as_of, str):
        as_of = dt.datetime.fromisoformat(as_of)
    return as_of.date() if isinstance(as_of, dt.datetime) else as_of


def literal(value: object, data_type: T.DataType) -> Column:
    """A literal of the column's own type; a datetime alone would get a zone."""
    if isinstance(data_type, T.TimestampNTZType):
        return F.lit(value.isoformat()).cast(data_type)
    return F.lit(value)


def midnight(day: dt.date, plus_days: int = 0) -> Column:
    moment = dt.datetime.combine(day + dt.timedelta(days=plus_days), dt.time())
    return F.lit(moment.isoformat()).cast("timestamp_ntz")


def days_after(day: Column | str, days: int | Column) -> Column:
    return F.date_add(day, days)


def label(day: Column | str, fmt: str = ISO_LABEL) -> Column:
    return F.date_format(day, fmt)
