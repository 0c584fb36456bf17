"""Time expressions: hour and month keys, text to time, calendar encodings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MICROS_PER_SECOND = 1_000_000
HOUR_TEXT = "yyyy-MM-dd'T'HH"


def col_of(c: str | Column) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def ntz(c: Column) -> Column:
    return c.cast("timestamp_ntz")


def hour_of(c: str | Column) -> Column:
    """Start of the hour (floor)."""
    return ntz(F.date_trunc("hour", col_of(c)))


def month_key(c: str | Column) -> Column:
    return F.date_format(col_of(c), "yyyy-MM")


def hour_key(c: str | Column) -> Column:
    """``YYYY-MM-DDTHH`` text."""
    return F.date_format(col_of(c), HOUR_TEXT)


def parse_time(c: str | Column, fmt: str | None = None) -> Column:
    """Text to time; text that does not parse becomes null."""
    parsed = F.try_to_timestamp(col_of(c), F.lit(fmt)) if fmt else F.try_to_timestamp(col_of(c))
    return ntz(parsed)


def micros(c: str | Column) -> Column:
    return F.unix_micros(col_of(c).cast("timestamp"))


def from_micros(c: Column) -> Column:
    return ntz(F.timestamp_micros(c))


def epoch_days(c: str | Column) -> Column:
    """Days since 1970-01-01 as a double."""
    return micros(c) / F.lit(86_400.0 * MICROS_PER_SECOND)


def hour_of_day(c: str | Column) -> Column:
    return F.hour(col_of(c))


def day_of_week(c: str | Column) -> Column:
    """Monday is 0."""
    return F.weekday(col_of(c))


def day_of_year(c: str | Column) -> Column:
    return F.dayofyear(col_of(c))
