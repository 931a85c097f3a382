"""Instants as whole microseconds since the epoch, so that arithmetic is exact."""

from __future__ import annotations

import math
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hushtrack.schemas import MESSAGE_DAY

MICROS_PER_SECOND = 1_000_000
MICROS_PER_HOUR = 3_600 * MICROS_PER_SECOND
MICROS_PER_DAY = 24 * MICROS_PER_HOUR

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def hours_to_micros(hours: float) -> int:
    return round(hours * MICROS_PER_HOUR)


def instant_micros(value: date | datetime | str) -> int:
    """Microseconds of a UTC instant given as a date, a datetime or ISO text."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    if not isinstance(value, datetime):
        value = datetime(value.year, value.month, value.day)
    if value.tzinfo is None:
        value = value.replace(tzinfo=timezone.utc)
    delta = value - _EPOCH
    return (delta.days * 86_400 + delta.seconds) * MICROS_PER_SECOND + delta.microseconds


def as_date(value: date | str) -> date:
    return date.fromisoformat(value) if isinstance(value, str) else value


def look_back_days(n_hours_before: float) -> int:
    """Whole days to read before a range so that the look-back counts are complete."""
    return math.ceil(n_hours_before / 24)


def micros(ts: Column | str) -> Column:
    """Microseconds of a timestamp column; columns without a zone are read as UTC."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(ts.cast("timestamp"))


def as_instant(df: DataFrame, column: str) -> Column:
    """A timestamp column as an instant; one without a zone is UTC whatever the session's zone."""
    if dict(df.dtypes)[column] != "timestamp_ntz":
        return F.col(column).cast("timestamp")
    return F.timestamp_micros(F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', `{column}`)"))


def instant_for(df: DataFrame, column: str, value: date | datetime | str | int) -> Column:
    """Literal of the column's own type for an instant (or its microseconds), so that comparisons
    with it reach the scan."""
    us = value if isinstance(value, int) else instant_micros(value)
    if dict(df.dtypes)[column] != "timestamp_ntz":
        return F.timestamp_micros(F.lit(us))
    wall = (_EPOCH + timedelta(microseconds=us)).replace(tzinfo=None)
    return F.lit(wall.isoformat(sep=" ")).cast("timestamp_ntz")


def utc_day(us: Column) -> Column:
    """UTC day of an instant given in microseconds, whatever the session's zone."""
    return F.date_from_unix_date(F.call_function("div", us - F.pmod(us, F.lit(MICROS_PER_DAY)), F.lit(MICROS_PER_DAY)).cast("int"))


def within(df: DataFrame, column: str, low_us: int | None, high_us: int | None) -> Column:
    """Half-open range of instants on the raw column, so that it reaches the scan.

    Where a table of messages is partitioned by day the range is put to the days as well, so that only the
    folders of its days are listed and opened. Rows of other sources, whose day is null, are judged by
    their time alone.
    """
    condition, days = F.lit(True), F.lit(True)
    day = F.col(MESSAGE_DAY)
    if low_us is not None:
        condition &= F.col(column) >= instant_for(df, column, low_us)
        days &= day >= F.lit(_EPOCH.date() + timedelta(days=low_us // MICROS_PER_DAY))
    if high_us is not None:
        condition &= F.col(column) < instant_for(df, column, high_us)
        days &= day <= F.lit(_EPOCH.date() + timedelta(days=(high_us - 1) // MICROS_PER_DAY))
    if column == "timestamp" and MESSAGE_DAY in df.columns:
        condition &= day.isNull() | days
    return condition


def instant(value: date | datetime | str) -> Column:
    """Timestamp literal; folds to a constant, so comparisons with it reach the scan."""
    return F.timestamp_micros(F.lit(instant_micros(value)))


def epoch_seconds(ts: Column | str) -> Column:
    """Float seconds since the epoch, for sinks that exchange numbers."""
    return micros(ts) / F.lit(float(MICROS_PER_SECOND))


def whole_second(value: datetime | None = None) -> datetime:
    """Version stamp of a run: UTC, truncated to the second."""
    value = value or datetime.now(tz=timezone.utc)
    if value.tzinfo is None:
        value = value.replace(tzinfo=timezone.utc)
    return value.astimezone(timezone.utc).replace(microsecond=0)
