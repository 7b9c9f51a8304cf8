"""Date and time expressions. Sessions run in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cleaning import ColumnLike, col

_ISO_MS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def encode_iso_ms(c: ColumnLike) -> Column:
    """ISO-8601 text, floored to milliseconds, ``Z`` suffix; missing is ``'NaT'``."""
    return F.coalesce(F.date_format(col(c), _ISO_MS), F.lit("NaT"))


def decode_time(c: ColumnLike) -> Column:
    """Timestamp from text or a timestamp; ``'NaT'`` and malformed text give NULL."""
    return col(c).try_cast("timestamp")


def floor_ms(c: ColumnLike) -> Column:
    """Floor to milliseconds and drop the zone."""
    return F.date_trunc("MILLISECOND", col(c)).cast("timestamp_ntz")


def is_weekend(c: ColumnLike) -> Column:
    """Saturday or Sunday; FALSE for NULL."""
    return F.coalesce(F.dayofweek(col(c)).isin(1, 7), F.lit(False))


def week_start(c: ColumnLike) -> Column:
    """Monday 00:00 of the week, as a timestamp."""
    return F.date_trunc("WEEK", col(c))


def month_start(c: ColumnLike) -> Column:
    return F.date_trunc("MONTH", col(c))


def duration_minutes(start: ColumnLike, end: ColumnLike, digits: int = 2) -> Column:
    """Minutes between two timestamps by whole seconds; NULL if either is NULL."""
    seconds = F.unix_timestamp(col(end)) - F.unix_timestamp(col(start))
    return F.round(seconds / F.lit(60.0), digits)


def in_trailing_days(c: ColumnLike, last: Column, days: int) -> Column:
    """``c`` lies in the ``days`` days that end with (and include) ``last``."""
    return col(c).between(F.date_sub(last, days - 1), last)


def us_date(c: ColumnLike, missing: str = "Unknown") -> Column:
    return F.coalesce(F.date_format(col(c), "MM/dd/yyyy"), F.lit(missing))


def time_ago(c: ColumnLike, as_of: Column) -> Column:
    """Age of a timestamp as text, measured against an explicit ``as_of``.

    Whole days if there are any; else hours once more than 3600 seconds have
    passed; else minutes.
    """
    age = F.floor((F.unix_micros(as_of) - F.unix_micros(col(c))) / F.lit(1e6))
    days = F.floor(age / 86400)
    seconds = F.pmod(age, F.lit(86400))

    def text(n: Column, unit: str) -> Column:
        return F.format_string(f"%d {unit}%s ago", n, F.when(n > 1, "s").otherwise(""))

    return F.coalesce(
        F.when(days > 0, text(days, "day"))
        .when(seconds > 3600, text(F.floor(seconds / 3600), "hour"))
        .when(seconds.isNotNull(), text(F.floor(seconds / 60), "minute")),
        F.lit("Unknown"),
    )
