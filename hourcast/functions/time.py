"""Calendar and timestamp expressions.

All of them assume ``spark.sql.session.timeZone=UTC`` (see ``hourcast.session``),
which makes the UTC day, the cast-to-date day and the truncated day agree for
both TIMESTAMP and TIMESTAMP_NTZ inputs.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from hourcast.functions._util import col


def utc_day(ts) -> Column:
    """Calendar day of ``ts`` in UTC (``(ts AT TIME ZONE 'UTC')::date``)."""
    return F.to_date(col(ts))


def as_date(ts) -> Column:
    """``ts::date`` in the session zone (UTC when configured by hourcast)."""
    return col(ts).cast("date")


def trunc_day(ts, ntz: bool = False) -> Column:
    """``date_trunc('day', ts)`` as a timestamp (not a date).

    Spark returns a zoned TIMESTAMP even for TIMESTAMP_NTZ input; pass
    ``ntz=True`` for NTZ input so the result is cast back and the input's type
    survives (see :func:`is_ntz`).
    """
    out = F.date_trunc("day", col(ts))
    return out.cast("timestamp_ntz") if ntz else out


def trunc_hour(ts, ntz: bool = False) -> Column:
    """``date_trunc('hour', ts)``, type-preserving like :func:`trunc_day`."""
    out = F.date_trunc("hour", col(ts))
    return out.cast("timestamp_ntz") if ntz else out


def is_ntz(df, column: str) -> bool:
    """Is ``df[column]`` a TIMESTAMP_NTZ column."""
    from pyspark.sql.types import TimestampNTZType
    return isinstance(df.schema[column].dataType, TimestampNTZType)


def hour_of_day(ts) -> Column:
    """``EXTRACT(HOUR FROM ts)`` as BIGINT (0..23)."""
    return F.hour(col(ts)).cast("bigint")


def iso_weekday(ts) -> Column:
    """ISO day of week, Monday=1 .. Sunday=7 (``EXTRACT(ISODOW ...)``).

    ``F.dayofweek`` is Sunday=1 and must not be used here.
    """
    return F.weekday(col(ts)) + F.lit(1)


def next_day(day, n: int = 1) -> Column:
    """``day + n`` for a DATE column."""
    return F.date_add(col(day), n)


def parse_timestamp(text, lenient: bool = False, ntz: bool = False) -> Column:
    """ISO-8601 text (``2024-01-01T05:00`` or with seconds/offset) to timestamp.

    Strict mode fails the query on unparsable text (ANSI); lenient mode yields
    NULL instead.
    """
    c = col(text)
    target = "timestamp_ntz" if ntz else "timestamp"
    return c.try_cast(target) if lenient else c.cast(target)


def within_complete_days(day, as_of, n_days: int) -> Column:
    """Predicate: ``day`` lies in the last ``n_days`` complete days before ``as_of``.

    ``as_of`` is a DATE column/literal ("today"); the window ends yesterday,
    inclusive, and starts ``n_days - 1`` days earlier.
    """
    if isinstance(as_of, datetime.date):
        as_of_c = F.lit(as_of)
    elif isinstance(as_of, str) and as_of[:1].isdigit():
        as_of_c = F.to_date(F.lit(as_of))
    else:
        as_of_c = col(as_of)
    return col(day).between(F.date_sub(as_of_c, n_days), F.date_sub(as_of_c, 1))
