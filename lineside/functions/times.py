"""Time arithmetic on ``timestamp_ntz``, free of the session time zone.

``unix_micros`` and friends would cast through the session zone, so everything here is built from the
date, hour, minute and second fields, which read a naive timestamp as it stands.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

Stamp = Column | str | datetime


def stamp(value: Stamp) -> Column:
    """Column, column name or naive datetime as a ``timestamp_ntz`` column."""
    if isinstance(value, datetime):
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.col(value) if isinstance(value, str) else value


def minutes(n: int | Column) -> Column:
    """An interval of ``n`` minutes."""
    return F.expr("INTERVAL '1' MINUTE") * (F.lit(n) if isinstance(n, int) else n)


def _epoch_minutes(ts: Column) -> Column:
    days = F.unix_date(ts.cast("date")).cast("bigint")
    return days * 1440 + F.hour(ts) * 60 + F.minute(ts)


def bucket(ts: Stamp, width: int = 5) -> Column:
    """Start of the ``width``-minute slice, aligned to the epoch; a NULL time gives a NULL bucket.

    ``window`` does whole-number arithmetic on the naive time but drops rows without one, hence the
    stand-in for NULL. Use one bucket per select or groupBy, as for any ``window``.
    """
    at = stamp(ts)
    stand_in = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.when(at.isNotNull(), F.window(F.coalesce(at, stand_in), f"{width} minutes")["start"])


def epoch_seconds(ts: Stamp) -> Column:
    """Whole seconds since 1970, rounded down, for a naive UTC time."""
    at = stamp(ts)
    return _epoch_minutes(at) * 60 + F.second(at)


def seconds_between(start: Stamp, end: Stamp) -> Column:
    """Second boundaries crossed from ``start`` to ``end`` (0.9 s to 1.1 s is one)."""
    return epoch_seconds(end) - epoch_seconds(start)


def iso_millis(ts: Stamp) -> Column:
    """ISO text with three decimals and no zone."""
    return F.date_format(stamp(ts), "yyyy-MM-dd'T'HH:mm:ss.SSS")
