"""Time parts of zoneless timestamps.

Each function works on dates and clock fields only, so its result does not
depend on the session time zone, and no value passes through a zoned type.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trip_marts.schemas import TIMESTAMP


def month_start(ts: Column) -> Column:
    """First instant of the month."""
    return F.trunc(ts.cast("date"), "month").cast(TIMESTAMP)


def month_text(ts: Column) -> Column:
    """Month as ``yyyy-MM``, used as a partition value."""
    return F.date_format(ts.cast("date"), "yyyy-MM")


def weekday_number(ts: Column) -> Column:
    """0 for Sunday to 6 for Saturday."""
    return F.dayofweek(ts) - 1


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def minute_boundaries(start: Column, end: Column) -> Column:
    """Minute boundaries crossed between two times, negative if end is first.

    00:00:59 to 00:01:00 is one; 00:00:00 to 00:00:59 is none.
    """
    days = F.datediff(end.cast("date"), start.cast("date")).cast("bigint")
    hours = F.hour(end) - F.hour(start)
    minutes = F.minute(end) - F.minute(start)
    return days * 1440 + hours * 60 + minutes
