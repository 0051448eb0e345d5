"""Zone-free time helpers for TIMESTAMP_NTZ columns.

NTZ cannot be cast to bigint, and casting to TIMESTAMP ties the result to the session zone.
Interval arithmetic, comparison and ``to_date`` keep the NTZ type, so everything here stays NTZ.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from abx.functions.util import col_of

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_micros(c) -> Column:
    """Microseconds since 1970-01-01 of an NTZ (wall-clock) timestamp."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), col_of(c))


def epoch_seconds(c) -> Column:
    """Whole epoch second of the wall-clock time (floor)."""
    return F.floor(epoch_micros(c) / F.lit(1_000_000)).cast("long")


def seconds_between(start, end) -> Column:
    """Number of second boundaries crossed from ``start`` to ``end``.

    Equals the difference of epoch seconds (.9 -> 1.1 gives 1), the semantics of a
    warehouse ``datediff('second', ...)``; null if either side is null.
    """
    return epoch_seconds(end) - epoch_seconds(start)


def minus_minutes(c, minutes: int) -> Column:
    return col_of(c) - F.make_dt_interval(mins=F.lit(int(minutes)))


def plus_days(c, days: int) -> Column:
    return col_of(c) + F.make_dt_interval(days=F.lit(int(days)))


def day_of(c) -> Column:
    """Calendar day of a wall-clock timestamp, as DATE."""
    return F.to_date(col_of(c))
