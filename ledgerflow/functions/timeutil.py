"""Time expressions: cutoffs, calendar days, wall-clock output."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ts_lit(t: dt.datetime | Column) -> Column:
    """A naive wall-clock time as a timestamp of the session's time zone.

    ``F.lit(datetime)`` would read it in the driver's OS time zone; the ISO
    text is cast by Spark instead. A Column passes through.
    """
    return t if isinstance(t, Column) else F.lit(t.isoformat(sep=" ")).cast("timestamp")


def ts_text(c: str) -> Column:
    """A timestamp column as ISO text in the session's time zone."""
    return F.date_format(F.col(c), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def cutoff_from_max(max_ts: Column) -> Column:
    """Midnight of (latest event - 24 hours)."""
    return F.date_trunc("day", max_ts - F.expr("INTERVAL 24 HOURS"))


def cutoff_from_as_of(as_of: Column) -> Column:
    """Midnight of the day before the run date."""
    return F.date_trunc("day", as_of.cast("timestamp")) - F.expr("INTERVAL 1 DAY")


def wall_clock(c: Column | str) -> Column:
    """Timestamp without time zone, for outputs read outside Spark."""
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")


def day(c: Column | str) -> Column:
    return F.to_date(F.col(c) if isinstance(c, str) else c)
