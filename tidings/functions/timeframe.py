"""Column functions for timeframes: half-hour boundaries, labels and the run schedule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The label's format and its constant zone suffix.
LABEL_FORMAT = "dd-MM-yy_HH-mm-ss"
LABEL_ZONE = "_GMT+0300"
SLOT = "30 minutes"


def next_slot(ts: Column) -> Column:
    """The next half-hour boundary, strictly later than ``ts``.

    It is the end of the tumbling half-hour window that holds ``ts``. Windows align to UTC, so
    this holds in every zone whose offset is a multiple of 30 minutes.
    """
    slot = F.window(ts, SLOT)
    return slot.getField("end")


def label(ts: Column) -> Column:
    """Timeframe label; the zone suffix is constant whatever clock ``ts`` follows."""
    return F.concat(F.date_format(ts, LABEL_FORMAT), F.lit(LABEL_ZONE))


def next_run(previous: Column, now: Column, period_minutes: Column | int) -> Column:
    """Previous run plus the period, or the next half hour when that moment has passed."""
    minutes = period_minutes if isinstance(period_minutes, Column) else F.lit(period_minutes)
    planned = previous + F.make_dt_interval(mins=minutes)
    return F.when(planned < now, ceil_slot(now)).otherwise(planned)


def ceil_slot(ts: Column) -> Column:
    """``next_slot`` without the time-window operator, for use next to another window."""
    whole = F.date_trunc("HOUR", ts)
    step = F.when(F.minute(ts) < 30, F.lit(30)).otherwise(F.lit(60))
    return whole + F.make_dt_interval(mins=step)


def in_zone(ts: Column, zone: str) -> Column:
    """Wall-clock time in ``zone`` of an instant given in UTC."""
    return F.from_utc_timestamp(ts, zone)
