"""Time expressions. All instants are UTC; the session time zone must be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from slotwise.config import DEFAULTS


def floor_slot(ts: Column, minutes: int = DEFAULTS.slot_minutes) -> Column:
    """The start of the slot ``ts`` falls in."""
    seconds = F.unix_seconds(ts.cast("timestamp"))
    return F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(minutes * 60)))


def trunc_minute(ts: Column) -> Column:
    return F.date_trunc("minute", ts)


def to_local(ts: Column, zone: str = DEFAULTS.local_zone) -> Column:
    """The wall-clock time of a UTC instant in ``zone``."""
    return F.from_utc_timestamp(ts, zone)


def weekday(ts: Column) -> Column:
    """Monday 0 to Sunday 6."""
    return F.weekday(ts)


def minutes_since_midnight(ts: Column) -> Column:
    return F.hour(ts) * 60 + F.minute(ts)


def is_rush_hour(day_of_week: Column, minutes: Column) -> Column:
    """Weekdays 07:00-09:30 and 17:00-19:59, both ends included; holidays do not matter."""
    return (day_of_week < 5) & (minutes.between(420, 570) | minutes.between(1020, 1199))


def days_before(ts: Column, days: int) -> Column:
    return ts - F.expr(f"INTERVAL '{days}' DAY")


def hours_after(ts: Column, hours: int) -> Column:
    return ts + F.expr(f"INTERVAL '{hours}' HOUR")


def parse_iso(text: Column, strict: bool = True) -> Column:
    """An ISO-8601 text with offset as a UTC instant; null on bad text when not strict."""
    return F.to_timestamp(text) if strict else F.try_to_timestamp(text)


def partition_path(ts: Column) -> Column:
    """``dt=YYYY-MM-DD/hh=HH/mm=MM`` of a UTC instant."""
    return F.concat(
        F.lit("dt="),
        F.date_format(ts, "yyyy-MM-dd"),
        F.lit("/hh="),
        F.date_format(ts, "HH"),
        F.lit("/mm="),
        F.date_format(ts, "mm"),
    )


def version_name(ts: Column) -> Column:
    """``vYYYYMMDD_HHMMSS``: sorts by name in time order."""
    return F.date_format(ts, "'v'yyyyMMdd_HHmmss")
