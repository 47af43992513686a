"""Clock and calendar helpers. Jobs pass ``as_of`` in; nothing here reads the clock."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR = timedelta(hours=1)
EPOCH = datetime(1970, 1, 1)
# 52 weeks, not a calendar year: the shift keeps the weekday.
REPLAY_SHIFT = timedelta(weeks=52)


def as_datetime(value: datetime | str) -> datetime:
    """ISO text or datetime as UTC wall time; anything else is an error. A zoned value is converted."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    if not isinstance(value, datetime):
        raise ValueError(f"expected a datetime or ISO text, got {value!r}")
    return value if value.tzinfo is None else value.astimezone(timezone.utc).replace(tzinfo=None)


def clock_floor(as_of: datetime) -> datetime:
    return as_datetime(as_of).replace(minute=0, second=0, microsecond=0)


def clock_ceil(as_of: datetime) -> datetime:
    floor = clock_floor(as_of)
    return floor if floor == as_datetime(as_of) else floor + HOUR


def next_hour(as_of: datetime) -> datetime:
    """The first full hour strictly after ``as_of``: what is stamped on predictions and what is looked up."""
    return clock_floor(as_of) + HOUR


def ntz(value: datetime) -> Column:
    # By way of text: a datetime literal would pass through the zones of Python and of the session.
    return F.lit(as_datetime(value).isoformat(sep=" ")).cast("timestamp_ntz")


def interval(delta: timedelta) -> Column:
    return F.lit(delta)


def floor_hour(ts: Column) -> Column:
    """Start of the hour of a wall time. Minutes and seconds are taken off, so no zone has a say."""
    ts = ts.cast("timestamp_ntz")
    return ts - F.make_dt_interval(F.lit(0), F.lit(0), F.minute(ts), F.extract(F.lit("SECOND"), ts))


def ceil_hour(ts: Column) -> Column:
    floor = floor_hour(ts)
    return F.when(floor == ts, floor).otherwise(floor + interval(HOUR))


def next_hour_of(ts: Column) -> Column:
    return floor_hour(ts) + interval(HOUR)


def month_of(ts: Column) -> Column:
    zero = F.lit(0)
    return F.try_make_timestamp_ntz(F.year(ts), F.month(ts), F.lit(1), zero, zero, zero)


def utc_instant(ts: Column) -> Column:
    """The instant of a UTC wall time, whatever the session's zone."""
    since = ts - ntz(EPOCH)  # an interval; the functions that count microseconds go through the session's zone
    days, hours, minutes = (F.extract(F.lit(f), since).cast("bigint") for f in ("DAY", "HOUR", "MINUTE"))
    micros = (F.extract(F.lit("SECOND"), since) * 1_000_000).cast("bigint")
    return F.timestamp_micros(((days * 24 + hours) * 60 + minutes) * 60_000_000 + micros)


def drop_zone(instant: Column) -> Column:
    """UTC wall time of an instant, whatever the session's zone."""
    micros = F.unix_micros(instant)
    day = 86_400_000_000
    days = F.floor(micros / F.lit(day).cast("decimal(12,0)")).cast("int")
    seconds = (micros - days.cast("bigint") * day).cast("decimal(18,0)") / F.lit(1_000_000).cast("decimal(8,0)")
    return ntz(EPOCH) + F.make_dt_interval(days, F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def wall_time(ts: Column, zone: str = "America/New_York", source_zone: str = "UTC") -> Column:
    """Wall time in ``source_zone`` shown as wall time in ``zone``."""
    return F.convert_timezone(F.lit(source_zone), F.lit(zone), ts)


def parse_time(text: Column) -> Column:
    """Timestamp from text, null where it does not parse."""
    return text.try_cast("timestamp_ntz")


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def day_of_week(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts)
