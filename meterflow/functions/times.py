"""Time expressions.

Stored times are TIMESTAMP_NTZ holding UTC wall-clock, so no result depends on the
session time zone; local time is derived with an explicit zone.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import lru_cache
from zoneinfo import ZoneInfo

from pyspark.sql import Column, functions as F


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


@lru_cache(maxsize=None)
def steady_since(timezone: str) -> tuple[datetime, int] | None:
    """From when on a zone keeps one UTC offset, and that offset in minutes.

    None for zones that still change it. The result is a UTC time a day after the last
    change between 1970 and 2037.
    """
    zone = ZoneInfo(timezone)
    moment, last = datetime(1970, 1, 1), datetime(2037, 12, 31)
    since, offset = moment, None
    while moment <= last:
        now = moment.replace(tzinfo=ZoneInfo("UTC")).astimezone(zone).utcoffset()
        if now != offset:
            since, offset = moment, now
        moment += timedelta(days=1)
    if since > datetime(2030, 1, 1) or offset % timedelta(minutes=1):
        return None
    return since + timedelta(days=1), int(offset / timedelta(minutes=1))


def _shift(value, source: str, target: str, zone: str, sign: int) -> Column:
    """Zone conversion; plain addition where the zone's offset no longer changes.

    ``convert_timezone`` resolves both zone names for every row, so it is kept for times
    before the last change and for zones with daylight saving.
    """
    col = _col(value)
    general = F.convert_timezone(F.lit(source), F.lit(target), col)
    steady = steady_since(zone)
    if steady is None:
        return general
    since, minutes = steady
    if sign < 0:
        since = since + timedelta(minutes=minutes)
    moved = col + F.expr(f"interval '{sign * minutes}' minute")
    return F.when(col >= F.lit(since.isoformat(" ")).cast("timestamp_ntz"), moved).otherwise(general)


def to_local(utc, timezone: str) -> Column:
    return _shift(utc, "UTC", timezone, timezone, 1)


def to_utc(local, timezone: str) -> Column:
    return _shift(local, timezone, "UTC", timezone, -1)


def instant_to_utc(instant) -> Column:
    """TIMESTAMP to UTC wall-clock NTZ, whatever the session zone is."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_col(instant)), _epoch())


def utc_to_instant(utc) -> Column:
    """UTC wall-clock NTZ to TIMESTAMP, as a watermark needs it."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch(), _col(utc)))


def local_day(utc, timezone: str) -> Column:
    return F.to_date(to_local(utc, timezone))


def local_text(utc, timezone: str, pattern: str = "yyyy-MM-dd HH:mm") -> Column:
    return F.date_format(to_local(utc, timezone), pattern)


def offset_text(utc, timezone: str) -> Column:
    """Local time with its offset, e.g. ``2024-01-01 05:30:00+05:30``."""
    utc = _col(utc)
    local = to_local(utc, timezone)
    minutes = F.timestamp_diff("MINUTE", utc, local)
    size = F.abs(minutes)
    return F.concat(
        F.date_format(local, "yyyy-MM-dd HH:mm:ss"),
        F.when(minutes < 0, "-").otherwise("+"),
        F.lpad(F.floor(size / 60).cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad((size % 60).cast("string"), 2, "0"),
    )


def hour_in(local: Column, start: int, end: int) -> Column:
    """Local hour within [start, end)."""
    return (F.hour(local) >= start) & (F.hour(local) < end)


def parse_day(text: Column) -> Column:
    """``YYYYMMDD`` or ``YYYY-MM-DD`` to a date; anything else is null."""
    digits = F.replace(text, F.lit("-"), F.lit(""))
    return F.when(digits.rlike("^[0-9]{8}$"), F.try_to_date(digits, "yyyyMMdd"))


def window_shift_minutes(timezone: str, window_minutes: int) -> int:
    """Start offset that puts window bounds on the zone's local clock.

    ``window()`` takes one start offset for all rows, so a zone that changes its offset
    cannot be aligned on a stream and is refused.
    """
    steady = steady_since(timezone)
    if steady is None:
        raise ValueError(f"{timezone} changes its UTC offset; windows cannot be aligned to it")
    return steady[1] % window_minutes
