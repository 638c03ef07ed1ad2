"""Microsecond arithmetic. Time rules compare exact longs, never truncated seconds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def micros(duration: str | int | dt.timedelta) -> int:
    """``"30 minutes"``, a number of seconds or a timedelta, in microseconds."""
    if isinstance(duration, dt.timedelta):
        return duration // dt.timedelta(microseconds=1)
    if isinstance(duration, int):
        return duration * 1_000_000
    amount, unit = duration.split()
    return int(amount) * _UNITS[unit.rstrip("s")] * 1_000_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_us(ts: Column | str) -> Column:
    """Microseconds since the epoch; a TIMESTAMP_NTZ counts as UTC (the session runs in UTC)."""
    return F.unix_micros(_col(ts).cast("timestamp"))


def from_epoch_us(us: Column | str, ntz: bool = True) -> Column:
    ts = F.timestamp_micros(_col(us))
    return ts.cast("timestamp_ntz") if ntz else ts


def time_bucket(us: Column | str, width_us: int) -> Column:
    """Index of the fixed-width bucket holding a microsecond time."""
    value = _col(us)
    width = F.lit(width_us).cast("bigint")
    return F.call_function("div", value - F.pmod(value, width), width)


def closed_hours(as_of: dt.datetime, hours: int = 24) -> tuple[dt.datetime, dt.datetime]:
    """``[start, end)`` of the last ``hours`` full hours; the hour still running is left out."""
    end = as_of.replace(minute=0, second=0, microsecond=0)
    return end - dt.timedelta(hours=hours), end
