"""Column expressions shared by the operators; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Lengths in microseconds of the intervals that do not follow the calendar.
FIXED_MICROS = {"1s": 1_000_000, "1min": 60_000_000, "5min": 300_000_000, "15min": 900_000_000, "30min": 1_800_000_000, "1h": 3_600_000_000, "4h": 14_400_000_000}
CALENDAR_UNITS = {"1d": "day", "1w": "week", "1mo": "month"}
#: Raw times from here on are microseconds, below milliseconds.
MICROSECONDS_FROM = 10**15
#: The type that exact sums add up; quantities have up to eight places.
EXACT = "decimal(28,8)"


def instant(ns: str | Column) -> Column:
    ns = F.col(ns) if isinstance(ns, str) else ns
    return F.timestamp_micros(_div(ns, 1000))


def _div(x: Column, by: int) -> Column:
    """Integer floor division."""
    return F.call_function("div", x - F.pmod(x, F.lit(by).cast("long")), F.lit(by).cast("long"))


def bucket_micros(ns: str | Column, width: int) -> Column:
    """Start of the epoch-aligned bucket of ``width`` microseconds, as a timestamp."""
    ns = F.col(ns) if isinstance(ns, str) else ns
    us = _div(ns, 1000)
    return F.timestamp_micros(us - F.pmod(us, F.lit(width).cast("long")))


def bar_start(ns: str | Column, interval: str) -> Column:
    """Start of the bar of an interval; days, ISO weeks and months are those of UTC."""
    if interval in FIXED_MICROS:
        return bucket_micros(ns, FIXED_MICROS[interval])
    if interval in CALENDAR_UNITS:
        return F.date_trunc(CALENDAR_UNITS[interval], instant(ns))
    raise ValueError(f"unknown interval: {interval}")


def restart(bar_time: str | Column, interval: str) -> Column:
    """Start of the coarser bar that a bar lies in."""
    t = F.col(bar_time) if isinstance(bar_time, str) else bar_time
    if interval in CALENDAR_UNITS:
        return F.date_trunc(CALENDAR_UNITS[interval], t)
    if interval in FIXED_MICROS:
        us = F.unix_micros(t)
        return F.timestamp_micros(us - F.pmod(us, F.lit(FIXED_MICROS[interval]).cast("long")))
    raise ValueError(f"unknown interval: {interval}")


def session_of(ns: str | Column) -> Column:
    """The UTC day of a tick."""
    return F.date_trunc("day", instant(ns))


def price_bin(price: str, size: float) -> Column:
    """Lower edge of the price's bin."""
    return F.floor(F.col(price) / F.lit(float(size))) * F.lit(float(size))


def bin_index(price: str, size: float) -> Column:
    return F.floor(F.col(price) / F.lit(float(size)))


def raw_to_ns(raw: str | Column) -> Column:
    """Nanoseconds of a raw time in milliseconds or microseconds."""
    raw = F.col(raw) if isinstance(raw, str) else raw
    return F.when(raw >= F.lit(MICROSECONDS_FROM), raw * F.lit(1000)).otherwise(raw * F.lit(1_000_000))


def ratio(x: Column, y: Column) -> Column:
    """x / y; null where y is 0 or null."""
    return F.try_divide(x, y)


def valid(*columns: str) -> Column:
    """All columns above 0 and no NaN (Spark holds NaN above every number)."""
    out = F.lit(True)
    for c in columns:
        out = out & (F.col(c) > 0) & ~F.isnan(c)
    return out


def total(x: Column, exact: bool) -> Column:
    """Sum as a double; exact: of decimals of eight places, so that the order of addition cannot matter."""
    return F.sum(x.cast(EXACT)).cast("double") if exact else F.sum(x)
