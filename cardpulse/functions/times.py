"""Integer event-time arithmetic. Microsecond longs keep window edges exact."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
}


def micros(duration: str) -> int:
    """``"5 minutes"`` as microseconds; several parts add up (``"1 hour 30 minutes"``)."""
    words = duration.split()
    if not words or len(words) % 2:
        raise ValueError(f"not a duration: {duration!r}")
    total = 0
    for amount, unit in zip(words[::2], words[1::2]):
        name = unit.lower().rstrip("s")
        if name not in _UNIT_MICROS:
            raise ValueError(f"unknown unit in {duration!r}")
        total += int(amount) * _UNIT_MICROS[name]
    if total <= 0:
        raise ValueError(f"duration must be positive: {duration!r}")
    return total


def slot_of(at_us: Column, width_us: int) -> Column:
    """Index of the epoch-aligned slot that holds ``at_us``; exact, also before 1970."""
    width = F.lit(width_us).cast("bigint")
    return F.call_function("div", at_us - F.pmod(at_us, width), width)


def interval(duration_us: int) -> Column:
    return F.make_dt_interval(secs=F.lit(duration_us / 1_000_000).cast("decimal(18,6)"))
