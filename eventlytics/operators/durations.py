"""Durations given as Spark interval text (``"5 minutes"``) or integer ms."""

from __future__ import annotations

_UNIT_US = {
    "microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
    "hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000,
}


def to_us(d: int | str) -> int:
    """Microseconds in ``d`` (int = milliseconds)."""
    if isinstance(d, int):
        return d * 1_000
    n, unit = d.strip().split()
    unit = unit.lower().rstrip("s")
    if unit not in _UNIT_US:
        raise ValueError(f"unsupported duration unit in {d!r}")
    return int(float(n) * _UNIT_US[unit])


def spark_interval(d: int | str) -> str:
    """Interval text Spark's ``window`` / ``withWatermark`` accept."""
    return f"{to_us(d)} microseconds"
