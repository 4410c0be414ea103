"""Event-time columns.

Every operator works on one event-time column ``et`` of type TIMESTAMP
(session zone UTC). Sources carry time as epoch seconds, epoch ms, text or
TIMESTAMP_NTZ; :func:`with_event_time` turns any of them into ``et`` and, for
streams, declares the watermark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def event_time_from(col: str | Column, unit: str = "s") -> Column:
    """Expression turning ``col`` into a TIMESTAMP.

    ``unit``: ``s`` / ``ms`` / ``us`` for epoch numbers (text is cast first),
    ``timestamp`` for TIMESTAMP or TIMESTAMP_NTZ (NTZ is read as UTC wall time).
    """
    c = F.col(col) if isinstance(col, str) else col
    if unit == "s":
        return F.timestamp_seconds(c.cast("bigint"))
    if unit == "ms":
        return F.timestamp_millis(c.cast("bigint"))
    if unit == "us":
        return F.timestamp_micros(c.cast("bigint"))
    if unit == "timestamp":
        return c.cast("timestamp")
    raise ValueError(f"unknown time unit {unit!r}")


def with_event_time(df: DataFrame, col: str, unit: str = "s", delay: str | None = None,
                    out: str = "et") -> DataFrame:
    """Add event-time column ``out`` from ``col``.

    ``delay`` is the bounded out-of-orderness of the watermark (streams only;
    batch frames ignore it). Ascending input uses ``"1 millisecond"``: a zero
    delay lets Spark drop a row whose time equals the watermark.
    """
    df = df.withColumn(out, event_time_from(col, unit))
    if delay is not None and df.isStreaming:
        df = df.withWatermark(out, delay)
    return df


def epoch_ms(col: str | Column = "et") -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.unix_millis(c)


def window_end_ms(window_col: str = "window") -> Column:
    """Exclusive window end as epoch ms (the reference's ``windowEnd``)."""
    return F.unix_millis(F.col(f"{window_col}.end"))
