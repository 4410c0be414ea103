"""Two-step sequence patterns per key.

Semantics of the pattern ``begin(p1).next(p2).within(d)``: ``next`` is
strict contiguity (the very next event of the key), ``within`` is
exclusive (gap ``< d``), and every overlapping match is reported. Events of
a key are ordered by ``(et, seq)``.

* :func:`adjacent_pair_within` -- completed matches, reported on the 2nd
  event (login failures: two fails in a row within 2 s).
* :func:`pattern_timeout` -- partial matches that time out: a ``p1`` event
  whose next event is absent or arrives ``>= d`` later. A next event inside
  ``d`` that is not ``p2`` discards the partial match silently.
* :func:`pattern_matches` -- completed matches reported on the 1st event
  with the 2nd event's time (the select side of a timeout pattern).

Plan: one shuffle on ``(key, time chunk)`` and a sort, then ``lag`` /
``lead``; see :mod:`eventlytics.operators.sequence` for why chunks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlytics.operators.durations import to_us
from eventlytics.operators.sequence import default_chunk_us, with_edges, with_halo

_HELPERS = ("_t", "_p1", "_p2", "_chunk", "_halo")


def _prepared(df: DataFrame, keys: Sequence[str], first: Column, second: Column, within_us: int,
              side: str, chunk_us: int | None, time_col: str, seq_col: str):
    chunk_us = chunk_us or default_chunk_us(within_us)
    # rows without an event time are left out, as on a stream
    base = df.where(F.col(time_col).isNotNull()).withColumn("_t", F.unix_micros(F.col(time_col))) \
             .withColumn("_p1", first).withColumn("_p2", second)
    if chunk_us >= within_us:
        return with_halo(base, "_t", within_us, chunk_us, side)
    return with_edges(base, list(keys), "_t", ["_t", seq_col], ["_p1", "_p2"], within_us, chunk_us, side)


def _window(keys: Sequence[str], seq_col: str):
    return Window.partitionBy(*keys, "_chunk").orderBy("_t", seq_col)


def adjacent_pair_within(df: DataFrame, keys: Sequence[str], first: Column, second: Column,
                         within, time_col: str = "et", seq_col: str = "seq",
                         chunk_us: int | None = None) -> DataFrame:
    """Events matching ``second`` whose previous event (same key) matched
    ``first`` less than ``within`` earlier. Output: the second event's
    columns plus ``first_et`` and ``first_seq``."""
    if df.isStreaming:
        raise ValueError("use eventlytics.streaming.staged_stream for streams")
    d = to_us(within)
    rows = _prepared(df, keys, first, second, d, "before", chunk_us, time_col, seq_col)
    w = _window(keys, seq_col)
    rows = rows.select("*", F.lag("_t").over(w).alias("_pt"), F.lag("_p1").over(w).alias("_pp1"),
                       F.lag(seq_col).over(w).alias("first_seq"))
    hit = (~F.col("_halo")) & F.col("_p2") & F.col("_pp1") & ((F.col("_t") - F.col("_pt")) < d)
    return rows.where(hit).select(*df.columns, F.timestamp_micros("_pt").alias("first_et"),
                                  "first_seq")


def _with_next(df, keys, start, nxt, within, time_col, seq_col, chunk_us):
    d = to_us(within)
    rows = _prepared(df, keys, start, nxt, d, "after", chunk_us, time_col, seq_col)
    w = _window(keys, seq_col)
    rows = rows.select("*", F.lead("_t").over(w).alias("_nt"), F.lead("_p2").over(w).alias("_np2"),
                       F.lead(seq_col).over(w).alias("next_seq"))
    return rows.where(~F.col("_halo") & F.col("_p1")), d


def pattern_timeout(df: DataFrame, keys: Sequence[str], start: Column, nxt: Column, within,
                    time_col: str = "et", seq_col: str = "seq",
                    chunk_us: int | None = None) -> DataFrame:
    """``start`` events of timed-out partial matches (C2). Output: their columns."""
    if df.isStreaming:
        raise ValueError("use eventlytics.streaming.staged_stream for streams")
    rows, d = _with_next(df, keys, start, nxt, within, time_col, seq_col, chunk_us)
    late = F.col("_nt").isNull() | ((F.col("_nt") - F.col("_t")) >= d)
    return rows.where(late).select(*df.columns)


def pattern_matches(df: DataFrame, keys: Sequence[str], start: Column, nxt: Column, within,
                    time_col: str = "et", seq_col: str = "seq",
                    chunk_us: int | None = None) -> DataFrame:
    """Completed matches (C3): the start event's columns plus ``next_et``
    and ``next_seq`` of the matching event."""
    if df.isStreaming:
        raise ValueError("use eventlytics.streaming.staged_stream for streams")
    rows, d = _with_next(df, keys, start, nxt, within, time_col, seq_col, chunk_us)
    done = F.col("_np2") & ((F.col("_nt") - F.col("_t")) < d)
    return rows.where(done).select(*df.columns, F.timestamp_micros("_nt").alias("next_et"),
                                   "next_seq")


def pattern_outcomes(df: DataFrame, keys: Sequence[str], start: Column, nxt: Column, within,
                     time_col: str = "et", seq_col: str = "seq",
                     chunk_us: int | None = None) -> DataFrame:
    """Matches and timeouts in one pass: the start event's columns,
    ``status`` (``match`` | ``timeout``), and ``next_et`` and ``next_seq`` of
    a match. A start event that some other event follows in time has none."""
    if df.isStreaming:
        raise ValueError("use eventlytics.streaming.staged_stream for streams")
    rows, d = _with_next(df, keys, start, nxt, within, time_col, seq_col, chunk_us)
    late = F.col("_nt").isNull() | ((F.col("_nt") - F.col("_t")) >= d)
    status = F.when(late, "timeout").when(F.col("_np2"), "match")
    matched = F.col("status") == "match"
    return rows.withColumn("status", status).where(F.col("status").isNotNull()).select(
        *df.columns, "status", F.when(matched, F.timestamp_micros("_nt")).alias("next_et"),
        F.when(matched, F.col("next_seq")).alias("next_seq"))
