"""Timer-driven keyed detectors in closed form (M1, M2, F3, E5 in batch).

The reference registers an event-time timer at ``t + d`` for *every* event
of a key; when a timer fires it inspects what the key has stored since the
last firing and clears it. With an ideal watermark (before an event at
``t`` exactly the timers ``< t`` have fired), an event at ``t`` is flushed
by the earliest timer ``>= t``, and all events flushed by the same timer
form one group. So

    bucket(t) = min { t_i + d  |  t_i + d >= t }   over the key's events,

an as-of lookup of each event into the key's timer set. Plan: each event
emits a *probe* at ``t`` and a *marker* at ``t + d``; sorted by time
descending (markers first on ties), a running ``last(marker, ignorenulls)``
gives each probe its bucket in one linear pass -- no range frame, whose
``min`` Spark recomputes per row. Probes and markers are partitioned by
``(key, time chunk)``; a chunk also gets the markers up to ``d`` after it that
a probe there can need (see :mod:`eventlytics.operators.sequence`). Then one
aggregation per ``(key, bucket)``, partial before the shuffle.

* :func:`failure_burst` (M1): failures are stored, any login sets a timer;
  a group with more than one failure emits its first failure.
* :func:`single_slot_timeout` (M2): a ``create`` fills an empty slot, any
  other event overwrites it; a group emits its first ``create`` when it
  holds no other event.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlytics.operators.durations import to_us
from eventlytics.operators.sequence import chunk_of, default_chunk_us


def _markers(base: DataFrame, keys: Sequence[str], d: int, w_us: int) -> DataFrame:
    """Markers (key, chunk, time): those of a chunk, and what the chunks
    before it need of them. They carry no payload."""
    tt = F.col("_t") + F.lit(d)
    own = base.select(*keys, chunk_of(tt, w_us).alias("_chunk"), tt.alias("_at"))
    if w_us >= d:  # those in the first d of a chunk go to the one before as well
        early = (F.col("_at") - F.col("_chunk") * F.lit(w_us)) < F.lit(d)
        to = F.when(early, F.array(F.col("_chunk"), F.col("_chunk") - 1)).otherwise(F.array(F.col("_chunk")))
        return own.select(*keys, F.explode(to).alias("_chunk"), "_at")
    first = own.groupBy(*keys, "_chunk").agg(F.min("_at").alias("_at"))
    back = F.explode(F.sequence(F.lit(1), F.lit(d // w_us + 1)))
    return own.union(first.select(*keys, "_chunk", "_at", back.alias("_k")).select(
        *keys, (F.col("_chunk") - F.col("_k")).alias("_chunk"), "_at"))


def flush_buckets(df: DataFrame, keys: Sequence[str], delay, time_col: str = "et",
                  chunk_us: int | None = None) -> DataFrame:
    """Every row that has an event time plus ``_t`` (event µs) and ``_bucket``
    (µs of the timer that flushes it)."""
    d = to_us(delay)
    w_us = chunk_us or default_chunk_us(d)
    base = df.where(F.col(time_col).isNotNull()).withColumn("_t", F.unix_micros(F.col(time_col)))
    probes = base.withColumns({"_chunk": chunk_of(F.col("_t"), w_us), "_kind": F.lit(1), "_at": F.col("_t")})
    blank = [F.col(f.name) if f.name in keys else F.lit(None).cast(f.dataType).alias(f.name)
             for f in base.schema.fields]
    x = probes.union(_markers(base, keys, d, w_us).select(*blank, "_chunk", F.lit(0).alias("_kind"), "_at"))
    w = (Window.partitionBy(*keys, "_chunk").orderBy(F.col("_at").desc(), F.col("_kind").asc())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    bucket = F.last(F.when(F.col("_kind") == 0, F.col("_at")), ignorenulls=True).over(w)
    return x.withColumn("_bucket", bucket).where(F.col("_kind") == 1) \
        .drop("_chunk", "_kind", "_at")


def failure_burst(df: DataFrame, keys: Sequence[str], is_failure: Column, delay,
                  time_col: str = "et", seq_col: str = "seq",
                  chunk_us: int | None = None) -> DataFrame:
    """First failure of every flush group holding more than one failure.
    Output: that failure's columns plus ``timer_et`` (when it is reported)."""
    if df.isStreaming:
        raise ValueError("use eventlytics.streaming.staged_stream for streams")
    cols = df.columns
    b = flush_buckets(df.withColumn("_f", is_failure), keys, delay, time_col, chunk_us)
    groups = (b.where(F.col("_f")).groupBy(*keys, "_bucket")
              .agg(F.count(F.lit(1)).alias("_n"),
                   F.min_by(F.struct(*cols), F.struct("_t", seq_col)).alias("_first")))
    return groups.where(F.col("_n") > 1).select(
        *[F.col(f"_first.{c}").alias(c) for c in cols],
        F.timestamp_micros("_bucket").alias("timer_et"))


def single_slot_timeout(df: DataFrame, keys: Sequence[str], is_create: Column, delay,
                        time_col: str = "et", seq_col: str = "seq",
                        chunk_us: int | None = None) -> DataFrame:
    """First ``create`` of every flush group without any other event.
    Output: that event's columns plus ``timer_et``."""
    if df.isStreaming:
        raise ValueError("use eventlytics.streaming.staged_stream for streams")
    cols = df.columns
    b = flush_buckets(df.withColumn("_c", is_create), keys, delay, time_col, chunk_us)
    first_create = F.min_by(F.struct(*cols), F.when(F.col("_c"), F.struct("_t", seq_col)))
    groups = (b.groupBy(*keys, "_bucket")
              .agg(F.count_if(~F.col("_c")).alias("_other"), first_create.alias("_first")))
    return groups.where((F.col("_other") == 0) & F.col("_first").isNotNull()).select(
        *[F.col(f"_first.{c}").alias(c) for c in cols],
        F.timestamp_micros("_bucket").alias("timer_et"))
