"""Late rows by arrival order.

A window is closed for a row if, before the row arrived, some row with a time
at or beyond the window's end (plus ``delay``) had arrived; the row then does
not count in it. That is a rule per row, not per micro-batch: it needs the
largest event time among all rows that arrived earlier, a prefix maximum over
the whole input in order of arrival.

The input is range-partitioned by arrival once and written with its block
numbers (so that the blocks stay what they are); each block gives its maximum,
a scan over these few rows (one per block) gives what each block starts from,
and a running maximum within the blocks does the rest. A block never holds more
than its share of rows, however arrivals crowd, as ties are told apart by the
further arrival columns. No row sees more than its own block, no join is made.

Rows without an event time are never late, make nothing late and count in no
window. The ascending rule of the reference is ``delay=0``; its bounded rule of
``d`` is ``d`` less one millisecond.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlytics.operators.durations import to_us
from eventlytics.operators.sequence import floor_div
from eventlytics.session import scratch_path


def with_seen_before(df: DataFrame, arrival: Sequence[str], time_col: str = "et", out: str = "seen_et",
                     blocks: int | None = None) -> DataFrame:
    """Adds ``out``: the largest ``time_col`` of all rows that arrived before
    (in the order of the columns ``arrival``, which should be unique); null
    for the first one."""
    spark = df.sparkSession
    n = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "arrival")
    ranged = df.repartitionByRange(n, *arrival).withColumn("_block", F.spark_partition_id())
    ranged.write.parquet(path)
    rows = spark.read.schema(ranged.schema).parquet(path).withColumn("_seen", F.col(time_col))
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # one row per block
    starts = rows.groupBy("_block").agg(F.max("_seen").alias("_seen")).select(
        "_block", F.max("_seen").over(earlier).alias("_seen"))
    rows = rows.withColumn("_start", F.lit(False))
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    both = rows.unionByName(starts.select(*blank, "_block", "_seen", F.lit(True).alias("_start")))
    running = (Window.partitionBy("_block").orderBy(F.col("_start").desc(), *arrival)
               .rowsBetween(Window.unboundedPreceding, -1))
    return (both.withColumn(out, F.max("_seen").over(running)).where(~F.col("_start"))
            .select(*df.columns, out))


def with_closed_windows(df: DataFrame, arrival: Sequence[str], size, slide=None, delay=0, time_col: str = "et",
                        blocks: int | None = None) -> DataFrame:
    """Adds ``seen_et`` and ``n_closed``: how many of the row's windows were
    closed when it arrived (they are its earliest ones)."""
    size_us, slide_us = to_us(size), to_us(slide if slide is not None else size)
    if size_us % slide_us:
        raise ValueError("size must be a multiple of slide")
    seen = with_seen_before(df, arrival, time_col, blocks=blocks)
    pane = floor_div(F.unix_micros(F.col(time_col)), slide_us)
    last = floor_div(F.unix_micros(F.col("seen_et")) - to_us(delay), slide_us)  # ends up to last * slide are closed
    closed = F.greatest(F.lit(0).cast("bigint"), F.least(last - pane, F.lit(size_us // slide_us)))
    return seen.withColumn("n_closed", F.when(last.isNotNull() & pane.isNotNull(), closed).otherwise(0)
                           .cast("int"))


def late_rows(df: DataFrame, arrival: Sequence[str], size, slide=None, delay=0, time_col: str = "et",
              blocks: int | None = None) -> DataFrame:
    """The rows that count in no window, with ``seen_et`` (the late output)."""
    n = to_us(size) // to_us(slide if slide is not None else size)
    rows = with_closed_windows(df, arrival, size, slide, delay, time_col, blocks)
    return rows.where((F.col("n_closed") == n) & F.col(time_col).isNotNull()).drop("n_closed")


def window_count_with_late(df: DataFrame, arrival: Sequence[str], size, slide=None, delay=0, keys: Sequence[str] = (),
                           time_col: str = "et", count_col: str = "cnt", late_col: str = "late",
                           blocks: int | None = None) -> DataFrame:
    """``(*keys, window_end, cnt, late)``: rows counted, and rows dropped
    because the window was closed, per window."""
    size_us, slide_us = to_us(size), to_us(slide if slide is not None else size)
    rows = with_closed_windows(df, arrival, size, slide, delay, time_col, blocks)
    pane = floor_div(F.unix_micros(F.col(time_col)), slide_us)
    # rows with the same pane and number of closed windows go on as one
    panes = rows.where(F.col(time_col).isNotNull()).groupBy(*keys, pane.alias("_p"), "n_closed").agg(
        F.count(F.lit(1)).alias("_n"))
    each = panes.select(*keys, "_p", "n_closed", "_n", F.explode(F.sequence(F.lit(1), F.lit(size_us // slide_us)))
                        .alias("_k"))
    is_late = F.col("_k") <= F.col("n_closed")
    return each.groupBy(*keys, ((F.col("_p") + F.col("_k")) * (slide_us // 1000)).alias("window_end")).agg(
        F.sum(F.when(is_late, 0).otherwise(F.col("_n"))).alias(count_col),
        F.sum(F.when(is_late, F.col("_n")).otherwise(0)).alias(late_col))
