"""Event-time window aggregations.

All windows are half-open ``[start, end)`` and aligned to the epoch; the
output carries ``window_end`` as epoch ms. Every function takes a batch or
a streaming frame: on a stream the caller sets the watermark (see
``with_event_time``) and runs the result in append mode, which emits each
window once, when the watermark passes its end.

Scale notes. Counts and sums are mergeable, so Spark aggregates partially
before the shuffle (``HashAggregate`` partial + final): a hot key costs one
partial row per map task and window, not one row per event. A sliding
window of size ``s`` and slide ``l`` copies each row ``n = s/l`` times
(``Expand``; the traffic job's 10 min / 5 s window copies 120 times) and
then shuffles the copies. The batch *pane* form (default when ``l``
divides ``s``) counts per slide-sized pane first (partial + final), then
shuffles only the pane counts, on ``(key, window block)``: a pane's ``n``
windows fall into at most two blocks of ``4n`` consecutive windows, so each
pane count is sent to one or two tasks. There a pane is two signed changes
(its count at its first window, minus it after its last); a running sum over
the changes gives the count of every window, so the work per pane does not
grow with ``n``, and only finished counts are written out per window. The
shuffle carries about 1.25 rows per pane instead of ``n`` per event, and a
hot key is spread over its time blocks. That stage has an explicit number of
partitions (``partitions``, else ``spark.sql.shuffle.partitions``), because
the rows multiply only after the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlytics.functions.time import window_end_ms
from eventlytics.operators.durations import spark_interval, to_us
from eventlytics.operators.sequence import floor_div


def _window(time_col: str, size, slide=None) -> Column:
    if slide is None or to_us(slide) == to_us(size):
        return F.window(time_col, spark_interval(size))
    return F.window(time_col, spark_interval(size), spark_interval(slide))


def pane_index(slide_us: int, time_col: str = "et") -> Column:
    return floor_div(F.unix_micros(F.col(time_col)), slide_us)


def counts_from_panes(panes: DataFrame, keys: list[str], size_us: int, slide_us: int, count_col: str = "cnt",
                      partitions: int | None = None) -> DataFrame:
    """Sliding counts from counts ``_n`` per pane ``_p`` (one row per key and
    pane), by signed changes (see the module notes)."""
    df, n = panes, size_us // slide_us
    block = 4 * n
    # window w (end = w * slide) holds panes w-n .. w-1, so pane p feeds w = p+1 .. p+n
    lo, hi = F.col("_p") + 1, F.col("_p") + n
    blocks = F.sequence(floor_div(lo, block), floor_div(hi, block))
    width = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = (panes.select(*keys, "_p", "_n", F.explode(blocks).alias("_b"))
              .repartition(width, *keys, "_b"))
    # in a block, a pane adds its count at its first window and takes it away after its last
    end = F.col("_b") * block + block
    first_w, after = F.greatest(lo, F.col("_b") * block), hi + 1
    change = lambda w, v: F.struct(w.alias("_w"), v.alias("_d"))
    changes = F.when(after < end, F.array(change(first_w, F.col("_n")), change(after, -F.col("_n")))
                     ).otherwise(F.array(change(first_w, F.col("_n"))))
    steps = spread.select(*keys, "_b", F.inline(changes)).groupBy(*keys, "_b", "_w").agg(F.sum("_d").alias("_d"))
    in_block = Window.partitionBy(*keys, "_b").orderBy("_w")
    level = F.sum("_d").over(in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    until = F.coalesce(F.lead("_w").over(in_block), end)
    runs = steps.select(*keys, "_w", until.alias("_until"), level.alias(count_col)).where(F.col(count_col) > 0)
    counts = runs.select(*keys, F.explode(F.sequence(F.col("_w"), F.col("_until") - 1)).alias("_w"), count_col)
    return counts.select(*keys, (F.col("_w") * (slide_us // 1000)).alias("window_end"), count_col)


def windowed_count(df: DataFrame, keys: Sequence[str], size, slide=None, time_col: str = "et",
                   method: str = "auto", count_col: str = "cnt", partitions: int | None = None) -> DataFrame:
    """Rows per key and window: ``(*keys, window_end, cnt)`` (A1 + A2 + P4).

    ``method``: ``direct`` (Spark's ``window``), ``pane`` (needs ``size`` to
    be a multiple of ``slide``) or ``auto`` (pane for sliding batch windows
    when possible). Both forms give identical rows. ``partitions``: width of
    the batch pane form's second stage (the session's shuffle partitions by
    default).
    """
    keys = list(keys)
    sliding = slide is not None and to_us(size) != to_us(slide)
    divisible = sliding and to_us(size) % to_us(slide) == 0
    if method == "auto":
        method = "pane" if divisible else "direct"
    if method == "pane" and sliding:
        if not divisible:
            raise ValueError("pane method needs size to be a multiple of slide")
        if not df.isStreaming:
            panes = df.groupBy(*keys, pane_index(to_us(slide), time_col).alias("_p")).agg(
                F.count(F.lit(1)).alias("_n"))
            return counts_from_panes(panes, keys, to_us(size), to_us(slide), count_col, partitions)
        # stream: chained append-mode aggregations keep the watermark lineage
        panes = (df.groupBy(_window(time_col, slide).alias("_pane"), *keys)
                 .agg(F.count(F.lit(1)).alias("_n"))
                 .select(F.window_time("_pane").alias("_pt"), *keys, "_n"))
        agg = (panes.groupBy(_window("_pt", size, slide).alias("window"), *keys)
               .agg(F.sum("_n").alias(count_col)))
    elif method in ("direct", "pane"):
        agg = (df.groupBy(_window(time_col, size, slide).alias("window"), *keys)
               .agg(F.count(F.lit(1)).alias(count_col)))
    else:
        raise ValueError(f"unknown method {method!r}")
    return agg.select(*keys, window_end_ms("window").alias("window_end"), count_col)


def window_count(df: DataFrame, size, time_col: str = "et", count_col: str = "cnt") -> DataFrame:
    """Rows per tumbling window over the whole stream."""
    return windowed_count(df, [], size, None, time_col, count_col=count_col)


def window_field_sum(df: DataFrame, sum_col: str, size, other_cols: Sequence[str],
                     time_col: str = "et", order_cols: Sequence[str] = ("et", "seq"),
                     safe: bool = False) -> DataFrame:
    """Sum one field per tumbling window; the other fields are those of the
    window's first record by ``order_cols`` (A3, the literal ``sum(0)``).

    ``safe=True`` returns NULL on BIGINT overflow instead of failing.
    """
    total = F.try_sum(sum_col) if safe else F.sum(sum_col)
    first = F.min_by(F.struct(*other_cols), F.struct(*order_cols))
    return (df.groupBy(_window(time_col, size).alias("window"))
            .agg(total.alias(sum_col), first.alias("_first"))
            .select(window_end_ms("window").alias("window_end"), sum_col,
                    *[F.col(f"_first.{c}").alias(c) for c in other_cols]))


def window_distinct(df: DataFrame, col: str, size, slide=None, time_col: str = "et",
                    exact: bool = True, rsd: float = 0.01, out_col: str | None = None) -> DataFrame:
    """Distinct values of ``col`` per window (A5, U4).

    Exact form: group by ``(window, col)`` first, then count per window. Spark
    plans ``count_distinct`` the same way in batch; written out, it also runs
    on a stream (two chained append-mode aggregations) and never holds a
    window's values in one set. ``exact=False`` uses HyperLogLog++
    (``approx_count_distinct``) with relative error ``rsd``.
    """
    out_col = out_col or f"distinct_{col}"
    if not exact:
        agg = (df.groupBy(_window(time_col, size, slide).alias("window"))
               .agg(F.approx_count_distinct(col, rsd).alias(out_col)))
    elif df.isStreaming:
        per_value = df.groupBy(_window(time_col, size, slide).alias("window"), col).agg(
            F.count(F.lit(1)).alias("_n"))
        agg = per_value.groupBy("window").agg(F.count(col).alias(out_col))
    else:
        agg = (df.groupBy(_window(time_col, size, slide).alias("window"))
               .agg(F.count_distinct(col).alias(out_col)))
    return agg.select(window_end_ms("window").alias("window_end"), out_col)


def window_distinct_sliding(df: DataFrame, col: str, size, slide, time_col: str = "et", out_col: str | None = None,
                            partitions: int | None = None) -> DataFrame:
    """Exact distinct values of ``col`` per sliding window (A5 x W1), batch.

    A value feeds the union of the windows of its occurrences. In pane order,
    an occurrence adds only the windows that the one before it (``lag`` per
    value) does not feed already, as two signed changes: plus one at its first
    new window, minus one after its last. Their running sum is the number of
    distinct values: the work is one row per value and pane, never one per
    window. Values are cut into blocks of time, each with what reaches in
    from the block before, so a hot value is spread; so are the running sums.
    Nulls are no value.
    """
    size_us, slide_us = to_us(size), to_us(slide)
    if size_us % slide_us:
        raise ValueError("size must be a multiple of slide")
    out_col = out_col or f"distinct_{col}"
    n = size_us // slide_us
    block = 4 * n
    seen = df.where(F.col(col).isNotNull() & F.col(time_col).isNotNull()).groupBy(
        F.col(col).alias("_v"), pane_index(slide_us, time_col).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    # pane p feeds windows p+1 .. p+n; it is seen in the block of its pane, and, if it reaches over, in the next
    lo, hi = floor_div(F.col("_p"), block), floor_div(F.col("_p") + n - 1, block)
    spread = seen.select("_v", "_p", F.explode(F.sequence(lo, hi)).alias("_b"))
    before = F.lag("_p").over(Window.partitionBy("_v", "_b").orderBy("_p"))
    start, end = F.col("_b") * block + 1, F.col("_b") * block + block  # windows of block b, inclusive
    spread = spread.select("_b", F.greatest(F.col("_p") + 1, before + n + 1, start).alias("_from"),
                           (F.col("_p") + n).alias("_to"))
    change = lambda w, v: F.struct(w.alias("_w"), F.lit(v).alias("_d"))
    last = F.least(F.col("_to"), end)
    changes = F.when(F.col("_from") > last, F.array().cast("array<struct<_w:bigint,_d:int>>")).when(
        F.col("_to") < end, F.array(change(F.col("_from"), 1), change(F.col("_to") + 1, -1))).otherwise(
        F.array(change(F.col("_from"), 1)))
    steps = spread.select("_b", F.inline(changes)).groupBy("_b", "_w").agg(F.sum("_d").alias("_d"))
    in_block = Window.partitionBy("_b").orderBy("_w")
    level = F.sum("_d").over(in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    until = F.coalesce(F.lead("_w").over(in_block), end + 1)
    runs = steps.select("_w", until.alias("_until"), level.alias(out_col)).where(F.col(out_col) > 0)
    return runs.select(F.explode(F.sequence(F.col("_w"), F.col("_until") - 1)).alias("_w"), out_col).select(
        (F.col("_w") * (slide_us // 1000)).alias("window_end"), out_col)
