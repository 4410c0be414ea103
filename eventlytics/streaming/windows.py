"""Windowed operators as staged streams: partial aggregates, not rows.

Each function returns a :class:`StagedStream` over a streaming frame; its
``finish()`` reads a bounded input to its end, ``start()`` runs it for good.
A micro-batch is aggregated to panes (or distinct values, or latest rows)
before it is staged; closed stretches are finished by the batch operator: a
sliding count is the running sum of signed pane changes, so no pane is copied
into the windows it feeds and none stays in a state store.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlytics.operators.durations import to_us
from eventlytics.operators.reconcile import latest_of_sides, merge_latest, statuses, tag_sides
from eventlytics.operators.sequence import HOUR_US
from eventlytics.operators.topk import top_k_per_window
from eventlytics.operators.windows import counts_from_panes, pane_index
from eventlytics.streaming.staged import StagedStream


def _pane_start(size_us: int) -> Column:
    return F.timestamp_micros(pane_index(size_us) * size_us)


def _staged(df: DataFrame, partial, op, size_us: int, emit: Column, name: str, delay, **options) -> StagedStream:
    chunk = -(-max(4 * size_us, HOUR_US) // size_us) * size_us  # a multiple of the window
    return StagedStream(df, op, size_us // 1000, emit, delay=delay, chunk=chunk // 1000, name=name,
                        partial=partial, ahead=0, **options)


def count_stream(df: DataFrame, keys: Sequence[str], size, slide=None, top: tuple[str, int] | None = None,
                 count_col: str = "cnt", delay="1 millisecond", name: str = "counts", **options) -> StagedStream:
    """``windowed_count`` on a stream: ``(*keys, window_end, cnt)``; with
    ``top=(key, k)`` only the k largest counts per window, with ``rank``."""
    keys, size_us = list(keys), to_us(size)
    slide_us = to_us(slide if slide is not None else size)
    if size_us % slide_us:
        raise ValueError("size must be a multiple of slide")

    def partial(rows):
        return rows.groupBy(*keys, _pane_start(slide_us).alias("et")).agg(F.count(F.lit(1)).alias("_n"))

    def op(rows):
        panes = rows.groupBy(*keys, pane_index(slide_us).alias("_p")).agg(F.sum("_n").alias("_n"))
        if size_us == slide_us:
            counts = panes.select(*keys, ((F.col("_p") + 1) * (slide_us // 1000)).alias("window_end"),
                                  F.col("_n").alias(count_col))
        else:
            counts = counts_from_panes(panes, keys, size_us, slide_us, count_col)
        return counts if top is None else top_k_per_window(counts, *top, count_col=count_col)

    return _staged(df, partial, op, size_us, F.col("window_end") * 1000 - 1, name, delay, **options)


def distinct_stream(df: DataFrame, col: str, size, out_col: str | None = None, delay="1 millisecond",
                    name: str = "distinct", **options) -> StagedStream:
    """Exact distinct values per tumbling window: each micro-batch stages its
    different values, a closed window counts the different ones of all."""
    size_us, out_col = to_us(size), out_col or f"distinct_{col}"

    def partial(rows):
        return rows.select(_pane_start(size_us).alias("et"), col).distinct()

    def op(rows):
        end = ((pane_index(size_us) + 1) * (size_us // 1000)).alias("window_end")
        return rows.groupBy(end, F.col(col)).agg(F.count(F.lit(1)).alias("_n")).groupBy("window_end").agg(
            F.count(col).alias(out_col))

    return _staged(df, partial, op, size_us, F.col("window_end") * 1000 - 1, name, delay, **options)


def field_sum_stream(df: DataFrame, sum_col: str, size, other_cols: Sequence[str],
                     order_cols: Sequence[str] = ("et", "seq"), delay="1 millisecond", name: str = "field-sum",
                     **options) -> StagedStream:
    """``window_field_sum`` on a stream: sums and first records of partial windows."""
    size_us = to_us(size)

    def partial(rows):
        order = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(order_cols)])
        first = F.min_by(F.struct(order.alias("k"), F.struct(*other_cols).alias("v")), order)
        return rows.groupBy(_pane_start(size_us).alias("_w")).agg(
            F.sum(sum_col).alias(sum_col), first.alias("_first")).withColumnRenamed("_w", "et")

    def op(rows):
        end = ((pane_index(size_us) + 1) * (size_us // 1000)).alias("window_end")
        sums = rows.groupBy(end).agg(F.sum(sum_col).alias(sum_col),
                                     F.min_by("_first.v", "_first.k").alias("_first"))
        return sums.select("window_end", sum_col, *[F.col(f"_first.{c}").alias(c) for c in other_cols])

    return _staged(df, partial, op, size_us, F.col("window_end") * 1000 - 1, name, delay, **options)


def reconcile_stream(orders: DataFrame, payments: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
                     payment_cols: Sequence[str], key_window, wait=None, seq_col: str = "seq",
                     delay="1 millisecond", name: str = "reconcile", **options) -> StagedStream:
    """``reconcile`` on two streams whose keys are tied to a tumbling window:
    each micro-batch stages the latest rows of its keys and sides. The result
    has a column ``window_end`` besides."""
    keys, size_us = list(keys), to_us(key_window)
    tagged = tag_sides(orders, payments, keys, order_cols, payment_cols, "et", seq_col)

    def partial(rows):
        return latest_of_sides(rows.withColumn("_w", _pane_start(size_us)), [*keys, "_w"], order_cols, payment_cols,
                               "et", seq_col).withColumnRenamed("_w", "et")

    def op(rows):
        latest = merge_latest(rows, [*keys, "et"])
        latest = latest.withColumn("window_end", F.unix_millis("et") + size_us // 1000)
        return statuses(latest, [*keys, "window_end"], order_cols, payment_cols, wait)

    return _staged(tagged, partial, op, size_us, F.col("window_end") * 1000 - 1, name, delay, **options)
