"""Mergeable sketches of distinct values per window (A5).

A pane's values become one sketch (partial aggregation: a task sends a sketch
per pane, not its values); a window unites the sketches of its panes, so a
value is hashed once however many windows it counts in. HyperLogLog sketches
estimate how many values a window has; theta sketches can be intersected as
well, which gives the values seen in a window *and* the one before it.

``bound`` of an estimate is three standard errors of its sketch, at least one
value: ``3 * 1.04 / sqrt(2 ** lg_k)`` for HyperLogLog, ``3 / sqrt(2 ** lg_k)``
of the union for theta.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlytics.operators.durations import to_us
from eventlytics.operators.windows import pane_index

LG_K = 12  # 4,096 registers or entries a sketch


def hll_bound(count: Column, lg_k: int = LG_K) -> Column:
    return F.greatest(F.lit(1.0), count * (3 * 1.04 / math.sqrt(2 ** lg_k)))


def window_distinct_estimate(df: DataFrame, col: str, size, slide=None, time_col: str = "et",
                             out_col: str = "estimate", lg_k: int = LG_K) -> DataFrame:
    """``(window_end, estimate)`` of the distinct values of ``col``. Nulls are
    no value; windows without one are left out."""
    size_us, slide_us = to_us(size), to_us(slide if slide is not None else size)
    if size_us % slide_us:
        raise ValueError("size must be a multiple of slide")
    n = size_us // slide_us
    rows = df.where(F.col(col).isNotNull() & F.col(time_col).isNotNull())
    panes = rows.groupBy(pane_index(slide_us, time_col).alias("_p")).agg(F.hll_sketch_agg(col, F.lit(lg_k)).alias("_s"))
    fed = panes.select(F.explode(F.sequence(F.col("_p") + 1, F.col("_p") + n)).alias("_w"), "_s")
    return fed.groupBy("_w").agg(F.hll_union_agg("_s").alias("_s")).select(
        (F.col("_w") * (slide_us // 1000)).alias("window_end"), F.hll_sketch_estimate("_s").alias(out_col))


def window_distinct_both(df: DataFrame, col: str, size, time_col: str = "et", out_col: str = "estimate",
                         lg_k: int = LG_K) -> DataFrame:
    """``(window_end, estimate, bound)``: how many values of ``col`` a tumbling
    window shares with the one before it."""
    size_us = to_us(size)
    rows = df.where(F.col(col).isNotNull() & F.col(time_col).isNotNull())
    own = rows.groupBy(pane_index(size_us, time_col).alias("_w")).agg(F.theta_sketch_agg(col, F.lit(lg_k)).alias("_s"))
    # a window's sketch is needed by it and by the next one
    both = own.select(F.explode(F.array(F.struct("_w", F.lit(0).alias("_age")), F.struct((F.col("_w") + 1).alias("_w"),
                      F.lit(1).alias("_age")))).alias("_to"), "_s").select("_to.*", "_s")
    pairs = both.groupBy("_w").agg(F.max_by("_s", F.when(F.col("_age") == 0, 1)).alias("_now"),
                                   F.max_by("_s", F.when(F.col("_age") == 1, 1)).alias("_before"))
    met = F.when(F.col("_before").isNull(), 0).otherwise(
        F.theta_sketch_estimate(F.theta_intersection("_now", "_before")))
    all_values = F.when(F.col("_before").isNull(), 0).otherwise(F.theta_sketch_estimate(F.theta_union("_now", "_before")))
    return pairs.where(F.col("_now").isNotNull()).select(
        ((F.col("_w") + 1) * (size_us // 1000)).alias("window_end"), met.cast("bigint").alias(out_col),
        F.greatest(F.lit(1.0), all_values * (3 / math.sqrt(2 ** lg_k))).alias("bound"))
