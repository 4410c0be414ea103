"""Top-k per window and the rank report.

Batch: ``row_number() <= k`` over ``partition by window_end``. Catalyst
turns the filter into a ``WindowGroupLimit`` that keeps only k rows per
window *before* the shuffle, so a window with millions of keys sends k rows
per map task. Streams: rank functions are not allowed on a stream, and a
``collect_list`` per window would hold every key of a window in one group;
instead the windowed counts run in append mode (each window arrives once,
complete) and each micro-batch is ranked with this same batch operator
(see ``eventlytics.streaming.top_k_stream``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlytics.functions.text import (
    ITEM_COUNT_LABEL, ITEM_LABEL, ITEM_RULER, TIME_LABEL, rank_line,
)


def top_k_per_window(counts: DataFrame, key: str, k: int = 5, window_col: str = "window_end",
                     count_col: str = "cnt", rank_col: str = "rank") -> DataFrame:
    """The ``k`` largest counts per window; ties by key ascending.
    Output: input columns plus ``rank`` (BIGINT, 1-based)."""
    if counts.isStreaming:
        raise ValueError("rank a stream per micro-batch: eventlytics.streaming.top_k_stream")
    w = Window.partitionBy(window_col).orderBy(F.col(count_col).desc(), F.col(key).asc())
    rn = F.row_number().over(w)
    return counts.withColumn(rank_col, rn).where(F.col(rank_col) <= k) \
        .withColumn(rank_col, F.col(rank_col).cast("bigint"))


def rank_report(top: DataFrame, key: str, window_col: str = "window_end", count_col: str = "cnt",
                rank_col: str = "rank", key_label: str = ITEM_LABEL,
                count_label: str = ITEM_COUNT_LABEL, trailer: str = "\n", ruler: str = ITEM_RULER) -> DataFrame:
    """One text block per window (T4): ruler, window time, ``NoI`` lines.

    Each group holds at most k rows (the output of :func:`top_k_per_window`),
    so collecting them is bounded.
    """
    line = rank_line(F.col(rank_col), F.col(key), F.col(count_col), key_label, count_label)
    per_window = top.groupBy(window_col).agg(
        F.sort_array(F.collect_list(F.struct(F.col(rank_col), line.alias("line")))).alias("_lines"))
    at = F.timestamp_millis(F.col(window_col))
    # the fraction as a Java timestamp prints it: at least one digit, no trailing zeros
    millis = F.rtrim(F.date_format(at, "SSS"), F.lit("0"))
    when = F.concat(F.date_format(at, "yyyy-MM-dd HH:mm:ss."), F.when(millis == "", "0").otherwise(millis))
    body = F.array_join(F.transform("_lines", lambda s: s["line"]), "\n")
    text = F.concat(F.lit(ruler + "\n" + TIME_LABEL), when, F.lit("\n"), body, F.lit("\n"),
                    F.lit(ruler + trailer))
    return per_window.select(window_col, text.alias("report"))
