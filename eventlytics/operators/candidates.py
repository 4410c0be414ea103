"""Exact top-k per window without shuffling every key's count.

Each pane's keys become one frequent-items sketch (partial aggregation: a task
sends a sketch per pane, not its keys); a window unites the sketches of its
panes and names its ``candidates`` largest keys. Only events of candidates are
counted again, exactly; the filter is a broadcast of the candidates per pane,
whose number is counted first.

The sketch bounds the count of any key that is no candidate, so the top k of a
window are accepted only if the k-th exact count is above that bound (a tie at
the bound proves nothing). The windows left over are counted the full way, from
the events of their panes alone; so is everything if the candidates are too
many to broadcast. The rows are those of ``windowed_count`` and
``top_k_per_window`` in every case.

The bound: a sketch of ``m`` slots (the power of two at or above a third more
than ``tracked``) over ``n`` rows is off by at most ``3.5 n / m``; an estimate
is an upper bound and lists only keys whose lower bound is above that error. So
a key that is not listed has at most ``7 n / m`` rows, or, where the list is
full, the last listed estimate if that is more.

Rows without an event time are left out; a null key is a key like any other.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlytics.operators.durations import to_us
from eventlytics.operators.topk import top_k_per_window
from eventlytics.operators.windows import counts_from_panes, pane_index
from eventlytics.session import scratch_path

TRACKED, CANDIDATES = 10_000, 500
MOST_BROADCAST = 500_000  # pairs of a pane and a key


def _kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once in the shared folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def window_candidates(df: DataFrame, key: str, size, slide=None, time_col: str = "et", tracked: int = TRACKED,
                      candidates: int = CANDIDATES) -> DataFrame:
    """``(window, bound, listed)``: a window's number (its end in slides), the
    most rows a key outside the list can have, and the listed keys."""
    n = to_us(size) // to_us(slide if slide is not None else size)
    slots = 2 ** math.ceil(math.log2(math.ceil(tracked / 0.75)))
    panes = df.groupBy(pane_index(to_us(slide if slide is not None else size), time_col).alias("_p")).agg(
        F.expr(f"approx_top_k_accumulate(`{key}`, {tracked})").alias("_s"), F.count(F.lit(1)).alias("_n"))
    fed = panes.select(F.explode(F.sequence(F.col("_p") + 1, F.col("_p") + n)).alias("window"), "_s", "_n")
    whole = fed.groupBy("window").agg(F.expr(f"approx_top_k_combine(_s, {tracked})").alias("_s"), F.sum("_n").alias("_n"))
    listed = whole.select("window", "_n", F.expr(f"approx_top_k_estimate(_s, {candidates})").alias("_l"))
    unlisted: Column = F.lit(7.0) * F.col("_n") / slots
    last = F.when(F.size("_l") >= candidates, F.element_at("_l", -1)["count"]).otherwise(0)
    return listed.select("window", F.greatest(unlisted, last).alias("bound"), F.col("_l.item").alias("listed"))


def top_k_by_candidates(df: DataFrame, key: str, k: int, size, slide=None, time_col: str = "et",
                        tracked: int = TRACKED, candidates: int = CANDIDATES,
                        most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """``(key, window_end, cnt, rank)``: the ``k`` largest counts per window,
    ties by key; a batch form (see the module notes)."""
    size_us, slide_us = to_us(size), to_us(slide if slide is not None else size)
    if size_us % slide_us:
        raise ValueError("size must be a multiple of slide")
    if candidates < k or tracked < candidates:
        raise ValueError("k <= candidates <= tracked")
    n = size_us // slide_us
    rows = df.where(F.col(time_col).isNotNull()).select(F.col(key).alias("_k"), F.col(time_col).alias("_t"))
    rows = rows.withColumn("_p", pane_index(slide_us, "_t"))

    def counted(part: DataFrame) -> DataFrame:
        panes = part.groupBy("_k", "_p").agg(F.count(F.lit(1)).alias("_n"))
        counts = counts_from_panes(panes, ["_k"], size_us, slide_us)
        return counts.withColumn("window", F.floor(F.col("window_end") / (slide_us // 1000)))

    def ranked(counts: DataFrame) -> DataFrame:
        top = top_k_per_window(counts.select("_k", "window_end", "cnt"), "_k", k)
        return top.select(F.col("_k").alias(key), "window_end", "cnt", "rank")

    panes_of = F.explode(F.sequence(F.col("window") - n, F.col("window") - 1)).alias("_p")
    found = _kept(window_candidates(rows, "_k", size, slide, "_t", tracked, candidates), "candidates")
    pairs = found.select("window", F.explode("listed").alias("_k"))
    wanted = _kept(pairs.select("_k", panes_of).distinct(), "candidate-panes")
    if wanted.limit(most_broadcast + 1).count() > most_broadcast:
        return ranked(counted(rows))

    same = lambda a, b, *cols: [a[c].eqNullSafe(b[c]) for c in cols]
    again = rows.join(F.broadcast(wanted), same(rows, wanted, "_k", "_p"), "left_semi")
    counts = counted(again)
    # a key is complete only in the windows that list it
    counts = counts.join(pairs, same(counts, pairs, "_k", "window"), "left_semi")
    counts = _kept(counts.join(found.select("window", "bound"), "window"), "candidate-counts")
    kth = F.row_number().over(Window.partitionBy("window").orderBy(F.col("cnt").desc(), "_k"))
    last = counts.select("window", "cnt", kth.alias("r")).where(F.col("r") == k).select("window", "cnt")
    # fewer than k keys: proven if no key at all is missing
    state = found.select("window", "bound").join(last, "window", "left")
    open_ = _kept(state.where(F.col("bound") >= F.coalesce("cnt", F.lit(1))).select("window"), "open-windows")
    proven = ranked(counts.join(open_, "window", "left_anti"))
    left = open_.select(panes_of).distinct()  # one row per pane of time
    if left.limit(most_broadcast + 1).count() <= most_broadcast:
        left = F.broadcast(left)
    rest = counted(rows.join(left, "_p", "left_semi")).join(open_, "window", "left_semi")
    return proven.unionByName(ranked(rest))
