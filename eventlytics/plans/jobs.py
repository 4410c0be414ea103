"""The reference's jobs, end to end, over raw sources.

Each job reads its source (a path for the text sources, a DataFrame for
in-memory or already-read events), assigns event time, and runs its
operators. ``stream=True`` reads the path as a file stream; DataFrame
inputs follow their own ``isStreaming``. Streams that are ranked per batch
(top-k), detected over stretches of time (J5-J8), summed with their first
record (literal J3) or reconciled (J9) are run over all available input, to its end, below the checkpoint folder and
returned as a table; page views and distinct counts return the unstarted
streaming frame, for the caller's ``writeStream``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlytics import operators as ops
from eventlytics import streaming as S
from eventlytics.functions.text import URL_COUNT_LABEL, URL_LABEL, URL_RULER
from eventlytics.functions.time import with_event_time
from eventlytics.sources.files import read_access_log, read_behavior

ASCENDING = "1 millisecond"  # watermark delay for ascending timestamps


def _seq(df: DataFrame) -> DataFrame:
    """The tie order of equal times: the source's ``seq`` (its arrival
    order). Without one, a hash of the row, in batch as on a stream: the same
    in any split of the input and any run, so that both agree."""
    return df if "seq" in df.columns else df.withColumn("seq", F.xxhash64(*df.columns))


def _page_views(spark: SparkSession, path: str, stream: bool, mode: str, position: bool = False) -> DataFrame:
    df = read_behavior(spark, path, mode=mode, stream=stream, position=position)
    if mode == "quarantine":
        df = df.where(~F.col("_bad")).drop("_bad", "_line")
    df = with_event_time(_seq(df.where(F.col("behavior") == "pv")), "ts_s", "s")
    return df.withWatermark("et", ASCENDING) if stream else df


def _top_counts(df: DataFrame, key: str, k: int, size, slide, delay, name: str) -> DataFrame:
    if df.isStreaming:
        return S.count_stream(df, [key], size, slide, (key, k), delay=delay, name=name).finish()
    return ops.top_k_per_window(ops.windowed_count(df, [key], size, slide), key, k)


def hot_items(spark: SparkSession, path: str, k: int = 5, size="60 minutes", slide="5 minutes",
              stream: bool = False, mode: str = "failfast", report: bool = False) -> DataFrame:
    """Top ``k`` items by page views per sliding window."""
    top = _top_counts(_page_views(spark, path, stream, mode), "item_id", k, size, slide, ASCENDING, "hot_items")
    return ops.rank_report(top, "item_id") if report else top


def traffic(spark: SparkSession, path: str, k: int = 5, size="10 minutes", slide="5 seconds",
            delay="1 second", key: str = "url", stream: bool = False, mode: str = "failfast",
            report: bool = False) -> DataFrame:
    """Top ``k`` URLs (or ``key="ip"``) by requests per sliding window,
    logs up to ``delay`` out of order."""
    log = read_access_log(spark, path, mode=mode, stream=stream)
    if mode == "quarantine":
        log = log.where(~F.col("_bad")).drop("_bad", "_line")
    top = _top_counts(log, key, k, size, slide, delay, "traffic")
    if report:
        return ops.rank_report(top, key, key_label=URL_LABEL, count_label=URL_COUNT_LABEL,
                               trailer="\n\n", ruler=URL_RULER)
    return top


def page_views(spark: SparkSession, path: str, size="1 hour", literal: bool = False,
               stream: bool = False, mode: str = "failfast") -> DataFrame:
    """Page views per window; ``literal=True`` reproduces the
    reference's ``sum(0)`` (sum of the user field, other fields of the
    window's first record: of equal times the line that comes first in the
    files)."""
    pv = _page_views(spark, path, stream, mode, position=literal)
    if literal:
        others = ["item_id", "category_id", "behavior", "ts_s"]
        if stream:
            return S.field_sum_stream(pv, "user_id", size, others, delay=ASCENDING, name="page-views").finish()
        return ops.window_field_sum(pv, "user_id", size, others)
    return ops.window_count(pv, size, count_col="pv")


def unique_visitors(spark: SparkSession, path: str, size="1 hour", col: str = "user_id",
                    exact: bool = True, stream: bool = False, mode: str = "failfast") -> DataFrame:
    """Distinct ``col`` (users; the reference counted items) per window."""
    return ops.window_distinct(_page_views(spark, path, stream, mode), col, size, exact=exact,
                               out_col="uv")


def _detected(df: DataFrame, op: Callable[[DataFrame], DataFrame], reach, emit_col: str, name: str) -> DataFrame:
    """``op`` over a batch frame, or over a stream to its end."""
    return S.staged_stream(df, op, reach, emit_col, name=name) if df.isStreaming else op(df)


def login_fail_timer(logins: DataFrame, delay="2 seconds") -> DataFrame:
    """First failure of every timer group with more than one failure."""
    fail = F.col("event_type") == "fail"
    return _detected(with_event_time(_seq(logins), "ts_s", "s"),
                     lambda lg: ops.failure_burst(lg, ["user_id"], fail, delay), delay, "timer_et", "login-timer")


def login_fail_pattern(logins: DataFrame, within="2 seconds") -> DataFrame:
    """Two adjacent failures within ``within``; (user_id, ip, event_type)
    of the second (P3)."""
    fail = F.col("event_type") == "fail"
    hits = _detected(with_event_time(_seq(logins), "ts_s", "s"), lambda lg: ops.adjacent_pair_within(
        lg, ["user_id"], fail, fail, within), within, "et", "login-pattern")
    return hits.select("user_id", "ip", "event_type")


def _orders(orders: DataFrame) -> DataFrame:
    return with_event_time(_seq(orders), "event_time", "s")


def order_timeout_pattern(orders: DataFrame, within="5 seconds") -> dict[str, DataFrame]:
    """``{"timeout": side output, "matched": completed create -> pay}``,
    both from one pass."""
    create, pay = F.col("event_type") == "create", F.col("event_type") == "pay"
    both = _detected(_orders(orders), lambda od: ops.pattern_outcomes(
        od, ["order_id"], create, pay, within), within, "et", "order-pattern")
    timeout = both.where(F.col("status") == "timeout").drop("status", "next_et", "next_seq")
    return {"timeout": timeout, "matched": both.where(F.col("status") == "match").drop("status")}


def order_timeout_timer(orders: DataFrame, delay="5 seconds") -> DataFrame:
    """The single-slot order timer."""
    create = F.col("event_type") == "create"
    return _detected(_orders(orders), lambda od: ops.single_slot_timeout(od, ["order_id"], create, delay),
                     delay, "timer_et", "order-timer")


def two_stream_join(orders: DataFrame, payments: DataFrame, wait=None,
                    gap="1 hour") -> dict[str, DataFrame]:
    """Matched pairs and the unmatched of both sides.

    On streams a key is closed once it has been silent for ``gap``; the
    result equals the batch one if no two neighbouring events of a key are
    that far apart.
    """
    o, p = _orders(orders), with_event_time(_seq(payments), "event_time", "s")
    cols = ["event_type", "event_time"]
    if not o.isStreaming:
        return ops.split_status(ops.reconcile(o, p, ["order_id"], cols, cols, wait=wait))
    end = S.End(o.sparkSession)
    o, p = (end.ending(x).withWatermark("et", ASCENDING) for x in (o, p))
    res = ops.reconcile(o, p, ["order_id"], cols, cols, wait=wait, key_gap=gap)
    return ops.split_status(S.stream_result(res, "two-stream-join", end=end))
