"""One-to-one reconciliation of two keyed event streams.

Each side keeps one slot per key and a later event overwrites it, so the
result is defined on the *latest* event per key and side: the two latest
events of a key pair up (optionally only when the payment follows the order
by at most ``wait``); a key present on one side only, or whose pair fails
the ``wait`` test, reports each present side as unmatched.

Output: one frame with a ``status`` column -- ``matched``,
``unmatched_order`` or ``unmatched_payment`` -- the side outputs of the
reference as a tag; :func:`split_status` gives the three frames.

Plan: the two sides are tagged and unioned, and one aggregation per key
takes the latest event of each side (``max_by`` with the other side's rows
ordered as NULL). It aggregates partially before its one shuffle, so a hot
key costs one row per map task, and there is no join: the "full outer"
pairing is the aggregation itself, and no key can fan out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlytics.operators.durations import spark_interval, to_us

MATCHED, UNMATCHED_ORDER, UNMATCHED_PAYMENT = "matched", "unmatched_order", "unmatched_payment"


def reconcile(orders: DataFrame, payments: DataFrame, keys: Sequence[str],
              order_cols: Sequence[str], payment_cols: Sequence[str], wait=None,
              order_filter=None, time_col: str = "et", seq_col: str = "seq",
              key_window=None, key_gap=None) -> DataFrame:
    """Columns: ``*keys, status, o_<order_cols>, o_et, p_<payment_cols>, p_et``.

    ``key_window``: for streams whose key is tied to a tumbling event-time
    window (e.g. a key per day), the window size. ``key_gap``: for other
    streams, how long a key must be silent before it is closed (a session
    window). See :func:`reconcile_windowed`.
    """
    if order_filter is not None:
        orders = orders.where(order_filter)
    if key_window is None and key_gap is None and (orders.isStreaming or payments.isStreaming):
        raise ValueError("streams need key_window or key_gap")
    return reconcile_windowed(orders, payments, keys, order_cols, payment_cols, key_window,
                              wait, time_col, seq_col, key_gap)


def reconcile_windowed(orders: DataFrame, payments: DataFrame, keys: Sequence[str],
                       order_cols: Sequence[str], payment_cols: Sequence[str], key_window=None,
                       wait=None, time_col: str = "et", seq_col: str = "seq", key_gap=None) -> DataFrame:
    """Both sides in one aggregation over their tagged union: ``max_by`` per
    side and key (and, with ``key_window``, per tumbling window of that
    size, which lets it run as an append-mode stream: a key's outputs appear
    once the watermark closes its window; equal to the plain form when every
    key lies in one window, e.g. a key per day with ``"1 day"``).
    One shuffle, partial aggregation before it, no join."""
    tagged = tag_sides(orders, payments, keys, order_cols, payment_cols, time_col, seq_col)
    group = list(keys)
    if key_window is not None:
        group.append(F.window(time_col, spark_interval(key_window)).alias("_w"))
    elif key_gap is not None:
        group.append(F.session_window(time_col, spark_interval(key_gap)).alias("_w"))
    agg = latest_of_sides(tagged, group, order_cols, payment_cols, time_col, seq_col)
    return statuses(agg, keys, order_cols, payment_cols, wait)


def tag_sides(orders: DataFrame, payments: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
              payment_cols: Sequence[str], time_col: str = "et", seq_col: str = "seq") -> DataFrame:
    """Both sides in one frame: keys, time, seq, ``_is_order``, ``o_*`` and
    ``p_*`` (null for the other side). Rows without an event time are left
    out, as on a stream."""
    def side(df, is_order, cols, null_cols, null_df):
        own = [F.col(c).alias(f"{'o' if is_order else 'p'}_{c}") for c in cols]
        other = [F.lit(None).cast(null_df.schema[c].dataType).alias(f"{'p' if is_order else 'o'}_{c}")
                 for c in null_cols]
        return df.where(F.col(time_col).isNotNull()).select(
            *keys, time_col, seq_col, F.lit(is_order).alias("_is_order"), *own, *other)

    return side(orders, True, order_cols, payment_cols, payments).unionByName(
        side(payments, False, payment_cols, order_cols, orders))


def latest_of_sides(tagged: DataFrame, group: list, order_cols: Sequence[str], payment_cols: Sequence[str],
                    time_col: str = "et", seq_col: str = "seq") -> DataFrame:
    """``_o`` and ``_p``: the latest event of each side per group."""
    def latest(prefix, cols, mine):
        payload = F.struct(*[F.col(f"{prefix}_{c}").alias(c) for c in cols], F.col(time_col).alias("_et"),
                           F.col(seq_col).alias("_seq"))
        return F.max_by(payload, F.when(mine, F.struct(time_col, seq_col))).alias(f"_{prefix}")

    is_order = F.col("_is_order")
    return tagged.groupBy(*group).agg(latest("o", order_cols, is_order), latest("p", payment_cols, ~is_order))


def merge_latest(parts: DataFrame, group: list) -> DataFrame:
    """The latest of partial results of :func:`latest_of_sides`."""
    pick = lambda c: F.when(F.col(c).isNotNull(), F.struct(f"{c}._et", f"{c}._seq"))
    return parts.groupBy(*group).agg(*[F.max_by(c, pick(c)).alias(c) for c in ("_o", "_p")])


def statuses(j: DataFrame, keys, order_cols, payment_cols, wait) -> DataFrame:
    both = F.col("_o").isNotNull() & F.col("_p").isNotNull()
    if wait is not None:
        gap = F.unix_micros(F.col("_p._et")) - F.unix_micros(F.col("_o._et"))
        both = both & gap.between(0, to_us(wait))
    statuses = (F.when(both, F.array(F.lit(MATCHED)))
                .otherwise(F.filter(F.array(
                    F.when(F.col("_o").isNotNull(), F.lit(UNMATCHED_ORDER)),
                    F.when(F.col("_p").isNotNull(), F.lit(UNMATCHED_PAYMENT))),
                    lambda s: s.isNotNull())))
    j = j.select(*keys, "_o", "_p", F.explode(statuses).alias("status"))
    keep_o = F.col("status") != UNMATCHED_PAYMENT
    keep_p = F.col("status") != UNMATCHED_ORDER
    o_cols = [F.when(keep_o, F.col(f"_o.{c}")).alias(f"o_{c}") for c in order_cols]
    p_cols = [F.when(keep_p, F.col(f"_p.{c}")).alias(f"p_{c}") for c in payment_cols]
    return j.select(*keys, "status", *o_cols, F.when(keep_o, F.col("_o._et")).alias("o_et"),
                    *p_cols, F.when(keep_p, F.col("_p._et")).alias("p_et"))


def split_status(result: DataFrame) -> dict[str, DataFrame]:
    """``{status: rows}`` for the three outputs (side outputs S6)."""
    return {s: result.where(F.col("status") == s)
            for s in (MATCHED, UNMATCHED_ORDER, UNMATCHED_PAYMENT)}
