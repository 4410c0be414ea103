"""Consuming reconciliation (X2): a key can pair many times.

Each key holds at most one event. An event of the other side that arrives
while one is held (and, with ``wait``, at most that much later) pairs with it
and both are gone; any other event takes its place. So an event can only pair
with the one right before or right after it in its key: call two neighbours
*linked* if their sides differ and their times are close enough; then, along a
run of consecutive links, the first pairs, the second cannot (its event is
gone), the third does, and so on. An event pairs backwards exactly if it ends
an odd number of consecutive links.

That number is a composition of two kinds of maps, "one more" and "none", so
it splits: a key is cut into time chunks; a chunk is summarised by its first
and last event, its number of events and the links at its end (if all its
events are linked, the count goes on from the chunk before); a scan over the
key's chunks carries the count and the neighbours over; and a window within
the chunk replays it. A key with a third of all rows spreads over its chunks;
nothing is joined and no row is touched in Python.

Output: ``*keys, status, o_<cols>, o_et, p_<cols>, p_et``; the status is
``matched``, ``unmatched_order`` or ``unmatched_payment`` (nothing paired with
the event in time), or ``replaced_order`` / ``replaced_payment`` (an event of
its own side took its place while it was held).

Defined cases: events are ordered by time, ``seq``, and orders before
payments; rows without an event time are left out; rows without a key are the
events of one key of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlytics.operators.durations import to_us
from eventlytics.operators.reconcile import MATCHED, UNMATCHED_ORDER, UNMATCHED_PAYMENT, tag_sides
from eventlytics.operators.sequence import chunk_of

REPLACED_ORDER, REPLACED_PAYMENT = "replaced_order", "replaced_payment"


def reconcile_consuming(orders: DataFrame, payments: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
                        payment_cols: Sequence[str], wait=None, time_col: str = "et", seq_col: str = "seq",
                        chunk="1 day") -> DataFrame:
    """See the module. ``wait`` (inclusive) is how long an event is held;
    without it, until another event of its key. ``chunk``: width of the time
    chunks of a key."""
    if orders.isStreaming or payments.isStreaming:
        raise ValueError("use eventlytics.streaming.staged_stream over the tagged union for streams")
    keys = list(keys)
    wait_us = None if wait is None else to_us(wait)
    payload = [f"o_{c}" for c in order_cols] + [f"p_{c}" for c in payment_cols]
    rows = tag_sides(orders, payments, keys, order_cols, payment_cols, time_col, seq_col)
    rows = rows.select(*keys, F.unix_micros(F.col(time_col)).alias("_t"), F.col(seq_col).alias("_s"),
                       F.when(F.col("_is_order"), 0).otherwise(1).alias("_side"), *payload)
    rows = rows.withColumn("_chunk", chunk_of(F.col("_t"), to_us(chunk)))
    order = ["_t", "_s", "_side"]

    def linked(before: Column, after: Column) -> Column:
        ok = before["_side"] != after["_side"]
        if wait_us is not None:
            ok = ok & (after["_t"] - before["_t"] <= wait_us)
        return F.coalesce(ok, F.lit(False))

    event = F.struct(*order, *payload)
    in_chunk = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    first_pass = rows.select(*keys, "_chunk", event.alias("_e"), F.lag(F.struct("_t", "_side")).over(in_chunk).alias("_b"),
                             F.row_number().over(in_chunk).alias("_rn"))
    broken = F.when(~linked(F.col("_b"), F.col("_e")), F.col("_rn"))
    by_order = F.struct(*[F.col(f"_e.{c}") for c in order])
    chunks = first_pass.groupBy(*keys, "_chunk").agg(
        F.count(F.lit(1)).alias("_n"), F.max(broken).alias("_break"), F.min_by("_e", by_order).alias("_first"),
        F.max_by("_e", by_order).alias("_last"))
    along = Window.partitionBy(*keys).orderBy("_chunk")
    chunks = chunks.select("*", F.lag("_last").over(along).alias("_prev"), F.lead("_first").over(along).alias("_next"))
    goes_on = linked(F.col("_prev"), F.col("_first")) & (F.col("_break") == 1)
    chunks = chunks.withColumn("_starts", (~goes_on).cast("int"))
    chunks = chunks.withColumn("_stretch", F.sum("_starts").over(along))
    links = F.when(F.col("_starts") == 1, F.col("_n") - F.col("_break")).otherwise(F.col("_n"))
    chunks = chunks.withColumn("_links", F.sum(links).over(Window.partitionBy(*keys, "_stretch").orderBy("_chunk")))
    chunks = chunks.withColumn("_links", F.lag("_links").over(along))

    def neighbour(col: str, kind: int) -> DataFrame:
        fields = [F.col(f"{col}.{c}").alias(c) for c in order + payload]
        carried = F.col("_links") if kind == 0 else F.lit(None).cast("bigint")
        return chunks.where(F.col(col).isNotNull()).select(
            *keys, *fields, "_chunk", F.lit(kind).alias("_kind"), carried.alias("_links"))

    own = rows.select("*", F.lit(1).alias("_kind"), F.lit(None).cast("bigint").alias("_links"))
    whole = own.unionByName(neighbour("_prev", 0)).unionByName(neighbour("_next", 2))
    w = Window.partitionBy(*keys, "_chunk").orderBy("_kind", *order)
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = whole.select(*keys, "_chunk", "_kind", *order, event.alias("_e"), F.lag(event).over(w).alias("_before"),
                         F.lead(F.struct("_t", "_side")).over(w).alias("_after"),
                         F.sum((F.col("_kind") == 1).cast("int")).over(so_far).alias("_rn"),
                         F.max("_links").over(so_far).alias("_carried"))
    whole = whole.withColumn("_linked", linked(F.col("_before"), F.col("_e")))
    last_break = F.max(F.when((F.col("_kind") == 1) & ~F.col("_linked"), F.col("_rn"))).over(so_far)
    run = F.coalesce(F.col("_rn") - last_break, F.coalesce("_carried", F.lit(0)) + F.col("_rn"))
    whole = whole.withColumn("_odd", run % 2 == 1).where(F.col("_kind") == 1)
    is_order = F.col("_e._side") == 0
    held = F.lit(True) if wait_us is None else F.col("_after._t") - F.col("_e._t") <= wait_us
    replaced = F.coalesce((F.col("_after._side") == F.col("_e._side")) & held, F.lit(False))
    status = (F.when(F.col("_odd"), F.lit(MATCHED))
              .when(linked(F.col("_e"), F.col("_after")), F.lit(None))  # pairs with the next one
              .when(replaced, F.when(is_order, REPLACED_ORDER).otherwise(REPLACED_PAYMENT))
              .otherwise(F.when(is_order, UNMATCHED_ORDER).otherwise(UNMATCHED_PAYMENT)))
    out = whole.withColumn("status", status).where(F.col("status").isNotNull())
    matched = F.col("status") == MATCHED

    def of(side: Column, name: str) -> Column:
        return F.when(side, F.col(f"_e.{name}")).when(matched, F.col(f"_before.{name}"))

    return out.select(*keys, "status", *[of(is_order, f"o_{c}").alias(f"o_{c}") for c in order_cols],
                      F.timestamp_micros(of(is_order, "_t")).alias("o_et"),
                      *[of(~is_order, f"p_{c}").alias(f"p_{c}") for c in payment_cols],
                      F.timestamp_micros(of(~is_order, "_t")).alias("p_et"))
