"""Reconciliation of two streams with unique keys: a stream-stream join (X2s).

If a key occurs once per side, the pairing is a full outer join, and no slot
or consuming is needed: an order and its payment meet if the payment follows
within ``wait``. Both watermarks and that time range bound the join's state: a
row is kept until the other side cannot bring its partner any more, and is
then reported unmatched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlytics.operators.durations import spark_interval
from eventlytics.operators.reconcile import MATCHED, UNMATCHED_ORDER, UNMATCHED_PAYMENT


def reconcile_unique(orders: DataFrame, payments: DataFrame, key: str, order_cols: Sequence[str],
                     payment_cols: Sequence[str], wait, delay="1 millisecond", time_col: str = "et") -> DataFrame:
    """``key, status, o_<cols>, o_et, p_<cols>, p_et`` of two frames, both
    batch or both streams, in which ``key`` is unique (and not null). A
    payment pairs with an order that is at most ``wait`` older, not younger.
    On streams each side's rows may be ``delay`` out of order."""
    def side(df, name, cols):
        if df.isStreaming:
            df = df.withWatermark(time_col, spark_interval(delay))
        return df.select(F.col(key).alias(f"_{name}"), F.col(time_col).alias(f"{name}_et"),
                         *[F.col(c).alias(f"{name}_{c}") for c in cols])

    o, p = side(orders, "o", order_cols), side(payments, "p", payment_cols)
    near = (F.col("p_et") >= F.col("o_et")) & (F.col("p_et") <= F.col("o_et") + F.expr(
        f"interval '{spark_interval(wait)}'"))
    j = o.join(p, (F.col("_o") == F.col("_p")) & near, "full_outer")
    status = F.when(F.col("_p").isNull(), UNMATCHED_ORDER).when(F.col("_o").isNull(), UNMATCHED_PAYMENT).otherwise(MATCHED)
    return j.select(F.coalesce("_o", "_p").alias(key), status.alias("status"), *[f"o_{c}" for c in order_cols], "o_et",
                    *[f"p_{c}" for c in payment_cols], "p_et")
