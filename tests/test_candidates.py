"""Top-k by candidates against the full count, whatever the sketches prove."""

import random

import pytest
from pyspark.sql import functions as F

from eventlytics import operators as ops
from eventlytics.operators import candidates as C



MINUTE = 60


def _events(spark, n=3000, keys=400, seed=3):
    """A few keys hold most rows; many hold one or two; some are null."""
    r = random.Random(seed)
    out = [(int(keys * r.random() ** 4) if r.random() > 0.02 else None, r.randrange(0, 40 * MINUTE)) for _ in range(n)]
    out += [(7, None), (None, None)]  # no event time: left out
    return spark.createDataFrame(out, "item_id bigint, s bigint").select("item_id", F.timestamp_seconds("s").alias("et"))


def _full(df, k):
    counts = ops.windowed_count(df.where("et IS NOT NULL"), ["item_id"], "10 minutes", "5 minutes")
    return ops.top_k_per_window(counts, "item_id", k)


def _sorted(df):
    return sorted(((r["window_end"], r["rank"], r["cnt"], r["item_id"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("tracked, listed, most", [
    (10_000, 500, 500_000),  # the sketches hold every key: all windows proven
    (300, 12, 500_000),      # full lists: ties at their end are counted the full way
    (12, 8, 500_000),        # saturated sketches: hardly a window proven
    (10_000, 500, 3),        # too many candidates to broadcast
])
def test_same_rows_as_the_full_count(spark, tracked, listed, most):
    df = _events(spark)
    got = ops.top_k_by_candidates(df, "item_id", 5, "10 minutes", "5 minutes", tracked=tracked,
                                  candidates=listed, most_broadcast=most)
    assert _sorted(got) == _sorted(_full(df, 5))


def test_bound_holds_for_every_key_outside_the_list(spark):
    df = _events(spark).where("et IS NOT NULL")
    counts = ops.windowed_count(df, ["item_id"], "10 minutes", "5 minutes")
    counts = counts.withColumn("window", F.floor(F.col("window_end") / 300_000))
    for tracked, listed in ((300, 12), (12, 8)):
        found = ops.window_candidates(df, "item_id", "10 minutes", "5 minutes", tracked=tracked, candidates=listed)
        outside = counts.join(found, "window").where("NOT exists(listed, x -> x <=> item_id)")
        assert outside.count() and outside.where("cnt > bound").count() == 0


def test_plan_sends_sketches_and_candidates(spark):
    df = _events(spark)
    plan = C.window_candidates(df, "item_id", "10 minutes", "5 minutes")._jdf.queryExecution().executedPlan().toString()
    assert "partial_approx_top_k_accumulate" in plan and "partial_approx_top_k_combine" in plan


def test_few_keys_and_no_rows(spark):
    df = _events(spark, n=6, keys=2)
    assert _sorted(ops.top_k_by_candidates(df, "item_id", 5, "10 minutes", "5 minutes")) == _sorted(_full(df, 5))
    assert ops.top_k_by_candidates(df.limit(0), "item_id", 5, "10 minutes", "5 minutes").count() == 0
    with pytest.raises(ValueError):
        ops.top_k_by_candidates(df, "item_id", 5, "10 minutes", "3 minutes")
