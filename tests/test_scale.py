"""Plan-shape and skew properties the operators rely on at scale."""

import random
import re

from pyspark.sql import functions as F

from eventlytics import operators as ops
from eventlytics.operators.sequence import default_chunk_us

from test_random_machines import D, SCHEMA, burst_machine, adjacent_machine, slot_machine
from conftest import rows


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _hot_key_events(n=900, seed=1):
    """Key 0 holds a third of all rows, spread over many chunk widths."""
    rnd = random.Random(seed)
    out, t = [], 0
    for i in range(n):
        t += rnd.choice([0, 1, D - 1, D, D + 1, D // 3])
        k = 0 if i % 3 == 0 else rnd.randrange(1, 40)
        out.append((k, rnd.choice("aab"), t))
    return out


def test_hot_key_is_split_by_time_and_stays_exact(spark):
    evs = _hot_key_events()
    df = spark.createDataFrame([e + (i,) for i, e in enumerate(evs)], SCHEMA + ", seq BIGINT") \
        .withColumn("et", F.timestamp_micros("t")).cache()
    chunk = 4 * D
    chunks = df.where("k = 0").select(F.floor(F.col("t") / chunk)).distinct().count()
    assert chunks > 10  # the hot key's rows land in many (key, chunk) partitions
    a = F.col("typ") == "a"
    burst = ops.failure_burst(df, ["k"], a, D // 1000, chunk_us=chunk)
    assert "_chunk" in _plan(burst)
    assert sorted((r.k, r.seq) for r in burst.collect()) == burst_machine(evs)
    slot = ops.single_slot_timeout(df, ["k"], a, D // 1000, chunk_us=chunk)
    assert sorted((r.k, r.seq) for r in slot.collect()) == slot_machine(evs)
    adj = ops.adjacent_pair_within(df, ["k"], a, a, D // 1000, chunk_us=chunk)
    assert sorted((r.k, r.seq) for r in adj.collect()) == adjacent_machine(evs)


def test_window_functions_partition_by_key_and_chunk(spark):
    df = spark.createDataFrame([(1, "a", 1, 0)], SCHEMA + ", seq BIGINT") \
        .withColumn("et", F.timestamp_micros("t"))
    a = F.col("typ") == "a"
    for out in (ops.failure_burst(df, ["k"], a, "2 seconds"),
                ops.pattern_timeout(df, ["k"], a, a, "2 seconds"),
                ops.adjacent_pair_within(df, ["k"], a, a, "2 seconds")):
        assert re.search(r"hashpartitioning\(k#\d+L?, _chunk#", _plan(out))
    assert default_chunk_us(2_000_000) == 3_600_000_000


def test_pane_counts_shuffle_pane_rows_not_window_copies(spark):
    # not spark.range: Spark 4.1's codegen of a 120-way Expand over a Range
    # source fails (IllegalAccessError on partitionIndex); files are fine
    df = spark.createDataFrame([(i % 7, i * 3) for i in range(1000)], "u BIGINT, s BIGINT") \
        .select("u", F.timestamp_seconds("s").alias("et"))
    pane = ops.windowed_count(df, ["u"], "10 minutes", "5 seconds")
    plan = _plan(pane)
    assert "Expand" not in plan and "REPARTITION_BY_NUM" in plan
    direct = ops.windowed_count(df, ["u"], "10 minutes", "5 seconds", method="direct")
    assert "Expand" in _plan(direct)
    assert rows(pane) == rows(direct)


def test_top_k_limits_before_the_exchange(spark):
    df = spark.range(1000).select((F.col("id") % 13).alias("u"),
                                  F.timestamp_seconds(F.col("id") * 7).alias("et"))
    top = ops.top_k_per_window(ops.windowed_count(df, ["u"], "1 hour", "5 minutes"), "u", 3)
    plan = _plan(top)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_reconcile_is_one_aggregation_without_join(spark):
    o = spark.range(100).select((F.col("id") % 5).alias("k"), F.lit("create").alias("e"),
                                F.timestamp_seconds("id").alias("et"), F.col("id").alias("seq"))
    p = o.withColumn("e", F.lit("pay"))
    res = ops.reconcile(o, p, ["k"], ["e"], ["e"])
    assert res.count() == 5  # five keys, one matched row each, whatever the fan-in
    plan = _plan(res)
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_a_hot_key_within_two_gaps_is_spread(spark):
    """A third of all rows belong to one key and lie within two gaps."""
    rnd = random.Random(4)
    evs = sorted([(0, rnd.choice("aab"), rnd.randrange(2 * D)) for _ in range(300)]
                 + [(rnd.randrange(1, 50), rnd.choice("aab"), rnd.randrange(40 * D)) for _ in range(600)],
                 key=lambda e: e[2])
    df = spark.createDataFrame([e + (i,) for i, e in enumerate(evs)], SCHEMA + ", seq BIGINT") \
        .withColumn("et", F.timestamp_micros("t")).cache()
    chunk = D // 16
    assert df.where("k = 0").select(F.floor(F.col("t") / chunk)).distinct().count() == 32
    a = F.col("typ") == "a"
    for width in (chunk, D // 3, D - 1):
        burst = ops.failure_burst(df, ["k"], a, D // 1000, chunk_us=width)
        assert sorted((r.k, r.seq) for r in burst.collect()) == burst_machine(evs)
        slot = ops.single_slot_timeout(df, ["k"], a, D // 1000, chunk_us=width)
        assert sorted((r.k, r.seq) for r in slot.collect()) == slot_machine(evs)
        adj = ops.adjacent_pair_within(df, ["k"], a, a, D // 1000, chunk_us=width)
        assert sorted((r.k, r.seq) for r in adj.collect()) == adjacent_machine(evs)
        whole = rows(ops.pattern_outcomes(df, ["k"], a, ~a, D // 1000), "k", "seq", "status")
        assert rows(ops.pattern_outcomes(df, ["k"], a, ~a, D // 1000, chunk_us=width), "k", "seq", "status") == whole
