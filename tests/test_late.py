"""Late rows by arrival order against a row-by-row watermark."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from eventlytics import operators as ops
from conftest import rows

SCHEMA = "arrival BIGINT, seq BIGINT, k BIGINT, t BIGINT"


def disordered(seed, n=400):
    rnd, out, t = random.Random(seed), [], 0
    for i in range(n):
        t += rnd.choice([0, 1, 300_000, 700_000])
        out.append((i // 3, i, rnd.randrange(3), None if i % 50 == 7 else t - rnd.choice([0, 0, 0, 1, 2_000_000, 9_000_000])))
    return out


def machine(evs, size, slide, delay):
    """(late rows, counted, dropped) by the reference's rule, row by row."""
    seen, late, counted, dropped = None, [], collections.Counter(), collections.Counter()
    for arrival, seq, k, t in sorted(evs, key=lambda e: e[:2]):
        if t is None:
            continue
        ends = [(t // slide + j) * slide for j in range(1, size // slide + 1)]
        closed = [e for e in ends if seen is not None and e <= seen - delay]
        if len(closed) == len(ends):
            late.append(seq)
        for e in ends:
            (dropped if e in closed else counted)[k, e // 1000] += 1
        seen = t if seen is None else max(seen, t)
    return late, {x: (counted[x], dropped[x]) for x in counted | dropped}


@pytest.mark.parametrize("slide_ms,delay_ms,blocks", [(4000, 0, 1), (4000, 0, 7), (1000, 1500, 5), (2000, 0, 64)])
def test_late_rows_equal_the_machine(spark, slide_ms, delay_ms, blocks):
    evs = disordered(blocks)
    df = spark.createDataFrame(evs, SCHEMA).withColumn("et", F.timestamp_micros("t")).repartition(5)
    late, windows = machine(evs, 4_000_000, slide_ms * 1000, delay_ms * 1000)
    got = ops.late_rows(df, ["arrival", "seq"], 4000, slide_ms, delay_ms, blocks=blocks)
    assert sorted(r["seq"] for r in got.collect()) == sorted(late) and late
    counts = ops.window_count_with_late(df, ["arrival", "seq"], 4000, slide_ms, delay_ms, ["k"], blocks=blocks)
    assert {(r["k"], r["window_end"]): (r["cnt"], r["late"]) for r in counts.collect()} == windows


def test_equal_arrivals_are_spread_over_blocks(spark):
    """A third of all rows arrive at one instant: blocks stay even, as ties
    are told apart by the second arrival column."""
    evs = [(0 if i % 3 else i, i, 0, i * 1000) for i in range(6000)]
    df = spark.createDataFrame(evs, SCHEMA).withColumn("et", F.timestamp_micros("t"))
    out = ops.with_seen_before(df, ["arrival", "seq"], blocks=8)
    sizes = [r["count"] for r in df.repartitionByRange(8, "arrival", "seq").groupBy(
        F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 6000 / 8
    seen, want = None, {}
    for arrival, seq, _, t in sorted(evs, key=lambda e: e[:2]):
        want[seq] = seen
        seen = t if seen is None else max(seen, t)
    got = {r["seq"]: r["s"] for r in out.select("seq", F.unix_micros("seen_et").alias("s")).collect()}
    assert got == want


def test_nothing_arrives(spark):
    df = spark.createDataFrame([], SCHEMA).withColumn("et", F.timestamp_micros("t"))
    assert ops.late_rows(df, ["arrival"], 1000).count() == 0
    assert ops.window_count_with_late(df, ["arrival"], 1000).count() == 0


def test_block_scan_sees_one_row_per_block(spark):
    df = spark.createDataFrame(disordered(1), SCHEMA).withColumn("et", F.timestamp_micros("t"))
    plan = ops.with_seen_before(df, ["arrival", "seq"], blocks=4)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan
    # what goes to a single task is the aggregated maxima
    single = plan[plan.index("Exchange SinglePartition"):]
    assert "HashAggregate" in single.split("\n")[1]


def naive_distinct(evs, size, slide):
    users = collections.defaultdict(set)
    for user, t in evs:
        if user is not None and t is not None:
            for j in range(1, size // slide + 1):
                users[(t // slide + j) * slide // 1000].add(user)
    return {e: len(u) for e, u in users.items()}


@pytest.mark.parametrize("slide_ms", [250, 1000, 4000])
def test_sliding_distinct_equals_sets(spark, slide_ms):
    rnd = random.Random(slide_ms)
    evs = [(rnd.choice([0, 0, 0, *range(1, 15), None]), rnd.choice([None] + [rnd.randrange(60_000_000)] * 30))
           for _ in range(500)]
    df = spark.createDataFrame(evs, "user_id BIGINT, t BIGINT").withColumn("et", F.timestamp_micros("t"))
    got = ops.window_distinct_sliding(df, "user_id", 4000, slide_ms, out_col="uv")
    assert {r["window_end"]: r["uv"] for r in got.collect()} == naive_distinct(evs, 4_000_000, slide_ms * 1000)
    assert rows(ops.window_distinct_sliding(df.where("false"), "user_id", 4000, slide_ms)) == []
