"""User aggregates, sketches and lenient log times."""

import collections
import datetime
import random

import pytest
from pyspark.sql import functions as F

from eventlytics import operators as ops
from eventlytics.operators import aggregates as A
from eventlytics.sources.files import lenient_time, parse_access_log


def table(spark, n=3000, seed=1):
    rnd = random.Random(seed)
    data = [(rnd.choice([None, 0, 0, 0, *range(1, 40)]), rnd.choice([None, *"abc"]), rnd.randrange(10**6)) for _ in range(n)]
    return data, spark.createDataFrame(data, "k INT, kind STRING, t BIGINT")


@pytest.mark.parametrize("fan,most_keys", [(1, 100_000), (16, 100_000), (3, 1)])
def test_user_aggregates_equal_python(spark, fan, most_keys):
    data, df = table(spark)
    times, kinds = collections.defaultdict(list), collections.defaultdict(collections.Counter)
    for k, kind, t in data:
        times[k].append(t)
        kinds[k].update([kind] if kind else [])
    gap = ops.aggregate_by(df.repartition(7), ["k"], ["t"], A.LAST_GAP, "bigint", fan=fan, most_keys=most_keys)
    assert {r["k"]: r["value"] for r in gap.collect()} == {
        k: (sorted(v)[-1] - sorted(v)[-2] if len(v) > 1 else None) for k, v in times.items()}
    mode = ops.aggregate_by(df.repartition(7), ["k"], ["kind"], A.MODE, "string", fan=fan, most_keys=most_keys)
    assert {r["k"]: r["value"] for r in mode.collect()} == {
        k: min(c, key=lambda v: (-c[v], v)) if c else None for k, c in kinds.items()}


def test_no_keys_and_no_rows(spark):
    data, df = table(spark, 100)
    total = ops.Aggregate(int, lambda s, t: s + t, lambda a, b: a + b, lambda s: s)
    assert [r["value"] for r in ops.aggregate_by(df, ["k"], ["t"], total, "bigint").groupBy().sum("value")
            .withColumnRenamed("sum(value)", "value").collect()] == [sum(t for *_, t in data)]
    assert ops.aggregate_by(df.where("false"), ["k"], ["t"], total, "bigint").count() == 0


def test_a_hot_key_leaves_a_task_as_one_row(spark):
    df = spark.range(30_000).select(F.lit(7).alias("k"), F.col("id").alias("t")).repartition(6)
    sent = df.mapInArrow(A._partials(A.LAST_GAP, 1, A.MOST_KEYS), "k int, state binary")
    per_task = sent.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(per_task) == 6 and {r["count"] for r in per_task} == {1}


def test_estimates_stay_in_their_bound(spark):
    rnd = random.Random(3)
    rows = [(rnd.randrange(40_000), rnd.randrange(20_000_000)) for _ in range(60_000)] + [(None, 5), (1, None)]
    df = spark.createDataFrame(rows, "v BIGINT, t BIGINT").withColumn("et", F.timestamp_micros("t"))
    exact = {r["window_end"]: r["d"] for r in ops.window_distinct_sliding(df, "v", 4000, 1000, out_col="d").collect()}
    got = ops.window_distinct_estimate(df, "v", 4000, 1000).select("*", ops.hll_bound(F.col("estimate")).alias("b"))
    assert {r["window_end"] for r in got.collect()} == exact.keys()
    assert all(abs(r["estimate"] - exact[r["window_end"]]) <= r["b"] for r in got.collect())
    seen = collections.defaultdict(set)
    for v, t in rows:
        if v is not None and t is not None:
            seen[t // 4_000_000].add(v)
    for r in ops.window_distinct_both(df, "v", 4000).collect():
        w = r["window_end"] // 4000 - 1
        assert abs(r["estimate"] - len(seen[w] & seen[w - 1])) <= r["bound"]


def test_sketches_leave_a_task_not_values(spark):
    df = spark.range(10).select(F.col("id").alias("v"), F.timestamp_seconds("id").alias("et"))
    plan = ops.window_distinct_estimate(df, "v", 4000, 1000)._jdf.queryExecution().executedPlan().toString()
    assert "partial_hll_sketch_agg" in plan and "partial_hll_union_agg" in plan


@pytest.mark.parametrize("text,want", [
    ("17/05/2015:10:05:03", (2015, 5, 17, 10, 5, 3)), ("32/01/2015:00:00:00", (2015, 2, 1, 0, 0, 0)),
    ("31/02/2015:12:00:00", (2015, 3, 3, 12, 0, 0)), ("31/02/2016:12:00:00", (2016, 3, 2, 12, 0, 0)),
    ("01/01/2015:25:61:61", (2015, 1, 2, 2, 2, 1)), ("00/01/2015:00:00:00", (2014, 12, 31, 0, 0, 0)),
    ("31/14/2015:00:00:00", (2016, 3, 2, 0, 0, 0)), ("1/00/2015:0:0:0", (2014, 12, 1, 0, 0, 0)),
    ("15/99/2015:99:99:99 more", (2023, 3, 19, 4, 40, 39)), ("nothing", None), ("1/2/2015", None), (None, None)])
def test_lenient_times_roll_over(spark, text, want):
    got = spark.createDataFrame([(text,)], "x STRING").select(lenient_time(F.col("x")).alias("t")).head()["t"]
    assert got == (want and datetime.datetime(*want))


def test_lenient_log(spark):
    lines = spark.createDataFrame([("1.1.1.1 - u 32/01/2015:25:00:00 +0000 GET /a",)], "value STRING")
    assert parse_access_log(lines, lenient=True).head()["et"] == datetime.datetime(2015, 2, 2, 1)
    bad = spark.createDataFrame([("1.1.1.1 - u soon +0000 GET /a",)], "value STRING")
    with pytest.raises(Exception, match="bad log time"):
        parse_access_log(bad, lenient=True).collect()
    assert parse_access_log(bad, "quarantine", lenient=True).head()["_bad"] is True
