"""A bounded stream that ends, gets more input and ends again gives the batch
rows; batch and stream agree on ties, null times and schemas."""

import random

import pytest
from pyspark.sql import functions as F

from eventlytics import operators as ops
from eventlytics import streaming as S
from eventlytics.plans import jobs
from eventlytics.session import child_names, scratch_path

SCHEMA = "k STRING, seq BIGINT, t BIGINT, v BIGINT"
SIZE, SLIDE = "10 seconds", "2 seconds"


def events(n=240, seed=2):
    rnd, out, t = random.Random(seed), [], 0
    for i in range(n):
        t += rnd.choice([0, 1, 400_000, 1_000_000, 9_000_000])
        out.append((rnd.choice("aab") + str(rnd.randrange(3)), i, t, rnd.randrange(20)))
    return out


def timed(df):
    return df.withColumn("et", F.timestamp_micros("t"))


def add(spark, folder, part):
    spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def flat(df, *cols):
    return sorted((tuple(r[c] for c in cols or df.columns) for r in df.collect()), key=str)


def batch_of(spark, evs, kind):
    df = timed(spark.createDataFrame(evs, SCHEMA))
    if kind == "count":
        return ops.windowed_count(df, ["k"], SIZE, SLIDE)
    if kind == "tumbling":
        return ops.windowed_count(df, ["k"], SIZE)
    if kind == "top":
        return ops.top_k_per_window(ops.windowed_count(df, ["v"], SIZE, SLIDE), "v", 3)
    if kind == "distinct":
        return ops.window_distinct(df, "v", SIZE, out_col="d")
    if kind == "sum":
        return ops.window_field_sum(df, "v", SIZE, ["k", "t"])
    if kind == "pair":
        return ops.adjacent_pair_within(df, ["k"], F.col("v") > 5, F.col("v") > 3, "5 seconds")
    even, w = F.col("v") % 2 == 0, (F.floor(F.col("t") / 10_000_000)).alias("w")
    return ops.reconcile(df.where(even).select("*", w), df.where(~even).select("*", w), ["k", "w"], ["v"], ["v"])


def staged_of(st, kind, **run):
    if kind == "count":
        return S.count_stream(st, ["k"], SIZE, SLIDE, delay="1 minute", **run)
    if kind == "tumbling":
        return S.count_stream(st, ["k"], SIZE, delay="1 minute", **run)
    if kind == "top":
        return S.count_stream(st, ["v"], SIZE, SLIDE, ("v", 3), delay="1 minute", **run)
    if kind == "distinct":
        return S.distinct_stream(st, "v", SIZE, "d", delay="1 minute", **run)
    if kind == "sum":
        return S.field_sum_stream(st, "v", SIZE, ["k", "t"], delay="1 minute", **run)
    if kind == "pair":
        return S.StagedStream(st, lambda df: ops.adjacent_pair_within(
            df, ["k"], F.col("v") > 5, F.col("v") > 3, "5 seconds"), "5 seconds", "et", delay="1 minute",
            chunk="5 seconds", **run)
    even, w = F.col("v") % 2 == 0, (F.floor(F.col("t") / 10_000_000)).alias("w")
    return S.reconcile_stream(st.where(even).select("*", w), st.where(~even).select("*", w), ["k", "w"], ["v"], ["v"],
                              SIZE, delay="1 minute", **run)


@pytest.mark.parametrize("kind", ["count", "tumbling", "top", "distinct", "sum", "pair", "reconcile"])
def test_finish_add_files_finish_again(spark, kind):
    evs = events()
    rnd = random.Random(9)
    shuffled = sorted(evs, key=lambda e: e[2] + rnd.randrange(50_000_000))  # within the delay
    folder = scratch_path(spark, "again-in")
    run = {"path": scratch_path(spark, "again-out"), "checkpoint": scratch_path(spark, "again-ckpt")}
    for cut in ((0, 80), (80, 81), (81, 200), (200, 240)):
        add(spark, folder, shuffled[slice(*cut)])
        st = timed(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder))
        want = batch_of(spark, shuffled[:cut[1]], kind)
        if cut == (81, 200):  # some stretches are emitted for good in between
            staged_of(st, kind, **run).start(availableNow=True).awaitTermination()
        got = staged_of(st, kind, **run).finish()
        assert flat(got, *want.columns) == flat(want)


def test_windows_of_many_small_batches(spark):
    evs = events(200, 5)
    folder = scratch_path(spark, "small-in")
    for i in range(0, 200, 20):
        add(spark, folder, evs[i:i + 20])
    st = timed(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder))
    staged = S.StagedStream(st, lambda df: df.groupBy("k").agg(F.max("et").alias("et")), "1 second", "et",
                            chunk="10 seconds")
    staged.start(availableNow=True).awaitTermination()
    # states and staged batches do not pile up
    assert len(child_names(spark, f"{staged.path}/state")) <= 3
    assert len(child_names(spark, f"{staged.path}/stage", "batch=*")) < 10


def test_late_row_counts_in_its_open_windows(spark):
    """A row behind the emitted stretch still counts in windows that are open."""
    rows = [[("a", 0, 0, 1)], [("a", 1, 99_000_000, 1)], [("a", 2, 79_000_000, 1)]]
    folder = scratch_path(spark, "open-in")
    for part in rows:
        add(spark, folder, part)
    st = timed(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder))
    staged = S.count_stream(st, ["k"], "40 seconds", "10 seconds", delay="10 seconds")
    staged.chunk = 10_000_000
    staged.start(availableNow=True).awaitTermination()
    got = {r["window_end"] // 1000: r["cnt"] for r in staged.finish().collect()}
    assert got == {10: 1, 20: 1, 30: 1, 40: 1, 90: 1, 100: 2, 110: 2, 120: 1, 130: 1}


def test_a_run_at_its_end_is_not_resumed(spark):
    folder, path, checkpoint = (scratch_path(spark, f"ended-{x}") for x in "ioc")
    add(spark, folder, events(30))

    def run():
        end = S.End(spark)
        st = end.ending(timed(spark.readStream.schema(SCHEMA).parquet(folder))).withWatermark("et", "1 second")
        return S.stream_result(ops.windowed_count(st, ["k"], SIZE), "ended", end, path=path, checkpoint=checkpoint)

    assert flat(run()) == flat(batch_of(spark, events(30), "tumbling"))
    with pytest.raises(RuntimeError, match="brought to its end"):
        run()


LOGINS = "user_id BIGINT, ip STRING, event_type STRING, ts_s BIGINT"
ORDERS = "order_id STRING, event_type STRING, event_time STRING"


def _tied_logins():
    out = []
    for u in range(60):  # equal times; no arrival order is given
        out += [(u, "a", "fail", 100 + u), (u, "b", "success", 100 + u), (u, "c", "fail", 101 + u)]
    return out + [(u, "z", "fail", None) for u in range(5)]


def _stream_of(spark, rows, schema):
    folder = scratch_path(spark, "tied-in")
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(folder)
    return spark.readStream.schema(schema).parquet(folder)


@pytest.mark.parametrize("job", [jobs.login_fail_timer, jobs.login_fail_pattern])
def test_logins_agree_in_batch_and_stream(spark, job):
    batch = job(spark.createDataFrame(_tied_logins(), LOGINS))
    stream = job(_stream_of(spark, _tied_logins(), LOGINS))
    assert [(f.name, f.dataType) for f in stream.schema] == [(f.name, f.dataType) for f in batch.schema]
    assert flat(stream) == flat(batch) and flat(batch)


def test_orders_agree_in_batch_and_stream(spark):
    rows = []
    for k in range(60):
        rows += [(str(k), "create", str(100 + k)), (str(k), "pay", str(100 + k)), (str(k), "create", str(102 + k)),
                 (str(k), "pay", str(102 + k + k % 9))]
    rows += [("7", "create", None), (None, "create", "100"), (None, None, None)]
    for job in (jobs.order_timeout_pattern, lambda df: {"slot": jobs.order_timeout_timer(df)}):
        batch, stream = job(spark.createDataFrame(rows, ORDERS)), job(_stream_of(spark, rows, ORDERS))
        assert batch.keys() == stream.keys()
        for side, want in batch.items():
            assert [(f.name, f.dataType) for f in stream[side].schema] == [(f.name, f.dataType) for f in want.schema]
            assert flat(stream[side]) == flat(want)
    orders, pays = rows, [(k, "weixin", t) for k, e, t in rows if e == "pay"] + [("x", "zhifubao", None)]
    batch = jobs.two_stream_join(spark.createDataFrame(orders, ORDERS), spark.createDataFrame(pays, ORDERS))
    stream = jobs.two_stream_join(_stream_of(spark, orders, ORDERS), _stream_of(spark, pays, ORDERS))
    for side, want in batch.items():
        assert [(f.name, f.dataType) for f in stream[side].schema] == [(f.name, f.dataType) for f in want.schema]
        assert flat(stream[side]) == flat(want)


def test_the_callers_schema_stays_as_it_is(spark):
    st = _stream_of(spark, _tied_logins(), LOGINS)
    before = st.schema.jsonValue()
    jobs.login_fail_timer(st)
    assert st.schema.jsonValue() == before
