"""Stream forms against the batch operators and the event machines: complete
results at the end of a bounded input, whatever the micro-batches and the
order of arrival (within the delay), and after a stop."""

import random

import pytest
from pyspark.sql import functions as F

from eventlytics import operators as ops
from eventlytics import streaming as S
from eventlytics.plans import registry as R
from eventlytics.session import scratch_path
from eventlytics.sources import tables as T
from eventlytics.sources.memory import rows_to_stream

from test_random_machines import D, SCHEMA, _events, adjacent_machine, burst_machine, slot_machine

from conftest import SF001, rows


def typ(x):
    return F.col("typ") == x


def _stream(spark, evs, per_file, schema=SCHEMA):
    st, _ = rows_to_stream(spark, evs, schema, rows_per_file=per_file)
    return st.withColumn("et", F.timestamp_micros("t"))


def _batch(spark, evs):
    return spark.createDataFrame([e + (i,) for i, e in enumerate(evs)], SCHEMA + ", seq BIGINT") \
        .withColumn("et", F.timestamp_micros("t"))


def _burst(df):
    return ops.failure_burst(df, ["k"], typ("a"), D // 1000)


def _slot(df):
    return ops.single_slot_timeout(df, ["k"], typ("a"), D // 1000)


def _adjacent(df):
    return ops.adjacent_pair_within(df, ["k"], typ("a"), typ("a"), D // 1000)


@pytest.mark.parametrize("per_file", [19, 60, 1000])
def test_staged_detectors_match_machines(spark, per_file):
    evs = _events(7, n=120)
    for op, machine, at in ((_burst, burst_machine, "timer_et"), (_slot, slot_machine, "timer_et"),
                            (_adjacent, adjacent_machine, "et")):
        st = _stream(spark, evs, per_file)
        got = S.staged_stream(st, op, D // 1000, at, chunk=2 * D // 1000)
        assert rows(got, "k", "seq") == machine(evs)


def test_staged_outcomes_equal_both_batch_forms(spark):
    evs = _events(5, n=120)
    got = S.staged_stream(_stream(spark, evs, 40), lambda df: ops.pattern_outcomes(
        df, ["k"], typ("a"), typ("b"), D // 1000), D // 1000, "et", chunk=D // 1000).cache()
    batch = _batch(spark, evs)
    assert rows(got.where("status = 'timeout'"), "k", "seq") == rows(
        ops.pattern_timeout(batch, ["k"], typ("a"), typ("b"), D // 1000), "k", "seq")
    assert rows(got.where("status = 'match'"), "k", "seq", "next_seq") == rows(
        ops.pattern_matches(batch, ["k"], typ("a"), typ("b"), D // 1000), "k", "seq", "next_seq")


def test_staged_takes_rows_out_of_order(spark):
    evs = _events(11, n=120)
    late_us = 3_000_000
    rnd = random.Random(3)
    order = sorted(range(len(evs)), key=lambda i: evs[i][2] + rnd.randrange(late_us))
    st = _stream(spark, [evs[i] + (i,) for i in order], 30, SCHEMA + ", orig BIGINT").withColumn("seq", F.col("orig"))
    got = S.staged_stream(st, _burst, D // 1000, "timer_et", delay="3 seconds", chunk=D // 1000)
    assert rows(got, "k", "seq") == burst_machine(evs)


def test_staged_drops_rows_of_an_emitted_stretch(spark):
    evs = [(1, "a", 0), (1, "a", 1), (2, "b", 100 * D), (1, "a", 2), (2, "b", 100 * D + 1)]
    st = _stream(spark, evs, 3)
    run = S.StagedStream(st, _adjacent, D // 1000, "et", chunk=D // 1000)
    run.start(availableNow=True).awaitTermination()  # emits the first stretch after the first micro-batch
    assert rows(run.finish(), "k", "t") == [(1, 1)]
    whole = S.staged_stream(_stream(spark, evs, 5), _adjacent, D // 1000, "et", chunk=D // 1000)
    assert rows(whole, "k", "t") == [(1, 1), (1, 2)]


def test_staged_plan_has_no_python(spark):
    st = _stream(spark, _events(1, n=10), 10)
    got = S.staged_stream(st, _burst, D // 1000, "timer_et")
    assert "Python" not in _burst(_batch(spark, _events(1, n=10)))._jdf.queryExecution().toString()
    assert got.count() >= 0


def test_staged_resumes_where_it_stopped(spark):
    evs = _events(7, n=120)
    folder = scratch_path(spark, "resume-in")
    path, checkpoint = scratch_path(spark, "resume-out"), scratch_path(spark, "resume-ckpt")

    def add(lo, hi):
        part = [e + (i,) for i, e in enumerate(evs)][lo:hi]
        spark.createDataFrame(part, SCHEMA + ", seq BIGINT").coalesce(1).write.mode("append").parquet(folder)

    def run():
        st = spark.readStream.schema(SCHEMA + ", seq BIGINT").parquet(folder)
        return S.StagedStream(st.withColumn("et", F.timestamp_micros("t")), _slot, D // 1000, "timer_et",
                              chunk=D // 1000, path=path, checkpoint=checkpoint)

    add(0, 70)
    run().start(availableNow=True).awaitTermination()
    some = rows(run().results(), "k", "seq")
    assert some and len(some) < len(slot_machine(evs))
    add(70, 120)
    assert rows(run().finish(), "k", "seq") == slot_machine(evs)


def test_top_k_resumes_with_its_checkpoint(spark):
    evs = _events(3, n=200, keys=6)
    folder = scratch_path(spark, "topk-in")
    path, checkpoint = scratch_path(spark, "topk-out"), scratch_path(spark, "topk-ckpt")

    def run(end=None):
        st = spark.readStream.schema(SCHEMA).parquet(folder).withColumn("et", F.timestamp_micros("t"))
        st = st.withWatermark("et", "1 millisecond")
        counts = ops.windowed_count(st, ["k"], "60 seconds", "20 seconds")
        return S.top_k_stream(counts, "k", 2, "resume", path=path, checkpoint=checkpoint, end=end)

    cols = ("window_end", "rank", "k", "cnt")
    batch = spark.createDataFrame(evs, SCHEMA).withColumn("et", F.timestamp_micros("t"))
    want = rows(ops.top_k_per_window(ops.windowed_count(batch, ["k"], "60 seconds", "20 seconds"), "k", 2), *cols)
    spark.createDataFrame(evs[:120], SCHEMA).coalesce(1).write.parquet(folder)
    first = rows(run(), *cols)
    spark.createDataFrame(evs[120:] + [(99, "a", 10 ** 15)], SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    both = rows(run(), *cols)
    assert first and len(first) < len(want) and both == want
    with pytest.raises(ValueError):
        S.top_k_stream(batch, "k", 2, "x", path=path)


@pytest.mark.parametrize("method", ["direct", "pane"])
def test_windows_to_the_end_of_the_stream(spark, method):
    evs = _events(3, n=200, keys=6)
    batch = spark.createDataFrame(evs, SCHEMA).withColumn("et", F.timestamp_micros("t"))
    end = S.End(spark)
    st = end.ending(_stream(spark, evs, 50)).withWatermark("et", "1 millisecond")
    got = S.top_k_stream(ops.windowed_count(st, ["k"], "60 seconds", "20 seconds", method=method), "k", 2,
                         f"topk_{method}", end=end)
    want = ops.top_k_per_window(ops.windowed_count(batch, ["k"], "60 seconds", "20 seconds"), "k", 2)
    assert rows(got, "window_end", "rank", "k", "cnt") == rows(want, "window_end", "rank", "k", "cnt")


def test_distinct_of_nulls_batch_and_stream(spark):
    evs = [(1, "a", 0), (None, "a", 1), (1, "a", 2), (None, "b", D), (2, "b", 90_000_000)]
    batch = spark.createDataFrame(evs, SCHEMA).withColumn("et", F.timestamp_micros("t"))
    end = S.End(spark)
    st = end.ending(_stream(spark, evs, 2)).withWatermark("et", "1 millisecond")
    got = S.stream_result(ops.window_distinct(st, "k", "30 seconds", out_col="n"), "uv_null", end)
    want = ops.window_distinct(batch, "k", "30 seconds", out_col="n")
    assert rows(got) == rows(want) and min(r[1] for r in rows(want)) == 1


def test_a_directory_of_overlapping_files(spark, tmp_path):
    """``events`` as a directory: equal rows in batch, in one micro-batch,
    and at one file per trigger with a delay that covers the disorder."""
    events = spark.read.parquet(f"{SF001}/events.parquet")
    folder = str(tmp_path)
    events.repartition(3).write.parquet(f"{folder}/events.parquet")
    span = events.agg(F.max(F.unix_micros(F.col("ts").cast("timestamp"))) - F.min(F.unix_micros(
        F.col("ts").cast("timestamp")))).head()[0]
    assert T.load_table(spark, folder, "events").count() == events.count()
    for name in ("pv_hourly", "login_fail_burst", "order_timeout_slot"):
        assert rows(R.QUERIES[f"{name}_stream"](spark, folder)) == rows(R.QUERIES[name](spark, SF001))
    st = T.stream_table(spark, folder, "events", T.EVENTS_SCHEMA, max_files_per_trigger=1)
    fail = F.col("event_type") == "fail"
    got = S.staged_stream(T.logins_from_events(st), lambda lg: ops.failure_burst(lg, ["user_id"], fail, R.GAP),
                          R.GAP, "timer_et", delay=f"{span // 1000 + 1} milliseconds")
    want = ops.failure_burst(T.logins_from_events(events), ["user_id"], fail, R.GAP)
    assert rows(got, "user_id", "seq") == rows(want, "user_id", "seq")
    end = S.End(spark)
    pv = end.ending(T.behavior_from_events(T.stream_table(
        spark, folder, "events", T.EVENTS_SCHEMA, max_files_per_trigger=1).where(F.col("event_type") == T.VIEW)))
    got = S.stream_result(ops.window_count(pv.withWatermark("et", f"{span} microseconds"), "1 hour", count_col="pv"),
                          "pv_dir", end)
    assert rows(got) == rows(R.QUERIES["pv_hourly"](spark, SF001))


def test_sides_from_one_run(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "k int, status string")
    paths = {s: scratch_path(spark, s) for s in ("a", "b", "c")}
    S.write_sides(df, paths)
    assert {s: rows(spark.read.parquet(p), "k") for s, p in paths.items()} == {"a": [(1,), (3,)], "b": [(2,)], "c": []}


def test_console_sink_runs(spark):
    q = S.console(_stream(spark, [(1, "a", 1)], 1), available_now=True)
    q.awaitTermination()
    assert q.exception() is None
