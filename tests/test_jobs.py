"""The reference jobs end to end on the fixture rows, batch and stream."""

import random

import pytest
from pyspark.sql import functions as F

from eventlytics import schemas
from eventlytics.plans import jobs
from eventlytics.session import scratch_path
from eventlytics.sources import kafka
from eventlytics.sources.files import read_lines
from eventlytics.sources.memory import rows_to_frame, rows_to_stream

from conftest import rows
from test_fixtures import BEHAVIOR_LINE, LOG_LINE, LOGINS, ORDERS, TWO_ORDERS, TWO_PAYS


def _text_file(spark, lines, name):
    path = scratch_path(spark, name)
    spark.createDataFrame([(x,) for x in lines], "value STRING").coalesce(1).write.text(path)
    return path


def test_hot_items_job_batch_and_stream(spark):
    path = _text_file(spark, [BEHAVIOR_LINE, "1,99,1,buy,1511658001"], "behavior")
    want = [(1511658300000 + 300000 * i, 1, 1715, 1) for i in range(12)]
    assert rows(jobs.hot_items(spark, path), "window_end", "rank", "item_id", "cnt") == want
    assert rows(jobs.hot_items(spark, path, stream=True), "window_end", "rank", "item_id", "cnt") == want
    rep = jobs.hot_items(spark, path, report=True).collect()
    assert len(rep) == 12 and all("No1: 商品ID=1715 浏览量=1" in r.report for r in rep)


def test_traffic_job(spark):
    second = LOG_LINE.replace("10:05:03", "10:05:04").replace("192.0.2.1", "192.0.2.2")
    path = _text_file(spark, [LOG_LINE, second, "junk"], "log")
    top = jobs.traffic(spark, path, mode="quarantine")
    assert top.count() == 120 and top.agg(F.max("cnt")).first()[0] == 2
    cols = ("window_end", "rank", "url", "cnt")
    assert rows(jobs.traffic(spark, path, mode="quarantine", stream=True), *cols) == rows(top, *cols)
    rep = jobs.traffic(spark, path, mode="quarantine", report=True).first().report
    bar = "=" * 35
    assert rep.startswith(f"{bar}\n时间: ") and rep.endswith(f"\n{bar}\n\n") and ".0\nNo1: URL=" in rep
    by_ip = jobs.traffic(spark, path, key="ip", mode="quarantine")
    assert by_ip.where("rank = 2").count() > 0


def test_page_view_jobs(spark):
    path = _text_file(spark, [BEHAVIOR_LINE], "pv")
    assert rows(jobs.page_views(spark, path)) == [(1511661600000, 1)]
    lit = jobs.page_views(spark, path, literal=True).select("user_id", "item_id").collect()
    assert [tuple(r) for r in lit] == [(543462, 1715)]
    assert rows(jobs.unique_visitors(spark, path)) == [(1511661600000, 1)]


def test_login_and_order_jobs(spark):
    lg = rows_to_frame(spark, LOGINS, schemas.LOGIN)
    assert rows(jobs.login_fail_timer(lg), "user_id", "ts_s") == [(1, 1558430842)]
    assert rows(jobs.login_fail_pattern(lg)) == [(1, "192.168.0.2", "fail"), (1, "192.168.0.3", "fail")]
    od = rows_to_frame(spark, ORDERS, schemas.ORDER)
    out = jobs.order_timeout_pattern(od)
    assert rows(out["timeout"], "order_id") == [("1",)]
    assert rows(out["matched"], "order_id") == [("2",)]
    assert rows(jobs.order_timeout_timer(od), "order_id") == [("1",)]


def test_two_stream_join_job(spark):
    o = rows_to_frame(spark, TWO_ORDERS, schemas.ORDER)
    p = rows_to_frame(spark, TWO_PAYS, schemas.PAYMENT)
    out = jobs.two_stream_join(o, p)
    assert rows(out["matched"], "order_id") == [("1",), ("2",)]
    assert rows(out["unmatched_order"], "order_id") == [("3",)]
    assert rows(out["unmatched_payment"], "order_id") == [("4",)]


def test_stream_jobs_on_fixture_rows(spark):
    st, _ = rows_to_stream(spark, LOGINS, schemas.LOGIN, rows_per_file=2)
    assert rows(jobs.login_fail_timer(st), "user_id", "ts_s") == [(1, 1558430842)]
    st, _ = rows_to_stream(spark, LOGINS, schemas.LOGIN, rows_per_file=1)
    assert rows(jobs.login_fail_pattern(st)) == [(1, "192.168.0.2", "fail"), (1, "192.168.0.3", "fail")]
    st, _ = rows_to_stream(spark, ORDERS, schemas.ORDER, rows_per_file=2)
    assert rows(jobs.order_timeout_timer(st), "order_id") == [("1",)]
    st, _ = rows_to_stream(spark, ORDERS, schemas.ORDER, rows_per_file=2)
    out = jobs.order_timeout_pattern(st)
    assert rows(out["timeout"], "order_id") == [("1",)] and rows(out["matched"], "order_id") == [("2",)]


def test_two_stream_join_as_a_stream(spark):
    # the first order is followed within the key by a later one and a payment
    orders = [("a", "create", "1000"), ("a", "create", "1004"), ("b", "create", "2000"), ("c", "create", "9000")]
    pays = [("a", "weixin", "1005"), ("d", "zhifubao", "3000")]
    batch = jobs.two_stream_join(rows_to_frame(spark, orders, schemas.ORDER),
                                 rows_to_frame(spark, pays, schemas.PAYMENT), wait="5 seconds")
    o, _ = rows_to_stream(spark, orders, schemas.ORDER, rows_per_file=4)
    p, _ = rows_to_stream(spark, pays, schemas.PAYMENT, rows_per_file=2)
    stream = jobs.two_stream_join(o, p, wait="5 seconds")
    for side in batch:
        assert rows(stream[side], "order_id", "o_event_time", "p_event_time") == rows(
            batch[side], "order_id", "o_event_time", "p_event_time")
    assert rows(stream["matched"], "order_id") == [("a",)]


def test_failfast_fails_on_an_empty_number(spark):
    path = _text_file(spark, ["1,,3,pv,5"], "bad")
    for job in (jobs.page_views, jobs.unique_visitors):
        with pytest.raises(Exception, match="bad behaviour line"):
            job(spark, path).collect()


def test_equal_times_on_a_stream_are_ordered_by_the_row(spark):
    rows_in = [(1, "x", "fail", 10), (1, "y", "fail", 10), (1, "z", "success", 11)]
    lines = spark.createDataFrame(rows_in, schemas.LOGIN)
    folder = scratch_path(spark, "ties")
    lines.repartition(3).write.parquet(folder)
    results = {str(rows(jobs.login_fail_timer(spark.readStream.schema(schemas.LOGIN).option(
        "maxFilesPerTrigger", n).parquet(folder)), "user_id", "ip")) for n in (1, 2, 10)}
    assert len(results) == 1


def _tied_logins(spark, **reading):
    """Logins parsed from lines read with their position."""
    lines = read_lines(spark, position=True, **reading)
    p = F.split("value", ",")
    return lines.select(p[0].cast("bigint").alias("user_id"), p[1].alias("ip"), p[2].alias("event_type"),
                        p[3].cast("bigint").alias("ts_s"), "seq")


def test_lines_keep_the_order_of_their_files(spark):
    """Whatever the splits and micro-batches, ``seq`` sorts like the lines."""
    rng = random.Random(5)
    users = [[f"{u},10.0.0.{k},{rng.choice(['fail', 'success'])},{u * 10 + k // 6}" for k in range(12)]
             for u in range(300)]
    lines = [x for ks in zip(*users) for x in ks]  # each user's lines in order, far apart
    path = scratch_path(spark, "tied")
    spark.createDataFrame(list(enumerate(lines)), "i bigint, value string").repartitionByRange(3, "i").orderBy(
        "i").select("value").write.text(path)
    want = []
    for ks in users:
        rec = [x.split(",") for x in ks]
        want += [(int(b[0]), b[1], "fail") for a, b in zip(rec, rec[1:])
                 if a[2] == b[2] == "fail" and int(b[3]) - int(a[3]) < 2]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("700b", "5k", before):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            batch = _tied_logins(spark, path=path)
            ordered = read_lines(spark, path, position=True).orderBy("seq").select("value").collect()
            assert [r[0] for r in ordered] == lines
            assert rows(jobs.login_fail_pattern(batch)) == sorted(want)
            for n in (None, 1):
                stream = _tied_logins(spark, path=path, stream=True, max_files_per_trigger=n)
                assert rows(jobs.login_fail_pattern(stream)) == sorted(want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert "seq" not in read_lines(spark, path).columns


def test_first_record_of_a_window_is_the_first_line(spark):
    lines = [f"{u},{i},1,pv,1511658000" for u, i in ((9, 70), (2, 30), (5, 10), (1, 90))]
    path = _text_file(spark, lines, "first")
    want = [(1511661600000, 17, 70, 1, "pv", 1511658000)]
    assert rows(jobs.page_views(spark, path, literal=True)) == want
    assert rows(jobs.page_views(spark, path, literal=True, stream=True)) == want


def test_kafka_encode_decode_and_options(spark):
    df = spark.createDataFrame([(543462, 1715, 1464116, "pv", 1511658000)], schemas.BEHAVIOR)
    enc = kafka.encode_lines(df, df.columns)
    assert [r.value for r in enc.collect()] == [BEHAVIOR_LINE]
    records = spark.createDataFrame([(bytearray(BEHAVIOR_LINE.encode()),)], "value BINARY")
    assert [r.value for r in kafka.decode_lines(records).collect()] == [BEHAVIOR_LINE]
    opts = kafka.source_options("broker:9092", "hotitems", group_id="consumer-group")
    assert opts == {"kafka.bootstrap.servers": "broker:9092", "subscribe": "hotitems",
                    "startingOffsets": "latest", "groupIdPrefix": "consumer-group"}
    assert kafka.sink_options("broker:9092", "hotitems")["topic"] == "hotitems"


def test_kafka_records(spark):
    rows_in = [(1, 10, "pv", 0), (2, None, "buy", 1), (3, 30, "é", 0)]
    df = spark.createDataFrame(rows_in, "user_id bigint, item_id bigint, behavior string, p int")
    sent = kafka.encode_records(df, ["user_id", "item_id", "behavior"], "t", key="user_id", partition="p")
    assert sent.columns == ["topic", "value", "key", "partition", "user_id", "item_id", "behavior", "p"]
    assert dict(sent.dtypes)["key"] == dict(sent.dtypes)["value"] == "binary"
    assert kafka.encode_records(df, ["user_id"], "t").where("key IS NOT NULL").count() == 0
    got = sent.selectExpr("topic", "key", "value", "partition", "user_id AS offset",
                          "timestamp_seconds(user_id) AS timestamp")
    extra = spark.createDataFrame([("t", None, None, 0, 7), ("t", None, bytearray(b"a\xff"), 5, 9)],
                                  "topic string, key binary, value binary, partition int, offset bigint")
    got = got.unionByName(extra.withColumn("timestamp", F.timestamp_seconds(F.lit(9))))
    out = {r["seq"]: (r["key"], r["value"]) for r in kafka.decode_records(got).collect()}
    # an empty field stays a field; a deletion is no line; bad bytes become a replacement character
    assert out == {(0, 1): ("1", "1,10,pv"), (1, 2): ("2", "2,,buy"), (0, 3): ("3", "3,30,é"), (5, 9): (None, "a\ufffd")}
    assert kafka.starting_offsets(kafka.offsets_after(got)) == '{"t": {"0": 8, "1": 3, "5": 10}}'
    assert kafka.decode_records(got.limit(0)).count() == 0
