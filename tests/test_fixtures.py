"""Goldens derived from the reference's inline rows (FIXTURES.md F1-F5)."""

from pyspark.sql import functions as F

from eventlytics import operators as ops
from eventlytics import schemas
from eventlytics.functions.time import with_event_time
from eventlytics.sources import files
from eventlytics.sources.memory import rows_to_frame

from conftest import rows

BEHAVIOR_LINE = "543462,1715,1464116,pv,1511658000"
LOG_LINE = "192.0.2.1 - u1 17/05/2015:10:05:03 +0000 GET /blog/tags/firefox?flav=rss20"

LOGINS = [(1, "192.168.0.1", "fail", 1558430842), (1, "192.168.0.2", "fail", 1558430843),
          (1, "192.168.0.3", "fail", 1558430844), (2, "192.168.10.10", "success", 1558430845)]
ORDERS = [("1", "create", "1558430842"), ("2", "create", "1558430843"), ("2", "pay", "1558430844"),
          ("3", "pay", "1558430942"), ("4", "pay", "1558430943")]
TWO_ORDERS = [("1", "create", "1558430842"), ("2", "create", "1558430843"),
              ("1", "pay", "1558430844"), ("2", "pay", "1558430845"),
              ("3", "create", "1558430849"), ("3", "pay", "1558430849")]
TWO_PAYS = [("1", "weixin", "1558430847"), ("2", "zhifubao", "1558430848"),
            ("4", "zhifubao", "1558430850")]


def _behavior(spark):
    lines = spark.createDataFrame([(BEHAVIOR_LINE,)], "value STRING")
    df = files.parse_behavior(lines).withColumn("seq", F.lit(0).cast("bigint"))
    return with_event_time(df, "ts_s", "s").where(F.col("behavior") == "pv")


def test_f1_hourly_count_sum_distinct(spark):
    pv = _behavior(spark)
    assert rows(ops.window_count(pv, "1 hour")) == [(1511661600000, 1)]
    fs = ops.window_field_sum(pv, "user_id", "1 hour", ["item_id", "category_id", "behavior", "ts_s"])
    assert rows(fs, "window_end", "user_id", "item_id", "category_id", "behavior", "ts_s") == [
        (1511661600000, 543462, 1715, 1464116, "pv", 1511658000)]
    assert rows(ops.window_distinct(pv, "user_id", "1 hour", out_col="uv")) == [(1511661600000, 1)]
    assert rows(ops.window_distinct(pv, "item_id", "1 hour", out_col="n")) == [(1511661600000, 1)]
    approx = ops.window_distinct(pv, "item_id", "1 hour", exact=False, out_col="n")
    assert rows(approx) == [(1511661600000, 1)]


def test_f1_top_k_all_methods(spark):
    pv = _behavior(spark)
    want = [(1511658300000 + 300000 * i, 1, 1715, 1) for i in range(12)]
    for method in ("direct", "pane", "auto"):
        counts = ops.windowed_count(pv, ["item_id"], "60 minutes", "5 minutes", method=method)
        top = ops.top_k_per_window(counts, "item_id", 5)
        assert rows(top, "window_end", "rank", "item_id", "cnt") == want, method


def test_f1_rank_report_layout(spark):
    pv = _behavior(spark)
    top = ops.top_k_per_window(ops.windowed_count(pv, ["item_id"], "60 minutes", "5 minutes"),
                               "item_id", 5)
    rep = {r["window_end"]: r["report"] for r in ops.rank_report(top, "item_id").collect()}
    assert rep[1511661600000] == (
        "====================================\n时间: 2017-11-26 02:00:00.0\n"
        "No1: 商品ID=1715 浏览量=1\n====================================\n")


def test_f2_access_log_parse(spark):
    lines = spark.createDataFrame([(LOG_LINE,)], "value STRING")
    out = files.parse_access_log(lines).select(
        "ip", "user_id", F.unix_seconds("et").alias("s"), "method", "url").collect()
    assert [tuple(r) for r in out] == [
        ("192.0.2.1", "u1", 1431857103, "GET", "/blog/tags/firefox?flav=rss20")]
    zoned = spark.createDataFrame([(LOG_LINE.replace("+0000", "+0200"),)], "value STRING")
    z = files.parse_access_log(zoned, use_zone=True).select(F.unix_seconds("et")).first()[0]
    assert z == 1431857103 - 7200


def test_quarantine_splits_bad_lines(spark):
    lines = spark.createDataFrame([(BEHAVIOR_LINE,), ("x,1715,1,pv,1",), ("1,2",)], "value STRING")
    good, bad = files.split_quarantine(files.parse_behavior(lines, mode="quarantine"))
    assert rows(good, "user_id") == [(543462,)]
    assert rows(bad) == [("1,2",), ("x,1715,1,pv,1",)]
    logs = spark.createDataFrame([(LOG_LINE,), ("bad line",), ("a b c 99/99/2015:99:00:00 z GET /",)],
                                 "value STRING")
    good, bad = files.split_quarantine(files.parse_access_log(logs, mode="quarantine"))
    assert good.count() == 1 and bad.count() == 2


def _logins(spark):
    return with_event_time(rows_to_frame(spark, LOGINS, schemas.LOGIN), "ts_s", "s")


def test_f3_adjacent_fail_pair(spark):
    fail = F.col("event_type") == "fail"
    out = ops.adjacent_pair_within(_logins(spark), ["user_id"], fail, fail, "2 seconds")
    assert rows(out, "user_id", "ip", "event_type") == [
        (1, "192.168.0.2", "fail"), (1, "192.168.0.3", "fail")]


def test_f3_failure_burst(spark):
    out = ops.failure_burst(_logins(spark), ["user_id"], F.col("event_type") == "fail", "2 seconds")
    assert rows(out, "user_id", "ip", "event_type", "ts_s") == [(1, "192.168.0.1", "fail", 1558430842)]


def _orders(spark, data=ORDERS):
    return with_event_time(rows_to_frame(spark, data, schemas.ORDER), "event_time", "s")


def test_f4_pattern_timeout_and_matches(spark):
    create, pay = F.col("event_type") == "create", F.col("event_type") == "pay"
    od = _orders(spark)
    out = ops.pattern_timeout(od, ["order_id"], create, pay, "5 seconds")
    assert rows(out, "order_id", "event_type", "event_time") == [("1", "create", "1558430842")]
    done = ops.pattern_matches(od, ["order_id"], create, pay, "5 seconds")
    assert rows(done.select("order_id", "event_time", F.unix_seconds("next_et").alias("n"))) == [
        ("2", "1558430843", 1558430844)]


def test_f4_single_slot_timeout(spark):
    out = ops.single_slot_timeout(_orders(spark), ["order_id"], F.col("event_type") == "create",
                                  "5 seconds")
    assert rows(out, "order_id", "event_type", "event_time") == [("1", "create", "1558430842")]


def test_f4_slot_alerts_when_pay_is_late(spark):
    od = _orders(spark, [("9", "create", "1000"), ("9", "pay", "1100")])
    out = ops.single_slot_timeout(od, ["order_id"], F.col("event_type") == "create", "5 seconds")
    assert rows(out, "order_id", "event_time") == [("9", "1000")]


def test_f5_reconcile(spark):
    o = with_event_time(rows_to_frame(spark, TWO_ORDERS, schemas.ORDER), "event_time", "s")
    p = with_event_time(rows_to_frame(spark, TWO_PAYS, schemas.PAYMENT), "event_time", "s")
    res = ops.reconcile(o, p, ["order_id"], ["event_type", "event_time"], ["event_type", "event_time"])
    parts = ops.split_status(res)
    assert rows(parts["matched"], "order_id", "o_event_type", "o_event_time", "p_event_type",
                "p_event_time") == [("1", "pay", "1558430844", "weixin", "1558430847"),
                                    ("2", "pay", "1558430845", "zhifubao", "1558430848")]
    assert rows(parts["unmatched_order"], "order_id", "o_event_type", "o_event_time") == [
        ("3", "pay", "1558430849")]
    assert rows(parts["unmatched_payment"], "order_id", "p_event_type", "p_event_time") == [
        ("4", "zhifubao", "1558430850")]


def test_reconcile_wait_splits_late_pairs(spark):
    o = with_event_time(rows_to_frame(spark, TWO_ORDERS, schemas.ORDER), "event_time", "s")
    p = with_event_time(rows_to_frame(spark, TWO_PAYS, schemas.PAYMENT), "event_time", "s")
    res = ops.reconcile(o, p, ["order_id"], ["event_type"], ["event_type"], wait="2 seconds")
    got = rows(res, "order_id", "status")
    assert got == [("1", "unmatched_order"), ("1", "unmatched_payment"), ("2", "unmatched_order"),
                   ("2", "unmatched_payment"), ("3", "unmatched_order"), ("4", "unmatched_payment")]
