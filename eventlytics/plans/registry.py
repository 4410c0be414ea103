"""Registered queries over the driver tables, each with its SQL oracle.

Every query reads the whole ``events`` table (through the adapters in
:mod:`eventlytics.sources.tables`) and returns only BIGINT / STRING
columns, times as epoch ms, so that results hash identically to the DuckDB
oracle. Orderings tie-break on ``event_id`` (``seq``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlytics import operators as ops
from eventlytics.functions.text import URL_COUNT_LABEL, URL_LABEL, URL_RULER
from eventlytics.functions.time import with_event_time
from eventlytics.plans import jobs
from eventlytics.session import scratch_path
from eventlytics.sources import kafka, tables as T
from eventlytics.operators.aggregates import LAST_GAP, MODE
from eventlytics.sources.files import parse_access_log, parse_behavior

# Parameters of the registered queries. The reference's 2 s / 5 s gaps
# match almost nothing on ``events`` (a user's events are hours apart), so
# the keyed detectors run with 12 hours.
TOP_K = 5
ITEM_WINDOW, ITEM_SLIDE = "60 minutes", "5 minutes"
URL_WINDOW, URL_SLIDE = "10 minutes", "5 seconds"
HOUR = "1 hour"
GAP = "12 hours"
TOPIC_PARTITIONS = 8
GAP_US = 12 * 3_600_000_000


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.load_table(spark, sf_dir, "events")


# --------------------------------------------------------------------- J1
def _views(spark: SparkSession, sf_dir: str) -> DataFrame:
    # filter on the stored column so that it reaches the parquet scan
    return T.behavior_from_events(_events(spark, sf_dir).where(F.col("event_type") == T.VIEW))


def hot_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    pv = _views(spark, sf_dir)
    counts = ops.windowed_count(pv, ["item_id"], ITEM_WINDOW, ITEM_SLIDE)
    return ops.top_k_per_window(counts, "item_id", TOP_K).select("window_end", "rank", "item_id", "cnt")


def hot_items_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``hot_items`` by frequent-items sketches and an exact recount."""
    top = ops.top_k_by_candidates(_views(spark, sf_dir), "item_id", TOP_K, ITEM_WINDOW, ITEM_SLIDE)
    return top.select("window_end", "rank", "item_id", "cnt")


def hot_items_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.rank_report(hot_items(spark, sf_dir), "item_id")


# --------------------------------------------------------------------- J2
def hot_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = T.access_log_from_events(_events(spark, sf_dir))
    counts = ops.windowed_count(log, ["url"], URL_WINDOW, URL_SLIDE)
    return ops.top_k_per_window(counts, "url", TOP_K).select("window_end", "rank", "url", "cnt")


def hot_urls_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.rank_report(hot_urls(spark, sf_dir), "url", key_label=URL_LABEL,
                           count_label=URL_COUNT_LABEL, trailer="\n\n", ruler=URL_RULER)


# ------------------------------------------------------------------ J3, J4
def _pv(spark, sf_dir):
    return _views(spark, sf_dir)


def pv_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.window_count(_pv(spark, sf_dir), HOUR, count_col="pv")


def field_sum_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.window_field_sum(_pv(spark, sf_dir), "user_id", HOUR,
                                ["item_id", "category_id", "behavior", "ts_s"])


def _minute_lines(spark, sf_dir) -> str:
    """A folder of behaviour CSV files whose times are whole minutes, so that
    many are equal; the files' lines are in a fixed disorder."""
    events = _events(spark, sf_dir).withColumn("ts", F.date_trunc("minute", "ts").cast("timestamp_ntz"))
    path = scratch_path(spark, "behavior-lines")
    T.behavior_lines_from_events(events.orderBy(F.md5(F.col("event_id").cast("string").cast("binary")))).write.text(path)
    return path


def first_views_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 (literal) over text files: of the views of a window's first minute
    the one whose line comes first in the files."""
    return jobs.page_views(spark, _minute_lines(spark, sf_dir), HOUR, literal=True)


def _csv_lines(spark, sf_dir):
    return T.behavior_lines_from_events(_events(spark, sf_dir))


def pv_hourly_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page views from behaviour CSV lines with epoch seconds."""
    pv = with_event_time(parse_behavior(_csv_lines(spark, sf_dir)), "ts_s", "s")
    return ops.window_count(pv.where(F.col("behavior") == "pv"), HOUR, count_col="pv")


def behavior_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Behaviour lines as records of a topic (key: user; a partition is the
    user's number mod 8; offset and time of the event), written, read back,
    decoded and parsed: what each partition holds per behaviour."""
    b = T.behavior_from_events(_events(spark, sf_dir)).withColumn("part", F.pmod("user_id", F.lit(TOPIC_PARTITIONS)))
    records = kafka.encode_records(
        b.select("user_id", "item_id", "category_id", "behavior", "ts_s", "part",
                 F.col("seq").alias("offset"), F.col("et").alias("timestamp")),
        ["user_id", "item_id", "category_id", "behavior", "ts_s"], "behavior", "user_id", "part")
    records = records.select("topic", "key", "value", "partition", "offset", "timestamp")
    path = scratch_path(spark, "behavior-topic")
    records.write.parquet(path)
    lines = kafka.decode_records(spark.read.schema(records.schema).parquet(path))
    rows = parse_behavior(lines, keep=["key", "value", "partition", "record_offset", "record_time"])
    return rows.groupBy("partition", "behavior").agg(
        F.count(F.lit(1)).alias("records"), F.sum(F.length("value")).cast("bigint").alias("value_chars"),
        F.sum((F.col("key") == F.col("user_id").cast("string")).cast("bigint")).alias("own_key"),
        F.min("record_offset").alias("first_offset"), F.max("record_offset").alias("last_offset"),
        F.unix_millis(F.max("record_time")).alias("last_ms")).withColumn("partition", F.col("partition").cast("bigint"))


def behavior_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good and bad CSV lines per behaviour; lines of items divisible by 7
    lose their category, those of items divisible by 11 their last field."""
    item = F.split("value", ",")[1].cast("bigint")
    broken = F.when(item % 7 == 0, F.regexp_replace("value", r"^(\d+,\d+),\d+,", "$1,x,")).when(
        item % 11 == 0, F.regexp_replace("value", r",\d+$", "")).otherwise(F.col("value"))
    rows = parse_behavior(_csv_lines(spark, sf_dir).select(broken.alias("value")), "quarantine")
    return rows.groupBy("behavior").agg(F.count_if(~F.col("_bad")).alias("good"),
                                        F.count_if(F.col("_bad")).alias("bad"))


def uv_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.window_distinct(_pv(spark, sf_dir), "user_id", HOUR, out_col="uv")


def distinct_items_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.window_distinct(_pv(spark, sf_dir), "item_id", HOUR, out_col="items")


# ------------------------------------------------------------------ J5, J6
def _logins(spark, sf_dir):
    return T.logins_from_events(_events(spark, sf_dir))


def login_fail_adjacent(spark: SparkSession, sf_dir: str) -> DataFrame:
    lg = _logins(spark, sf_dir)
    fail = F.col("event_type") == "fail"
    hits = ops.adjacent_pair_within(lg, ["user_id"], fail, fail, GAP)
    return hits.select("user_id", "ip", "event_type", F.unix_millis("et").alias("event_ms"),
                       F.unix_millis("first_et").alias("first_ms"))


def login_fail_burst(spark: SparkSession, sf_dir: str) -> DataFrame:
    lg = _logins(spark, sf_dir)
    alerts = ops.failure_burst(lg, ["user_id"], F.col("event_type") == "fail", GAP)
    return alerts.select("user_id", "ip", "event_type", F.unix_millis("et").alias("event_ms"),
                         F.unix_millis("timer_et").alias("timer_ms"))


# ------------------------------------------------------------------ J7, J8
def order_timeout_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    od = T.orders_from_events(_events(spark, sf_dir))
    out = ops.pattern_timeout(od, ["order_id"], F.col("event_type") == "create",
                              F.col("event_type") == "pay", GAP)
    return out.select("order_id", "event_type", F.unix_millis("et").alias("event_ms"))


def order_pay_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    od = T.orders_from_events(_events(spark, sf_dir))
    out = ops.pattern_matches(od, ["order_id"], F.col("event_type") == "create",
                              F.col("event_type") == "pay", GAP)
    return out.select("order_id", F.unix_millis("et").alias("event_ms"),
                      F.unix_millis("next_et").alias("next_ms"))


def order_timeout_slot(spark: SparkSession, sf_dir: str) -> DataFrame:
    od = T.orders_from_events(_events(spark, sf_dir), only_orders_and_payments=True)
    out = ops.single_slot_timeout(od, ["order_id"], F.col("event_type") == "create", GAP)
    return out.select("order_id", "event_type", F.unix_millis("et").alias("event_ms"),
                      F.unix_millis("timer_et").alias("timer_ms"))


# --------------------------------------------------------------------- J9
def _reconciled(spark, sf_dir):
    ev = _events(spark, sf_dir)
    day = F.date_format(F.col("et"), "yyyy-MM-dd").alias("day")
    orders = T.orders_from_events(ev.where(F.col("event_type") == T.VIEW)).select("*", day)
    pays = T.payments_from_events(ev).select("*", day)
    return ops.reconcile(orders, pays, ["order_id", "day"], ["event_type"], ["event_type"])


def reconcile_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _reconciled(spark, sf_dir).where(F.col("status") == "matched")
    return r.select("order_id", "day", F.col("o_event_type").alias("order_type"),
                    F.unix_millis("o_et").alias("order_ms"), F.col("p_event_type").alias("channel"),
                    F.unix_millis("p_et").alias("pay_ms"))


def reconcile_unmatched_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _reconciled(spark, sf_dir).where(F.col("status") == "unmatched_order")
    return r.select("order_id", "day", F.col("o_event_type").alias("order_type"),
                    F.unix_millis("o_et").alias("order_ms"))


def reconcile_unmatched_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _reconciled(spark, sf_dir).where(F.col("status") == "unmatched_payment")
    return r.select("order_id", "day", F.col("p_event_type").alias("channel"),
                    F.unix_millis("p_et").alias("pay_ms"))


# ------------------------------------------------------- late rows
# A fixed disorder: views arrive up to 60 places away from their order.
def _disordered(spark, sf_dir):
    pv = _views(spark, sf_dir).select("seq", "et")
    return pv.withColumn("arrival", F.col("seq") + F.col("seq") * 7919 % 61)


def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views that arrive when their hour is closed."""
    out = ops.late_rows(_disordered(spark, sf_dir), ["arrival", "seq"], HOUR)
    return out.select("seq", F.unix_millis("et").alias("event_ms"), F.unix_millis("seen_et").alias("seen_ms"))


def pv_hourly_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views counted, and dropped as late, per hour."""
    return ops.window_count_with_late(_disordered(spark, sf_dir), ["arrival", "seq"], HOUR, count_col="pv")


def pv_sliding_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same per sliding window: a late row still counts in its open ones."""
    return ops.window_count_with_late(_disordered(spark, sf_dir), ["arrival", "seq"], ITEM_WINDOW, ITEM_SLIDE,
                                      delay="1 minute", count_col="pv")


# ------------------------------------------------- consuming pairing
def reconcile_consuming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pairing of a user's views and purchases within 12 hours."""
    ev = _events(spark, sf_dir)
    r = ops.reconcile_consuming(T.orders_from_events(ev.where(F.col("event_type") == T.VIEW)), T.payments_from_events(ev),
                                ["order_id"], ["event_type"], ["event_type"], wait=GAP)
    return r.select("order_id", "status", F.unix_millis("o_et").alias("order_ms"),
                    F.col("p_event_type").alias("channel"), F.unix_millis("p_et").alias("pay_ms"))


# ------------------------------------------- sliding distinct users
def uv_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.window_distinct_sliding(_pv(spark, sf_dir), "user_id", ITEM_WINDOW, URL_SLIDE, out_col="uv")


def uv_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact users per sliding hour, and whether the united sketches' estimate
    is within its bound. (One grouping of both results, no join.)"""
    pv, uv = _pv(spark, sf_dir), F.col("uv")
    exact = ops.window_distinct_sliding(pv, "user_id", ITEM_WINDOW, ITEM_SLIDE, out_col="uv")
    guess = ops.window_distinct_estimate(pv, "user_id", ITEM_WINDOW, ITEM_SLIDE)
    both = exact.unionByName(guess, allowMissingColumns=True).groupBy("window_end").agg(
        F.max("uv").alias("uv"), F.max("estimate").alias("estimate"))
    return both.select("window_end", "uv", (F.abs(F.col("estimate") - uv) <= ops.hll_bound(uv)).alias("in_bound"))


def uv_returning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of an hour that were there the hour before, and whether the
    intersected sketches say so within their bound."""
    pv = _pv(spark, sf_dir)
    hour = F.floor(F.unix_seconds("et") / 3600)
    seen = pv.select("user_id", hour.alias("h")).distinct()
    near = seen.select("user_id", F.explode(F.array("h", F.col("h") + 1)).alias("w"), "h")
    exact = near.groupBy("w", "user_id").agg(F.count(F.lit(1)).alias("n"), F.max("h").alias("last")).groupBy("w").agg(
        F.count_if(F.col("n") == 2).alias("returning"), F.max("last").alias("last"))
    exact = exact.where("last = w").select(((F.col("w") + 1) * 3_600_000).alias("window_end"), "returning")
    guess = ops.window_distinct_both(pv, "user_id", HOUR)
    both = exact.unionByName(guess, allowMissingColumns=True).groupBy("window_end").agg(
        F.max("returning").alias("returning"), F.max("estimate").alias("estimate"), F.max("bound").alias("bound"))
    return both.select("window_end", "returning",
                       (F.abs(F.col("estimate") - F.col("returning")) <= F.col("bound")).alias("in_bound"))


# -------------------------------------------- aggregates of the user
def user_last_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Milliseconds between a user's last two events."""
    ev = T.orders_from_events(_events(spark, sf_dir)).select("order_id", F.unix_micros("et").alias("t"))
    out = ops.aggregate_by(ev, ["order_id"], ["t"], LAST_GAP, "bigint", "gap_us")
    return out.select("order_id", F.expr("gap_us div 1000").alias("gap_ms"))


def hourly_top_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent behaviour of each hour."""
    ev = T.behavior_from_events(_events(spark, sf_dir))
    hours = ev.select(((F.floor(F.unix_seconds("et") / 3600) + 1) * 3_600_000).alias("window_end"), "behavior")
    return ops.aggregate_by(hours, ["window_end"], ["behavior"], MODE, "string", "behavior")


# ------------------------------------------------- lenient log times
def log_lenient_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests per day of log lines with fields out of range: for k % 5 = 1
    the day is 32, for 2 the date is 31/02, for 3 the time 25:61:61, for 4 the
    month 14."""
    k = F.regexp_extract("value", r"/k/(\d+)$", 1).cast("int") % 5
    bad = (F.when(k == 1, F.regexp_replace("value", r" \d\d/", " 32/"))
           .when(k == 2, F.regexp_replace("value", r" \d\d/\d\d/", " 31/02/"))
           .when(k == 3, F.regexp_replace("value", r":\d\d:\d\d:\d\d ", ":25:61:61 "))
           .when(k == 4, F.regexp_replace("value", r"/\d\d/(\d{4}):", r"/14/$1:")).otherwise(F.col("value")))
    lines = T.access_lines_from_events(_events(spark, sf_dir)).select(bad.alias("value"))
    log = parse_access_log(lines, lenient=True)
    return log.groupBy(F.date_format("et", "yyyy-MM-dd").alias("day")).agg(
        F.count(F.lit(1)).alias("requests"), F.sum(F.unix_seconds("et")).alias("sum_s"))


# ------------------------------------------------------------------ oracles
_EV = """
ev AS (
  SELECT event_id AS seq, epoch_us(ts) AS t, user_id, event_type,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events)"""

_TOPK = """
, r AS (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, {key}) AS rank FROM c)
SELECT window_end, CAST(rank AS BIGINT) AS rank, {key}, cnt FROM r WHERE rank <= 5"""

_HOT_ITEMS_SQL = "WITH " + _EV + """
, c AS (
  SELECT k AS item_id, (t // 300000000 + 1 + j) * 300000 AS window_end, count(*) AS cnt
  FROM ev, range(0, 12) AS r(j) WHERE event_type = 'view' GROUP BY 1, 2)""" + _TOPK.format(key="item_id")

_HOT_URLS_SQL = "WITH " + _EV + """
, c AS (
  SELECT '/k/' || CAST(k AS VARCHAR) AS url,
         ((t // 1000000) * 1000000 // 5000000 + 1 + j) * 5000 AS window_end, count(*) AS cnt
  FROM ev, range(0, 120) AS r(j) GROUP BY 1, 2)""" + _TOPK.format(key="url")


def _report_sql(topk_sql: str, key: str, key_label: str, count_label: str, trailer: str, ruler: str) -> str:
    nl = "chr(10)"
    return f"""
WITH topk AS ({topk_sql})
SELECT window_end,
  '{ruler}' || {nl} || '时间: ' || strftime(make_timestamp(window_end * 1000), '%Y-%m-%d %H:%M:%S')
  || '.0' || {nl}
  || string_agg('No' || CAST(rank AS VARCHAR) || ':' || '{key_label}' || CAST({key} AS VARCHAR)
                || '{count_label}' || CAST(cnt AS VARCHAR), {nl} ORDER BY rank)
  || {nl} || '{ruler}' || {trailer} AS report
FROM topk GROUP BY window_end"""


_PV = "WITH " + _EV + """
, pv AS (SELECT *, (t // 3600000000 + 1) * 3600000 AS window_end FROM ev WHERE event_type = 'view')"""

_LOGINS = "WITH " + _EV + """
, lg AS (SELECT seq, t, user_id,
                '192.168.' || CAST(k AS VARCHAR) || '.' || CAST(user_id % 256 AS VARCHAR) AS ip,
                CASE WHEN event_type = 'error' THEN 'fail' ELSE 'success' END AS event_type
         FROM ev)"""

_ORDERS = "WITH " + _EV + """
, od AS (SELECT seq, t, CAST(user_id AS VARCHAR) AS order_id,
                CASE event_type WHEN 'view' THEN 'create' WHEN 'purchase' THEN 'pay'
                     ELSE event_type END AS event_type
         FROM ev)"""

_RECON = "WITH " + _EV + """
, o AS (SELECT CAST(user_id AS VARCHAR) AS order_id, strftime(make_timestamp(t), '%Y-%m-%d') AS day,
               arg_max('create', (t, seq)) AS order_type, arg_max(t, (t, seq)) AS ot
        FROM ev WHERE event_type = 'view' GROUP BY 1, 2)
, p AS (SELECT CAST(user_id AS VARCHAR) AS order_id, strftime(make_timestamp(t), '%Y-%m-%d') AS day,
               arg_max(CASE WHEN k % 2 = 0 THEN 'weixin' ELSE 'zhifubao' END, (t, seq)) AS channel,
               arg_max(t, (t, seq)) AS pt
        FROM ev WHERE event_type = 'purchase' GROUP BY 1, 2)"""

_BUCKETS = """
, b AS (SELECT *, {d} + min(t) OVER (PARTITION BY {key} ORDER BY t
                   RANGE BETWEEN {d} PRECEDING AND CURRENT ROW) AS bucket FROM {src})"""

ORACLES: dict[str, str] = {
    "hot_items": _HOT_ITEMS_SQL,
    "hot_items_sketched": _HOT_ITEMS_SQL,
    "hot_items_report": _report_sql(_HOT_ITEMS_SQL, "item_id", " 商品ID=", " 浏览量=", "chr(10)",
                                    "===================================="),
    "hot_urls": _HOT_URLS_SQL,
    "hot_urls_report": _report_sql(_HOT_URLS_SQL, "url", " URL=", " 流量=", "chr(10) || chr(10)",
                                   "==================================="),
    "pv_hourly": _PV + "\nSELECT window_end, count(*) AS pv FROM pv GROUP BY 1",
    "pv_hourly_csv": _PV + "\nSELECT window_end, count(*) AS pv FROM pv GROUP BY 1",
    "behavior_topic": "WITH " + _EV + """
, line AS (SELECT *, CASE event_type WHEN 'view' THEN 'pv' WHEN 'purchase' THEN 'buy' ELSE event_type END AS behavior FROM ev)
SELECT CAST(user_id % 8 AS BIGINT) AS partition, behavior, count(*) AS records,
       CAST(sum(length(concat_ws(',', user_id, k, k // 10, behavior, t // 1000000))) AS BIGINT) AS value_chars,
       count(*) AS own_key, min(seq) AS first_offset, max(seq) AS last_offset, max(t) // 1000 AS last_ms
FROM line GROUP BY 1, 2""",
    "behavior_quarantine": "WITH " + _EV + """
SELECT CASE event_type WHEN 'view' THEN 'pv' WHEN 'purchase' THEN 'buy' ELSE event_type END AS behavior,
       count(*) FILTER (WHERE k % 7 <> 0 AND k % 11 <> 0) AS good,
       count(*) FILTER (WHERE k % 7 = 0 OR k % 11 = 0) AS bad
FROM ev GROUP BY 1""",
    "field_sum_hourly": _PV + """
SELECT window_end, CAST(sum(user_id) AS BIGINT) AS user_id, arg_min(k, (t, seq)) AS item_id,
       CAST(arg_min(k // 10, (t, seq)) AS INTEGER) AS category_id, 'pv' AS behavior,
       arg_min(t // 1000000, (t, seq)) AS ts_s
FROM pv GROUP BY 1""",
    "first_views_lines": _PV + """
SELECT window_end, CAST(sum(user_id) AS BIGINT) AS user_id,
       arg_min(k, (t // 60000000, md5(CAST(seq AS VARCHAR)))) AS item_id,
       CAST(arg_min(k // 10, (t // 60000000, md5(CAST(seq AS VARCHAR)))) AS INTEGER) AS category_id, 'pv' AS behavior,
       min(t // 60000000) * 60 AS ts_s
FROM pv GROUP BY 1""",
    "uv_hourly": _PV + "\nSELECT window_end, count(DISTINCT user_id) AS uv FROM pv GROUP BY 1",
    "distinct_items_hourly": _PV + "\nSELECT window_end, count(DISTINCT k) AS items FROM pv GROUP BY 1",
    "login_fail_adjacent": _LOGINS + f"""
, x AS (SELECT *, lag(t) OVER w AS pt, lag(event_type) OVER w AS pe FROM lg
        WINDOW w AS (PARTITION BY user_id ORDER BY t, seq))
SELECT user_id, ip, event_type, t // 1000 AS event_ms, pt // 1000 AS first_ms
FROM x WHERE event_type = 'fail' AND pe = 'fail' AND t - pt < {GAP_US}""",
    "login_fail_burst": _LOGINS + _BUCKETS.format(d=GAP_US, key="user_id", src="lg") + """
, g AS (SELECT user_id, bucket, count(*) AS n, arg_min((ip, event_type, t), (t, seq)) AS f
        FROM b WHERE event_type = 'fail' GROUP BY 1, 2)
SELECT user_id, f[1] AS ip, f[2] AS event_type, f[3] // 1000 AS event_ms, bucket // 1000 AS timer_ms
FROM g WHERE n > 1""",
    "order_timeout_pattern": _ORDERS + f"""
, x AS (SELECT *, lead(t) OVER (PARTITION BY order_id ORDER BY t, seq) AS nt FROM od)
SELECT order_id, event_type, t // 1000 AS event_ms FROM x
WHERE event_type = 'create' AND (nt IS NULL OR nt - t >= {GAP_US})""",
    "order_pay_matches": _ORDERS + f"""
, x AS (SELECT *, lead(t) OVER w AS nt, lead(event_type) OVER w AS ne FROM od
        WINDOW w AS (PARTITION BY order_id ORDER BY t, seq))
SELECT order_id, t // 1000 AS event_ms, nt // 1000 AS next_ms FROM x
WHERE event_type = 'create' AND ne = 'pay' AND nt - t < {GAP_US}""",
    "order_timeout_slot": _ORDERS + ", od2 AS (SELECT * FROM od WHERE event_type IN ('create', 'pay'))"
    + _BUCKETS.format(d=GAP_US, key="order_id", src="od2") + """
, g AS (SELECT order_id, bucket, count(*) FILTER (WHERE event_type <> 'create') AS other,
               arg_min(t, (t, seq)) FILTER (WHERE event_type = 'create') AS ct
        FROM b GROUP BY 1, 2)
SELECT order_id, 'create' AS event_type, ct // 1000 AS event_ms, bucket // 1000 AS timer_ms
FROM g WHERE other = 0 AND ct IS NOT NULL""",
    "reconcile_matched": _RECON + """
SELECT order_id, day, order_type, ot // 1000 AS order_ms, channel, pt // 1000 AS pay_ms
FROM o JOIN p USING (order_id, day)""",
    "reconcile_unmatched_orders": _RECON + """
SELECT order_id, day, order_type, ot // 1000 AS order_ms FROM o ANTI JOIN p USING (order_id, day)""",
    "reconcile_unmatched_payments": _RECON + """
SELECT order_id, day, channel, pt // 1000 AS pay_ms FROM p ANTI JOIN o USING (order_id, day)""",
}

_DISORDERED = "WITH " + _EV + """
, a AS (SELECT seq, t, seq + seq * 7919 % 61 AS arrival FROM ev WHERE event_type = 'view')
, s AS (SELECT *, max(t) OVER (ORDER BY arrival, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
        FROM a)"""
ORACLES["late_rows"] = _DISORDERED + """
SELECT seq, t // 1000 AS event_ms, seen // 1000 AS seen_ms FROM s WHERE (t // 3600000000 + 1) * 3600000000 <= seen"""
_LATE_COUNTS = """
, w AS (SELECT (t // {slide} + j) * {slide} AS e, seen FROM s, range(1, {n} + 1) AS r(j))
SELECT e // 1000 AS window_end, count(*) FILTER (WHERE seen IS NULL OR e > seen - {delay}) AS pv,
       count(*) FILTER (WHERE e <= seen - {delay}) AS late
FROM w GROUP BY e"""
ORACLES["pv_hourly_late"] = _DISORDERED + _LATE_COUNTS.format(slide=3_600_000_000, n=1, delay=0)
ORACLES["pv_sliding_late"] = _DISORDERED + _LATE_COUNTS.format(slide=300_000_000, n=12, delay=60_000_000)
# along a run of links (neighbours of both sides, close enough) every other one pairs
ORACLES["reconcile_consuming"] = "WITH " + _EV + f"""
, e AS (SELECT CAST(user_id AS VARCHAR) AS order_id, seq, t, event_type = 'view' AS o,
               CASE WHEN event_type = 'purchase' THEN CASE WHEN k % 2 = 0 THEN 'weixin' ELSE 'zhifubao' END END AS channel
        FROM ev WHERE event_type IN ('view', 'purchase'))
, n AS (SELECT *, lag((o, t, channel)) OVER w AS b, lead((o, t)) OVER w AS a, row_number() OVER w AS rn FROM e
        WINDOW w AS (PARTITION BY order_id ORDER BY t, seq))
, l AS (SELECT *, coalesce(b[1] <> o AND t - b[2] <= {GAP_US}, false) AS linked FROM n)
, r AS (SELECT *, (rn - max(rn) FILTER (WHERE NOT linked) OVER (PARTITION BY order_id ORDER BY t, seq)) % 2 = 1 AS odd FROM l)
SELECT order_id,
       CASE WHEN odd THEN 'matched'
            WHEN a[1] = o AND a[2] - t <= {GAP_US} THEN CASE WHEN o THEN 'replaced_order' ELSE 'replaced_payment' END
            ELSE CASE WHEN o THEN 'unmatched_order' ELSE 'unmatched_payment' END END AS status,
       CASE WHEN o THEN t WHEN odd THEN b[2] END // 1000 AS order_ms,
       CASE WHEN NOT o THEN channel WHEN odd THEN b[3] END AS channel,
       CASE WHEN NOT o THEN t WHEN odd THEN b[2] END // 1000 AS pay_ms
FROM r WHERE odd OR NOT coalesce(a[1] <> o AND a[2] - t <= {GAP_US}, false)"""
ORACLES["uv_sliding"] = "WITH " + _EV + """
SELECT (t // 5000000 + 1 + j) * 5000 AS window_end, count(DISTINCT user_id) AS uv
FROM ev, range(0, 720) AS r(j) WHERE event_type = 'view' GROUP BY 1"""

ORACLES["uv_sketched"] = "WITH " + _EV + """
SELECT (t // 300000000 + 1 + j) * 300000 AS window_end, count(DISTINCT user_id) AS uv, true AS in_bound
FROM ev, range(0, 12) AS r(j) WHERE event_type = 'view' GROUP BY 1"""
ORACLES["uv_returning"] = "WITH " + _EV + """
, s AS (SELECT DISTINCT user_id, t // 3600000000 AS h FROM ev WHERE event_type = 'view')
SELECT (a.h + 1) * 3600000 AS window_end, count(b.h) AS returning, true AS in_bound
FROM s AS a LEFT JOIN s AS b ON b.user_id = a.user_id AND b.h = a.h - 1 GROUP BY a.h"""
ORACLES["user_last_gap"] = "WITH " + _EV + """
, r AS (SELECT user_id, t, lag(t) OVER w AS b, row_number() OVER (PARTITION BY user_id ORDER BY t DESC, seq DESC) AS n
        FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY t, seq))
SELECT CAST(user_id AS VARCHAR) AS order_id, (t - b) // 1000 AS gap_ms FROM r WHERE n = 1"""
ORACLES["hourly_top_type"] = "WITH " + _EV + """
, c AS (SELECT (t // 3600000000 + 1) * 3600000 AS window_end, CASE event_type WHEN 'view' THEN 'pv' WHEN 'purchase'
               THEN 'buy' ELSE event_type END AS behavior, count(*) AS n FROM ev GROUP BY ALL)
SELECT window_end, arg_min(behavior, (-n, behavior)) AS behavior FROM c GROUP BY 1"""
ORACLES["log_lenient_daily"] = "WITH " + _EV + """
, p AS (SELECT k % 5 AS m, make_timestamp((t // 1000000) * 1000000) AS ts FROM ev)
, x AS (SELECT CASE m WHEN 1 THEN date_trunc('month', ts) + INTERVAL 31 DAY + (ts - date_trunc('day', ts))
                      WHEN 2 THEN date_trunc('year', ts) + INTERVAL 1 MONTH + INTERVAL 30 DAY + (ts - date_trunc('day', ts))
                      WHEN 3 THEN date_trunc('day', ts) + INTERVAL 1 DAY + INTERVAL 7321 SECOND
                      WHEN 4 THEN date_trunc('year', ts) + INTERVAL 13 MONTH + (date_trunc('day', ts) - date_trunc('month', ts))
                                  + (ts - date_trunc('day', ts))
                      ELSE ts END AS ts FROM p)
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS requests, sum(epoch_us(ts) // 1000000)::BIGINT AS sum_s FROM x GROUP BY 1"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "uv_sketched": uv_sketched,
    "uv_returning": uv_returning,
    "user_last_gap": user_last_gap,
    "hourly_top_type": hourly_top_type,
    "log_lenient_daily": log_lenient_daily,
    "late_rows": late_rows,
    "pv_hourly_late": pv_hourly_late,
    "pv_sliding_late": pv_sliding_late,
    "reconcile_consuming": reconcile_consuming,
    "uv_sliding": uv_sliding,
    "hot_items": hot_items,
    "hot_items_sketched": hot_items_sketched,
    "hot_items_report": hot_items_report,
    "hot_urls": hot_urls,
    "hot_urls_report": hot_urls_report,
    "pv_hourly": pv_hourly,
    "pv_hourly_csv": pv_hourly_csv,
    "behavior_quarantine": behavior_quarantine,
    "behavior_topic": behavior_topic,
    "field_sum_hourly": field_sum_hourly,
    "first_views_lines": first_views_lines,
    "uv_hourly": uv_hourly,
    "distinct_items_hourly": distinct_items_hourly,
    "login_fail_adjacent": login_fail_adjacent,
    "login_fail_burst": login_fail_burst,
    "order_timeout_pattern": order_timeout_pattern,
    "order_pay_matches": order_pay_matches,
    "order_timeout_slot": order_timeout_slot,
    "reconcile_matched": reconcile_matched,
    "reconcile_unmatched_orders": reconcile_unmatched_orders,
    "reconcile_unmatched_payments": reconcile_unmatched_payments,
}


# ------------------------------------------------------------ stream twins
# The same jobs as Structured Streaming queries over the events table, read
# to its end: every twin gives the batch result, and has its oracle.
from eventlytics import streaming as S  # noqa: E402

DELAY, LOG_DELAY = "1 millisecond", "1 second"  # ascending input; access logs


def _events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.stream_table(spark, sf_dir, "events", T.EVENTS_SCHEMA)


def _pv_stream(spark, sf_dir):
    return T.behavior_from_events(_events_stream(spark, sf_dir).where(F.col("event_type") == T.VIEW))


def hot_items_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = S.count_stream(_pv_stream(spark, sf_dir), ["item_id"], ITEM_WINDOW, ITEM_SLIDE, ("item_id", TOP_K),
                         delay=DELAY, name="hot_items_stream")
    return top.finish().select("window_end", "rank", "item_id", "cnt")


def hot_urls_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = T.access_log_from_events(_events_stream(spark, sf_dir))
    top = S.count_stream(log, ["url"], URL_WINDOW, URL_SLIDE, ("url", TOP_K), delay=LOG_DELAY, name="hot_urls_stream")
    return top.finish().select("window_end", "rank", "url", "cnt")


def pv_hourly_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.count_stream(_pv_stream(spark, sf_dir), [], HOUR, count_col="pv", delay=DELAY,
                          name="pv_hourly_stream").finish()


def uv_hourly_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.distinct_stream(_pv_stream(spark, sf_dir), "user_id", HOUR, "uv", DELAY, "uv_hourly_stream").finish()


def distinct_items_hourly_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.distinct_stream(_pv_stream(spark, sf_dir), "item_id", HOUR, "items", DELAY,
                             "distinct_items_hourly_stream").finish()


def field_sum_hourly_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.field_sum_stream(_pv_stream(spark, sf_dir), "user_id", HOUR,
                              ["item_id", "category_id", "behavior", "ts_s"], delay=DELAY,
                              name="field_sum_hourly_stream").finish()


def first_views_lines_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.page_views(spark, _minute_lines(spark, sf_dir), HOUR, literal=True, stream=True)


def login_fail_burst_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    fail = F.col("event_type") == "fail"
    out = S.staged_stream(T.logins_from_events(_events_stream(spark, sf_dir)), lambda lg: ops.failure_burst(
        lg, ["user_id"], fail, GAP), GAP, "timer_et", delay=DELAY, name="login_fail_burst_stream")
    return out.select("user_id", "ip", "event_type", F.unix_millis("et").alias("event_ms"),
                      F.unix_millis("timer_et").alias("timer_ms"))


def login_fail_adjacent_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    fail = F.col("event_type") == "fail"
    out = S.staged_stream(T.logins_from_events(_events_stream(spark, sf_dir)), lambda lg: ops.adjacent_pair_within(
        lg, ["user_id"], fail, fail, GAP), GAP, "et", delay=DELAY, name="login_fail_adjacent_stream")
    return out.select("user_id", "ip", "event_type", F.unix_millis("et").alias("event_ms"),
                      F.unix_millis("first_et").alias("first_ms"))


def order_timeout_slot_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    od = T.orders_from_events(_events_stream(spark, sf_dir), only_orders_and_payments=True)
    out = S.staged_stream(od, lambda x: ops.single_slot_timeout(
        x, ["order_id"], F.col("event_type") == "create", GAP), GAP, "timer_et", delay=DELAY,
        name="order_timeout_slot_stream")
    return out.select("order_id", "event_type", F.unix_millis("et").alias("event_ms"),
                      F.unix_millis("timer_et").alias("timer_ms"))


def order_outcomes_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timeouts and matches of the order pattern from one stream run."""
    od = T.orders_from_events(_events_stream(spark, sf_dir))
    out = S.staged_stream(od, lambda x: ops.pattern_outcomes(
        x, ["order_id"], F.col("event_type") == "create", F.col("event_type") == "pay", GAP), GAP, "et",
        delay=DELAY, name="order_outcomes_stream")
    return out.select("order_id", "status", F.unix_millis("et").alias("event_ms"),
                      F.unix_millis("next_et").alias("next_ms"))


def order_timeout_pattern_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = order_outcomes_stream(spark, sf_dir).where(F.col("status") == "timeout")
    return out.select("order_id", F.lit("create").alias("event_type"), "event_ms")


def order_pay_matches_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = order_outcomes_stream(spark, sf_dir).where(F.col("status") == "match")
    return out.select("order_id", "event_ms", "next_ms")


def reconcile_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three outputs of the reconciliation, tagged, from one stream run."""
    ev = _events_stream(spark, sf_dir)
    day = F.date_format(F.col("et"), "yyyy-MM-dd").alias("day")
    orders = T.orders_from_events(ev.where(F.col("event_type") == T.VIEW)).select("*", day)
    pays = T.payments_from_events(ev.where(F.col("event_type") == T.PURCHASE)).select("*", day)
    # the key holds its day, so a key closes with its 1-day window
    out = S.reconcile_stream(orders, pays, ["order_id", "day"], ["event_type"], ["event_type"], "1 day", delay=DELAY,
                             name="reconcile_stream").finish()
    return out.select("order_id", "day", "status", F.col("o_event_type").alias("order_type"),
                      F.unix_millis("o_et").alias("order_ms"), F.col("p_event_type").alias("channel"),
                      F.unix_millis("p_et").alias("pay_ms"))


def reconcile_matched_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reconcile_stream(spark, sf_dir).where(F.col("status") == "matched")
    return r.select("order_id", "day", "order_type", "order_ms", "channel", "pay_ms")


def reconcile_unmatched_orders_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reconcile_stream(spark, sf_dir).where(F.col("status") == "unmatched_order")
    return r.select("order_id", "day", "order_type", "order_ms")


def reconcile_unmatched_payments_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reconcile_stream(spark, sf_dir).where(F.col("status") == "unmatched_payment")
    return r.select("order_id", "day", "channel", "pay_ms")


def reconcile_unique_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view and a purchase that is the very next event, at most an hour
    later, as a stream-stream join: both keys are unique."""
    ev, end = _events_stream(spark, sf_dir), S.End(spark)
    orders = T.orders_from_events(ev.where(F.col("event_type") == T.VIEW)).withColumn("next_id", F.col("seq") + 1)
    pays = T.payments_from_events(ev.where(F.col("event_type") == T.PURCHASE)).withColumn("next_id", F.col("seq"))
    out = S.stream_result(S.reconcile_unique(
        end.ending(orders), end.ending(pays), "next_id", ["order_id"], ["event_type"], HOUR, DELAY),
        "reconcile_unique_stream", end)
    return out.where("next_id is not null").select(  # not the end marks
        "next_id", "status", "o_order_id", F.unix_millis("o_et").alias("order_ms"),
        F.col("p_event_type").alias("channel"), F.unix_millis("p_et").alias("pay_ms"))


ORACLES["reconcile_unique_stream"] = "WITH " + _EV + """
, o AS (SELECT seq + 1 AS next_id, CAST(user_id AS VARCHAR) AS o_order_id, t FROM ev WHERE event_type = 'view')
, p AS (SELECT seq AS next_id, CASE WHEN k % 2 = 0 THEN 'weixin' ELSE 'zhifubao' END AS channel, t
        FROM ev WHERE event_type = 'purchase')
SELECT coalesce(o.next_id, p.next_id) AS next_id,
       CASE WHEN p.t IS NULL THEN 'unmatched_order' WHEN o.t IS NULL THEN 'unmatched_payment' ELSE 'matched' END AS status,
       o_order_id, o.t // 1000 AS order_ms, channel, p.t // 1000 AS pay_ms
FROM o FULL JOIN p ON o.next_id = p.next_id AND p.t BETWEEN o.t AND o.t + 3600000000"""

STREAM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    hot_items_stream, hot_urls_stream, pv_hourly_stream, uv_hourly_stream, distinct_items_hourly_stream,
    field_sum_hourly_stream, first_views_lines_stream, login_fail_burst_stream, login_fail_adjacent_stream, order_timeout_slot_stream,
    order_timeout_pattern_stream, order_pay_matches_stream, order_outcomes_stream, reconcile_stream,
    reconcile_matched_stream, reconcile_unmatched_orders_stream, reconcile_unmatched_payments_stream,
    reconcile_unique_stream)}

ORACLES["order_outcomes_stream"] = f"""
SELECT order_id, 'timeout' AS status, event_ms, NULL AS next_ms FROM ({ORACLES["order_timeout_pattern"]}) AS a
UNION ALL
SELECT order_id, 'match' AS status, event_ms, next_ms FROM ({ORACLES["order_pay_matches"]}) AS b"""
ORACLES["reconcile_stream"] = f"""
SELECT order_id, day, 'matched' AS status, order_type, order_ms, channel, pay_ms
FROM ({ORACLES["reconcile_matched"]}) AS m
UNION ALL
SELECT order_id, day, 'unmatched_order' AS status, order_type, order_ms, NULL, NULL
FROM ({ORACLES["reconcile_unmatched_orders"]}) AS uo
UNION ALL
SELECT order_id, day, 'unmatched_payment' AS status, NULL, NULL, channel, pay_ms
FROM ({ORACLES["reconcile_unmatched_payments"]}) AS up"""
ORACLES.update({name: ORACLES[name.removesuffix("_stream")] for name in STREAM_QUERIES if name not in ORACLES})
QUERIES.update(STREAM_QUERIES)
