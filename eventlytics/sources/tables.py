"""Adapters from the driver's ``events`` table to the reference's records.

``events(event_id, ts TIMESTAMP_NTZ, user_id, event_type, value, props)``
has unique ascending ``ts``; ``props`` is ``{"k": 0..99}``. The mapping:

* behaviour: item = ``k``, category = ``k div 10``, ``view`` -> ``pv``,
  ``purchase`` -> ``buy``;
* logins: ``error`` -> ``fail``, anything else -> ``success``;
* orders: key = user, ``view`` -> ``create``, ``purchase`` -> ``pay``;
* payments: ``purchase`` rows, channel from the parity of ``k``;
* access log: each event rendered as a log line (ip from the user,
  url ``/k/<k>``) and parsed back with the access-log parser.

Every adapter keeps ``et`` (TIMESTAMP, UTC) and ``seq`` (= ``event_id``) so
that all orderings are total and match the SQL oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlytics.functions.time import event_time_from
from eventlytics.sources.files import LOG_TIME_FORMAT, parse_access_log

# Fixed values of the mapping above.
VIEW, PURCHASE, ERROR = "view", "purchase", "error"
PAY_CHANNELS = ("weixin", "zhifubao")


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, name: str, schema: str,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """The same table as a file stream, whether ``<name>.parquet`` is one
    file or a directory of part files.

    Without ``max_files_per_trigger`` a backlog is one micro-batch. With it,
    files may arrive in any order, and rows that overtake others by more
    than the watermark delay make those late: choose the delay accordingly.
    """
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    # a pattern, as a file stream takes a plain path for a directory
    return r.parquet(f"{sf_dir.rstrip('/')}/{name}.parque[t]")


EVENTS_SCHEMA = ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
                 "value DOUBLE, props STRING")


def _item() -> F.Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def _et() -> F.Column:
    return event_time_from("ts", "timestamp")


def behavior_from_events(events: DataFrame) -> DataFrame:
    item = _item()
    return events.select(
        F.col("user_id"), item.alias("item_id"), F.floor(item / 10).cast("int").alias("category_id"),
        F.when(F.col("event_type") == VIEW, "pv").when(F.col("event_type") == PURCHASE, "buy")
         .otherwise(F.col("event_type")).alias("behavior"),
        F.unix_seconds(_et()).alias("ts_s"), _et().alias("et"), F.col("event_id").alias("seq"))


def logins_from_events(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id"),
        F.concat(F.lit("192.168."), _item().cast("string"), F.lit("."),
                 (F.col("user_id") % 256).cast("string")).alias("ip"),
        F.when(F.col("event_type") == ERROR, "fail").otherwise("success").alias("event_type"),
        F.unix_seconds(_et()).alias("ts_s"), _et().alias("et"), F.col("event_id").alias("seq"))


def orders_from_events(events: DataFrame, only_orders_and_payments: bool = False) -> DataFrame:
    if only_orders_and_payments:
        events = events.where(F.col("event_type").isin(VIEW, PURCHASE))
    return events.select(
        F.col("user_id").cast("string").alias("order_id"),
        F.when(F.col("event_type") == VIEW, "create").when(F.col("event_type") == PURCHASE, "pay")
         .otherwise(F.col("event_type")).alias("event_type"),
        F.unix_seconds(_et()).cast("string").alias("event_time"),
        _et().alias("et"), F.col("event_id").alias("seq"))


def payments_from_events(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") == PURCHASE).select(
        F.col("user_id").cast("string").alias("order_id"),
        F.when(_item() % 2 == 0, PAY_CHANNELS[0]).otherwise(PAY_CHANNELS[1]).alias("event_type"),
        F.unix_seconds(_et()).cast("string").alias("event_time"),
        _et().alias("et"), F.col("event_id").alias("seq"))


def behavior_lines_from_events(events: DataFrame) -> DataFrame:
    """Render each event as a behaviour CSV line (column ``value``)."""
    b = behavior_from_events(events)
    return b.select(F.concat_ws(",", *[F.col(c).cast("string") for c in (
        "user_id", "item_id", "category_id", "behavior", "ts_s")]).alias("value"))


def access_lines_from_events(events: DataFrame) -> DataFrame:
    """Render each event as an access-log line (column ``value``)."""
    ip = F.concat(F.lit("10.0."), (F.col("user_id") % 256).cast("string"), F.lit("."),
                  _item().cast("string"))
    method = F.when(F.col("event_type") == PURCHASE, "POST").otherwise("GET")
    return events.select(F.concat_ws(
        " ", ip, F.lit("-"), F.col("user_id").cast("string"),
        F.date_format(F.col("ts"), LOG_TIME_FORMAT), F.lit("+0000"), method,
        F.concat(F.lit("/k/"), _item().cast("string"))).alias("value"))


def access_log_from_events(events: DataFrame) -> DataFrame:
    return parse_access_log(access_lines_from_events(events))
