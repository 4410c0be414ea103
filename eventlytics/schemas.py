"""Record schemas of the reference's event types, as Spark DDL strings."""

# user behaviour CSV: useId, itemId, categoryId, behavior, timestamp (epoch s)
BEHAVIOR = "user_id BIGINT, item_id BIGINT, category_id INT, behavior STRING, ts_s BIGINT"
# access log after parsing; et is the request time
ACCESS_LOG = "ip STRING, user_id STRING, et TIMESTAMP, method STRING, url STRING"
# login attempts (epoch s)
LOGIN = "user_id BIGINT, ip STRING, event_type STRING, ts_s BIGINT"
# order and payment events: every field is text, time is epoch seconds as text
ORDER = "order_id STRING, event_type STRING, event_time STRING"
PAYMENT = "order_id STRING, event_type STRING, event_time STRING"
# intermediate results: per key and window end (epoch ms)
ITEM_VIEW_COUNT = "item_id BIGINT, window_end BIGINT, cnt BIGINT"
URL_VIEW_COUNT = "url STRING, window_end BIGINT, cnt BIGINT"
