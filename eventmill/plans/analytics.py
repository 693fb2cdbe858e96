"""Analytics branches in batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.operators import analytics, decode
from eventmill.plans import sql
from eventmill.sources import driver_tables as tables
from eventmill.sources import topics

# The tables hold about one event every four minutes, so windows are wider than the defaults.
WINDOW = "1 hour"
JOIN_WINDOW = "60 minutes"
MIN_QUANTITY = 50


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.orders_in(tables.event_log(spark, sf_dir))


def _payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.payments_in(tables.event_log(spark, sf_dir))


def large_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large orders of the topic, many of whose records are damaged, with their own payload."""
    records = tables.topic_records(spark, sf_dir)
    orders = decode.order_created(decode.decode_lenient(records))
    large = analytics.large_orders(orders, MIN_QUANTITY)
    return large.select("key", F.col("payload").alias("value"))


def item_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.item_counts(_orders(spark, sf_dir))


def item_counts_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = analytics.item_counts(_orders(spark, sf_dir))
    wire = topics.long_records(counts, "item", "order_count")
    return wire.select("key", F.hex("value").alias("value_hex"))


def item_count_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.item_count_changelog(_orders(spark, sf_dir))


def item_orders_per_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.item_orders_per_window(_orders(spark, sf_dir), WINDOW)


def window_late_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = tables.orders_in(tables.late_events(spark, sf_dir))
    kept = analytics.drop_late(late, by="partition", seq="seq", size=WINDOW, grace="30 minutes")
    return analytics.item_orders_per_window(kept, WINDOW)


def paid_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.paid_orders(_orders(spark, sf_dir), _payments(spark, sf_dir), JOIN_WINDOW)


def counts_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = tables.table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("item")
    )
    return analytics.counts_lookup(analytics.item_counts(_orders(spark, sf_dir)), asked)


QUERIES = {
    "large_orders": large_orders,
    "item_counts": item_counts,
    "item_counts_topic": item_counts_topic,
    "item_count_changelog": item_count_changelog,
    "item_orders_per_window": item_orders_per_window,
    "window_late_drop": window_late_drop,
    "paid_orders": paid_orders,
    "counts_lookup": counts_lookup,
}

ITEM_COUNTS = f"""WITH {sql.LOG}, {sql.CREATED}
SELECT item, count(*) AS order_count FROM created GROUP BY item"""

CHANGELOG = f"""WITH {sql.LOG}, {sql.CREATED}
SELECT seq, item, count(*) OVER (PARTITION BY item ORDER BY seq) AS order_count FROM created"""

PER_WINDOW = f"""SELECT item || '@' || strftime(date_trunc('hour', event_time), '{sql.ISO}')
         AS item_window,
       item, date_trunc('hour', event_time) AS window_start, count(*) AS order_count"""

ITEM_ORDERS_PER_WINDOW = f"""WITH {sql.LOG}, {sql.CREATED}
{PER_WINDOW} FROM created GROUP BY item, date_trunc('hour', event_time)"""

PAID_ORDERS = f"""WITH {sql.LOG}, {sql.CREATED}, {sql.PAID}
SELECT o.key, o.order_id, o.item, o.quantity, p.order_id AS payment_id, p.amount,
       greatest(o.event_time, p.event_time) AS event_time
FROM created o JOIN paid p ON o.key = p.key
 AND p.event_time BETWEEN o.event_time - INTERVAL 60 MINUTE AND o.event_time + INTERVAL 60 MINUTE"""

LARGE_ORDERS = f"""WITH {sql.LOG}, {sql.RECORDS}
SELECT key, body AS value FROM records
WHERE event_type = 'OrderCreated' AND {sql.LENIENT} AND k NOT BETWEEN 55 AND 59
  AND {sql.LENIENT_QUANTITY} >= {MIN_QUANTITY}"""

ORACLE = {
    "large_orders": LARGE_ORDERS,
    "item_counts": ITEM_COUNTS,
    "item_counts_topic": f"""WITH {sql.LOG}, {sql.CREATED}
SELECT item AS key, lpad(to_hex(count(*)), 16, '0') AS value_hex FROM created GROUP BY item""",
    "item_count_changelog": CHANGELOG,
    "item_orders_per_window": ITEM_ORDERS_PER_WINDOW,
    "window_late_drop": f"""WITH {sql.LOG},
late AS (SELECT * REPLACE (event_time - to_minutes(quantity) AS event_time) FROM log
         WHERE event_type = 'OrderCreated'),
seen AS (SELECT *, max(event_time) OVER (PARTITION BY partition ORDER BY seq) AS stream_time
         FROM late)
{PER_WINDOW} FROM seen
WHERE date_trunc('hour', event_time) + INTERVAL 1 HOUR + INTERVAL 30 MINUTE > stream_time
GROUP BY item, date_trunc('hour', event_time)""",
    "paid_orders": PAID_ORDERS,
    "counts_lookup": f"""WITH {sql.LOG}, {sql.CREATED}
SELECT CAST(p_partkey AS VARCHAR) AS item, count(c.seq) AS order_count
FROM part LEFT JOIN created c ON c.item = CAST(p_partkey AS VARCHAR) GROUP BY p_partkey""",
}
