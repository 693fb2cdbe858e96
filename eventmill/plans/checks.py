"""Operational checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill import constants as C
from eventmill.operators import checks, hot_keys, saga
from eventmill.plans import saga as saga_plans
from eventmill.plans import sql
from eventmill.sources import driver_tables as tables

GROUP = "counting-job"


def consumer_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lag of a group that stopped after the last order of each partition."""
    log = tables.event_log(spark, sf_dir).select(
        F.lit(C.ORDER_EVENTS).alias("topic"), "partition", "seq", "event_type"
    )
    numbered = hot_keys.running_count(log, ["topic", "partition"], "seq", "_n")
    records = numbered.withColumn("offset", F.col("_n") - 1)
    committed = (
        tables.orders_in(records)
        .groupBy("topic", "partition")
        .agg((F.max("offset") + 1).alias("committed_offset"))
        .withColumn("group", F.lit(GROUP))
    )
    return checks.consumer_lag(records, committed)


def key_partition_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.key_partition_check(tables.topic_records(spark, sf_dir))


def misplaced_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events placed by their number instead of their key."""
    records = tables.event_log(spark, sf_dir).select(
        "key", F.pmod(F.col("seq"), F.lit(C.TOPIC_PARTITIONS)).alias("partition")
    )
    return checks.misplaced_keys(records)


def order_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = tables.event_log(spark, sf_dir)
    payment = F.col("event_type").startswith("Payment")
    orders = log.filter(~payment).withColumn("topic", F.lit(C.ORDER_EVENTS))
    payments = log.filter(payment).withColumn("topic", F.lit(C.PAYMENT_EVENTS))
    return checks.order_timeline(orders, payments).select(
        "key", "seq", "topic", "event_type", "event_time"
    )


def saga_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit on a finished saga: nothing is broken."""
    done = saga_plans.finished(spark, sf_dir)
    live = saga_plans.live_in(done)
    payments = done.filter("payment_status IS NOT NULL").select(
        "order_id", F.col("payment_status").alias("status")
    )
    balance = saga.stock_balance(tables.stock(spark, sf_dir), live)
    return checks.saga_audit(
        done.select("order_id", "status"), live, payments, saga.saga_events(done), balance
    )


def log_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit on the raw tables, which no saga produced: most checks find something.

    Every created order of the log counts as a live reservation of order ``key``; every
    purchase as a completed payment.
    """
    log = tables.event_log(spark, sf_dir).withColumn("order_id", F.col("key"))
    reservations = tables.orders_in(log).select("order_id", "item", "quantity")
    payments = tables.of_type(log, C.PAYMENT_COMPLETED).select(
        "order_id", F.lit(C.PAYMENT_STATUS_COMPLETED).alias("status")
    )
    balance = saga.stock_balance(tables.stock(spark, sf_dir), reservations)
    return checks.saga_audit(
        tables.order_table(spark, sf_dir), reservations, payments, log, balance
    )


QUERIES = {
    "consumer_lag": consumer_lag,
    "key_partition_check": key_partition_check,
    "misplaced_keys": misplaced_keys,
    "order_timeline": order_timeline,
    "saga_audit": saga_audit,
    "log_audit": log_audit,
}

ORACLE = {
    "consumer_lag": f"""WITH {sql.LOG},
n AS (SELECT partition, event_type,
        row_number() OVER (PARTITION BY partition ORDER BY seq) AS position FROM log),
e AS (SELECT partition, max(position) AS end_offset,
        max(CASE WHEN event_type = 'OrderCreated' THEN position END) AS committed_offset
      FROM n GROUP BY partition)
SELECT '{GROUP}' AS "group", 'order.events' AS topic, partition, end_offset, committed_offset,
       end_offset - committed_offset AS lag
FROM e""",
    "key_partition_check": f"""WITH {sql.LOG},
k AS (SELECT {sql.topic("event_type")} AS topic, key, count(DISTINCT partition) AS parts
      FROM log GROUP BY 1, 2)
SELECT topic, count(*) AS key_count, count(*) FILTER (parts > 1) AS split_keys
FROM k GROUP BY topic""",
    "misplaced_keys": f"""WITH {sql.LOG}
SELECT key, min(seq % 3) AS low, max(seq % 3) AS high FROM log GROUP BY key
HAVING count(DISTINCT seq % 3) > 1""",
    "order_timeline": f"""WITH {sql.LOG}
SELECT key, seq, {sql.topic("event_type")} AS topic, event_type, event_time FROM log
ORDER BY key, seq""",
    "saga_audit": f"""{saga_plans.SAGA},
live AS (SELECT order_id, item, quantity FROM outcome WHERE reserved AND NOT released),
closing AS (SELECT s.item, available_quantity - coalesce(sum(l.quantity), 0) AS closing_quantity
            FROM stock s LEFT JOIN live l ON l.item = s.item GROUP BY s.item, available_quantity)
SELECT 'stock is never negative' AS check_name, count(*) AS violations
FROM closing WHERE closing_quantity < 0
UNION ALL
SELECT 'at most one live reservation per order', count(*)
FROM (SELECT order_id FROM live GROUP BY order_id HAVING count(*) > 1)
UNION ALL
SELECT 'a payment has its event', count(*) FROM outcome
WHERE payment_status IS NOT NULL AND NOT reserved
UNION ALL
SELECT 'a payment event has its payment', count(*) FROM outcome
WHERE reserved AND payment_status IS NULL
UNION ALL
SELECT 'a completed order holds its reservation', count(*) FROM outcome
WHERE status = 'COMPLETED' AND order_id NOT IN (SELECT order_id FROM live)
UNION ALL
SELECT 'a live reservation belongs to a completed order', count(*) FROM live
WHERE order_id NOT IN (SELECT order_id FROM outcome WHERE status = 'COMPLETED')""",
    "log_audit": f"""WITH {sql.LOG}, {sql.CREATED}, {sql.PAID}, {sql.FAILED}, {sql.STOCK},
closing AS (SELECT s.item, available_quantity - coalesce(sum(c.quantity), 0) AS closing_quantity
            FROM stock s LEFT JOIN created c ON c.item = s.item
            GROUP BY s.item, available_quantity),
done AS (SELECT CAST(o_orderkey AS VARCHAR) AS id FROM orders WHERE o_orderstatus = 'F')
SELECT 'stock is never negative' AS check_name, count(*) AS violations
FROM closing WHERE closing_quantity < 0
UNION ALL
SELECT 'at most one live reservation per order', count(*)
FROM (SELECT key FROM created GROUP BY key HAVING count(*) > 1)
UNION ALL
SELECT 'a payment has its event', 0
UNION ALL
SELECT 'a payment event has its payment', count(*) FROM failed
UNION ALL
SELECT 'a completed order holds its reservation', count(*) FROM done
WHERE id NOT IN (SELECT key FROM created)
UNION ALL
SELECT 'a live reservation belongs to a completed order', count(*) FROM created
WHERE key NOT IN (SELECT id FROM done)""",
}
