"""Further event reports."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill import constants as C
from eventmill.functions import times
from eventmill.operators import analytics, extras, ordered_fold
from eventmill.plans import reliability as batch_reliability
from eventmill.plans import sql
from eventmill.plans.analytics import JOIN_WINDOW
from eventmill.sources import driver_tables as tables

SESSION_GAP = "6 hours"
CLIENT_LIMIT = 4
HIGH_TOTAL = 300000.0


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.event_log(spark, sf_dir)


def high_value_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    payments = tables.payments_in(_log(spark, sf_dir))
    return extras.high_value_payments(payments).select("seq", "key", "payment_id", "amount")


def item_quantity_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extras.item_quantity_totals(tables.orders_in(_log(spark, sf_dir)))


def payment_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extras.payment_branches(_log(spark, sf_dir)).select("branch", "seq", "key", "amount")


def latest_event_per_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir)
    payment = F.col("event_type").startswith("Payment")
    return extras.latest_event_per_order(
        tables.orders_in(log).select("key", "seq", "event_type"),
        log.filter(payment).select("key", "seq", "event_type"),
    )


def failed_payment_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir)
    failures = tables.of_type(log, C.PAYMENT_FAILED)
    return extras.failed_payment_orders(tables.orders_in(log), failures).select("key", "seq")


def unpaid_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir)
    unpaid = extras.unpaid_orders(tables.orders_in(log), tables.payments_in(log), JOIN_WINDOW)
    return unpaid.select("key", "seq", "order_id")


def enrich_latest_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the amount of the latest purchase of their item as its price."""
    log = _log(spark, sf_dir)
    changes = tables.payments_in(log).select("item", "seq", F.col("amount").alias("price"))
    orders = tables.orders_in(log).select("seq", "item", "quantity")
    return extras.enrich_latest_price(orders, changes)


def hopping_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = tables.orders_in(_log(spark, sf_dir))
    return analytics.item_orders_per_window(orders, "5 hours", "1 hour")


def session_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    sessions = extras.session_counts(_log(spark, sf_dir), ["key"], SESSION_GAP)
    return sessions.select(
        "key",
        times.plain(F.col("session_start")).alias("session_start"),
        times.plain(F.col("session_end")).alias("session_end"),
        "event_count",
    )


def customer_order_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extras.customer_order_counts(tables.order_table(spark, sf_dir), "customer_id")


def high_value_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extras.high_value_orders(tables.order_table(spark, sf_dir), "total", HIGH_TOTAL)


def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders before 1996 as the first version, later ones as the second with a currency."""
    orders = tables.table(spark, sf_dir, "orders")
    rows = orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_totalprice").alias("amount"),
        (F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")).alias("_old"),
    )
    old = rows.filter("_old").drop("_old")
    new = rows.filter("NOT _old").drop("_old").withColumn("currency", F.lit("EUR"))
    return extras.merge_versions(old, new, {"currency": "USD"})


def saga_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir).withColumn("order_id", F.col("key"))
    metrics = extras.saga_metrics(
        log,
        retries=batch_reliability.retry_requeue(spark, sf_dir),
        dead_letters=batch_reliability.dlq_route(spark, sf_dir),
    )
    return metrics.select("metric", F.round("value", 6).alias("value"))


def client_rate_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extras.client_rate_limit(_log(spark, sf_dir), "key", CLIENT_LIMIT, "1 day")


def out_of_order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = tables.late_events(spark, sf_dir)
    return extras.out_of_order_events(late).select("key", "seq", "event_time", "previous_time")


def saga_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extras.saga_state(_log(spark, sf_dir).withColumn("order_id", F.col("key")))


def open_quantity_start(key: tuple) -> int:
    return 0


def open_quantity(key: tuple, state: int, rows: pd.DataFrame) -> tuple[int, pd.DataFrame]:
    """A user's handler: quantity ordered for a key since its last payment, after each event."""
    paid = (rows["event_type"] == C.PAYMENT_COMPLETED).to_numpy()
    ordered = np.where(paid, 0, rows["quantity"].fillna(0).to_numpy(dtype="int64"))
    total = state + np.cumsum(ordered)
    at_payment = np.maximum.accumulate(np.where(paid, np.arange(1, len(rows) + 1), 0))
    since = np.where(at_payment > 0, total - total[at_payment - 1], total)
    return int(since[-1]), pd.DataFrame(
        {"key": rows["key"], "seq": rows["seq"], "open_quantity": since}
    )


OPEN_QUANTITY = "key STRING, seq BIGINT, open_quantity BIGINT"


def open_quantity_events(events: DataFrame) -> DataFrame:
    """Orders and payments, as the handler reads them."""
    kinds = F.col("event_type").isin(C.ORDER_CREATED, C.PAYMENT_COMPLETED)
    return events.filter(kinds).select(
        "key", "seq", "event_type", F.col("quantity").cast("bigint").alias("quantity")
    )


def fold_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's function over each key's events in order."""
    events = open_quantity_events(tables.event_log(spark, sf_dir))
    return ordered_fold.fold_in_order(
        events, ["key"], "seq", open_quantity_start, open_quantity, OPEN_QUANTITY
    )


QUERIES = {
    "fold_orders": fold_orders,
    "high_value_payments": high_value_payments,
    "item_quantity_totals": item_quantity_totals,
    "payment_branches": payment_branches,
    "latest_event_per_order": latest_event_per_order,
    "failed_payment_orders": failed_payment_orders,
    "unpaid_orders": unpaid_orders,
    "enrich_latest_price": enrich_latest_price,
    "hopping_counts": hopping_counts,
    "session_counts": session_counts,
    "customer_order_counts": customer_order_counts,
    "high_value_orders": high_value_orders,
    "schema_evolution": schema_evolution,
    "saga_metrics": saga_metrics,
    "client_rate_limit": client_rate_limit,
    "out_of_order_events": out_of_order_events,
    "saga_state": saga_state,
}

SESSION_COUNTS = f"""WITH {sql.LOG},
g AS (SELECT *, CASE WHEN event_time - lag(event_time) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END
        AS starts FROM log WINDOW w AS (PARTITION BY key ORDER BY event_time)),
s AS (SELECT *, sum(starts) OVER (PARTITION BY key ORDER BY event_time
        RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session FROM g)
SELECT key, min(event_time) AS session_start, max(event_time) + INTERVAL 6 HOUR AS session_end,
       count(*) AS event_count
FROM s GROUP BY key, session"""

UNPAID = f"""WITH {sql.LOG}, {sql.CREATED}, {sql.PAID}
SELECT key, seq, order_id FROM created o WHERE NOT EXISTS (
  SELECT 1 FROM paid p WHERE p.key = o.key AND p.event_time
  BETWEEN o.event_time - INTERVAL 60 MINUTE AND o.event_time + INTERVAL 60 MINUTE)"""

FOLD_ORDERS = f"""WITH {sql.LOG},
runs AS (
  SELECT *, count(*) FILTER (event_type = 'PaymentCompleted')
              OVER (PARTITION BY key ORDER BY seq) AS run
  FROM log WHERE event_type IN ('OrderCreated', 'PaymentCompleted'))
SELECT key, seq,
       CAST(sum(CASE WHEN event_type = 'OrderCreated' THEN quantity ELSE 0 END)
              OVER (PARTITION BY key, run ORDER BY seq) AS BIGINT) AS open_quantity
FROM runs"""

ORACLE = {
    "fold_orders": FOLD_ORDERS,
    "high_value_payments": f"""WITH {sql.LOG}, {sql.PAID}
SELECT seq, key, order_id AS payment_id, amount FROM paid WHERE amount > 100""",
    "item_quantity_totals": f"""WITH {sql.LOG}, {sql.CREATED}
SELECT item, CAST(sum(quantity) AS BIGINT) AS total_quantity FROM created GROUP BY item""",
    "payment_branches": f"""WITH {sql.LOG}
SELECT CASE event_type WHEN 'PaymentCompleted' THEN 'payments-ok' ELSE 'payments-failed' END
         AS branch, seq, key, amount
FROM log WHERE event_type LIKE 'Payment%'""",
    "latest_event_per_order": f"""WITH {sql.LOG}
SELECT key, arg_max(event_type, seq) AS event_type, max(seq) AS seq FROM log
WHERE event_type IN ('OrderCreated', 'PaymentCompleted', 'PaymentFailed') GROUP BY key""",
    "failed_payment_orders": f"""WITH {sql.LOG}, {sql.CREATED}, {sql.FAILED}
SELECT key, seq FROM created WHERE key IN (SELECT key FROM failed)""",
    "unpaid_orders": UNPAID,
    "enrich_latest_price": f"""WITH {sql.LOG}, {sql.CREATED}, {sql.PAID},
last AS (SELECT item, arg_max(amount, seq) AS price FROM paid GROUP BY item)
SELECT c.item, c.seq, c.quantity, l.price FROM created c LEFT JOIN last l ON l.item = c.item""",
    "hopping_counts": f"""WITH {sql.LOG}, {sql.CREATED},
hops AS (SELECT item, date_trunc('hour', event_time) - to_hours(CAST(h AS INTEGER)) AS window_start
         FROM created, range(5) r(h))
SELECT item || '@' || strftime(window_start, '{sql.ISO}') AS item_window, item, window_start,
       count(*) AS order_count
FROM hops GROUP BY item, window_start""",
    "session_counts": SESSION_COUNTS,
    "customer_order_counts": """SELECT o_custkey AS customer_id, count(*) AS order_count
FROM orders GROUP BY o_custkey""",
    "high_value_orders": f"""SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
       o_custkey AS customer_id, o_totalprice AS total,
       CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'PENDING'
                          ELSE 'CANCELLED' END AS status
FROM orders WHERE o_totalprice > {HIGH_TOTAL}""",
    "schema_evolution": """SELECT o_orderkey AS order_id, o_totalprice AS amount,
       CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN 'USD' ELSE 'EUR' END AS currency
FROM orders""",
    "saga_metrics": f"""{batch_reliability.RETRIED}, {sql.RECORDS}, {sql.STRICT},
t AS (SELECT key, min(event_time) FILTER (event_type = 'OrderCreated') AS c,
             min(event_time) FILTER (event_type = 'PaymentCompleted') AS p FROM log GROUP BY key),
w AS (SELECT (epoch_us(p) - epoch_us(c)) / 1000000.0 AS s FROM t WHERE p >= c)
SELECT event_type AS metric, round(CAST(count(*) AS DOUBLE), 6) AS value FROM log GROUP BY 1
UNION ALL SELECT 'paid_orders', CAST(count(*) AS DOUBLE) FROM w
UNION ALL SELECT 'completion_seconds_p50', round(quantile_cont(s, 0.5), 6) FROM w
UNION ALL SELECT 'completion_seconds_p95', round(quantile_cont(s, 0.95), 6) FROM w
UNION ALL SELECT 'retries', CAST(count(*) AS DOUBLE) FROM retried
UNION ALL SELECT 'dead_letters', CAST(count(*) AS DOUBLE) FROM strict
WHERE error IS NOT NULL""",
    "client_rate_limit": f"""WITH {sql.LOG}
SELECT key, date_trunc('day', event_time) AS window_start, count(*) AS request_count
FROM log GROUP BY 1, 2 HAVING count(*) > {CLIENT_LIMIT}""",
    "out_of_order_events": f"""WITH {sql.LOG},
late AS (SELECT * REPLACE (event_time - to_minutes(quantity) AS event_time) FROM log),
p AS (SELECT *, lag(event_time) OVER (PARTITION BY key ORDER BY seq) AS previous_time FROM late)
SELECT key, seq, event_time, previous_time FROM p WHERE previous_time > event_time""",
    "saga_state": f"""WITH {sql.LOG},
last AS (SELECT key, arg_max(event_type, seq) AS kind FROM log
         WHERE event_type IN ('OrderCreated', 'PaymentCompleted', 'PaymentFailed') GROUP BY key)
SELECT key AS order_id, kind AS last_event,
       CASE kind WHEN 'OrderCreated' THEN 'STARTED' WHEN 'PaymentCompleted' THEN 'COMPLETED'
                 ELSE 'COMPENSATING' END AS state,
       CASE kind WHEN 'OrderCreated' THEN 'reserve inventory' WHEN 'PaymentCompleted' THEN 'none'
                 ELSE 'release inventory' END AS current_step
FROM last""",
}
