"""Decoding of topic records, many of them damaged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill import constants as C
from eventmill.functions import ids, times
from eventmill.operators import decode, saga
from eventmill.plans import sql
from eventmill.sources import driver_tables as tables

HANDLED = (C.ORDER_CREATED, C.PAYMENT_COMPLETED, C.PAYMENT_FAILED)


def _lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.decode_lenient(tables.topic_records(spark, sf_dir))


def strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.decode_strict(tables.topic_records(spark, sf_dir), HANDLED)


def decode_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lenient(spark, sf_dir).select(
        "offset", "key", "event_id", "event_type", "aggregate_id"
    )


def event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lenient(spark, sf_dir).select(
        "offset", times.plain(F.col("event_time")).alias("event_time")
    )


def lenient_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.order_created(_lenient(spark, sf_dir)).select(
        "offset", "order_id", "item", "quantity"
    )


def lenient_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.payment_completed(_lenient(spark, sf_dir)).select(
        "offset", "payment_id", "amount"
    )


def topic_item_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = decode.order_created(_lenient(spark, sf_dir))
    return orders.groupBy("item").agg(F.count(F.lit(1)).alias("order_count"))


def decode_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    readable = F.coalesce(F.col("error") != "decode event:", F.lit(True))
    good = F.col("error").isNull()
    return strict(spark, sf_dir).select(
        "offset",
        F.when(good, ids.canonical_uuid(F.col("event_id"))).alias("event_id"),
        F.when(readable, F.col("event_type")).alias("event_type"),
        F.when(good, times.plain(F.col("event_time"))).alias("event_time"),
        "error",
    )


def decode_strict_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = decode.typed_payload(strict(spark, sf_dir), C.ORDER_CREATED)
    return orders.select("offset", "order_id", "item", "quantity")


def route_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = strict(spark, sf_dir).filter(F.col("error").isNull())
    routed = decode.route_by_type(good, HANDLED)
    return routed.select(F.concat("branch", F.lit(" handler")).alias("branch"), "offset", "key")


def validate_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = decode.typed_payload(strict(spark, sf_dir), C.ORDER_CREATED)
    return saga.validate_orders(requests).select(
        "offset", "item", "quantity", "accepted", "status"
    )


QUERIES = {
    "decode_lenient": decode_lenient,
    "event_time": event_time,
    "lenient_coercion": lenient_coercion,
    "lenient_payments": lenient_payments,
    "topic_item_counts": topic_item_counts,
    "decode_strict": decode_strict,
    "decode_strict_orders": decode_strict_orders,
    "route_by_type": route_by_type,
    "validate_orders": validate_orders,
}

_WITH = f"WITH {sql.LOG}, {sql.RECORDS}"
_LENIENT_ITEM = """CASE WHEN k BETWEEN 20 AND 24 OR k BETWEEN 35 AND 44 THEN ''
       WHEN k BETWEEN 25 AND 29 THEN 'null'
       WHEN k BETWEEN 70 AND 74 THEN ''
       WHEN k BETWEEN 75 AND 79 THEN '7'
       ELSE item END"""
_LENIENT_ORDERS = f"""FROM records
WHERE event_type = 'OrderCreated' AND {sql.LENIENT} AND k NOT BETWEEN 55 AND 59"""
_STRICT_ORDERS = """CASE WHEN k BETWEEN 20 AND 29 OR k BETWEEN 40 AND 44 THEN '' ELSE item END
         AS item,
       CASE WHEN k BETWEEN 20 AND 29 OR k BETWEEN 40 AND 44 THEN 0 WHEN k = 93 THEN 7 ELSE k END
         AS quantity"""

ORACLE = {
    "decode_lenient": f"""{_WITH}
SELECT "offset", key, CASE WHEN k = 94 THEN '' ELSE id_text END AS event_id,
       CASE WHEN k BETWEEN 55 AND 59 THEN '' ELSE event_type END AS event_type,
       key AS aggregate_id
FROM records WHERE {sql.LENIENT}""",
    "event_time": f"""{_WITH}
SELECT "offset", date_trunc('millisecond', CASE WHEN k BETWEEN 45 AND 54 OR k = 96
         THEN event_time + INTERVAL 5 SECOND ELSE event_time END) AS event_time
FROM records WHERE {sql.LENIENT}""",
    "lenient_coercion": f"""{_WITH}
SELECT "offset", CASE WHEN k BETWEEN 35 AND 44 THEN '' ELSE order_id END AS order_id,
  {_LENIENT_ITEM} AS item,
  {sql.LENIENT_QUANTITY} AS quantity
{_LENIENT_ORDERS}""",
    "lenient_payments": f"""{_WITH}
SELECT "offset", CASE WHEN k BETWEEN 35 AND 44 THEN '' ELSE order_id END AS payment_id,
       CASE WHEN k BETWEEN 35 AND 44 THEN 0.0 ELSE amount END AS amount
FROM records
WHERE event_type = 'PaymentCompleted' AND {sql.LENIENT} AND k NOT BETWEEN 55 AND 59""",
    "topic_item_counts": f"""{_WITH}
SELECT {_LENIENT_ITEM} AS item, count(*) AS order_count {_LENIENT_ORDERS} GROUP BY 1""",
    "decode_strict": f"""{_WITH}, {sql.STRICT}
SELECT "offset", CASE WHEN error IS NULL THEN id END AS event_id,
       CASE WHEN error IS NULL OR error <> 'decode event:' THEN event_type END AS event_type,
       CASE WHEN error IS NULL AND k NOT BETWEEN 50 AND 54
            THEN date_trunc('millisecond', event_time) END AS event_time,
       error
FROM strict""",
    "decode_strict_orders": f"""{_WITH}, {sql.STRICT}
SELECT "offset", CASE WHEN k BETWEEN 40 AND 44 THEN '' ELSE order_id END AS order_id,
       {_STRICT_ORDERS}
FROM strict WHERE error IS NULL AND event_type = 'OrderCreated'""",
    "route_by_type": f"""{_WITH}, {sql.STRICT}
SELECT event_type || ' handler' AS branch, "offset", key FROM strict
WHERE error IS NULL AND event_type IN ('OrderCreated', 'PaymentCompleted', 'PaymentFailed')""",
    "validate_orders": f"""{_WITH}, {sql.STRICT},
requests AS (SELECT "offset", {_STRICT_ORDERS}
  FROM strict WHERE error IS NULL AND event_type = 'OrderCreated')
SELECT *, item <> '' AND quantity > 0 AS accepted,
       CASE WHEN item <> '' AND quantity > 0 THEN 'PENDING' END AS status
FROM requests""",
}
