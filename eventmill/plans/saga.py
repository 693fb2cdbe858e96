"""The order saga in batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill import constants as C
from eventmill.functions import ids
from eventmill.operators import saga
from eventmill.plans import sql
from eventmill.session import written
from eventmill.sources import driver_tables as tables


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One order request per OrderCreated event."""
    return tables.orders_in(tables.event_log(spark, sf_dir)).select(
        "order_id", "item", "seq", "quantity"
    )


def outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return saga.run_saga(
        requests(spark, sf_dir), tables.stock(spark, sf_dir), tables.prices(spark, sf_dir)
    )


def finished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outcome as a written table, for reports that read it more than once."""
    return written(outcome(spark, sf_dir), "saga-outcome")


def live_in(done: DataFrame) -> DataFrame:
    """Live reservations after a finished saga."""
    return done.filter("reserved AND NOT released").select("order_id", "item", "quantity")


def price_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tables.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_partkey").cast("string").alias("item"),
        F.col("l_quantity").alias("quantity"),
    )
    return saga.price_lookup(lines, tables.prices(spark, sf_dir))


def payment_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    reserved = requests(spark, sf_dir).select(
        ids.derived_id(F.col("order_id"), F.lit(C.INVENTORY_RESERVED)).alias("event_id"),
        "order_id",
        "item",
        "quantity",
    )
    return saga.payment_outcome(reserved, tables.prices(spark, sf_dir))


def _reserve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return saga.reserve_stock(requests(spark, sf_dir), tables.stock(spark, sf_dir))


def reserve_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reserve(spark, sf_dir).drop("error")


def reserve_resubmitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reservation where an item's requests share a few order ids, so many are resubmitted."""
    again = requests(spark, sf_dir).withColumn(
        "order_id", F.concat_ws("-", "item", (F.col("quantity") % 3).cast("string"))
    )
    small = again.withColumn("quantity", F.col("quantity") * 5)
    return saga.reserve_stock(small, tables.stock(spark, sf_dir))


def release_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reservations by unconditional reserve, given back where the charge fails."""
    reservations = _reserve(spark, sf_dir).filter("reserved").select("order_id", "item", "quantity")
    failing = requests(spark, sf_dir).filter(
        ~saga.payment_succeeds(F.col("order_id"), C.PAYMENT_FAILURE_RATE)
    )
    # Every failure is delivered twice; the second gives nothing back.
    both = F.array(F.col("seq"), F.col("seq") + 1)
    twice = failing.select("order_id", F.explode(both).alias("seq"))
    return saga.release_stock(reservations, twice)


def stock_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return saga.stock_balance(tables.stock(spark, sf_dir), live_in(outcome(spark, sf_dir)))


def order_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tables.event_log(spark, sf_dir).withColumn("order_id", F.col("key"))
    orders = tables.order_table(spark, sf_dir).select(
        "order_id", F.lit(C.PENDING).alias("status")
    )
    return saga.order_status(orders, events)


def order_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of every order a line item names, shifted so that some are not found."""
    asked = tables.table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 2).cast("string").alias("order_id")
    )
    return saga.order_lookup(tables.order_table(spark, sf_dir), asked)


def saga_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcome(spark, sf_dir)


def saga_final_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status derived from the published events instead of the outcome."""
    pending = requests(spark, sf_dir).filter(saga.request_is_valid()).select(
        "order_id", F.lit(C.PENDING).alias("status")
    )
    return saga.order_status(pending, saga.saga_events(outcome(spark, sf_dir)))


QUERIES = {
    "price_lookup": price_lookup,
    "payment_outcome": payment_outcome,
    "reserve_stock": reserve_stock,
    "reserve_resubmitted": reserve_resubmitted,
    "release_stock": release_stock,
    "stock_balance": stock_balance,
    "order_status": order_status,
    "order_lookup": order_lookup,
    "saga_outcome": saga_outcome,
    "saga_final_status": saga_final_status,
}

_REQUESTS = """requests AS (
  SELECT order_id, item, seq, quantity, true AS holds FROM created)"""
RESERVED = f"WITH RECURSIVE {sql.LOG}, {sql.CREATED}, {sql.STOCK}, {_REQUESTS}, " + sql.fold(
    "requests"
)
_PRICE = f"coalesce(p.price, {C.DEFAULT_UNIT_PRICE}::DOUBLE)"
PAYS = f"{sql.draw('order_id')} >= {C.PAYMENT_FAILURE_RATE}"
_REASON = f"""CASE WHEN available_before IS NULL THEN '{C.UNKNOWN_ITEM}'
       WHEN NOT reserved THEN '{C.INSUFFICIENT_STOCK}' END"""

RESERVE_STOCK = f"""{RESERVED}
SELECT order_id, item, seq, quantity, available_before, reserved,
       CASE WHEN reserved THEN 'InventoryReserved' ELSE 'InventoryReservationFailed' END
         AS event_type,
       {_REASON} AS reason
FROM decided"""

SAGA = f"""WITH RECURSIVE {sql.LOG}, {sql.CREATED}, {sql.STOCK}, {sql.PRICES},
requests AS (SELECT order_id, item, seq, quantity, {PAYS} AS holds FROM created
             WHERE quantity > 0),
{sql.fold("requests")},
outcome AS (
  SELECT order_id, d.item, seq, quantity, available_before, reserved,
         CASE WHEN reserved THEN {_PRICE} * quantity END AS amount,
         CASE WHEN reserved AND holds THEN 'COMPLETED'
              WHEN reserved THEN 'FAILED' END AS payment_status,
         reserved AND NOT holds AS released,
         CASE WHEN reserved AND holds THEN 'COMPLETED' ELSE 'CANCELLED' END AS status,
         coalesce({_REASON}, CASE WHEN NOT holds THEN '{C.PAYMENT_DECLINED}' END) AS reason
  FROM decided d LEFT JOIN prices p ON p.item = d.item)"""

ORDER_STATUS = f"""WITH {sql.LOG},
last AS (
  SELECT key, arg_max(CASE event_type WHEN 'PaymentCompleted' THEN 'COMPLETED'
                      ELSE 'CANCELLED' END, seq) AS status
  FROM log WHERE event_type IN ('PaymentCompleted', 'PaymentFailed') GROUP BY key)
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, coalesce(l.status, 'PENDING') AS status
FROM orders LEFT JOIN last l ON l.key = CAST(o_orderkey AS VARCHAR)"""

ORACLE = {
    "price_lookup": f"""WITH {sql.PRICES}
SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS item, l_quantity AS quantity,
       {_PRICE} AS price, {_PRICE} * l_quantity AS amount
FROM lineitem LEFT JOIN prices p ON p.item = CAST(l_partkey AS VARCHAR)""",
    "payment_outcome": f"""WITH {sql.LOG}, {sql.CREATED}, {sql.PRICES}
SELECT {sql.derived_id(sql.derived_id("order_id", "'InventoryReserved'"), "'payment'")}
         AS payment_id,
       {sql.derived_id("order_id", "'InventoryReserved'")} AS event_id,
       order_id, c.item, quantity, {_PRICE} AS price, {_PRICE} * quantity AS amount,
       CASE WHEN {PAYS} THEN 'COMPLETED' ELSE 'FAILED' END AS payment_status,
       CASE WHEN {PAYS} THEN 'PaymentCompleted' ELSE 'PaymentFailed' END AS event_type,
       CASE WHEN NOT ({PAYS}) THEN '{C.PAYMENT_DECLINED}' END AS reason
FROM created c LEFT JOIN prices p ON p.item = c.item""",
    "reserve_stock": RESERVE_STOCK,
    "reserve_resubmitted": f"""WITH RECURSIVE {sql.LOG}, {sql.CREATED}, {sql.STOCK},
numbered AS (
  SELECT item || '-' || (quantity % 3) AS order_id, item, seq, quantity * 5 AS quantity,
         row_number() OVER (PARTITION BY item ORDER BY seq) AS rn FROM created),
fold AS (
  SELECT item, CAST(0 AS BIGINT) AS rn, CAST(available_quantity AS BIGINT) AS after_it,
         CAST(NULL AS BIGINT) AS available_before, false AS reserved, false AS wrong,
         CAST([] AS VARCHAR[]) AS held, CAST(NULL AS BIGINT) AS seq
  FROM stock
  UNION ALL
  SELECT f.item, n.rn,
         CASE WHEN f.after_it >= n.quantity AND NOT list_contains(f.held, n.order_id)
              THEN f.after_it - n.quantity ELSE f.after_it END,
         f.after_it, f.after_it >= n.quantity AND NOT list_contains(f.held, n.order_id),
         f.after_it >= n.quantity AND list_contains(f.held, n.order_id),
         CASE WHEN f.after_it >= n.quantity THEN list_append(f.held, n.order_id) ELSE f.held END,
         n.seq
  FROM fold f JOIN numbered n ON n.item = f.item AND n.rn = f.rn + 1)
SELECT n.order_id, n.item, n.seq, CAST(n.quantity AS INTEGER) AS quantity, f.available_before,
       coalesce(f.reserved, false) AS reserved,
       CASE WHEN f.wrong THEN 'order already reserved' END AS error,
       CASE WHEN f.reserved THEN 'InventoryReserved'
            WHEN coalesce(f.wrong, false) THEN NULL ELSE 'InventoryReservationFailed' END
         AS event_type,
       CASE WHEN f.available_before IS NULL THEN '{C.UNKNOWN_ITEM}'
            WHEN NOT f.reserved AND NOT f.wrong THEN '{C.INSUFFICIENT_STOCK}' END AS reason
FROM numbered n LEFT JOIN fold f ON f.seq = n.seq""",
    "release_stock": f"""{RESERVED}
SELECT order_id, item, quantity, seq AS released_seq FROM decided
WHERE reserved AND NOT ({PAYS})""",
    "stock_balance": f"""{SAGA},
held AS (SELECT item, sum(quantity) AS q, count(*) AS n FROM outcome
         WHERE reserved AND NOT released GROUP BY item)
SELECT s.item, available_quantity, CAST(coalesce(q, 0) AS BIGINT) AS reserved_quantity,
       coalesce(n, 0) AS reservations,
       CAST(available_quantity - coalesce(q, 0) AS BIGINT) AS closing_quantity
FROM stock s LEFT JOIN held h ON h.item = s.item""",
    "order_status": ORDER_STATUS,
    "order_lookup": """WITH asked AS (SELECT DISTINCT l_orderkey * 2 AS id FROM lineitem)
SELECT CAST(id AS VARCHAR) AS order_id,
       CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'PENDING'
                          WHEN 'P' THEN 'CANCELLED' END AS status,
       o_orderkey IS NOT NULL AS found
FROM asked LEFT JOIN orders ON o_orderkey = id""",
    "saga_outcome": f"{SAGA} SELECT * FROM outcome",
    "saga_final_status": f"{SAGA} SELECT order_id, status FROM outcome",
}
