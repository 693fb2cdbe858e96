"""The operators as streaming jobs over the given tables, run until the input is used up.

Each run has fresh sink and checkpoint folders under the shared folder; the result is read
from the sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill import constants as C
from eventmill.functions import times
from eventmill.operators import analytics, decode, extras, reliability, saga
from eventmill.plans import analytics as batch
from eventmill.plans import extras as batch_extras
from eventmill.plans import reliability as batch_reliability
from eventmill.plans import saga as batch_saga
from eventmill.plans import sql
from eventmill.sources import driver_tables as tables
from eventmill.sources import state
from eventmill.streaming import jobs, runner

WINDOW = batch.WINDOW
JOIN_WINDOW = batch.JOIN_WINDOW


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.orders_in(tables.event_stream(spark, sf_dir))


def _payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.payments_in(tables.event_stream(spark, sf_dir))


def _appended(spark: SparkSession, name: str, stream: DataFrame) -> DataFrame:
    sink, checkpoint = runner.job_paths(spark, name)
    runner.run_append(stream, sink, checkpoint)
    return spark.read.schema(stream.schema).parquet(sink)


def _updated(spark: SparkSession, name: str, stream: DataFrame, keys: list[str]) -> DataFrame:
    sink, checkpoint = runner.job_paths(spark, name)
    runner.run_update(stream, sink, checkpoint, keys)
    return runner.read_latest(spark, sink, keys)


def stream_source_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic read from the start and decoded."""
    records = tables.topic_records(spark, sf_dir, streaming=True)
    decoded = decode.decode_lenient(records).select("offset", "key", "event_type")
    return _appended(spark, "replay", decoded)


def stream_large_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = tables.topic_records(spark, sf_dir, streaming=True)
    orders = decode.order_created(decode.decode_lenient(records))
    large = analytics.large_orders(orders, batch.MIN_QUANTITY)
    return _appended(spark, "large-orders", large.select("key", F.col("payload").alias("value")))


def stream_item_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = analytics.item_counts(_orders(spark, sf_dir))
    return _updated(spark, "item-counts", counts, ["item"])


def counts_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All counts, read from the state of the counting job instead of its output."""
    sink, checkpoint = runner.job_paths(spark, "counts-state")
    runner.run_update(analytics.item_counts(_orders(spark, sf_dir)), sink, checkpoint, ["item"])
    return state.read_counts(spark, checkpoint)


def stream_count_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _appended(spark, "changelog", jobs.count_changes(_orders(spark, sf_dir)))


def stream_item_orders_per_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = analytics.with_lateness(_orders(spark, sf_dir), C.COUNT_GRACE)
    counts = analytics.item_orders_per_window(orders, WINDOW)
    latest = _updated(spark, "per-window", counts, ["item_window"])
    return latest.withColumn("window_start", times.plain(F.col("window_start")))


def stream_final_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One final row per window, once no event can change it."""
    orders = analytics.with_lateness(_orders(spark, sf_dir), C.COUNT_GRACE)
    counts = analytics.item_orders_per_window(orders, WINDOW)
    final = _appended(spark, "final-windows", counts)
    return final.withColumn("window_start", times.plain(F.col("window_start")))


def stream_late_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows over late events, with lateness judged record by record."""
    late = tables.orders_in(tables.event_stream(spark, sf_dir)).withColumn(
        "event_time", F.expr("event_time - make_dt_interval(0, 0, quantity, 0)")
    )
    accepted = _appended(
        spark, "late", jobs.accepted_by_window(late, "partition", WINDOW, "30 minutes")
    )
    events = tables.orders_in(tables.late_events(spark, sf_dir))
    kept = events.join(accepted, "seq", "left_semi")
    return analytics.item_orders_per_window(kept, WINDOW)


def stream_paid_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    paid = analytics.paid_orders_stream(
        _orders(spark, sf_dir), _payments(spark, sf_dir), JOIN_WINDOW
    )
    joined = _appended(spark, "paid-orders", paid)
    return joined.withColumn("event_time", times.plain(F.col("event_time")))


def stream_unpaid_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that got no payment, emitted once that is certain."""
    joined = extras.unpaid_orders_stream(
        _orders(spark, sf_dir), _payments(spark, sf_dir), JOIN_WINDOW
    )
    rows = _appended(spark, "unpaid-orders", joined)
    return rows.filter("payment_id IS NULL").select("key", "order_id")


def stream_session_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = analytics.with_lateness(tables.event_stream(spark, sf_dir), C.COUNT_GRACE)
    sessions = extras.session_counts_stream(events, ["key"], batch_extras.SESSION_GAP)
    rows = _appended(spark, "sessions", sessions)
    return rows.select(
        "key",
        times.plain(F.col("session_start")).alias("session_start"),
        times.plain(F.col("session_end")).alias("session_end"),
        "event_count",
    )


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries of the purchases and one of the rest, each id kept once."""
    log = tables.event_stream(spark, sf_dir).withColumn("event_id", F.md5("order_id"))
    again = tables.of_type(tables.event_stream(spark, sf_dir), C.PAYMENT_COMPLETED)
    both = log.unionByName(again.withColumn("event_id", F.md5("order_id")))
    once = reliability.dedup_stream(both.select("event_id", "seq", "event_type", "key"))
    return _appended(spark, "dedup", once)


def stream_order_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tables.event_stream(spark, sf_dir).withColumn("order_id", F.col("key"))
    latest = _updated(spark, "status", saga.latest_status(events), ["order_id"])
    orders = tables.order_table(spark, sf_dir).select("order_id", F.lit(C.PENDING).alias("status"))
    updated = orders.join(latest, "order_id", "left")
    return updated.select("order_id", F.coalesce("new_status", "status").alias("status"))


def stream_reserve_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = _orders(spark, sf_dir).select("order_id", "item", "seq", "quantity")
    decided = jobs.keep_stock(jobs.stock_movements(requests, tables.stock(spark, sf_dir)))
    rows = _appended(spark, "reserve", decided)
    return rows.select(
        "order_id",
        "item",
        "seq",
        F.col("quantity").cast("int").alias("quantity"),
        "available_before",
        (F.col("event_type") == C.INVENTORY_RESERVED).alias("reserved"),
        "event_type",
        "reason",
    )


def _saga_topics(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Inventory and payment events of all orders, made by chained streaming stages."""
    requests = _orders(spark, sf_dir).select("order_id", "item", "seq", "quantity")
    root = runner.job_paths(spark, "saga")[0]
    inventory, payments = jobs.run_saga_stages(requests, tables.stock(spark, sf_dir), root)
    return (
        spark.read.schema(jobs.INVENTORY_EVENTS).parquet(inventory),
        spark.read.schema(jobs.PAYMENT_EVENTS).parquet(payments),
    )


def stream_saga_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final status of every order after reservation, charge and release by streaming stages."""
    inventory, payments = _saga_topics(spark, sf_dir)
    # A payment event follows the inventory event of its order.
    events = inventory.select("order_id", "event_type", (F.col("seq") * 2).alias("seq")).union(
        payments.select("order_id", "event_type", F.col("seq") * 2 + 1)
    )
    orders = batch_saga.requests(spark, sf_dir).select(
        "order_id", F.lit(C.PENDING).alias("status")
    )
    return saga.order_status(orders, events)


def stream_release_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reservations given back by the streaming stages."""
    inventory, _ = _saga_topics(spark, sf_dir)
    return inventory.filter(F.col("event_type") == C.INVENTORY_RELEASED).select(
        "order_id", "item", F.col("quantity").cast("int").alias("quantity")
    )


def stream_consume_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Effects and dead letters of the idempotent consumer, read by committed batch."""
    root = runner.job_paths(spark, "consumer")[0]
    sinks = {name: f"{root}/{name}" for name in ("effects", "dead_letters", "processed")}
    marker = f"{root}/marker"
    records = batch_reliability.redelivered_records(spark, sf_dir, streaming=True)
    outcomes = jobs.consume_stream(
        records, tables.processed_ids(spark, sf_dir), batch_reliability.HANDLED
    )
    write = jobs.consumer(
        sinks, marker, batch_reliability.GROUP, F.lit(batch_reliability.NOW).cast("timestamp")
    )
    runner.run_batches(outcomes, write, f"{root}/checkpoint")
    effects = runner.read_committed(spark, sinks["effects"], marker)
    letters = reliability.parked(runner.read_committed(spark, sinks["dead_letters"], marker))
    return effects.select("offset", F.lit("effect").alias("outcome"), "error").union(
        letters.select("original_offset", F.lit("dead letter"), "error")
    )


def stream_dedup_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As :func:`stream_dedup`, with ids forgotten a day after their event time."""
    log = tables.event_stream(spark, sf_dir).withColumn("event_id", F.md5("order_id"))
    again = tables.of_type(tables.event_stream(spark, sf_dir), C.PAYMENT_COMPLETED)
    both = log.unionByName(again.withColumn("event_id", F.md5("order_id")))
    once = reliability.dedup_stream(
        both.select("event_id", "seq", "event_type", "key", "event_time"), "1 day"
    )
    return _appended(spark, "dedup-within", once.drop("event_time"))


def stream_dlq_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters parked by a streaming job; good and bad records never block each other."""
    records = tables.topic_records(spark, sf_dir, streaming=True)
    strict = decode.decode_strict(records, batch_reliability.HANDLED)
    failed_at = F.lit(batch_reliability.NOW).cast("timestamp")
    letters = reliability.dead_letters(strict, batch_reliability.GROUP, failed_at)
    return reliability.parked(_appended(spark, "dlq", letters))


def stream_fold_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same user's function as in ``fold_orders``, with its state carried on a stream."""
    folded = jobs.fold_stream(
        batch_extras.open_quantity_events(tables.event_stream(spark, sf_dir)),
        ["key"],
        "seq",
        batch_extras.open_quantity_start,
        batch_extras.open_quantity,
        batch_extras.OPEN_QUANTITY,
    )
    return _appended(spark, "fold", folded)


def stream_enrich_latest_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the price of their item as it was when they arrived; the price table is kept by
    the same stream, whose prices change in between."""
    events = tables.event_stream(spark, sf_dir)
    kinds = F.col("event_type").isin(C.ORDER_CREATED, C.PAYMENT_COMPLETED)
    price = F.when(F.col("event_type") == C.PAYMENT_COMPLETED, F.col("amount")).alias("price")
    rows = events.filter(kinds).select("item", "seq", "quantity", price)
    sink, checkpoint = runner.job_paths(spark, "prices")
    runner.run_batches(rows, jobs.price_enricher(f"{sink}/orders", f"{sink}/prices"), checkpoint)
    return spark.read.parquet(f"{sink}/orders").select("item", "seq", "quantity", "price")


QUERIES = {
    "stream_enrich_latest_price": stream_enrich_latest_price,
    "stream_fold_orders": stream_fold_orders,
    "stream_source_replay": stream_source_replay,
    "stream_large_orders": stream_large_orders,
    "stream_item_counts": stream_item_counts,
    "counts_all": counts_all,
    "stream_count_changelog": stream_count_changelog,
    "stream_item_orders_per_window": stream_item_orders_per_window,
    "stream_final_window_counts": stream_final_window_counts,
    "stream_late_drop": stream_late_drop,
    "stream_paid_orders": stream_paid_orders,
    "stream_unpaid_orders": stream_unpaid_orders,
    "stream_session_counts": stream_session_counts,
    "stream_dedup": stream_dedup,
    "stream_order_status": stream_order_status,
    "stream_reserve_stock": stream_reserve_stock,
    "stream_saga_outcome": stream_saga_outcome,
    "stream_release_stock": stream_release_stock,
    "stream_consume_orders": stream_consume_orders,
    "stream_dedup_within": stream_dedup_within,
    "stream_dlq_route": stream_dlq_route,
}

ORACLE = {
    "stream_enrich_latest_price": f"""WITH {sql.LOG},
priced AS (
  SELECT *, last_value(CASE WHEN event_type = 'PaymentCompleted' THEN amount END IGNORE NULLS)
              OVER (PARTITION BY item ORDER BY seq) AS price
  FROM log WHERE event_type IN ('OrderCreated', 'PaymentCompleted'))
SELECT item, seq, quantity, price FROM priced WHERE event_type = 'OrderCreated'""",
    "stream_fold_orders": batch_extras.FOLD_ORDERS,
    "stream_source_replay": f"""WITH {sql.LOG}, {sql.RECORDS}
SELECT "offset", key, CASE WHEN k BETWEEN 55 AND 59 THEN '' ELSE event_type END AS event_type
FROM records WHERE {sql.LENIENT}""",
    "stream_large_orders": batch.LARGE_ORDERS,
    "stream_item_counts": batch.ITEM_COUNTS,
    "counts_all": batch.ITEM_COUNTS,
    "stream_count_changelog": batch.CHANGELOG,
    "stream_item_orders_per_window": batch.ITEM_ORDERS_PER_WINDOW,
    "stream_final_window_counts": f"""WITH {sql.LOG}, {sql.CREATED}
{batch.PER_WINDOW} FROM created GROUP BY item, date_trunc('hour', event_time)
HAVING date_trunc('hour', event_time) + INTERVAL 1 HOUR
       <= (SELECT max(event_time) FROM created) - INTERVAL 30 SECOND""",
    "stream_late_drop": batch.ORACLE["window_late_drop"],
    "stream_paid_orders": batch.PAID_ORDERS,
    "stream_unpaid_orders": f"""WITH {sql.LOG}, {sql.CREATED}, {sql.PAID},
mark AS (SELECT least((SELECT max(event_time) FROM created), (SELECT max(event_time) FROM paid))
         - INTERVAL 1 MINUTE AS final_before)
SELECT key, order_id FROM created o WHERE NOT EXISTS (
  SELECT 1 FROM paid p WHERE p.key = o.key AND p.event_time
  BETWEEN o.event_time - INTERVAL 60 MINUTE AND o.event_time + INTERVAL 60 MINUTE)
AND event_time + INTERVAL 60 MINUTE < (SELECT final_before FROM mark)""",
    "stream_session_counts": batch_extras.SESSION_COUNTS
    + """
HAVING max(event_time) + INTERVAL 6 HOUR
       <= (SELECT max(event_time) FROM log) - INTERVAL 30 SECOND""",
    "stream_dedup": f"""WITH {sql.LOG}
SELECT md5(order_id) AS event_id, seq, event_type, key FROM log""",
    "stream_order_status": batch_saga.ORDER_STATUS,
    "stream_reserve_stock": batch_saga.RESERVE_STOCK,
    "stream_saga_outcome": f"""{batch_saga.RESERVED}
SELECT order_id, CASE WHEN reserved AND {batch_saga.PAYS} THEN 'COMPLETED' ELSE 'CANCELLED' END
         AS status
FROM decided""",
    "stream_release_stock": f"""{batch_saga.RESERVED}
SELECT order_id, item, quantity FROM decided WHERE reserved AND NOT ({batch_saga.PAYS})""",
    "stream_consume_orders": f"""{batch_reliability.CONSUMED}
SELECT "offset", outcome, error FROM consumed WHERE outcome IN ('effect', 'dead letter')""",
    "stream_dedup_within": f"""WITH {sql.LOG}
SELECT md5(order_id) AS event_id, seq, event_type, key FROM log""",
    "stream_dlq_route": batch_reliability.ORACLE["dlq_route"],
}
