"""Streaming forms of the operators that need state beyond the built-in ones."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill import constants as C
from eventmill.functions import ids, times
from eventmill.operators import decode, extras, ordered_fold, reliability, saga
from eventmill.streaming import processors, runner
from eventmill.streaming.processors import (
    CountChanges,
    LateFilter,
    SeenIds,
    StockKeeper,
    UserFold,
)

# The worker that prepares a stateful operator does not see files added to the session.
cloudpickle.register_pickle_by_value(processors)


#: Groups of items in the stock keeper's state; fixed for the life of a checkpoint.
ITEM_BUCKETS = 1024


def count_changes(orders: DataFrame) -> DataFrame:
    """Stream of ``seq, item, order_count``: one row per order."""
    return (
        orders.select("item", "seq")
        .groupBy("item")
        .transformWithStateInPandas(
            statefulProcessor=CountChanges(),
            outputStructType=CountChanges.SCHEMA,
            outputMode="Append",
            timeMode="None",
        )
    )


def stock_movements(requests: DataFrame, stock: DataFrame, kind: str = "reserve") -> DataFrame:
    """Requests or releases as input of :func:`keep_stock`; ``stock`` is a static table."""
    opening = stock.select(
        "item", F.col("available_quantity").cast("bigint").alias("opening")
    )
    return requests.join(opening, "item", "left").select(
        "item",
        F.lit(kind).alias("kind"),
        "order_id",
        "seq",
        F.col("quantity").cast("bigint").alias("quantity"),
        "opening",
    )


def keep_stock(movements: DataFrame) -> DataFrame:
    """Decisions and releases in arrival order, as events; error rows belong on the DLQ."""
    bucket = F.pmod(F.xxhash64("item"), F.lit(ITEM_BUCKETS)).cast("int").alias("bucket")
    return movements.select("*", bucket).groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=StockKeeper(),
        outputStructType=StockKeeper.SCHEMA,
        outputMode="Append",
        timeMode="None",
    )


def releases(failures: DataFrame, stock: DataFrame) -> DataFrame:
    """Failed payments as release movements.

    ``failures``: payment events with the item they were charged for, so no reservation has to
    be looked up (a table of them could be older than the failure).
    """
    failed = failures.filter(F.col("event_type") == C.PAYMENT_FAILED)
    named = failed.select("item", "order_id", "seq", F.lit(0).cast("bigint").alias("quantity"))
    return stock_movements(named, stock, "release")


# --- the saga as stages over topics ---------------------------------------------------------

INVENTORY_EVENTS = StockKeeper.SCHEMA
PAYMENT_EVENTS = "seq BIGINT, order_id STRING, item STRING, event_type STRING, reason STRING"


def inventory_stage(requests: DataFrame, payments: DataFrame, stock: DataFrame) -> DataFrame:
    """Inventory events of new order requests and of failed payments."""
    return keep_stock(stock_movements(requests, stock).unionByName(releases(payments, stock)))


def payment_stage(
    inventory: DataFrame, failure_rate: float = C.PAYMENT_FAILURE_RATE
) -> DataFrame:
    """Payment events of new reservations; ``seq`` stays that of the order."""
    ok = saga.payment_succeeds(F.col("order_id"), failure_rate)
    reserved = inventory.filter(F.col("event_type") == C.INVENTORY_RESERVED)
    return reserved.select(
        "seq",
        "order_id",
        "item",
        F.when(ok, C.PAYMENT_COMPLETED).otherwise(C.PAYMENT_FAILED).alias("event_type"),
        F.when(~ok, C.PAYMENT_DECLINED).alias("reason"),
    )


def run_saga_stages(
    requests: DataFrame, stock: DataFrame, root: str, rate: float = C.PAYMENT_FAILURE_RATE
) -> tuple[str, str]:
    """Run the stages in turn until no stage has anything new: the topics of inventory and
    payment events. Each stage has its own checkpoint under ``root``, so a run that stops
    anywhere is continued by calling this again."""
    spark = requests.sparkSession
    inventory, payments = f"{root}/inventory", f"{root}/payments"
    for topic, schema in ((inventory, INVENTORY_EVENTS), (payments, PAYMENT_EVENTS)):
        spark.createDataFrame([], schema).write.mode("append").parquet(topic)
    for _ in range(2):  # orders are reserved and charged; then failed ones are released
        paid = spark.readStream.schema(PAYMENT_EVENTS).parquet(payments)
        runner.run_append(
            inventory_stage(requests, paid, stock), inventory, f"{root}/inventory-checkpoint"
        )
        reserved = spark.readStream.schema(INVENTORY_EVENTS).parquet(inventory)
        runner.run_append(payment_stage(reserved, rate), payments, f"{root}/payment-checkpoint")
    return inventory, payments


# --- the idempotent consumer ----------------------------------------------------------------

#: Groups of ids in the consumer's state; fixed for the life of a checkpoint.
ID_BUCKETS = 1024


def consume_stream(
    records: DataFrame, processed: DataFrame, handled: Sequence[str], buckets: int = ID_BUCKETS
) -> DataFrame:
    """:func:`eventmill.operators.reliability.consume` on a stream of records.

    Ids seen are keyed state, so neither time nor bytes read per micro-batch grow with history.
    ``processed``: ids the service had before; they are loaded into the state once, by the first
    micro-batch. Output: the records with their envelope columns, ``id``, ``error``, ``outcome``.
    """

    def bucket(event_id: Column) -> Column:
        return F.pmod(F.xxhash64(event_id), F.lit(buckets)).cast("int").alias("bucket")

    decoded = decode.decode_strict(records, handled).drop("headers", "payload")
    known = F.when(reliability.has_id(F.col("error")), ids.canonical_uuid(F.col("event_id")))
    # A record without an id goes anywhere, so that such rows do not meet in one task.
    spread = F.coalesce(known, F.concat_ws(":", "partition", "offset"))
    rows = decoded.select("*", known.alias("id"), bucket(spread))
    before = processed.select(ids.canonical_uuid(F.col("event_id")).alias("id"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("bucket").schema]
    return rows.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=SeenIds(handled),
        outputStructType=", ".join([*fields, "outcome STRING"]),
        outputMode="Append",
        timeMode="None",
        initialState=before.select(bucket(F.col("id")), "id").groupBy("bucket"),
    )


def consumer(
    sinks: dict[str, str], marker: str, group: str, failed_at: Column | None = None
) -> Callable[[DataFrame, int], None]:
    """Writer of what :func:`consume_stream` decided: effects, dead letters and processed ids of a
    micro-batch become visible together. ``sinks``: folders named so."""

    def split(batch: DataFrame, batch_id: int) -> dict[str, DataFrame]:
        outcome = F.col("outcome")
        return {
            "effects": batch.filter(outcome == "effect").drop("outcome", "id"),
            "dead_letters": reliability.dead_letters(
                batch.filter(outcome == "dead letter"), group, failed_at
            ),
            "processed": batch.filter(outcome.isin("effect", "ignored")).select(
                F.col("id").alias("event_id")
            ),
        }

    return runner.atomic_sinks(sinks, marker, split)


def price_enricher(orders: str, prices: str) -> Callable[[DataFrame, int], None]:
    """Writer that gives orders the price of their item as of their arrival.

    A micro-batch has ``item, seq, quantity`` and ``price``, which is NULL for an order; a change
    counts for the orders after it. Prices of earlier batches come from the table in ``prices``, of
    which a batch reads and rewrites the buckets it touches; the orders go to ``orders``. A repeated
    batch sees the prices before it and replaces what it wrote.
    """
    table = runner.KeyedTable(prices, ["item"])

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            changes = batch.filter("price IS NOT NULL").select("item", "price", "seq")
            asked = batch.filter("price IS NULL").drop("price")
            before = table.rows_before(batch, batch_id, changes.schema)
            priced = extras.price_at_arrival(asked, changes, before)
            runner.upsert_batch(orders)(priced, batch_id)
            last = changes.groupBy("item").agg(
                F.max_by("price", "seq").alias("price"), F.max("seq").alias("seq")
            )
            table.write(last, batch_id)
        finally:
            batch.unpersist()

    return write


def fold_stream(
    events: DataFrame, keys: Sequence[str], seq: str, start: Callable, step: Callable, schema: str
) -> DataFrame:
    """:func:`eventmill.operators.ordered_fold.fold_in_order` on a stream: rows are in order
    within a micro-batch, and the state (JSON) is carried from one to the next."""
    return events.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=UserFold(
            ordered_fold.by_value(start), ordered_fold.by_value(step), seq
        ),
        outputStructType=schema,
        outputMode="Append",
        timeMode="None",
    )


def accepted_by_window(
    events: DataFrame,
    by: str = "partition",
    size: str = C.COUNT_WINDOW,
    grace: str = C.COUNT_GRACE,
) -> DataFrame:
    """``seq`` of the events a windowed count accepts, judged record by record."""
    span = int((times.seconds_of(size) + times.seconds_of(grace)) * 1_000_000)
    start = F.unix_micros(F.window("event_time", size)["start"])
    return (
        events.select(
            by,
            "seq",
            F.unix_micros("event_time").alias("at"),
            (start + F.lit(span)).alias("window_end"),
        )
        .groupBy(by)
        .transformWithStateInPandas(
            statefulProcessor=LateFilter(),
            outputStructType=LateFilter.SCHEMA,
            outputMode="Append",
            timeMode="None",
        )
    )
