"""Order saga as data jobs: accept, reserve, charge, compensate, resolve.

Batch schedule: an order's payment outcome is applied before the next order of the same
item, and the steps of one order follow its request (``seq``, then step number). This is one
of the orders in which independent consumers may run. Streams follow arrival instead
(:mod:`eventmill.streaming.jobs`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill import constants as C
from eventmill.functions import ids
from eventmill.operators import allocation, hot_keys

# Position of a step within its order, used where events of several topics are merged.
STEPS = {
    C.ORDER_CREATED: 0,
    C.INVENTORY_RESERVED: 1,
    C.INVENTORY_RESERVATION_FAILED: 1,
    C.PAYMENT_COMPLETED: 2,
    C.PAYMENT_FAILED: 2,
    C.INVENTORY_RELEASED: 3,
}


# --- accept ---------------------------------------------------------------------------------


def request_is_valid() -> Column:
    """An item is named and the quantity is positive; anything unreadable is NULL and fails."""
    return F.coalesce((F.length("item") > 0) & (F.col("quantity") > 0), F.lit(False))


def validate_orders(requests: DataFrame) -> DataFrame:
    """All requests with ``accepted`` and, for accepted ones, status PENDING."""
    ok = request_is_valid()
    return requests.withColumn("accepted", ok).withColumn(
        "status", F.when(F.col("accepted"), C.PENDING)
    )


# --- reserve --------------------------------------------------------------------------------


def reserve_stock(
    requests: DataFrame, stock: DataFrame, block_rows: int = hot_keys.BLOCK_ROWS
) -> DataFrame:
    """Reserve stock for each order in arrival order; nothing is given back.

    ``requests``: ``order_id, item, seq, quantity``. Rows with an ``error`` belong on the dead
    letter topic: they name an order whose reservation of the item is live.
    """
    holding = requests.withColumn("holds", F.lit(True))
    decided = allocation.allocate(holding, stock, block_rows)
    return allocation.reservation_outcome(decided).drop("holds")


# --- charge ---------------------------------------------------------------------------------


def price_lookup(
    lines: DataFrame, prices: DataFrame, default_price: float = C.DEFAULT_UNIT_PRICE
) -> DataFrame:
    """Add ``price`` (default where the item is not priced) and ``amount``.

    No broadcast hint: Spark broadcasts the price table while its size is under the
    configured threshold and otherwise sorts and merges, splitting hot items.
    """
    # One price per item, so that no line is multiplied.
    joined = lines.join(prices.select("item", F.col("price").alias("_price")), "item", "left")
    return joined.withColumn("price", F.coalesce("_price", F.lit(default_price))).withColumn(
        "amount", F.col("price") * F.col("quantity")
    ).drop("_price")


def payment_succeeds(order_id: Column, failure_rate: float) -> Column:
    """Outcome of the charge: fails if the order's draw is below the rate."""
    return ids.draw(order_id) >= F.lit(failure_rate)


def payment_outcome(
    reserved: DataFrame, prices: DataFrame, failure_rate: float = C.PAYMENT_FAILURE_RATE
) -> DataFrame:
    """One payment per reservation event, with status, event type and reason.

    ``reserved``: ``event_id, order_id, item, quantity``. A second reservation event of an
    order with a new id is charged again.
    """
    ok = payment_succeeds(F.col("order_id"), failure_rate)
    charged = price_lookup(reserved, prices).withColumn("_ok", ok)
    return charged.select(
        ids.derived_id(F.col("event_id"), F.lit("payment")).alias("payment_id"),
        *[c for c in charged.columns if c != "_ok"],
        F.when(F.col("_ok"), C.PAYMENT_STATUS_COMPLETED)
        .otherwise(C.PAYMENT_STATUS_FAILED)
        .alias("payment_status"),
        F.when(F.col("_ok"), C.PAYMENT_COMPLETED)
        .otherwise(C.PAYMENT_FAILED)
        .alias("event_type"),
        F.when(~F.col("_ok"), C.PAYMENT_DECLINED).alias("reason"),
    )


# --- compensate -----------------------------------------------------------------------------


def release_stock(reservations: DataFrame, failures: DataFrame) -> DataFrame:
    """Reservations given back: those whose order has a failed payment, each once.

    ``failures``: ``order_id, seq`` of PaymentFailed events. Output adds ``released_seq``,
    the first failure. An order without a reservation gives no row.
    """
    first = failures.groupBy("order_id").agg(F.min("seq").alias("released_seq"))
    return reservations.join(first, "order_id", "inner")


def live_reservations(reservations: DataFrame, failures: DataFrame) -> DataFrame:
    """Reservations that no failed payment has given back."""
    failed = failures.select("order_id").distinct()
    return reservations.join(failed, "order_id", "left_anti")


def stock_balance(stock: DataFrame, live: DataFrame) -> DataFrame:
    """Closing stock per item: opening stock minus live reservations, sorted by item."""
    held = live.groupBy("item").agg(
        F.sum("quantity").alias("reserved_quantity"), F.count(F.lit(1)).alias("reservations")
    )
    none = F.lit(0).cast("bigint")
    return (
        stock.join(held, "item", "left")
        .select(
            "item",
            "available_quantity",
            F.coalesce("reserved_quantity", none).alias("reserved_quantity"),
            F.coalesce("reservations", none).alias("reservations"),
            (F.col("available_quantity") - F.coalesce("reserved_quantity", none)).alias(
                "closing_quantity"
            ),
        )
        .orderBy("item")
    )


# --- resolve --------------------------------------------------------------------------------


def status_of_event() -> Column:
    """Status an event sets on its order; NULL for events that set none."""
    kind = F.col("event_type")
    return F.when(kind == C.PAYMENT_COMPLETED, C.COMPLETED).when(
        kind.isin(C.INVENTORY_RESERVATION_FAILED, C.PAYMENT_FAILED), C.CANCELLED
    )


def merge_events(*topics: DataFrame) -> DataFrame:
    """Events of several topics as one; all carry the same columns."""
    merged = topics[0]
    for topic in topics[1:]:
        merged = merged.unionByName(topic)
    return merged


def latest_status(events: DataFrame) -> DataFrame:
    """Last status set per order, by ``seq``. Also valid on a stream in update mode."""
    setting = events.withColumn("_status", status_of_event()).filter("_status IS NOT NULL")
    # The status goes through the aggregate as a flag: two plain numbers per order can be
    # aggregated in a hash table, text would need a sort.
    done = F.max_by((F.col("_status") == C.COMPLETED).cast("int"), "seq")
    last = setting.groupBy("order_id").agg(done.alias("_done"))
    status = F.when(F.col("_done") == 1, C.COMPLETED).otherwise(C.CANCELLED)
    return last.select("order_id", status.alias("new_status"))


def order_status(orders: DataFrame, events: DataFrame) -> DataFrame:
    """Orders with their current status; events of unknown orders have no effect."""
    updated = orders.join(latest_status(events), "order_id", "left")
    return updated.withColumn("status", F.coalesce("new_status", "status")).drop("new_status")


def order_lookup(orders: DataFrame, wanted: DataFrame) -> DataFrame:
    """Status of each requested order id, ``found`` false where there is none."""
    ids_wanted = wanted.select("order_id").distinct()
    known = orders.select("order_id", "status", F.lit(True).alias("_known"))
    return ids_wanted.join(known, "order_id", "left").select(
        "order_id", "status", F.coalesce("_known", F.lit(False)).alias("found")
    )


# --- whole saga -----------------------------------------------------------------------------


def run_saga(
    requests: DataFrame,
    stock: DataFrame,
    prices: DataFrame,
    failure_rate: float = C.PAYMENT_FAILURE_RATE,
    block_rows: int = hot_keys.BLOCK_ROWS,
) -> DataFrame:
    """Every accepted order taken to its final status, one row per order.

    ``requests``: ``order_id, item, seq, quantity``. An order whose payment fails gives its
    stock back before the next order of the item.
    """
    valid = requests.filter(request_is_valid())
    paying = payment_succeeds(F.col("order_id"), failure_rate)
    decided = allocation.allocate(valid.withColumn("holds", paying), stock, block_rows)
    # A request for an order whose reservation is live is a dead letter, not an outcome.
    decided = decided.filter("error IS NULL")
    priced = price_lookup(allocation.reservation_outcome(decided), prices)
    reserved, paid = F.col("reserved"), F.col("holds")
    return priced.select(
        "order_id",
        "item",
        "seq",
        "quantity",
        "available_before",
        "reserved",
        F.when(reserved, F.col("amount")).alias("amount"),
        F.when(reserved & paid, C.PAYMENT_STATUS_COMPLETED)
        .when(reserved, C.PAYMENT_STATUS_FAILED)
        .alias("payment_status"),
        (reserved & ~paid).alias("released"),
        F.when(reserved & paid, C.COMPLETED).otherwise(C.CANCELLED).alias("status"),
        F.coalesce(F.col("reason"), F.when(reserved & ~paid, C.PAYMENT_DECLINED)).alias("reason"),
    )


def saga_events(outcome: DataFrame) -> DataFrame:
    """The events a finished saga published, in order: one row per event.

    ``seq`` orders them over all topics: the request's place, then the step.
    """
    steps = F.array(
        F.lit(C.ORDER_CREATED),
        F.when(F.col("reserved"), C.INVENTORY_RESERVED).otherwise(C.INVENTORY_RESERVATION_FAILED),
        F.when(F.col("payment_status") == C.PAYMENT_STATUS_COMPLETED, C.PAYMENT_COMPLETED).when(
            F.col("payment_status") == C.PAYMENT_STATUS_FAILED, C.PAYMENT_FAILED
        ),
        F.when(F.col("released"), C.INVENTORY_RELEASED),
    )
    exploded = outcome.select("*", F.posexplode(steps).alias("step", "event_type"))
    topic = (
        F.when(F.col("event_type") == C.ORDER_CREATED, C.ORDER_EVENTS)
        .when(F.col("event_type").startswith("Payment"), C.PAYMENT_EVENTS)
        .otherwise(C.INVENTORY_EVENTS)
    )
    return exploded.filter("event_type IS NOT NULL").select(
        ids.derived_id(F.col("order_id"), F.col("event_type")).alias("event_id"),
        "event_type",
        "order_id",
        topic.alias("topic"),
        (F.col("seq") * 4 + F.col("step")).alias("seq"),
        "step",
        "item",
        "quantity",
        "amount",
        "reason",
    )
