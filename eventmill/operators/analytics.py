"""The analytics branches: large orders, counts per item, counts per window, paid orders.

Inputs are typed event rows (:mod:`eventmill.operators.decode` or a table with the same
columns). Expressions are shared by batch and streams; a streaming input only needs
:func:`with_lateness` in front of the windowed operators.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill import constants as C
from eventmill.functions import times
from eventmill.operators import hot_keys


def with_lateness(df: DataFrame, grace: str) -> DataFrame:
    """Declare on a stream how late rows may arrive."""
    return df.withWatermark("event_time", grace)


def large_orders(orders: DataFrame, min_quantity: int = C.LARGE_ORDER_QUANTITY) -> DataFrame:
    """Orders of at least ``min_quantity``; the key is kept, the envelope dropped.

    Orders decoded from a topic keep their payload as JSON text, with all the fields it came
    with; rows without a payload column have the typed fields alone.
    """
    kept = ["key", "order_id", "item", "quantity"]
    kept += ["payload"] if "payload" in orders.columns else []
    return orders.filter(F.col("quantity") >= min_quantity).select(*kept)


def item_counts(orders: DataFrame) -> DataFrame:
    """Number of orders per item."""
    return orders.groupBy("item").agg(F.count(F.lit(1)).alias("order_count"))


def item_count_changelog(
    orders: DataFrame, seq: str = "seq", block_rows: int = hot_keys.BLOCK_ROWS
) -> DataFrame:
    """One row per order: the count of its item after that order, in arrival order."""
    counted = hot_keys.running_count(
        orders.select("item", seq), ["item"], seq, "order_count", block_rows
    )
    return counted.select(seq, "item", "order_count")


def window_key(item: Column, window_start: Column) -> Column:
    """Flat text key ``item@start``."""
    return F.concat(item, F.lit("@"), times.iso_seconds(window_start))


def item_orders_per_window(
    orders: DataFrame, size: str = C.COUNT_WINDOW, slide: str | None = None
) -> DataFrame:
    """Orders per item and window; tumbling, or hopping with ``slide``."""
    counted = orders.groupBy(F.window("event_time", size, slide), "item").agg(
        F.count(F.lit(1)).alias("order_count")
    )
    return counted.select(
        window_key(F.col("item"), F.col("window.start")).alias("item_window"),
        "item",
        F.col("window.start").alias("window_start"),
        "order_count",
    )


def drop_late(
    events: DataFrame,
    by: str = "partition",
    seq: str = "offset",
    size: str = C.COUNT_WINDOW,
    grace: str = C.COUNT_GRACE,
    block_rows: int = hot_keys.BLOCK_ROWS,
) -> DataFrame:
    """Rows a windowed count accepts when lateness is judged record by record.

    Stream time is the largest event time seen so far in the partition, this row
    included; a row is late when its window's end plus grace is not after it.
    """
    seen = hot_keys.running_max(
        events, [by], seq, F.col("event_time"), "_stream_time", block_rows
    )
    end = F.window("event_time", size)["end"]
    return (
        seen.withColumn("_end", end)
        .filter(F.col("_end") + F.expr(f"INTERVAL {grace}") > F.col("_stream_time"))
        .drop("_end", "_stream_time")
    )


def _paid_columns() -> list[Column]:
    return [
        F.col("o.key").alias("key"),
        F.col("o.order_id").alias("order_id"),
        F.col("o.item").alias("item"),
        F.col("o.quantity").alias("quantity"),
        F.col("p.payment_id").alias("payment_id"),
        F.col("p.amount").alias("amount"),
        F.greatest("o.event_time", "p.event_time").alias("event_time"),
    ]


def _within(window: str) -> Column:
    return F.expr(
        f"p.event_time BETWEEN o.event_time - INTERVAL {window} "
        f"AND o.event_time + INTERVAL {window}"
    )


def slot_sides(
    orders: DataFrame, payments: DataFrame, window: str
) -> tuple[DataFrame, DataFrame, Column]:
    """Both sides of the join within ``window`` as ``o`` and ``p``, and its condition.

    Both sides get a time slot two windows wide; a payment is copied into the (at most
    two) slots its range touches. The join is then on key *and* slot, so a key with very
    many events spreads over its slots and only near rows meet.
    """
    slot_millis = int(times.seconds_of(window) * 2000)

    def slot(shift: str = "") -> Column:
        millis = f"unix_millis(CAST(event_time {shift} AS TIMESTAMP))"
        return F.expr(f"{millis} DIV {slot_millis}")

    left = orders.withColumn("_slot", slot()).alias("o")
    first, last = slot(f"- INTERVAL {window}"), slot(f"+ INTERVAL {window}")
    right = payments.withColumn("_slot", F.explode(F.sequence(first, last))).alias("p")
    on = (F.col("o.key") == F.col("p.key")) & (F.col("o._slot") == F.col("p._slot"))
    return left, right, on & _within(window)


def paid_orders(orders: DataFrame, payments: DataFrame, window: str = C.JOIN_WINDOW) -> DataFrame:
    """Orders joined with payments of the same key at most ``window`` apart, either way."""
    left, right, on = slot_sides(orders, payments, window)
    return left.join(right, on, "inner").select(*_paid_columns())


def paid_orders_stream(
    orders: DataFrame,
    payments: DataFrame,
    window: str = C.JOIN_WINDOW,
    grace: str = C.JOIN_GRACE,
) -> DataFrame:
    """The same join between two streams; state is bounded by window plus grace."""
    left = with_lateness(orders, grace).alias("o")
    right = with_lateness(payments, grace).alias("p")
    on = (F.col("o.key") == F.col("p.key")) & _within(window)
    return left.join(right, on, "inner").select(*_paid_columns())


def counts_lookup(counts: DataFrame, items: DataFrame) -> DataFrame:
    """Count of each requested item; an item never ordered has 0."""
    wanted = items.select("item").distinct()
    return wanted.join(counts, "item", "left").select(
        "item", F.coalesce("order_count", F.lit(0)).cast("bigint").alias("order_count")
    )
