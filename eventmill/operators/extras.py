"""Further event reports: payments, customers, windows, schema versions, metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from eventmill import constants as C
from eventmill.functions import times
from eventmill.operators import analytics, hot_keys


def high_value_payments(payments: DataFrame, min_amount: float = 100.0) -> DataFrame:
    return payments.filter(F.col("amount") > min_amount)


def item_quantity_totals(orders: DataFrame) -> DataFrame:
    return orders.groupBy("item").agg(
        F.sum(F.col("quantity").cast("bigint")).alias("total_quantity")
    )


def payment_branches(events: DataFrame) -> DataFrame:
    """All payment events in one pass, with the branch each belongs to: ``payments-ok`` or
    ``payments-failed``. Write with ``partitionBy("branch")`` to have them apart."""
    kind = F.col("event_type")
    return events.filter(kind.isin(C.PAYMENT_COMPLETED, C.PAYMENT_FAILED)).withColumn(
        "branch",
        F.when(kind == C.PAYMENT_COMPLETED, "payments-ok").otherwise("payments-failed"),
    )


def latest_event_per_order(*topics: DataFrame) -> DataFrame:
    """Type and place of the last event per key over all topics, whatever its type.

    ``seq`` is unique. The aggregate carries numbers only (text would need a sort); the last rows
    are then fetched by key and number. Events without a key are one group.
    """
    merged = topics[0].select("key", "event_type", "seq")
    for topic in topics[1:]:
        merged = merged.unionByName(topic.select("key", "event_type", "seq"))
    last = merged.groupBy("key").agg(F.max("seq").alias("seq")).alias("last")
    same = F.col("all.key").eqNullSafe(F.col("last.key")) & F.col("all.seq").eqNullSafe(
        F.col("last.seq")
    )
    return merged.alias("all").join(last, same, "left_semi").select("key", "event_type", "seq")


def failed_payment_orders(orders: DataFrame, failures: DataFrame) -> DataFrame:
    """Orders whose key has at least one failed payment."""
    return orders.join(failures.select("key").distinct(), "key", "left_semi")


def unpaid_orders(
    orders: DataFrame, payments: DataFrame, window: str = C.JOIN_WINDOW
) -> DataFrame:
    """Orders without a completed payment of their key within ``window``, either way.

    Each row is judged on its own, so orders without an id, or with an id twice, stay apart; an
    order without a key is unpaid.
    """
    left, right, on = analytics.slot_sides(orders, payments, window)
    return left.join(right, on, "left_anti").drop("_slot")


def unpaid_orders_stream(
    orders: DataFrame,
    payments: DataFrame,
    window: str = C.JOIN_WINDOW,
    grace: str = C.JOIN_GRACE,
) -> DataFrame:
    """Orders with their payment within ``window``; without one once that is certain."""
    left = analytics.with_lateness(orders, grace).alias("o")
    right = analytics.with_lateness(payments, grace).alias("p")
    on = F.expr(
        f"o.key = p.key AND p.event_time BETWEEN o.event_time - INTERVAL {window} "
        f"AND o.event_time + INTERVAL {window}"
    )
    return left.join(right, on, "leftOuter").select(
        "o.key", "o.order_id", "o.item", "o.quantity", "p.payment_id", "p.amount"
    )


def latest_per_key(changes: DataFrame, key: str, seq: str) -> DataFrame:
    """Compacted view of a topic: the last row per key."""
    rest = [c for c in changes.columns if c != key]
    last = changes.groupBy(key).agg(F.max_by(F.struct(*rest), seq).alias("_last"))
    return last.select(key, "_last.*")


def enrich_latest_price(orders: DataFrame, price_changes: DataFrame) -> DataFrame:
    """Orders with the latest price of their item, NULL if it was never priced."""
    # Two plain numbers per item, so the aggregate needs no sort.
    prices = price_changes.groupBy("item").agg(F.max_by("price", "seq").alias("price"))
    return orders.join(prices, "item", "left")


def price_at_arrival(orders: DataFrame, changes: DataFrame, before: DataFrame) -> DataFrame:
    """Orders with the last price of their item set before them (by ``seq``), NULL if there is none.

    ``changes``: ``item, price, seq``; ``before``: the last one per item of earlier times. Orders
    without an item have no price.
    """
    earlier = before.select("item", "price", F.lit(None).cast("bigint").alias("seq"))
    both = orders.withColumn("_order", F.lit(True)).unionByName(
        changes.unionByName(earlier), allowMissingColumns=True
    )
    past = W.partitionBy("item").orderBy(F.col("seq").asc_nulls_first())
    price = F.last("price", ignorenulls=True).over(past.rowsBetween(W.unboundedPreceding, 0))
    known = F.when(F.col("item").isNotNull(), price)
    return both.withColumn("price", known).filter("_order").drop("_order")


def session_counts(
    events: DataFrame, keys: Sequence[str], gap: str, time: str = "event_time"
) -> DataFrame:
    """Sessions per key: runs of events less than ``gap`` apart.

    Events of one key in the same ``gap``-wide slot always share a session, so they are
    first counted per slot, before the shuffle. What is then ordered per key is bounded by
    the time covered, not by the number of events.
    """
    gap_micros = int(times.seconds_of(gap) * 1_000_000)
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    slots = (
        events.select(*keys, micros.alias("_at"))
        .withColumn("_slot", F.expr(f"(_at - pmod(_at, {gap_micros})) DIV {gap_micros}"))
        .groupBy(*keys, "_slot")
        .agg(F.min("_at").alias("_from"), F.max("_at").alias("_to"), F.count("_at").alias("_n"))
    )
    in_order = W.partitionBy(*keys).orderBy("_slot")
    apart = F.col("_from") - F.lag("_to").over(in_order)
    starts = F.when(F.coalesce(apart < gap_micros, F.lit(False)), 0).otherwise(1)
    numbered = slots.withColumn("_starts", starts).withColumn(
        "_session", F.sum("_starts").over(in_order.rowsBetween(W.unboundedPreceding, 0))
    )
    return (
        numbered.groupBy(*keys, "_session")
        .agg(
            F.timestamp_micros(F.min("_from")).alias("session_start"),
            F.timestamp_micros(F.max("_to") + gap_micros).alias("session_end"),
            F.sum("_n").alias("event_count"),
        )
        .drop("_session")
    )


def session_counts_stream(events: DataFrame, keys: Sequence[str], gap: str) -> DataFrame:
    """Sessions on a stream (after :func:`analytics.with_lateness`)."""
    counted = events.groupBy(F.session_window("event_time", gap), *keys).agg(
        F.count(F.lit(1)).alias("event_count")
    )
    return counted.select(
        *keys,
        F.col("session_window.start").alias("session_start"),
        F.col("session_window.end").alias("session_end"),
        "event_count",
    )


def customer_order_counts(orders: DataFrame, customer: str) -> DataFrame:
    return orders.groupBy(customer).agg(F.count(F.lit(1)).alias("order_count"))


def high_value_orders(orders: DataFrame, total: str, min_total: float = 1000.0) -> DataFrame:
    return orders.filter(F.col(total) > min_total)


def merge_versions(old: DataFrame, new: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Rows of two schema versions as the new one; fields the old lacks get their default."""
    merged = new.unionByName(old, allowMissingColumns=True)
    for name, value in defaults.items():
        merged = merged.withColumn(name, F.coalesce(F.col(name), F.lit(value)))
    return merged


def saga_metrics(
    events: DataFrame,
    time: str = "event_time",
    retries: DataFrame | None = None,
    dead_letters: DataFrame | None = None,
) -> DataFrame:
    """Counts per event type, and for paid orders the time from creation to payment.

    ``events``: ``order_id, event_type`` and a time. Output: ``metric, value``; also the number
    of rows of ``retries`` and ``dead_letters`` where they are given.
    """
    counts = events.groupBy(F.col("event_type").alias("metric")).agg(
        F.count(F.lit(1)).cast("double").alias("value")
    )
    waits = completion_times(events, time)
    paid = waits.agg(F.count(F.lit(1)).cast("double").alias("value")).select(
        F.lit("paid_orders").alias("metric"), "value"
    )
    shares = {"completion_seconds_p50": 0.5, "completion_seconds_p95": 0.95}
    spread = exact_percentiles(waits, "wait_micros", shares).select(
        "metric", (F.col("value") / F.lit(1_000_000.0)).alias("value")
    )
    result = counts.unionByName(paid).unionByName(spread)
    for name, rows in (("retries", retries), ("dead_letters", dead_letters)):
        if rows is not None:
            counted = rows.agg(F.count(F.lit(1)).cast("double").alias("value"))
            result = result.unionByName(counted.select(F.lit(name).alias("metric"), "value"))
    return result


def exact_percentiles(
    df: DataFrame, column: str, shares: Mapping[str, float], width: int = 1_000_000
) -> DataFrame:
    """``metric, value``: interpolated percentiles of a whole-number column, one row per share.

    In two steps, so that no task holds all values: counts per range of ``width`` values give
    the range of each wanted rank, and only there are single values counted. Without rows the
    value is NULL.
    """
    ranges = df.groupBy(F.expr(f"`{column}` DIV {width}").alias("_range")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    upto = W.orderBy("_range").rowsBetween(W.unboundedPreceding, W.currentRow)
    ends = ranges.withColumn("_end", F.sum("_n").over(upto))
    wanted = F.explode(
        F.array(
            *[
                F.struct(F.lit(name).alias("metric"), F.lit(share).alias("_share"))
                for name, share in shares.items()
            ]
        )
    )
    total = df.agg(F.count(F.lit(1)).alias("_total")).select("_total", wanted.alias("_w"))
    place = F.col("_w._share") * (F.col("_total") - 1)
    ranks = total.select(
        "_w.metric",
        (place - F.floor(place)).alias("_part"),
        F.explode(F.array(F.floor(place), F.ceil(place))).alias("_rank"),
    ).distinct()
    # One or two ranks per share meet the counts of the ranges.
    found = ranks.join(
        ends, (F.col("_rank") < F.col("_end")) & (F.col("_rank") >= F.col("_end") - F.col("_n"))
    ).select("metric", "_part", "_rank", "_range", (F.col("_end") - F.col("_n")).alias("_before"))
    inside = (
        df.select(F.col(column).alias("_value"), F.expr(f"`{column}` DIV {width}").alias("_range"))
        .join(F.broadcast(found), "_range")
        .groupBy("metric", "_part", "_rank", "_before", "_value")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    by_value = W.partitionBy("metric", "_rank").orderBy("_value")
    at = inside.withColumn(
        "_end", F.col("_before") + F.sum("_n").over(by_value.rowsBetween(W.unboundedPreceding, 0))
    ).filter((F.col("_rank") < F.col("_end")) & (F.col("_rank") >= F.col("_end") - F.col("_n")))
    values = at.groupBy("metric").agg(
        (
            F.min("_value") + (F.max("_value") - F.min("_value")) * F.max("_part")
        ).alias("value")
    )
    names = df.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(name) for name in shares])).alias("metric")
    )
    return names.join(values, "metric", "left")


def completion_times(events: DataFrame, time: str = "event_time") -> DataFrame:
    """Seconds from the first creation to the first payment, per paid order."""
    kind = F.col("event_type")
    both = events.groupBy("order_id").agg(
        F.min(F.when(kind == C.ORDER_CREATED, F.col(time))).alias("_created"),
        F.min(F.when(kind == C.PAYMENT_COMPLETED, F.col(time))).alias("_paid"),
    )
    wait = F.unix_micros(F.col("_paid").cast("timestamp")) - F.unix_micros(
        F.col("_created").cast("timestamp")
    )
    return both.filter("_paid >= _created").select(
        "order_id",
        wait.alias("wait_micros"),
        (wait / F.lit(1_000_000.0)).alias("wait_seconds"),
    )


def client_rate_limit(
    requests: DataFrame,
    client: str,
    limit: int = C.CLIENT_REQUESTS_PER_MINUTE,
    window: str = "1 minute",
    time: str = "event_time",
) -> DataFrame:
    """Clients and windows with more requests than allowed."""
    counted = requests.groupBy(F.window(time, window), client).agg(
        F.count(F.lit(1)).alias("request_count")
    )
    return counted.filter(F.col("request_count") > limit).select(
        client, F.col("window.start").alias("window_start"), "request_count"
    )


def out_of_order_events(
    events: DataFrame,
    key: str = "key",
    seq: str = "seq",
    time: str = "event_time",
    block_rows: int = hot_keys.BLOCK_ROWS,
) -> DataFrame:
    """Events that are older than the one before them in their key."""
    keyed = events.filter(F.col(key).isNotNull())
    seen = hot_keys.previous_value(keyed, [key], seq, time, "previous_time", block_rows)
    return seen.filter(F.col("previous_time") > F.col(time))


# State a saga is in after the last event of its order, and the step then due.
SAGA_STATES = {
    C.ORDER_CREATED: ("STARTED", "reserve inventory"),
    C.INVENTORY_RESERVED: ("INVENTORY_RESERVED", "charge payment"),
    C.INVENTORY_RESERVATION_FAILED: ("FAILED", "none"),
    C.PAYMENT_COMPLETED: ("COMPLETED", "none"),
    C.PAYMENT_FAILED: ("COMPENSATING", "release inventory"),
    C.INVENTORY_RELEASED: ("FAILED", "none"),
}


def saga_state(events: DataFrame) -> DataFrame:
    """State and due step per order. ``events``: ``order_id, event_type, seq``."""
    kinds = list(SAGA_STATES)
    # As a number the type is aggregated in a hash table; text would need a sort.
    code = F.array_position(F.lit(kinds), F.col("event_type")).cast("int")
    known = events.filter(F.col("event_type").isin(*kinds)).withColumn("_code", code)
    last = known.groupBy("order_id").agg(F.max_by("_code", "seq").alias("_code"))
    states = [state for state, _ in SAGA_STATES.values()]
    steps = [step for _, step in SAGA_STATES.values()]
    return last.select(
        "order_id",
        F.element_at(F.lit(kinds), F.col("_code")).alias("last_event"),
        F.element_at(F.lit(states), F.col("_code")).alias("state"),
        F.element_at(F.lit(steps), F.col("_code")).alias("current_step"),
    )
