"""Checks an operator of the system runs on its data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill import constants as C


def consumer_lag(records: DataFrame, committed: DataFrame) -> DataFrame:
    """Log end, committed position and lag per group, topic and partition.

    ``records``: ``topic, partition, offset``. ``committed``: ``group, topic, partition,
    committed_offset`` (the next offset to read). A partition that a group of its topic never
    committed has position 0; a committed partition without records ends where it was committed.
    """
    ends = records.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end_offset"))
    # Every partition known of a topic, with the groups that read the topic.
    groups = committed.groupBy("topic").agg(F.collect_set("group").alias("_groups"))
    known = ends.select("topic", "partition").union(committed.select("topic", "partition"))
    places = (
        known.distinct()
        .join(groups, "topic")
        .select("topic", "partition", F.explode("_groups").alias("group"))
    )
    joined = places.join(ends, ["topic", "partition"], "left").join(
        committed, ["group", "topic", "partition"], "left"
    )
    position = F.coalesce("committed_offset", F.lit(0).cast("bigint"))
    end = F.coalesce("end_offset", position)
    return joined.select(
        "group",
        "topic",
        "partition",
        end.alias("end_offset"),
        position.alias("committed_offset"),
        (end - position).alias("lag"),
    )


def key_partition_check(records: DataFrame) -> DataFrame:
    """Per topic: number of keys, and of keys found in more than one partition (must be 0)."""
    per_key = records.groupBy("topic", "key").agg(
        F.min("partition").alias("_low"), F.max("partition").alias("_high")
    )
    return per_key.groupBy("topic").agg(
        F.count(F.lit(1)).alias("key_count"),
        F.count_if(F.col("_low") != F.col("_high")).alias("split_keys"),
    )


def misplaced_keys(records: DataFrame) -> DataFrame:
    """Keys found in more than one partition, over all topics (must be empty)."""
    return (
        records.groupBy("key")
        .agg(F.min("partition").alias("low"), F.max("partition").alias("high"))
        .filter("low <> high")
    )


def order_timeline(*topics: DataFrame, key: str | None = None) -> DataFrame:
    """Events of all topics ordered within their key by ``seq``; of one key if given.

    A sort on key and ``seq`` together, so a key with very many events spreads over tasks.
    """
    merged = topics[0]
    for topic in topics[1:]:
        merged = merged.unionByName(topic)
    if key is not None:
        merged = merged.filter(F.col("key") == key)
    return merged.orderBy("key", "seq")


def saga_audit(
    orders: DataFrame,
    reservations: DataFrame,
    payments: DataFrame,
    events: DataFrame,
    balance: DataFrame,
) -> DataFrame:
    """Named checks with the number of rows that break each (all must be 0).

    ``events``: ``order_id, event_type``. ``reservations``: live ones. ``balance``: see
    :func:`eventmill.operators.saga.stock_balance`.
    """
    codes = {C.PAYMENT_COMPLETED: 1, C.PAYMENT_FAILED: 2}

    def rows(df: DataFrame, **numbers) -> DataFrame:
        """Rows of one source as numbers per order; what a source does not say is 0."""
        names = ("live", "paid_ok", "paid_bad", "told_ok", "told_bad", "done")
        return df.select(
            "order_id", *[F.lit(numbers.get(n, 0)).cast("bigint").alias(n) for n in names]
        )

    status, kind = F.col("status"), F.col("event_type")
    completed = (status == C.PAYMENT_STATUS_COMPLETED).cast("bigint")
    everything = (
        rows(reservations, live=1)
        .union(rows(payments, paid_ok=completed, paid_bad=1 - completed))
        .union(
            rows(
                events.filter(kind.isin(*codes)),
                told_ok=(kind == C.PAYMENT_COMPLETED).cast("bigint"),
                told_bad=(kind == C.PAYMENT_FAILED).cast("bigint"),
            )
        )
        .union(rows(orders.filter(status == C.COMPLETED), done=1))
    )
    sums = [F.sum(n).alias(n) for n in everything.columns if n != "order_id"]
    per_order = everything.groupBy("order_id").agg(*sums)

    def unmatched(mine: str, other: str) -> Column:
        """Rows of one kind whose order has none of the other."""
        return F.when(F.col(other) == 0, F.col(mine)).otherwise(0)

    broken = {
        "at most one live reservation per order": F.when(F.col("live") > 1, 1).otherwise(0),
        "a payment has its event": unmatched("paid_ok", "told_ok")
        + unmatched("paid_bad", "told_bad"),
        "a payment event has its payment": unmatched("told_ok", "paid_ok")
        + unmatched("told_bad", "paid_bad"),
        "a completed order holds its reservation": unmatched("done", "live"),
        "a live reservation belongs to a completed order": unmatched("live", "done"),
    }
    counted = per_order.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(n) for n, c in broken.items()]
    )
    result = balance.filter("closing_quantity < 0").agg(
        F.count(F.lit(1)).alias("violations")
    ).select(F.lit("stock is never negative").alias("check_name"), "violations")
    named = F.array(
        *[F.struct(F.lit(n).alias("check_name"), F.col(f"`{n}`").alias("violations")) for n in broken]
    )
    return result.unionByName(counted.select(F.inline(named)))
