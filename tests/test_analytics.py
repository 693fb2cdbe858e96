"""The analytics branches on small event lists, in batch and as streams."""

import datetime as dt
import json
import tempfile

import pytest
import topics
from pyspark.sql import functions as F
from topics import created, paid, records

from eventmill.operators import analytics, decode, extras
from eventmill.sources import topics as source
from eventmill.streaming import jobs, runner


def orders_of(spark, rows, **kwargs):
    return decode.order_created(decode.decode_lenient(records(spark, rows, **kwargs)))


def payments_of(spark, rows):
    return decode.payment_completed(decode.decode_lenient(records(spark, rows, "payment.events")))


def test_large_orders_keep_key_and_payload(spark):
    rows = [created("o1", quantity=2), created("o2", quantity=5), created("o3", "gadget", 9)]
    large = analytics.large_orders(orders_of(spark, rows))
    payload = large.withColumnRenamed("order_id", "orderId")
    out = source.json_records(payload, "key", "orderId", "item", "quantity").orderBy("key")
    assert [(r["key"], json.loads(r["value"])["quantity"]) for r in out.collect()] == [
        ("o2", 5),
        ("o3", 9),
    ]


COUNT_ROWS = [
    created("o1"),
    created("o2", "gadget"),
    created("o3"),
    ("o1", topics.event("o1", "OrderCancelled", {})),
]


def test_counts_and_changelog_ignore_other_types(spark):
    orders = orders_of(spark, COUNT_ROWS)
    counts = {r["item"]: r["order_count"] for r in analytics.item_counts(orders).collect()}
    assert counts == {"widget": 2, "gadget": 1}
    log = analytics.item_count_changelog(orders, seq="offset").orderBy("offset").collect()
    assert [(r["item"], r["order_count"]) for r in log] == [
        ("widget", 1),
        ("gadget", 1),
        ("widget", 2),
    ]


def test_lookup_of_absent_item_is_zero(spark):
    counts = analytics.item_counts(orders_of(spark, COUNT_ROWS))
    asked = spark.createDataFrame([("widget",), ("sprocket",)], "item string")
    found = {r["item"]: r["order_count"] for r in analytics.counts_lookup(counts, asked).collect()}
    assert found == {"widget": 2, "sprocket": 0}


def test_windows_and_key_text(spark):
    rows = [created(f"o{i}", seconds=s) for i, s in enumerate((10, 50, 70))]
    out = analytics.item_orders_per_window(orders_of(spark, rows)).orderBy("item_window")
    assert [(r["item_window"], r["order_count"]) for r in out.collect()] == [
        ("widget@2026-09-25T10:00:00Z", 2),
        ("widget@2026-09-25T10:01:00Z", 1),
    ]


def test_paid_order_columns(spark):
    orders = orders_of(spark, [created("o1", "gadget", 3)])
    out = analytics.paid_orders(orders, payments_of(spark, [paid("o1", seconds=2)])).collect()
    assert [(r["item"], r["quantity"], r["payment_id"], r["amount"]) for r in out] == [
        ("gadget", 3, "p1", 75.0)
    ]


@pytest.mark.parametrize(
    "shift,matches",
    [(2, 1), (300, 1), (301, 0), (300.001, 0), (-300, 1), (-300.5, 0), (0, 1)],
)
def test_join_bounds_are_inclusive(spark, shift, matches):
    orders = orders_of(spark, [created("o1", seconds=400)])
    payments = payments_of(spark, [paid("o1", seconds=400 + shift), paid("o2", seconds=400)])
    assert analytics.paid_orders(orders, payments).count() == matches


def test_join_multiplies_duplicates_and_skips_null_keys(spark):
    rows = [created("o1"), created("o1"), (None, created("o9")[1])]
    payments = payments_of(spark, [paid("o1"), (None, paid("o9")[1])])
    assert analytics.paid_orders(orders_of(spark, rows), payments).count() == 2


def test_slots_give_the_same_pairs_as_a_plain_join(spark):
    orders = spark.range(400).select(
        (F.col("id") % 3).cast("string").alias("key"),
        F.col("id").cast("string").alias("order_id"),
        F.lit("widget").alias("item"),
        F.lit(1).alias("quantity"),
        F.timestamp_micros(F.col("id") * 61_000_017).alias("event_time"),
    )
    payments = spark.range(400).select(
        (F.col("id") % 3).cast("string").alias("key"),
        F.col("id").cast("string").alias("payment_id"),
        F.lit(1.0).alias("amount"),
        F.timestamp_micros(F.col("id") * 59_000_011).alias("event_time"),
    )
    out = analytics.paid_orders(orders, payments)
    mine = sorted((r["order_id"], r["payment_id"]) for r in out.collect())
    plain = orders.alias("o").join(
        payments.alias("p"),
        F.expr(
            "o.key = p.key AND p.event_time BETWEEN o.event_time - INTERVAL 5 MINUTES "
            "AND o.event_time + INTERVAL 5 MINUTES"
        ),
    )
    expected = sorted((r[0], r[1]) for r in plain.select("order_id", "payment_id").collect())
    assert mine == expected and len(mine) > 100


def test_late_rule_per_record(spark):
    """Dropped exactly when window end plus grace is not after the largest time seen."""
    times = [10, 89.999, 20, 90, 30, 70]
    rows = [created(f"o{i}", seconds=s) for i, s in enumerate(times)]
    orders = orders_of(spark, rows)
    kept = analytics.drop_late(orders).orderBy("offset").collect()
    # Offset 2 arrives at 10:01:29.999 and still counts; offset 4 arrives at 10:01:30.
    assert [r["offset"] for r in kept] == [0, 1, 2, 3, 5]
    blocks = analytics.drop_late(orders, block_rows=2).orderBy("offset").collect()
    assert [r["offset"] for r in blocks] == [0, 1, 2, 3, 5]


# --- streams --------------------------------------------------------------------------------


def write_batches(spark, rows, parts, topic="order.events"):
    """The records as files of a topic folder, in ``parts`` consecutive pieces."""
    folder = tempfile.mkdtemp(prefix="run-") + "/topic"
    size = -(-len(rows) // parts)
    for i in range(0, len(rows), size):
        piece = records(spark, rows[i : i + size], topic, first_offset=i)
        piece.coalesce(1).write.mode("append").parquet(folder)
    return folder


def stream_of(spark, folder):
    return source.stream_topic(spark, folder, maxFilesPerTrigger="1")


ROWS = [
    created(f"o{i}", ["widget", "gadget", "gizmo"][i * i % 3], i % 7, seconds=i * 13)
    for i in range(60)
]


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_stream_equals_batch_for_any_split(spark, parts):
    folder = write_batches(spark, ROWS, parts)
    orders = decode.order_created(decode.decode_lenient(stream_of(spark, folder)))
    batch = orders_of(spark, ROWS)

    sink, checkpoint = runner.job_paths(spark, "t-counts")
    runner.run_update(analytics.item_counts(orders), sink, checkpoint, ["item"])
    mine = runner.read_latest(spark, sink, ["item"]).select("item", "order_count").collect()
    assert sorted(mine) == sorted(analytics.item_counts(batch).collect())

    sink, checkpoint = runner.job_paths(spark, "t-log")
    runner.run_append(
        jobs.count_changes(orders.withColumnRenamed("offset", "seq")), sink, checkpoint
    )
    mine = spark.read.parquet(sink).select("seq", "item", "order_count").collect()
    expected = analytics.item_count_changelog(batch, seq="offset").collect()
    assert sorted(tuple(r) for r in mine) == sorted(tuple(r) for r in expected)


@pytest.mark.parametrize("parts", [1, 3])
def test_stream_join_equals_batch(spark, parts):
    pays = [paid(f"o{i}", f"p{i}", i * 1.5, seconds=i * 20) for i in range(60)]
    orders = decode.order_created(
        decode.decode_lenient(stream_of(spark, write_batches(spark, ROWS, parts)))
    )
    payments = decode.payment_completed(
        decode.decode_lenient(
            stream_of(spark, write_batches(spark, pays, parts, "payment.events"))
        )
    )
    sink, checkpoint = runner.job_paths(spark, "t-join")
    runner.run_append(analytics.paid_orders_stream(orders, payments), sink, checkpoint)
    mine = spark.read.parquet(sink).select("key", "payment_id").collect()
    expected = analytics.paid_orders(orders_of(spark, ROWS), payments_of(spark, pays))
    expected = expected.select("key", "payment_id").collect()
    assert sorted(mine) == sorted(expected) and len(mine) > 10


def test_restart_goes_on_and_fresh_checkpoint_starts_over(spark):
    folder = write_batches(spark, ROWS[:30], 2)
    sink, checkpoint = runner.job_paths(spark, "t-restart")

    def run(sink, checkpoint):
        orders = decode.order_created(decode.decode_lenient(stream_of(spark, folder)))
        runner.run_update(analytics.item_counts(orders), sink, checkpoint, ["item"])
        counts = runner.read_latest(spark, sink, ["item"])
        return sorted(tuple(r) for r in counts.select("item", "order_count").collect())

    run(sink, checkpoint)
    records(spark, ROWS[30:], first_offset=30).coalesce(1).write.mode("append").parquet(folder)
    whole = sorted(tuple(r) for r in analytics.item_counts(orders_of(spark, ROWS)).collect())
    assert run(sink, checkpoint) == whole
    assert run(sink, checkpoint) == whole  # nothing new: nothing counted twice
    assert run(*runner.job_paths(spark, "t-again")) == whole


def test_watermark_drops_rows_of_closed_windows(spark):
    """A late row is kept while its window is open and dropped two batches after it closed."""
    rows = [created("o0", seconds=10), created("o1", seconds=600), created("o2", seconds=605)]
    rows += [created("o3", seconds=20), created("o4", seconds=610)]
    folder = write_batches(spark, rows, 5)
    orders = decode.order_created(decode.decode_lenient(stream_of(spark, folder)))
    windows = analytics.item_orders_per_window(analytics.with_lateness(orders, "30 seconds"))
    sink, checkpoint = runner.job_paths(spark, "t-late")
    runner.run_update(windows, sink, checkpoint, ["item_window"])
    latest = runner.read_latest(spark, sink, ["item_window"])
    counts = {r["item_window"]: r["order_count"] for r in latest.collect()}
    assert counts == {"widget@2026-09-25T10:00:00Z": 1, "widget@2026-09-25T10:10:00Z": 3}


def test_tombstones_and_broken_values_are_skipped(spark):
    rows = [("o1", None), ("o2", "not json"), ("o3", "null"), ("o4", "[1]"), created("o5")]
    assert analytics.item_counts(orders_of(spark, rows)).collect()[0]["order_count"] == 1


def test_long_wire_round_trip(spark):
    from eventmill.functions import envelope

    df = spark.createDataFrame([(0,), (1,), (258,), (2**40 + 5,), (-7,)], "n bigint")
    wire = df.withColumn("w", envelope.long_wire(F.col("n")))
    out = wire.select("n", "w", envelope.long_from_wire(F.col("w")).alias("back")).collect()
    for r in out:
        assert bytes(r["w"]) == r["n"].to_bytes(8, "big", signed=True)
        assert r["back"] == r["n"]


def test_sessions_equal_a_row_by_row_reading(spark):
    base = dt.datetime(2026, 1, 1)
    marks = {"a": [0, 5, 9, 30, 39.9, 50, 60, 70], "b": [0, 10, 19.99, 100]}
    rows = [(k, base + dt.timedelta(minutes=m)) for k, ms in marks.items() for m in ms]
    events = spark.createDataFrame(rows, "key string, event_time timestamp")
    out = extras.session_counts(events, ["key"], "10 minutes")
    mine = sorted((r["key"], r["event_count"]) for r in out.collect())
    assert mine == sorted(_sessions(marks, 10))


def _sessions(marks, gap):
    for key, minutes in marks.items():
        count, last = 0, None
        for m in sorted(minutes):
            if last is not None and m - last >= gap:
                yield key, count
                count = 0
            count, last = count + 1, m
        yield key, count
