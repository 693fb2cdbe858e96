"""The saga's rules on small tables, in batch and as streams."""

import random

import pytest
from pyspark.sql import functions as F

from eventmill import constants as C
from eventmill.operators import checks, saga
from eventmill.streaming import jobs, runner

REQUEST = "order_id string, item string, seq bigint, quantity int"


def stock_of(spark):
    return spark.createDataFrame(
        list(C.STOCK_SEED.items()), "item string, available_quantity int"
    )


def prices_of(spark):
    return spark.createDataFrame(list(C.UNIT_PRICES.items()), "item string, price double")


def run(spark, orders, rate, stock=None):
    requests = spark.createDataFrame(orders, REQUEST)
    return saga.run_saga(requests, stock or stock_of(spark), prices_of(spark), rate)


def closing(spark, outcome):
    live = outcome.filter("reserved AND NOT released").select("order_id", "item", "quantity")
    rows = saga.stock_balance(stock_of(spark), live).collect()
    return {r["item"]: r["closing_quantity"] for r in rows}


def test_paid_order_completes_and_holds_stock(spark):
    out = run(spark, [("o1", "widget", 1, 2)], 0.0)
    row = out.first()
    assert (row["status"], row["amount"], row["payment_status"]) == (C.COMPLETED, 20.0, "COMPLETED")
    assert closing(spark, out) == {"widget": 98, "gadget": 50}


def test_failed_payment_cancels_and_gives_stock_back(spark):
    out = run(spark, [("o1", "gadget", 1, 3)], 1.0)
    row = out.first()
    assert (row["status"], row["reason"], row["released"]) == (
        C.CANCELLED,
        C.PAYMENT_DECLINED,
        True,
    )
    assert closing(spark, out) == {"widget": 100, "gadget": 50}


def test_unknown_item_and_missing_stock_cancel_without_payment(spark):
    out = run(spark, [("o1", "Apple", 1, 1), ("o2", "widget", 2, 500)], 0.0)
    rows = {r["order_id"]: (r["status"], r["reason"], r["payment_status"]) for r in out.collect()}
    assert rows == {
        "o1": (C.CANCELLED, C.UNKNOWN_ITEM, None),
        "o2": (C.CANCELLED, C.INSUFFICIENT_STOCK, None),
    }


def test_invalid_requests_are_rejected(spark):
    rows = [("a", "", 1, 5), ("b", "widget", 2, 0), ("c", None, 3, 5), ("d", "widget", 4, 5)]
    out = saga.validate_orders(spark.createDataFrame(rows, REQUEST)).orderBy("seq").collect()
    assert [(r["accepted"], r["status"]) for r in out] == [(False, None)] * 3 + [(True, "PENDING")]


def test_unpriced_item_has_the_default_price(spark):
    lines = spark.createDataFrame([("gizmo", 4), ("gadget", 2)], "item string, quantity int")
    out = saga.price_lookup(lines, prices_of(spark)).collect()
    assert {r["item"]: r["amount"] for r in out} == {"gizmo": 60.0, "gadget": 50.0}


@pytest.mark.parametrize("rate,failed", [(0.0, 0), (1.0, 1000)])
def test_rates_zero_and_one_are_certain(spark, rate, failed):
    ids = spark.range(1000).select(F.col("id").cast("string").alias("order_id"))
    assert ids.filter(~saga.payment_succeeds(F.col("order_id"), rate)).count() == failed


def test_second_reservation_event_charges_again(spark):
    reserved = spark.createDataFrame(
        [("e1", "o1", "widget", 1), ("e2", "o1", "widget", 1)],
        "event_id string, order_id string, item string, quantity int",
    )
    out = saga.payment_outcome(reserved, prices_of(spark), 0.0)
    assert out.select("payment_id").distinct().count() == 2


def test_release_once_and_only_with_reservation(spark):
    held = spark.createDataFrame(
        [("o1", "widget", 2)], "order_id string, item string, quantity int"
    )
    failures = spark.createDataFrame(
        [("o1", 9), ("o1", 4), ("o7", 5)], "order_id string, seq bigint"
    )
    out = saga.release_stock(held, failures).collect()
    assert [(r["order_id"], r["released_seq"]) for r in out] == [("o1", 4)]
    assert saga.live_reservations(held, failures).count() == 0


def test_last_status_wins_and_unknown_orders_have_no_effect(spark):
    orders = spark.createDataFrame([("o1", "PENDING"), ("o2", "PENDING")], "order_id string, status string")
    events = spark.createDataFrame(
        [
            ("o1", C.PAYMENT_COMPLETED, 1),
            ("o1", C.PAYMENT_FAILED, 2),
            ("o1", C.INVENTORY_RESERVED, 3),
            ("o9", C.PAYMENT_COMPLETED, 4),
        ],
        "order_id string, event_type string, seq bigint",
    )
    out = {r["order_id"]: r["status"] for r in saga.order_status(orders, events).collect()}
    assert out == {"o1": C.CANCELLED, "o2": C.PENDING}


def test_resubmitted_request_is_an_error_only_while_the_first_is_live(spark):
    rows = [
        ("o1", "widget", 1, 500),  # refused
        ("o1", "widget", 2, 60),  # so this one is decided
        ("o1", "widget", 3, 10),  # and this one meets a live reservation
        ("o2", "widget", 4, 40),
        ("o1", "widget", 5, 10),  # no stock left: refused as any other
        ("o2", "gadget", 6, 1),  # another item
    ]
    out = saga.reserve_stock(spark.createDataFrame(rows, REQUEST), stock_of(spark)).orderBy("seq")
    assert [(r["event_type"] or r["error"], r["reason"]) for r in out.collect()] == [
        (C.INVENTORY_RESERVATION_FAILED, C.INSUFFICIENT_STOCK),
        (C.INVENTORY_RESERVED, None),
        ("order already reserved", None),
        (C.INVENTORY_RESERVED, None),
        (C.INVENTORY_RESERVATION_FAILED, C.INSUFFICIENT_STOCK),
        (C.INVENTORY_RESERVED, None),
    ]


def test_released_order_is_decided_again(spark):
    rows = [("o1", "widget", 1, 60), ("o1", "widget", 2, 60), ("o2", "widget", 3, 100)]
    out = run(spark, rows, 1.0).orderBy("seq").collect()
    assert [(r["reserved"], r["released"]) for r in out] == [(True, True)] * 3


def random_orders(n=200, seed=3):
    rng = random.Random(seed)
    items = ["widget", "gadget", "Apple"]
    return [(f"o{i}", rng.choice(items), i, rng.randint(1, 9)) for i in range(n)]


def test_audit_of_a_saga_finds_nothing(spark):
    out = run(spark, random_orders(), 0.3)
    live = out.filter("reserved AND NOT released").select("order_id", "item", "quantity")
    payments = out.filter("payment_status IS NOT NULL").select(
        "order_id", F.col("payment_status").alias("status")
    )
    balance = saga.stock_balance(stock_of(spark), live)
    audit = checks.saga_audit(out, live, payments, saga.saga_events(out), balance).collect()
    assert len(audit) == 6 and all(r["violations"] == 0 for r in audit)


# --- streams --------------------------------------------------------------------------------

MOVEMENT = "item string, kind string, order_id string, seq bigint, quantity bigint, opening bigint"


def run_movements(spark, batches):
    """Feed movements batch by batch to one stock job; return its events."""
    folder, sink, checkpoint = (*runner.job_paths(spark, "stock"), None)
    source, (sink, checkpoint) = folder + "-in", runner.job_paths(spark, "stock")
    for rows in batches:
        spark.createDataFrame(rows, MOVEMENT).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(MOVEMENT).parquet(source)
        runner.run_append(jobs.keep_stock(stream), sink, checkpoint)
    return spark.read.parquet(sink).orderBy("seq").collect()


def test_stream_reserve_release_and_duplicates(spark):
    def move(kind, order_id, seq, quantity=0):
        return ("widget", kind, order_id, seq, quantity, 10)

    batches = [
        [move("reserve", "o1", 1, 8), move("reserve", "o2", 2, 8), move("reserve", "o1", 3, 1)],
        [move("release", "o1", 4), move("release", "o1", 5), move("release", "o9", 6)],
        [move("reserve", "o3", 7, 10), ("ghost", "reserve", "o4", 8, 1, None)],
    ]
    out = run_movements(spark, batches)
    assert [(r["seq"], r["event_type"] or r["error"], r["reason"]) for r in out] == [
        (1, C.INVENTORY_RESERVED, None),
        (2, C.INVENTORY_RESERVATION_FAILED, C.INSUFFICIENT_STOCK),
        (3, "order already reserved", None),
        (4, C.INVENTORY_RELEASED, None),
        (7, C.INVENTORY_RESERVED, None),
        (8, C.INVENTORY_RESERVATION_FAILED, C.UNKNOWN_ITEM),
    ]


@pytest.mark.parametrize("parts", [1, 3])
def test_stream_saga_with_serial_releases_equals_batch(spark, parts):
    """Releases fed right after their order's step give the batch schedule."""
    orders = random_orders(60)
    rate = 0.4
    outcome = {r["order_id"]: r for r in run(spark, orders, rate).collect()}
    movements = []
    for order_id, item, seq, quantity in orders:
        opening = C.STOCK_SEED.get(item)
        movements.append((item, "reserve", order_id, seq * 2, quantity, opening))
        if outcome[order_id]["released"]:
            movements.append((item, "release", order_id, seq * 2 + 1, 0, opening))
    size = -(-len(movements) // parts)
    batches = [movements[i : i + size] for i in range(0, len(movements), size)]
    events = run_movements(spark, batches)
    got = {r["order_id"]: r["reason"] for r in events if r["seq"] % 2 == 0}
    expected = {
        k: (None if v["reserved"] else v["reason"]) for k, v in outcome.items()
    }
    assert got == expected


def test_atomic_outputs_are_read_by_committed_batch(spark):
    from eventmill.session import scratch_path

    root = scratch_path(spark, "atomic")
    sinks = {"state": f"{root}/state", "events": f"{root}/events"}
    marker = f"{root}/marker"

    def split(batch, batch_id):
        return {
            "state": batch.select("id"),
            "events": batch.select(F.concat(F.lit("e"), "id").alias("event_id")),
        }

    write = runner.atomic_sinks(sinks, marker, split)
    write(spark.range(5), 0)
    write(spark.range(5, 8), 1)
    write(spark.range(5, 8), 1)  # a repeated batch replaces itself
    # A batch that stopped before its marker: state written, events missing.
    spark.range(100, 101).write.parquet(f"{sinks['state']}/batch_id=2")
    assert runner.read_committed(spark, sinks["state"], marker).count() == 8
    assert runner.read_committed(spark, sinks["events"], marker).count() == 8


def test_stream_stock_takes_many_items_in_one_frame(spark, monkeypatch):
    """Items are handled in buckets, whose state tells items and orders of one number apart."""
    plain = jobs.StockKeeper.handleInputRows

    def counted(self, key, rows, timerValues):
        for frame in plain(self, key, rows, timerValues):
            yield frame.assign(reason=f"frame {key[0]}")

    monkeypatch.setattr(jobs.StockKeeper, "handleInputRows", counted)
    monkeypatch.setattr(jobs, "ITEM_BUCKETS", 1)
    items = [None, *[f"i{i}" for i in range(20)]]
    first = [(item, "reserve", f"o{n % 2}", n, 4, 5) for n, item in enumerate(items)]
    then = [(item, "release", f"o{n % 2}", 100 + n, 0, 5) for n, item in enumerate(items)]
    then += [(item, "release", f"o{1 - n % 2}", 200 + n, 0, 5) for n, item in enumerate(items)]
    again = [(item, "reserve", "o0", 300 + n, 5, 1) for n, item in enumerate(items)]
    out = run_movements(spark, [first, then, again])
    frames = {r["reason"] for r in out}
    assert frames == {"frame 0"}
    assert [(r["seq"], r["item"], r["event_type"], r["available_before"], r["quantity"]) for r in out] == [
        *[(n, item, C.INVENTORY_RESERVED, 5, 4) for n, item in enumerate(items)],
        *[(100 + n, item, C.INVENTORY_RELEASED, 1, 4) for n, item in enumerate(items)],
        *[(300 + n, item, C.INVENTORY_RESERVED, 5, 5) for n, item in enumerate(items)],
    ]
