"""Ordered per-key work with a key cut into blocks gives what one pass gives."""

import random

import pytest
from pyspark.sql import functions as F

from eventmill.operators import allocation, hot_keys, saga


def rows_with_hot_key(n, seed):
    """Two thirds of the rows share one key, in bursts; values are small integers."""
    rng = random.Random(seed)
    rows, seq = [], 0
    for _ in range(n):
        seq += rng.choice([1, 1, 1, 2, 5])
        key = "hot" if rng.random() < 0.66 else f"k{rng.randrange(12)}"
        rows.append((key, seq, rng.choice([None, 1, 2, 3, 9])))
    return rows


@pytest.mark.parametrize("block_rows", [3, 10, 1000])
def test_running_values(spark, block_rows):
    rows = rows_with_hot_key(300, block_rows)
    df = spark.createDataFrame(rows, "key string, seq bigint, v int").repartition(5)
    value = F.coalesce("v", F.lit(0))
    summed = hot_keys.running_sum(df, ["key"], "seq", value, "total", block_rows)
    counted = hot_keys.running_count(summed, ["key"], "seq", "n", block_rows)
    largest = hot_keys.running_max(counted, ["key"], "seq", value, "high", block_rows)
    out = hot_keys.previous_value(largest, ["key"], "seq", "v", "before", block_rows)
    got = {r["seq"]: (r["total"], r["n"], r["high"], r["before"]) for r in out.collect()}
    state, expected = {}, {}
    for key, seq, v in sorted(rows, key=lambda r: r[1]):
        total, n, high, before = state.get(key, (0, 0, None, None))
        w = v or 0
        total, n, high = total + w, n + 1, w if high is None else max(high, w)
        expected[seq] = (total, n, high, before)
        state[key] = (total, n, high, v)
    assert got == expected


def brute_force(requests, stock):
    left, out = dict(stock), {}
    for item, seq, quantity, holds in sorted(requests, key=lambda r: r[1]):
        before = left.get(item)
        fits = before is not None and before >= quantity
        out[seq] = (before, fits)
        if fits and holds:
            left[item] -= quantity
    return out


def allocate(spark, requests, stock, block_rows):
    req = spark.createDataFrame(requests, "item string, seq bigint, quantity int, holds boolean")
    table = spark.createDataFrame(stock, "item string, available_quantity int")
    out = allocation.allocate(req.repartition(4), table, block_rows)
    return {r["seq"]: (r["available_before"], r["reserved"]) for r in out.collect()}


def random_requests(seed, n=250, low=1):
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        item = "hot" if rng.random() < 0.6 else rng.choice(["a", "b", "c", "unknown"])
        quantity = rng.choice([1, 2, 3, 7, 20, 64, 100]) if low > 0 else rng.randint(low, 30)
        rows.append((item, seq * 3, quantity, rng.random() < 0.7))
    return rows


STOCK = [("hot", 700), ("a", 100), ("b", 0), ("c", 2000)]


@pytest.mark.parametrize("seed,block_rows", [(1, 7), (2, 20), (3, 10_000), (4, 1)])
def test_allocation_equals_one_by_one(spark, seed, block_rows):
    requests = random_requests(seed)
    assert allocate(spark, requests, STOCK, block_rows) == brute_force(requests, dict(STOCK))


@pytest.mark.parametrize("seed,block_rows", [(5, 15), (6, 40)])
def test_allocation_with_quantities_that_add_stock(spark, seed, block_rows):
    requests = random_requests(seed, low=-4)
    assert allocate(spark, requests, STOCK, block_rows) == brute_force(requests, dict(STOCK))


def test_hot_item_may_be_unknown(spark):
    requests = [("ghost", i, 1, True) for i in range(50)]
    assert allocate(spark, requests, STOCK, 8) == brute_force(requests, dict(STOCK))


def rounds(monkeypatch):
    """Counts the levels walked, which are the driver's rounds."""
    seen, walk = [], allocation._walk_level
    monkeypatch.setattr(allocation, "_walk_level", lambda *a: seen.append(1) or walk(*a))
    return seen


@pytest.mark.parametrize("choices", [[1, 5, 30], [0, 0, 1, 5, 30]])
def test_rounds_do_not_grow_with_blocks(spark, monkeypatch, choices):
    """With quantities of 0 or more there is a round per power of two, however many blocks."""
    rng, seen = random.Random(9), rounds(monkeypatch)
    requests = [("hot", i, rng.choice(choices), True) for i in range(3000)]
    assert allocate(spark, requests, [("hot", 20_000)], 10) == brute_force(requests, {"hot": 20_000})
    assert len(seen) <= 16


def test_items_that_may_gain_stock_are_streamed(spark, monkeypatch):
    seen = rounds(monkeypatch)
    requests = random_requests(11, n=300, low=-30)
    assert allocate(spark, requests, STOCK, 4) == brute_force(requests, dict(STOCK))
    assert len(seen) <= 16


def resubmitted(rows, stock):
    left, held, want = dict(stock), set(), {}
    for order_id, item, seq, quantity, holds in rows:
        before = left.get(item)
        fits = before is not None and before >= quantity
        if fits and order_id is not None and (item, order_id) in held:
            want[seq] = (before, False, "order already reserved")
            continue
        want[seq] = (before, fits, None)
        if fits and holds:
            held.add((item, order_id))
            left[item] -= quantity
    return want


def resubmit(spark, rows, stock, block_rows):
    schema = "order_id string, item string, seq bigint, quantity int, holds boolean"
    req = spark.createDataFrame(rows, schema).repartition(4)
    table = spark.createDataFrame(stock, "item string, available_quantity int")
    out = allocation.allocate(req, table, block_rows).collect()
    return {r["seq"]: (r["available_before"], r["reserved"], r["error"]) for r in out}


@pytest.mark.parametrize("seed", [1, 2])
def test_resubmitted_orders_that_hold_or_give_back(spark, seed):
    rng = random.Random(seed)
    rows = [
        (rng.choice([None, *[f"o{rng.randrange(60)}"] * 6]), rng.choice(["hot", "hot", "a", "ghost"]),
         i, rng.choice([0, 1, 2, 5, 17, 40, 200]), rng.random() < 0.7)
        for i in range(400)
    ]
    assert resubmit(spark, rows, STOCK, 9) == resubmitted(rows, STOCK)


def test_a_thousand_blocks_with_resubmitted_orders(spark, monkeypatch):
    """Rounds do not grow with the blocks that hold a resubmitted order."""
    rng, seen = random.Random(12), rounds(monkeypatch)
    rows = [
        ("same" if i % 3 == 0 else f"o{rng.randrange(900)}", "hot", i, rng.choice([1, 1, 2, 9]), True)
        for i in range(4000)
    ]
    stock = [("hot", 2500)]
    assert resubmit(spark, rows, stock, 4) == resubmitted(rows, stock)
    assert len(seen) <= 14


def test_many_hot_keys_are_all_split(spark):
    rows = [(f"k{i % 40}", i, 1) for i in range(800)]
    df = spark.createDataFrame(rows, "key string, seq bigint, v int")
    assert hot_keys.hot_keys(df, ["key"], "seq", 5).count() == 40


@pytest.mark.parametrize("block_rows", [6, 1000])
def test_resubmitted_orders_across_blocks(spark, block_rows):
    rng = random.Random(3)
    rows = [
        (f"o{rng.randrange(40)}", rng.choice(["hot", "hot", "a"]), i, rng.randint(0, 20))
        for i in range(150)
    ]
    left, held, want = dict(STOCK), set(), {}
    for order_id, item, seq, quantity in rows:
        before = left[item]
        if before >= quantity and (item, order_id) in held:
            want[seq] = (before, False, "order already reserved")
            continue
        fits = before >= quantity
        want[seq] = (before, fits, None)
        if fits:
            held.add((item, order_id))
            left[item] -= quantity
    req = spark.createDataFrame(rows, "order_id string, item string, seq bigint, quantity int")
    table = spark.createDataFrame(STOCK, "item string, available_quantity int")
    out = allocation.allocate(req.withColumn("holds", F.lit(True)), table, block_rows).collect()
    assert {r["seq"]: (r["available_before"], r["reserved"], r["error"]) for r in out} == want


def test_smaller_order_fits_after_a_larger_was_refused(spark):
    req = spark.createDataFrame(
        [("o1", "widget", 1, 60), ("o2", "widget", 2, 60), ("o3", "widget", 3, 40)],
        "order_id string, item string, seq bigint, quantity int",
    )
    stock = spark.createDataFrame([("widget", 100)], "item string, available_quantity int")
    out = saga.reserve_stock(req, stock).orderBy("seq").collect()
    assert [(r["event_type"], r["reason"]) for r in out] == [
        ("InventoryReserved", None),
        ("InventoryReservationFailed", "insufficient stock"),
        ("InventoryReserved", None),
    ]
