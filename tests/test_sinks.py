"""Tables kept by streams, the outbox, and prices as of arrival: bounded files, repeats, restarts."""

import os

import pytest
from pyspark.sql import functions as F

from eventmill.operators import extras
from eventmill.streaming import jobs, runner
from eventmill.streaming.outbox import Outbox


def files(folder):
    return sorted(
        os.path.join(at, n) for at, _, names in os.walk(folder) for n in names if n.endswith(".parquet")
    )


@pytest.fixture
def table(spark):
    sink, _ = runner.job_paths(spark, "table")
    return runner.KeyedTable(sink, ["k"], buckets=4)


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k string, v bigint")


def current(spark, table):
    return sorted((tuple(r) for r in table.rows(spark).collect()), key=repr)


def test_last_row_of_every_key(spark, table):
    table.write(rows(spark, ("a", 1), ("b", 1), (None, 1)), 0)
    table.write(rows(spark, ("a", 2), ("c", 2)), 1)
    table.write(rows(spark), 2)
    table.write(rows(spark, (None, 3)), 3)
    assert current(spark, table) == [("a", 2), ("b", 1), ("c", 2), (None, 3)]


def test_a_repeated_batch_replaces_itself(spark, table):
    table.write(rows(spark, ("a", 1), ("b", 1)), 0)
    table.write(rows(spark, ("a", 2), ("d", 2)), 1)
    table.write(rows(spark, ("a", 5)), 1)
    assert current(spark, table) == [("a", 5), ("b", 1)]


def test_files_do_not_grow_with_batches(spark, table):
    counts = []
    for batch in range(9):
        table.write(rows(spark, *[(f"k{i}", batch) for i in range(12)]), batch)
        counts.append(len(files(table.sink)))
    assert max(counts) <= 2 * 4 + 2 and counts[-1] == counts[3]


def test_untouched_buckets_are_not_rewritten(spark, table):
    table.write(rows(spark, *[(f"k{i}", 0) for i in range(12)]), 0)
    before = set(files(f"{table.sink}/data"))
    table.write(rows(spark, ("k1", 1)), 1)
    assert before <= set(files(f"{table.sink}/data"))
    assert len(set(files(f"{table.sink}/data")) - before) == 1


def test_empty_table(spark, table):
    table.write(rows(spark), 0)
    assert current(spark, table) == [] and table.rows(spark).columns == ["k", "v"]


def test_prices_as_of_arrival_over_restarts(spark):
    root, checkpoint = runner.job_paths(spark, "prices")
    schema = "item string, seq bigint, quantity int, price double"
    parts = [
        [("x", 1, 5, None), ("x", 2, None, 1.5), ("x", 3, 5, None), ("y", 4, 5, None), (None, 5, 5, None)],
        [("x", 6, 5, None), ("x", 7, None, 2.5), ("y", 8, None, 9.0), ("x", 9, 1, None), (None, 10, None, 4.0)],
        [("y", 11, 5, None), ("x", 12, 5, None), (None, 13, 5, None), ("z", 14, 5, None)],
    ]
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(schema).parquet(f"{root}/in")
        runner.run_batches(stream, jobs.price_enricher(f"{root}/orders", f"{root}/prices"), checkpoint)
    found = {r["seq"]: r["price"] for r in spark.read.parquet(f"{root}/orders").collect()}
    assert found == {1: None, 3: 1.5, 4: None, 5: None, 6: 1.5, 9: 2.5, 11: 9.0, 12: 2.5, 13: None, 14: None}


def test_price_at_arrival_of_one_batch(spark):
    orders = spark.createDataFrame([("x", 5), ("x", 1)], "item string, seq bigint")
    changes = spark.createDataFrame([("x", 2.0, 3)], "item string, price double, seq bigint")
    before = spark.createDataFrame([("x", 1.0, 99)], changes.schema)
    out = extras.price_at_arrival(orders, changes, before).collect()
    assert {(r["seq"], r["price"]) for r in out} == {(1, 1.0), (5, 2.0)}


def outbox(spark, n, segment_rows):
    made = spark.range(n).select(F.col("id").alias("seq"), F.lit("orders").alias("topic"), F.lit("v" * 50).alias("value"))
    box = Outbox(spark, runner.job_paths(spark, "outbox")[0], made.schema, segment_rows).create()
    box.append(made.repartition(3))
    return box


def now():
    return F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")


def test_relay_publishes_everything_in_order_once(spark):
    box, sent = outbox(spark, 25, 4), []
    while batch := box.next_batch(10).collect():
        sent += [r["seq"] for r in batch]
        box.mark(spark.createDataFrame(batch, box.schema), now())
    assert sent == list(range(25))
    assert box.table().filter("published_at IS NULL").count() == 0 and box.table().count() == 25
    # A row that comes late opens its segment again.
    late = spark.createDataFrame([(-3, "orders", "late"), (25, "orders", "new")], box.schema)
    box.append(late)
    assert [r["seq"] for r in box.next_batch().collect()] == [-3, 25]
    assert [tuple(r) for r in box.backlog().collect()] == [("orders", 2, -3)]


def test_marking_writes_the_same_for_any_outbox(spark):
    wrote = []
    for n in (300, 3000):
        box = outbox(spark, n, 100)
        before = set(files(box.folder))
        box.mark(box.next_batch(100), now())
        new = set(files(box.folder)) - before
        assert all("/rows/" not in f for f in new)
        wrote.append(sum(os.path.getsize(f) for f in new))
    assert wrote[1] <= 1.2 * wrote[0]


def test_relay_reads_open_segments_only(spark):
    box = outbox(spark, 1000, 100)
    box.mark(box.next_batch(500), now())
    plan = box.unpublished()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("(segment") >= 2 and ">= 5)" in plan.split("PartitionFilters", 1)[1]
    assert [r["seq"] for r in box.next_batch(2).collect()] == [500, 501]
