"""Deduplication, dead letters, replay, outbox, checks."""

import datetime as dt

from pyspark.sql import functions as F
from topics import created, records

from eventmill.operators import checks, decode, extras, reliability

NOW = dt.datetime(2026, 9, 25, 12, 0, 0)


def uid(n):
    return f"00000000-0000-4000-8000-{n:012d}"


def test_duplicate_is_applied_once_by_services_and_twice_by_analytics(spark):
    rows = [created("o1", event_id=uid(1)), created("o1", event_id=uid(1))]
    rows.append(created("o2", event_id=uid(2)))
    recs = records(spark, rows)
    strict = decode.typed_payload(decode.decode_strict(recs), "OrderCreated")
    once = reliability.dedup_events(strict, seq="offset")
    assert sorted(r["offset"] for r in once.collect()) == [0, 2]
    assert decode.order_created(decode.decode_lenient(recs)).count() == 3


def test_processed_ids_are_skipped_and_recorded(spark):
    events = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "event_id string, seq bigint")
    processed = spark.createDataFrame([("a", NOW)], "event_id string, processed_at timestamp")
    new = reliability.dedup_events(events, processed)
    assert [(r["event_id"], r["seq"]) for r in new.collect()] == [("b", 2)]
    added = reliability.newly_processed(new, F.lit(NOW))
    assert processed.unionByName(added).count() == 2


def test_many_copies_of_one_id_collapse(spark):
    events = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "copy").otherwise(F.col("id").cast("string")).alias("event_id"),
        F.col("id").alias("seq"),
    )
    out = reliability.first_arrivals(events)
    assert out.count() == 5000 - 1667 + 1
    assert out.filter("event_id = 'copy'").first()["seq"] == 0


def test_replayed_letter_reaches_its_topic_again(spark):
    rows = [("k1", "not json"), created("k2", quantity="lots", event_id=uid(2))]
    rows.append(created("k3", quantity="lots", event_id=uid(3)))
    letters = reliability.dead_letters(decode.decode_strict(records(spark, rows)), "g")
    processed = spark.createDataFrame([(uid(3).upper(),)], "event_id string")
    all_keys = reliability.dlq_replay(letters, processed).collect()
    assert sorted((r["key"], r["topic"]) for r in all_keys) == [
        ("k1", "order.events"),
        ("k2", "order.events"),
    ]
    one = reliability.dlq_replay(letters, processed, key="k2").collect()
    assert [(r["key"], r["value"]) for r in one] == [rows[1]]


def test_letter_headers(spark):
    letters = reliability.dead_letters(
        decode.decode_strict(records(spark, [("k", "x")], first_offset=41)), "g", F.lit(NOW)
    )
    headers = {h["key"]: bytes(h["value"]).decode() for h in letters.first()["headers"]}
    assert headers == {
        "dlq-original-topic": "order.events",
        "dlq-original-partition": "0",
        "dlq-original-offset": "41",
        "dlq-error": "decode event:",
        "dlq-failed-at": "2026-09-25T12:00:00Z",
    }


def test_retry_actions(spark):
    rows = [(1, 1), (1, 0), (2, 1), (2, 3), (3, 60)]
    failures = spark.createDataFrame(
        [(a, NOW - dt.timedelta(seconds=s)) for a, s in rows], "attempt int, failed_at timestamp_ntz"
    )
    out = reliability.retry_due(failures, F.lit(NOW).cast("timestamp_ntz"))
    assert [r["action"] for r in out.collect()] == ["retry", "wait", "wait", "retry", "dlq"]


def test_failure_record_columns(spark):
    failures = spark.createDataFrame(
        [("{}", "boom", 3, NOW)], "value string, error string, attempt int, failed_at timestamp"
    )
    row = reliability.failure_records(failures, "payment").first()
    assert (row["original_event"], row["attempt_count"], row["service"]) == ("{}", 3, "payment")


def test_outbox_batches_publish_oldest_first_until_empty(spark):
    outbox = spark.range(250).select(
        F.col("id").alias("seq"),
        F.lit("order.events").alias("topic"),
        F.lit(NOW).alias("created_at"),
        F.lit(None).cast("timestamp").alias("published_at"),
    )
    sizes = []
    for _ in range(4):
        batch = reliability.outbox_next_batch(outbox)
        seqs = [r["seq"] for r in batch.collect()]
        sizes.append(len(seqs))
        assert seqs == sorted(seqs)
        outbox = reliability.mark_published(outbox, batch, F.lit(NOW))
    assert sizes == [100, 100, 50, 0]
    assert reliability.outbox_backlog(outbox).count() == 0


def test_relay_of_an_outbox_stream_publishes_each_row_once(spark):
    from eventmill.schemas import OUTBOX
    from eventmill.streaming import runner

    folder, _ = runner.job_paths(spark, "outbox")
    sink, checkpoint = runner.job_paths(spark, "relay")

    def queue(low, high):
        rows = [(i, uid(i), "order.events", f"o{i}", b"{}", NOW, None) for i in range(low, high)]
        spark.createDataFrame(rows, OUTBOX).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(OUTBOX).parquet(folder)
        runner.run_append(reliability.relay_records(stream), sink, checkpoint)
        return sorted(r["key"] for r in spark.read.parquet(sink).collect())

    assert queue(0, 3) == ["o0", "o1", "o2"]
    assert queue(3, 5) == ["o0", "o1", "o2", "o3", "o4"]


def test_lag_falls_to_zero(spark):
    recs = records(spark, [created(f"o{i}") for i in range(5)])
    schema = "group string, topic string, partition int, committed_offset bigint"

    def lag(offset):
        committed = spark.createDataFrame([("g", "order.events", 0, offset)], schema)
        return checks.consumer_lag(recs, committed).first()["lag"]

    assert (lag(4), lag(5)) == (1, 0)


def test_seed_keeps_existing_rows(spark):
    table = spark.createDataFrame([("widget", 7)], "item string, available_quantity int")
    seed = spark.createDataFrame([("widget", 100), ("gadget", 50)], table.schema)
    out = reliability.seed_if_absent(table, seed, "item").collect()
    assert sorted(tuple(r) for r in out) == [("gadget", 50), ("widget", 7)]


def test_old_rows_get_the_default_currency(spark):
    old = spark.createDataFrame([("1", 5.0)], "order_id string, amount double")
    new = spark.createDataFrame(
        [("2", 6.0, "EUR"), ("3", 7.0, None)], "order_id string, amount double, currency string"
    )
    out = extras.merge_versions(old, new, {"currency": "USD"}).orderBy("order_id").collect()
    assert [r["currency"] for r in out] == ["USD", "EUR", "USD"]


def test_timeline_of_one_key(spark):
    def topic(name, seqs):
        rows = [("o1", s, name) for s in seqs] + [("o2", 99, name)]
        return spark.createDataFrame(rows, "key string, seq bigint, topic string")

    out = checks.order_timeline(topic("a", [1, 5]), topic("b", [3]), topic("c", [2, 8]), key="o1")
    assert [r["seq"] for r in out.collect()] == [1, 2, 3, 5, 8]


def test_latest_event_of_any_type(spark):
    rows = [("o1", "OrderCreated", 1), ("o1", "OrderCancelled", 9), ("o2", "PaymentFailed", 3),
            (None, "view", 4), (None, "OrderCreated", 2)]
    events = spark.createDataFrame(rows, "key string, event_type string, seq bigint")
    out = {tuple(r) for r in extras.latest_event_per_order(events.limit(3), events).collect()}
    assert out == {("o1", "OrderCancelled", 9), ("o2", "PaymentFailed", 3), (None, "view", 4)}


def test_first_copies_are_those_of_the_least_place(spark):
    rows = [(f"e{i % 5}", i % 3, 100 - i, i) for i in range(60)] + [(None, 1, 5, 60), (None, 0, 9, 61)]
    events = spark.createDataFrame(rows, "event_id string, part int, at bigint, row int")
    out = reliability.first_arrivals(events, seq=("part", "at")).collect()
    least = {}
    for event_id, part, at, row in rows:
        least[event_id] = min(least.get(event_id, (9, 0, 0)), (part, at, row))
    assert {r["event_id"]: (r["part"], r["at"], r["row"]) for r in out} == least


def test_negative_numbers_keep_their_order(spark):
    rows = [(a, b) for a in (-(2**31), -1, 0, 1, 2**31) for b in (-(2**63), -1, 0, 1, 2**63 - 1)]
    df = spark.createDataFrame(rows, "a bigint, b bigint")
    places = df.select("a", "b", reliability.place_of("a", "b").alias("p")).collect()
    assert [tuple(r)[:2] for r in sorted(places, key=lambda r: r["p"])] == sorted(rows)
