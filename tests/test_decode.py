"""Lenient and strict reading of records."""

import json

import pytest
from pyspark.sql import functions as F
from topics import T0, created, event, records

from eventmill import constants as C
from eventmill.functions import ids
from eventmill.operators import decode, reliability
from eventmill.sources import driver_tables

UUID = "5b2a7a52-0000-4000-8000-000000000001"


def lenient_rows(spark, payloads):
    rows = [
        ("k", '{"eventType":"OrderCreated","payload":%s}' % text if text is not None
         else '{"eventType":"OrderCreated"}')
        for text in payloads
    ]
    out = decode.order_created(decode.decode_lenient(records(spark, rows))).orderBy("offset")
    return [(r["item"], r["quantity"]) for r in out.collect()]


def test_lenient_coercion_of_every_kind(spark):
    cases = [
        ('{"item":"a","quantity":7}', ("a", 7)),
        ('{"item":"a","quantity":"7"}', ("a", 7)),
        ('{"item":"a","quantity":" 7 "}', ("a", 7)),
        ('{"item":"a","quantity":7.9}', ("a", 7)),
        ('{"item":"a","quantity":-7.9}', ("a", -7)),
        ('{"item":"a","quantity":"7.9"}', ("a", 7)),
        ('{"item":"a","quantity":"1e2"}', ("a", 100)),
        ('{"item":"a","quantity":null}', ("a", 0)),
        ('{"item":"a"}', ("a", 0)),
        ('{"item":"a","quantity":"lots"}', ("a", 0)),
        ('{"item":"a","quantity":true}', ("a", 1)),
        ('{"item":"a","quantity":false}', ("a", 0)),
        ('{"item":"a","quantity":"true"}', ("a", 0)),
        ('{"item":"a","quantity":{"n":1}}', ("a", 0)),
        ('{"item":"a","quantity":3000000000}', ("a", 3000000000 - 2**32)),
        ('{"item":"a","quantity":"3000000000"}', ("a", 0)),
        ('{"item":"a","quantity":50000000000000000000}', ("a", 50000000000000000000 % 2**32 - 2**32)),
        ('{"item":"a","quantity":-50000000000000000000}', ("a", -50000000000000000000 % 2**32)),
        ('{"item":"a","quantity":1e12}', ("a", 2147483647)),
        ('{"item":null,"quantity":1}', ("null", 1)),
        ('{"quantity":1}', ("", 1)),
        ('{"item":{"x":1},"quantity":1}', ("", 1)),
        ('{"item":[1],"quantity":1}', ("", 1)),
        ('{"item":"{x}","quantity":1}', ("{x}", 1)),
        ('{"item":12,"quantity":1}', ("12", 1)),
        ('{"item":true,"quantity":1}', ("true", 1)),
        ('{"item":"a","item":"b","quantity":1}', ("b", 1)),
        ("{}", ("", 0)),
        ("null", ("", 0)),
        ("5", ("", 0)),
        (None, ("", 0)),
    ]
    assert lenient_rows(spark, [c[0] for c in cases]) == [c[1] for c in cases]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("2026-09-25T11:00:00Z", "2026-09-25 11:00:00"),
        ("2026-09-25T11:00:00.123456789Z", "2026-09-25 11:00:00.123"),
        ("2026-09-25T11:00:00+02:00", "2026-09-25 09:00:00"),
        ("2026-09-25", None),
        ("2026-09-25T11:00:00", None),
        ("2026-09-25 11:00:00Z", None),
        ("2026-13-25T11:00:00Z", None),
        ("yesterday", None),
        (123, None),
        (None, None),
    ],
)
def test_event_time_falls_back_to_record_time(spark, text, expected):
    value = json.dumps({"eventType": "OrderCreated", "timestamp": text, "payload": {}})
    row = decode.decode_lenient(records(spark, [("k", value)]))
    got = row.select(F.col("event_time").cast("string")).first()[0]
    assert got == (expected or T0.strftime("%Y-%m-%d %H:%M:%S"))


def test_events_before_1970_are_dropped(spark):
    value = json.dumps({"eventType": "OrderCreated", "timestamp": "1969-12-31T23:59:59Z"})
    assert decode.decode_lenient(records(spark, [("k", value)])).count() == 0


def strict_errors(spark, values, handled=(C.ORDER_CREATED,)):
    rows = [("k", v) for v in values]
    out = decode.decode_strict(records(spark, rows), handled).orderBy("offset")
    return [r["error"] for r in out.collect()]


def order(payload, **changes):
    doc = {"eventId": UUID, "eventType": "OrderCreated", "timestamp": "2026-09-25T10:00:00Z"}
    doc.update(payload=payload, **changes)
    return json.dumps(doc)


def test_strict_errors(spark):
    good = {"orderId": "o", "item": "widget", "quantity": 2}
    bad_payload = "bad OrderCreated payload:"
    no_payload = json.loads(order(good))
    del no_payload["payload"]
    cases = [
        (order(good), None),
        ("this is not json", "decode event:"),
        ("[1]", "decode event:"),
        ("null", "invalid eventId"),
        (order(good, eventId=7), "decode event:"),
        (order(good, timestamp="2026-09-25"), "decode event:"),
        (order(good, timestamp=None), None),
        (order(good, eventId="o1"), "invalid eventId"),
        (order(good, eventId=UUID.upper()), None),
        (order(good, eventId="{" + UUID + "}"), None),
        (order(good, eventId=UUID.replace("-", "")), None),
        (order(good, eventId="urn:uuid:" + UUID), "unstorable eventId"),
        (order({"quantity": "lots"}), bad_payload),
        (order({"quantity": 7.5}), bad_payload),
        (order({"quantity": True}), bad_payload),
        (order({"item": 5}), bad_payload),
        (order([1]), bad_payload),
        (order(None), None),
        (json.dumps(no_payload), bad_payload),
        (order({"quantity": 2**31}), "OrderCreated value out of range"),
        (order({"quantity": None}), None),
        (order({"Quantity": "lots"}), bad_payload),
        (order({"quantity": "lots"}, eventType="PaymentFailed"), None),
    ]
    assert strict_errors(spark, [c[0] for c in cases]) == [c[1] for c in cases]


def test_strict_reading_of_odd_texts(spark):
    good = {"orderId": "o", "item": "widget", "quantity": 2}
    text = order(good)
    bad, bad_payload = "decode event:", "bad OrderCreated payload:"
    cases = [
        (text + " x", bad),
        (text + "]", bad),
        (text + "} ", bad),
        (text + "," + text, bad),
        (text + ',"v":1', bad),
        (text + "] [", bad),
        (" \n" + text + "\t ", None),
        (text.replace('"', "'"), bad),
        (text.replace("2}", "NaN}"), bad),
        (text.replace('"eventId"', '"EventId"'), None),
        (text.replace("10:00:00Z", "10:00:00.1234567891Z"), None),
        (text.replace("10:00:00Z", "10:00:00z"), bad),
        (text.replace("T10:00:00Z", "t10:00:00Z"), bad),
        (text.replace('"quantity": 2', '"quantity": "x", "Quantity": 2'), bad_payload),
        (text.replace('"quantity": 2', '"quantity": 2, "quantity": null'), None),
        (text.replace('"payload"', '"payload": 5, "Payload"'), None),
    ]
    got = strict_errors(spark, [c[0] for c in cases])
    assert got == [c[1] for c in cases]


def test_last_field_of_a_name_counts(spark):
    rows = [
        ('"quantity": 1, "Quantity": 7', 7),
        ('"Quantity": 7, "quantity": 1', 1),
        ('"quantity": 1, "QUANTITY": null', 1),
        ('"Quantity": 3', 3),
    ]
    values = [
        order({"orderId": "o"}).replace('"orderId": "o"', f'"orderId": "o", {fields}').replace(
            "OrderCreated", "Order\\u0043reated")
        for fields, _ in rows
    ]
    decoded = decode.decode_strict(records(spark, [("k", v) for v in values]))
    out = decode.typed_payload(decoded, C.ORDER_CREATED).orderBy("offset").collect()
    assert [r["quantity"] for r in out] == [q for _, q in rows]


def test_lenient_skips_what_is_no_standard_json(spark):
    text = '{"eventType":"OrderCreated","payload":{"item":"a","quantity":%s}}'
    values = [text % "1", (text % "1").replace('"', "'"), text % "NaN", (text % "2") + " x"]
    out = decode.order_created(decode.decode_lenient(records(spark, [("k", v) for v in values])))
    assert [r["quantity"] for r in out.orderBy("offset").collect()] == [1, 2]


def test_payload_is_kept_as_it_came(spark):
    from eventmill.operators import analytics

    payload = '{"quantity":"9","note":"n","item":"a","orderId":"o","more":[1.5,{"x":null}]}'
    value = '{"eventType":"OrderCreated","payload":%s}' % payload
    orders = decode.order_created(decode.decode_lenient(records(spark, [("k", value)])))
    assert analytics.large_orders(orders).first()["payload"] == payload


def test_names_match_in_any_case_and_missing_fields_are_zero(spark):
    value = json.dumps(
        {"EVENTID": UUID, "eventtype": "OrderCreated", "Payload": {"ORDERID": "o1", "Item": "w"}}
    )
    decoded = decode.decode_strict(records(spark, [("k", value)]))
    row = decode.typed_payload(decoded, C.ORDER_CREATED).first()
    assert (row["order_id"], row["item"], row["quantity"]) == ("o1", "w", 0)


def test_broken_messages_of_the_manual_test(spark):
    """Both go to the dead letters; analytics skips one and counts the other under ''."""
    second = json.dumps(
        {"eventId": UUID, "eventType": "OrderCreated", "payload": {"quantity": "lots"}}
    )
    rows = records(spark, [(None, "this is not json"), (None, second)])
    letters = reliability.dead_letters(decode.decode_strict(rows), "inventory-service")
    parked = reliability.parked(letters).orderBy("original_offset").collect()
    assert [r["error"] for r in parked] == ["decode event:", "bad OrderCreated payload:"]
    assert [r["value"] for r in parked] == ["this is not json", second]
    assert {r["topic"] for r in parked} == {"inventory-service.dlq"}
    counted = decode.order_created(decode.decode_lenient(rows)).collect()
    assert [(r["item"], r["quantity"]) for r in counted] == [("", 0)]
    assert counted[0]["event_time"].replace(tzinfo=None) == T0.replace(tzinfo=None)


def test_uuid_forms_share_one_canonical_id(spark):
    forms = [UUID, UUID.upper(), "{" + UUID + "}", UUID.replace("-", ""), "urn:uuid:" + UUID]
    df = spark.createDataFrame([(f,) for f in forms], "id string")
    out = df.select(ids.is_uuid(F.col("id")), ids.canonical_uuid(F.col("id"))).distinct().collect()
    assert [tuple(r) for r in out] == [(True, UUID.replace("-", ""))]


def test_key_and_partition_of_events(spark):
    from eventmill.operators import checks
    from eventmill.sources import topics as source

    rows = [(f"o{i % 5}", event(f"o{i % 5}", "OrderCreated", {})) for i in range(30)]
    frames = []
    for topic in ("order.events", "inventory.events", "payment.events"):
        frame = records(spark, rows, topic)
        frames.append(frame.withColumn("partition", source.partition_of(F.col("key"), 3)))
    merged = frames[0].unionByName(frames[1]).unionByName(frames[2])
    assert checks.misplaced_keys(merged).count() == 0
    assert created("o1")[0] == "o1"


def test_records_of_one_row_group_are_decoded_by_many_tasks(spark, tmp_path):
    rows = [(i, i % 50, "signup", 1.5, f'{{"k": {i % 100}}}') for i in range(2000)]
    events = spark.createDataFrame(
        rows, "event_id bigint, user_id bigint, event_type string, value double, props string"
    ).withColumn("ts", F.expr("timestamp_ntz'2024-01-02 03:04:05'"))
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    read = decode.decode_strict(driver_tables.topic_records(spark, str(tmp_path)))
    tasks = read.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in tasks) == 2000
    assert len(tasks) >= spark.sparkContext.defaultParallelism
    assert max(r["count"] for r in tasks) < 400
