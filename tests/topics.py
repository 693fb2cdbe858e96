"""Building topic records for tests."""

import datetime as dt
import json

from eventmill.schemas import TOPIC_RECORD

T0 = dt.datetime(2026, 9, 25, 10, 0, 0, tzinfo=dt.timezone.utc)


def at(seconds: float) -> str:
    moment = T0 + dt.timedelta(seconds=seconds)
    return moment.strftime("%Y-%m-%dT%H:%M:%S.%fZ") if seconds % 1 else moment.strftime(
        "%Y-%m-%dT%H:%M:%SZ"
    )


def event(key, event_type, payload, seconds=0.0, event_id=None):
    return json.dumps(
        {
            "eventId": event_id or f"{key}-{event_type}",
            "eventType": event_type,
            "aggregateId": key,
            "timestamp": at(seconds),
            "payload": payload,
        }
    )


def created(key, item="widget", quantity=1, seconds=0.0, event_id=None):
    payload = {"orderId": key, "item": item, "quantity": quantity}
    return key, event(key, "OrderCreated", payload, seconds, event_id)


def paid(key, payment_id="p1", amount=75.0, seconds=0.0, event_id=None):
    payload = {"orderId": key, "paymentId": payment_id, "amount": amount}
    return key, event(key, "PaymentCompleted", payload, seconds, event_id)


def records(spark, rows, topic="order.events", record_time=T0, first_offset=0):
    """Topic records of (key, value) pairs, offsets in the given order."""
    data = [
        (key, value, topic, 0, first_offset + i, record_time, None)
        for i, (key, value) in enumerate(rows)
    ]
    return spark.createDataFrame(data, TOPIC_RECORD)
