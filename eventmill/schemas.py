"""Schemas of topic records, payloads and tables, as DDL text."""

from __future__ import annotations

TOPIC_RECORD = (
    "key STRING, value STRING, topic STRING, partition INT, offset BIGINT, "
    "timestamp TIMESTAMP, headers ARRAY<STRUCT<key: STRING, value: BINARY>>"
)

OUTBOX = (
    "seq BIGINT, event_id STRING, topic STRING, key STRING, value BINARY, "
    "created_at TIMESTAMP, published_at TIMESTAMP"
)

# Payload fields per event type, with the JSON type a strict reader requires.
PAYLOAD_FIELDS: dict[str, list[tuple[str, str]]] = {
    "OrderCreated": [("orderId", "string"), ("item", "string"), ("quantity", "int")],
    "InventoryReserved": [("orderId", "string"), ("item", "string"), ("quantity", "int")],
    "InventoryReservationFailed": [("orderId", "string"), ("reason", "string")],
    "InventoryReleased": [("orderId", "string")],
    "PaymentCompleted": [("orderId", "string"), ("paymentId", "string"), ("amount", "double")],
    "PaymentFailed": [("orderId", "string"), ("reason", "string")],
}
