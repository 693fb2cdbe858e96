"""Decoding topic records: leniently for analytics, strictly with an error column for the saga.

All functions are row-local, so they run the same on batch and streaming DataFrames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill import constants as C
from eventmill.functions import coercion, ids, times
from eventmill.schemas import PAYLOAD_FIELDS

INT_MIN, INT_MAX = coercion.INT_MIN, coercion.INT_MAX


# The envelope, every field of any JSON type; ``_bad`` is set where the value is no JSON object.
ENVELOPE = (
    "eventId VARIANT, eventType VARIANT, aggregateId VARIANT, timestamp VARIANT, "
    "payload VARIANT, _bad STRING"
)


def decode_lenient(records: DataFrame) -> DataFrame:
    """Envelope fields of every record whose value is a JSON object; others are skipped.

    Output: ``key, event_id, event_type, aggregate_id, event_time, payload, value`` plus
    ``partition, offset``. Records with an event time before 1970 are dropped. Text after the
    object is ignored.
    """
    options = {"columnNameOfCorruptRecord": "_bad", **coercion.STANDARD_JSON}
    read = F.from_json("value", ENVELOPE, options)
    names = {
        "event_id": "eventId",
        "event_type": "eventType",
        "aggregate_id": "aggregateId",
        "time": "timestamp",
    }
    parsed = records.select(
        F.col("key").cast("string").alias("key"),
        F.col("timestamp").alias("_record_time"),
        "value",
        "partition",
        "offset",
        F.inline(F.array(read)),
    )
    scalars = parsed.filter(F.col("_bad").isNull()).select(
        "key",
        "_record_time",
        "payload",
        "value",
        "partition",
        "offset",
        *[F.try_variant_get(n, "$", "string").alias(f"{c}_text") for c, n in names.items()],
        *[coercion.json_kind(F.col(n)).alias(f"{c}_kind") for c, n in names.items()],
    )
    return scalars.select(
        "key",
        coercion.lenient_text("event_id").alias("event_id"),
        coercion.lenient_text("event_type").alias("event_type"),
        coercion.lenient_text("aggregate_id").alias("aggregate_id"),
        times.event_time(F.col("time_text"), F.col("_record_time")).alias("event_time"),
        "payload",
        "value",
        "partition",
        "offset",
    ).filter(F.col("event_time") >= F.timestamp_seconds(F.lit(0)))


def is_type(event_type: str) -> Column:
    """Null-safe test of the event type."""
    return F.col("event_type").eqNullSafe(event_type)


def order_created(decoded: DataFrame) -> DataFrame:
    """Typed OrderCreated rows: ``key, event_time, order_id, item, quantity``, the payload as JSON
    text with all its fields, and the position."""
    paths = {"order_id": "$.orderId", "item": "$.item", "quantity": "$.quantity"}
    payload = F.from_json("value", "payload STRING", coercion.STANDARD_JSON)["payload"]
    created = decoded.filter(is_type(C.ORDER_CREATED))
    return coercion.add_scalars(created, "payload", paths).select(
        "key",
        "event_time",
        coercion.lenient_text("order_id").alias("order_id"),
        coercion.lenient_text("item").alias("item"),
        coercion.lenient_int("quantity").alias("quantity"),
        payload.alias("payload"),
        "partition",
        "offset",
    )


def payment_completed(decoded: DataFrame) -> DataFrame:
    """Typed PaymentCompleted rows: ``key, event_time, payment_id, amount`` and position."""
    paths = {"payment_id": "$.paymentId", "amount": "$.amount"}
    paid = decoded.filter(is_type(C.PAYMENT_COMPLETED))
    return coercion.add_scalars(paid, "payload", paths).select(
        "key",
        "event_time",
        coercion.lenient_text("payment_id").alias("payment_id"),
        coercion.lenient_double("amount").alias("amount"),
        "partition",
        "offset",
    )


def _payload_error(event_type: str) -> Column:
    """Error of a payload of this type; its fields were read into ``_fields``."""
    # An absent payload is an error, JSON null is not (it decodes to the zero struct).
    kind, fields = F.col("_payload_kind"), F.col("_fields")
    bad = ~F.coalesce((kind == "VOID") | kind.startswith("OBJECT<"), F.lit(False))
    # A whole number the reader accepts but the INT column does not.
    too_large = F.lit(False)
    for name, target in PAYLOAD_FIELDS[event_type]:
        bad = bad | ~coercion.strict_ok(fields, name, target)
        if target == "int":
            whole = coercion.strict_value(fields, name, "int")
            too_large = too_large | (whole > INT_MAX) | (whole < INT_MIN)
    return F.when(
        F.col("event_type") == event_type,
        F.when(bad, f"bad {event_type} payload:").when(
            too_large, f"{event_type} value out of range"
        ),
    )


def decode_strict(records: DataFrame, handled: Sequence[str] = (C.ORDER_CREATED,)) -> DataFrame:
    """All record columns plus envelope columns, ``error`` and the payload's fields.

    Names match in any letter case; of several fields with one name all must be readable, and the
    last one that is not null counts. Checks run in the order JSON, id, payload; ``error`` is NULL
    for a good record. The payload is checked for ``handled`` types only, so a broken payload of
    an ignored type is no error.
    """
    names = {"event_id": "eventId", "event_type": "eventType", "aggregate_id": "aggregateId"}
    raw = list(records.columns)
    value = F.col("value")
    read = coercion.once(records, coercion.read_objects(value).alias("_docs"))
    doc = F.get(F.col("_docs"), F.lit(0))
    parsed = coercion.once(
        read,
        coercion.one_value(value, F.col("_docs")).alias("_one"),
        coercion.object_fields(doc).alias("_outer"),
        coercion.last_field(doc, "payload").alias("_payload"),
    )
    outer, payload = F.col("_outer"), F.col("_payload")
    kind = coercion.json_kind(payload)
    envelope = coercion.once(
        parsed.drop("_docs"),
        kind.alias("_payload_kind"),
        coercion.ordered_fields(payload, value, "payload").alias("_fields"),
        *[coercion.strict_value(outer, n, "string").alias(c) for c, n in names.items()],
        coercion.strict_text(outer, "timestamp").alias("_time_text"),
        times.parse_strict_instant(coercion.strict_text(outer, "timestamp")).alias("event_time"),
    )
    envelope_ok = F.col("_one") & (F.col("_time_text").isNull() | F.col("event_time").isNotNull())
    for n in (*names.values(), "timestamp"):
        envelope_ok = envelope_ok & coercion.strict_ok(outer, n, "string")
    error = F.coalesce(
        F.when(~F.coalesce(envelope_ok, F.lit(False)), "decode event:"),
        F.when(~ids.is_uuid(F.col("event_id")), "invalid eventId"),
        F.when(ids.is_urn(F.col("event_id")), "unstorable eventId"),
        *[_payload_error(t) for t in handled],
    )
    checked = coercion.once(envelope, error.alias("error"))
    return checked.select(*raw, *names, "event_time", "error", F.col("_fields").alias("payload"))


def typed_payload(decoded: DataFrame, event_type: str) -> DataFrame:
    """Good rows of one type, payload fields as typed columns (after :func:`decode_strict`)."""
    columns = []
    for name, kind in PAYLOAD_FIELDS[event_type]:
        value = coercion.strict_value(F.col("payload"), name, kind)
        snake = "".join(f"_{c.lower()}" if c.isupper() else c for c in name)
        columns.append((value.try_cast("int") if kind == "int" else value).alias(snake))
    dropped = {"error", "value", "headers", "payload"}
    keep = [c for c in decoded.columns if c not in dropped]
    good = decoded.filter(F.col("error").isNull() & is_type(event_type))
    return good.select(*keep, *columns)


def route_by_type(decoded: DataFrame, event_types: Sequence[str]) -> DataFrame:
    """Rows of the handled types in one pass, with their type as ``branch``; rows of other types
    are left out. Write with ``partitionBy("branch")`` to have the branches apart."""
    return decoded.filter(F.col("event_type").isin(*event_types)).withColumn(
        "branch", F.col("event_type")
    )
