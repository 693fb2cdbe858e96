"""Building event envelopes and wire forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventmill.functions import times


def envelope_json(
    event_id: Column, event_type: Column, aggregate_id: Column, timestamp: Column, payload: Column
) -> Column:
    """JSON text of one event envelope; ``payload`` is a struct."""
    return F.to_json(
        F.struct(
            event_id.alias("eventId"),
            event_type.alias("eventType"),
            aggregate_id.alias("aggregateId"),
            times.iso_micros(timestamp).alias("timestamp"),
            payload.alias("payload"),
        )
    )


def long_wire(number: Column) -> Column:
    """8-byte big-endian form of a BIGINT, as long-valued topics carry it."""
    return F.unhex(F.lpad(F.hex(number.cast("bigint")), 16, "0"))


def long_from_wire(data: Column) -> Column:
    """BIGINT from its 8-byte big-endian form, negative numbers included."""
    high = F.conv(F.hex(F.substring(data, 1, 4)), 16, 10).cast("bigint")
    low = F.conv(F.hex(F.substring(data, 5, 4)), 16, 10).cast("bigint")
    return F.shiftleft(high, 32).bitwiseOR(low)
