"""Event time and time texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A full ISO instant, that is date, 'T', time with seconds, and a zone; as the lenient
# reader takes it (any case, up to nine fraction digits) and as the strict one does.
INSTANT = r"^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(\.\d{1,9})?([Zz]|[+-]\d{2}:\d{2})$"
STRICT_INSTANT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def parse_instant(text: Column) -> Column:
    """TIMESTAMP of a full ISO instant, cut to milliseconds; NULL for any other text."""
    parsed = F.try_to_timestamp(F.upper(text))
    return F.when(text.rlike(INSTANT), F.date_trunc("MILLISECOND", parsed))


def parse_strict_instant(text: Column) -> Column:
    """As :func:`parse_instant`, but upper case only and any number of fraction digits."""
    parsed = F.try_to_timestamp(F.regexp_replace(text, r"(\.\d{6})\d+", "$1"))
    return F.when(text.rlike(STRICT_INSTANT), F.date_trunc("MILLISECOND", parsed))


def event_time(envelope_time: Column, record_time: Column) -> Column:
    """Time in the envelope if it is a full instant, else the record's own time."""
    return F.coalesce(parse_instant(envelope_time), F.date_trunc("MILLISECOND", record_time))


def iso_seconds(ts: Column) -> Column:
    return F.date_format(ts, ISO_SECONDS)


def iso_micros(ts: Column) -> Column:
    return F.date_format(ts, ISO_MICROS)


def plain(ts: Column) -> Column:
    """Zone-free timestamp in the session zone (UTC)."""
    return ts.cast("timestamp_ntz")


def seconds_of(duration: str) -> float:
    """Length in seconds of a text such as '5 minutes' (driver side, for parameters)."""
    amount, unit = duration.split()
    per_unit = {"millisecond": 0.001, "second": 1, "minute": 60, "hour": 3600, "day": 86400}
    return float(amount) * per_unit[unit.rstrip("s").lower()]
