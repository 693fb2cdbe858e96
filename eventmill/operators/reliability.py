"""Duplicate-safe, loss-safe processing: deduplication, dead letters, outbox."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill import constants as C
from eventmill.functions import coercion, envelope, ids, times

# --- idempotent consumption -----------------------------------------------------------------


def place_of(*columns: str) -> Column:
    """One number that orders rows as the whole-number columns do, the first column first.

    A number stays in the hash table of an aggregate; a struct would make Spark sort instead.
    """
    place = F.col(columns[0]).cast("decimal(38,0)")
    for name in columns[1:]:
        # Each further column is a 64-bit number: 19 digits, moved up so that none is negative.
        digits = F.col(name).cast("decimal(38,0)") + F.lit(str(2**63)).cast("decimal(38,0)")
        place = (place * F.lit(str(10**20)).cast("decimal(38,0)") + digits).cast("decimal(38,0)")
    return place


def first_arrivals(
    events: DataFrame, event_id: str = "event_id", seq: str | Sequence[str] = "seq"
) -> DataFrame:
    """The first copy of every event id, by arrival.

    ``seq`` are whole-number columns (the first below 2^59 where there are two) that no two copies
    of an id share. The aggregate holds numbers only and combines copies before the shuffle, so one
    id with very many copies costs one row per input task; the rows are then fetched by id and
    place, which spreads them evenly.
    """
    names = (seq,) if isinstance(seq, str) else tuple(seq)
    rows = events.withColumn("_place", F.col(names[0]) if len(names) == 1 else place_of(*names))
    first = rows.groupBy(F.col(event_id).alias("_id")).agg(F.min("_place").alias("_first"))
    same = F.col(event_id).eqNullSafe(F.col("_id")) & F.col("_place").eqNullSafe(F.col("_first"))
    return rows.join(first, same, "left_semi").select(*events.columns)


def unprocessed(
    events: DataFrame, processed: DataFrame, event_id: str = "event_id"
) -> DataFrame:
    """Events whose id the service has not recorded yet."""
    return events.join(processed.select(event_id), event_id, "left_anti").select(*events.columns)


def dedup_events(
    events: DataFrame,
    processed: DataFrame | None = None,
    event_id: str = "event_id",
    seq: str | Sequence[str] = "seq",
) -> DataFrame:
    """Each event once: the first copy, unless the service processed it before."""
    first = first_arrivals(events, event_id, seq)
    return first if processed is None else unprocessed(first, processed, event_id)


#: Errors of records that carry no usable id, as the strict decode names them.
WITHOUT_ID = ("decode event:", "invalid eventId", "unstorable eventId")


def has_id(error: Column) -> Column:
    """Whether a strictly decoded record carries a usable id."""
    return error.isNull() | ~error.isin(*WITHOUT_ID)


def consume(
    decoded: DataFrame,
    processed: DataFrame,
    handled: Sequence[str],
    seq: Sequence[str] = ("partition", "offset"),
) -> DataFrame:
    """What an idempotent consumer does with each record, in the column ``outcome``.

    ``decoded``: records after :func:`eventmill.operators.decode.decode_strict`; they are read
    twice, so hand over a written table of them. In this order: a
    record that cannot be read or has no valid id is a ``dead letter``; one whose id the service
    processed before, or an earlier good record has, is a ``duplicate``, even if its payload is
    broken; a broken payload is a ``dead letter``; then a handled type takes ``effect`` and any
    other is ``ignored``. A parked record does not count as processed, so a later good copy of it
    still takes effect.
    """
    place = place_of(*seq)
    readable = has_id(F.col("error"))
    # A record without an id gets one of its own, so that such rows do not meet in one task.
    own = F.concat_ws(":", F.lit("none"), *[F.col(c).cast("string") for c in seq])
    rows = decoded.withColumn(
        "_id", F.when(readable, ids.canonical_uuid(F.col("event_id"))).otherwise(own)
    )
    first = (
        rows.filter(F.col("error").isNull()).groupBy("_id").agg(F.min(place).alias("_first"))
    )
    done = (
        processed.select(ids.canonical_uuid(F.col("event_id")).alias("_id"))
        .distinct()
        .withColumn("_done", F.lit(True))
    )
    outcome = (
        F.when(~readable, "dead letter")
        .when(F.col("_done") | (place > F.col("_first")), "duplicate")
        .when(F.col("error").isNotNull(), "dead letter")
        .when(F.col("event_type").isin(*handled), "effect")
        .otherwise("ignored")
    )
    return (
        rows.join(first, "_id", "left")
        .join(done, "_id", "left")
        .withColumn("outcome", outcome)
        .select(*decoded.columns, "outcome")
    )


def newly_processed(events: DataFrame, now: Column, event_id: str = "event_id") -> DataFrame:
    """Rows to add to the processed table, ignored event types included."""
    return events.select(F.col(event_id).alias("event_id"), now.alias("processed_at"))


def dedup_stream(events: DataFrame, within: str | None = None) -> DataFrame:
    """Each event id once on a stream.

    Without ``within`` every id is remembered for ever, as the processed table does; with it
    ids are forgotten that long after their event time, which bounds the state.
    """
    if within is None:
        return events.dropDuplicates(["event_id"])
    return events.withWatermark("event_time", within).dropDuplicatesWithinWatermark(["event_id"])


def seed_if_absent(table: DataFrame, seed: DataFrame, key: str) -> DataFrame:
    """``table`` plus the seed rows whose key it does not have yet."""
    missing = seed.join(table.select(key), key, "left_anti").select(*table.columns)
    return table.unionByName(missing)


# --- dead letters ---------------------------------------------------------------------------


def good_records(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("error").isNull())


def dead_letters(decoded: DataFrame, group: str, failed_at: Column | None = None) -> DataFrame:
    """Records with an error as parked: key and value unchanged, five headers added."""
    when = F.current_timestamp() if failed_at is None else failed_at
    headers = {
        "dlq-original-topic": F.col("topic"),
        "dlq-original-partition": F.col("partition").cast("string"),
        "dlq-original-offset": F.col("offset").cast("string"),
        "dlq-error": F.col("error"),
        "dlq-failed-at": times.iso_seconds(when),
    }
    array = F.array(
        *[
            F.struct(F.lit(k).alias("key"), v.cast("binary").alias("value"))
            for k, v in headers.items()
        ]
    )
    return decoded.filter(F.col("error").isNotNull()).select(
        F.concat(F.lit(group), F.lit(C.DLQ_SUFFIX)).alias("topic"),
        "key",
        "value",
        array.alias("headers"),
    )


def header(name: str) -> Column:
    """Text of one header of a record."""
    found = F.filter("headers", lambda h: h["key"] == name)
    return F.try_element_at(found, F.lit(1))["value"].cast("string")


def parked(letters: DataFrame) -> DataFrame:
    """Dead letters with their headers as columns."""
    return letters.select(
        "topic",
        "key",
        "value",
        header("dlq-original-topic").alias("original_topic"),
        header("dlq-original-partition").cast("int").alias("original_partition"),
        header("dlq-original-offset").cast("bigint").alias("original_offset"),
        header("dlq-error").alias("error"),
        header("dlq-failed-at").alias("failed_at"),
    )


def dlq_summary(letters: DataFrame) -> DataFrame:
    """Number of dead letters per original topic and error."""
    return (
        parked(letters)
        .groupBy("original_topic", "error")
        .agg(F.count(F.lit(1)).alias("parked_count"))
    )


def dlq_replay(letters: DataFrame, processed: DataFrame, key: str | None = None) -> DataFrame:
    """Records to append to their original topics again, of one key or of all.

    Values whose event id was processed meanwhile are left out; a value without an id, or
    one that is not JSON, is always sent again.
    """
    rows = parked(letters)
    if key is not None:
        rows = rows.filter(F.col("key") == key)
    read = F.try_variant_get(coercion.parse_lenient(F.col("value")), "$.eventId", "string")
    rows, id_text = coercion.once(rows, read.alias("_id_text")), F.col("_id_text")
    # A row without a valid id gets one of its own, so that such rows do not meet in one task.
    own = F.concat_ws(":", F.lit("none"), "original_partition", "original_offset")
    known = F.when(ids.is_uuid(id_text), ids.canonical_uuid(id_text))
    rows = rows.withColumn("_id", F.coalesce(known, own))
    done = processed.select(ids.canonical_uuid(F.col("event_id")).alias("_id"))
    return rows.join(done, "_id", "left_anti").select(
        F.col("original_topic").alias("topic"), "key", "value"
    )


def retry_due(
    failures: DataFrame, now: Column, max_attempts: int = C.MAX_HANDLE_ATTEMPTS
) -> DataFrame:
    """Failed records with what happens to them now: ``retry``, ``wait`` or ``dlq``.

    ``failures``: ``attempt`` (1 for the first) and ``failed_at``. Attempt n waits n seconds.
    """
    due_at = F.timestamp_add("SECOND", F.col("attempt"), F.col("failed_at"))
    return failures.withColumn("due_at", due_at).withColumn(
        "action",
        F.when(F.col("attempt") >= max_attempts, "dlq")
        .when(F.col("due_at") <= now, "retry")
        .otherwise("wait"),
    )


def requeued(failures: DataFrame, now: Column, max_attempts: int = C.MAX_HANDLE_ATTEMPTS) -> DataFrame:
    """The failed records due for a retry, to be appended again with the next attempt number."""
    due = retry_due(failures, now, max_attempts).filter(F.col("action") == "retry")
    return due.withColumn("attempt", F.col("attempt") + 1).select(*failures.columns)


def exhausted(failures: DataFrame, now: Column, max_attempts: int = C.MAX_HANDLE_ATTEMPTS) -> DataFrame:
    """The failed records without a further attempt; :func:`failure_records` gives them in full."""
    return retry_due(failures, now, max_attempts).filter(F.col("action") == "dlq").select(
        *failures.columns
    )


def failure_records(failures: DataFrame, service: str) -> DataFrame:
    """Failed records in the long form: event, reason, attempts, time and service."""
    return failures.select(
        F.col("value").alias("original_event"),
        F.col("error").alias("failure_reason"),
        F.col("attempt").alias("attempt_count"),
        "failed_at",
        F.lit(service).alias("service"),
    )


# --- outbox ---------------------------------------------------------------------------------


def outbox_envelope(events: DataFrame, payload: Column, created_at: Column) -> DataFrame:
    """Outbox rows of new events. ``events``: ``seq, event_id, topic, event_type, order_id``."""
    value = envelope.envelope_json(
        F.col("event_id"), F.col("event_type"), F.col("order_id"), created_at, payload
    )
    return events.select(
        "seq",
        "event_id",
        "topic",
        F.col("order_id").alias("key"),
        value.cast("binary").alias("value"),
        created_at.alias("created_at"),
        F.lit(None).cast(events.select(created_at).schema[0].dataType).alias("published_at"),
    )


def outbox_next_batch(outbox: DataFrame, size: int = C.OUTBOX_BATCH_SIZE) -> DataFrame:
    """The oldest unpublished rows, in order."""
    return outbox.filter(F.col("published_at").isNull()).orderBy("seq").limit(size)


def relay_records(outbox: DataFrame) -> DataFrame:
    """Outbox rows as records to publish; also valid on the outbox read as a stream.

    A relay that stops between publishing and marking publishes again, so delivery is at
    least once and consumers skip the copies (:func:`dedup_events`).
    """
    return outbox.filter(F.col("published_at").isNull()).select(
        "topic", "key", F.col("value").cast("string").alias("value")
    )


def mark_published(outbox: DataFrame, published: DataFrame, now: Column) -> DataFrame:
    """Outbox with the published rows stamped."""
    done = published.select("seq", F.lit(True).alias("_done"))
    joined = outbox.join(done, "seq", "left")
    stamp = F.when(F.col("published_at").isNull() & F.col("_done"), now)
    return joined.withColumn("published_at", F.coalesce("published_at", stamp)).select(
        *outbox.columns
    )


def outbox_backlog(outbox: DataFrame) -> DataFrame:
    """Unpublished rows per topic: how many, the oldest number and its time."""
    return (
        outbox.filter(F.col("published_at").isNull())
        .groupBy("topic")
        .agg(
            F.count(F.lit(1)).alias("backlog"),
            F.min("seq").alias("oldest_seq"),
            F.min("created_at").alias("oldest_created_at"),
        )
    )
