"""Deduplication, dead letters, outbox."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill import constants as C
from eventmill.functions import ids
from eventmill.operators import decode, reliability
from eventmill.plans import decoding, sql
from eventmill.session import scratch_path, written
from eventmill.sources import driver_tables as tables
from eventmill.streaming.outbox import Outbox

HANDLED = decoding.HANDLED
GROUP = "inventory-service"
# "Now" of the retry and parking queries: a fixed moment inside the events' month.
NOW = "2024-01-15 00:00:00"
# Offsets of second deliveries start here.
SECOND_DELIVERY = 1_000_000_000_000
#: Rows of a segment in the relay query, so that its outbox has several.
RELAY_SEGMENT = 10_000


def dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    once = reliability.dedup_events(
        tables.redelivered_log(spark, sf_dir),
        tables.processed_ids(spark, sf_dir),
        seq=("seq", "delivery"),
    )
    return once.select("event_id", "seq", "delivery", "event_type", "key")


def seed_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    seed = tables.table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("item"), F.lit(100).alias("available_quantity")
    )
    return reliability.seed_if_absent(tables.stock(spark, sf_dir), seed, "item")


def _letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed_at = F.lit(NOW).cast("timestamp")
    return reliability.dead_letters(decoding.strict(spark, sf_dir), GROUP, failed_at)


def dlq_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reliability.parked(_letters(spark, sf_dir))


def good_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records that are not parked."""
    return reliability.good_records(decoding.strict(spark, sf_dir)).select("offset", "value")


def dlq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reliability.dlq_summary(_letters(spark, sf_dir))


def dlq_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reliability.dlq_replay(_letters(spark, sf_dir), tables.processed_ids(spark, sf_dir))


def retry_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    failures = tables.of_type(tables.event_log(spark, sf_dir), C.PAYMENT_FAILED).select(
        "seq",
        F.expr("CAST(1 + quantity DIV 40 AS INT)").alias("attempt"),
        F.col("event_time").alias("failed_at"),
    )
    return reliability.retry_due(failures, F.lit(NOW).cast("timestamp_ntz"))


def _failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = tables.of_type(tables.event_log(spark, sf_dir), C.PAYMENT_FAILED)
    return failed.select(
        "seq",
        "key",
        F.expr("CAST(1 + quantity DIV 40 AS INT)").alias("attempt"),
        F.col("event_time").alias("failed_at"),
        F.concat(F.lit("order "), "key").alias("value"),
        F.lit(C.PAYMENT_DECLINED).alias("error"),
    )


def retry_requeue(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.lit(NOW).cast("timestamp_ntz")
    return reliability.requeued(_failures(spark, sf_dir), now).select("seq", "key", "attempt")


def failure_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    spent = reliability.exhausted(_failures(spark, sf_dir), F.lit(NOW).cast("timestamp_ntz"))
    return reliability.failure_records(spent, GROUP)


def redelivered_records(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    """The topic, then every record a second time with other contents: another note, and a
    quantity that was text as a number."""
    records = tables.topic_records(spark, sf_dir, streaming)
    note = F.replace("value", F.lit('"as it came"'), F.lit('"again"'))
    repaired = F.replace(note, F.lit('"quantity":"7"'), F.lit('"quantity":7'))
    twice = F.array(
        F.struct("offset", "value"),
        F.struct((F.col("offset") + SECOND_DELIVERY).alias("offset"), repaired.alias("value")),
    )
    rest = [c for c in records.columns if c not in ("offset", "value")]
    return records.select(*rest, F.inline(twice)).select(*records.columns)


def consume_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode.decode_strict(redelivered_records(spark, sf_dir), HANDLED)
    decoded = written(
        decoded.select("partition", "offset", "event_id", "event_type", "error"), "decoded"
    )
    consumed = reliability.consume(decoded, tables.processed_ids(spark, sf_dir), HANDLED)
    return consumed.select("offset", "outcome", "error")


def outbox_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = tables.orders_in(tables.event_log(spark, sf_dir)).select(
        "seq",
        ids.derived_id(F.col("order_id"), F.col("event_type")).alias("event_id"),
        F.lit(C.ORDER_EVENTS).alias("topic"),
        "event_type",
        "order_id",
        "item",
        "quantity",
        "event_time",
    )
    payload = F.struct(F.col("order_id").alias("orderId"), "item", "quantity")
    rows = reliability.outbox_envelope(orders, payload, F.col("event_time"))
    return rows.select("seq", "event_id", "topic", "key", F.col("value").cast("string"))


def _outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as outbox rows; failed payments are not published yet."""
    log = tables.event_log(spark, sf_dir)
    payment = F.col("event_type").startswith("Payment")
    unpublished = F.col("event_type") == C.PAYMENT_FAILED
    return log.select(
        "seq",
        F.when(payment, C.PAYMENT_EVENTS).otherwise(C.ORDER_EVENTS).alias("topic"),
        "key",
        F.col("event_time").alias("created_at"),
        F.when(~unpublished, F.col("event_time")).alias("published_at"),
    )


def outbox_next_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reliability.outbox_next_batch(_outbox(spark, sf_dir)).select(
        "seq", "topic", "key", "created_at"
    )


def outbox_mark_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    outbox = _outbox(spark, sf_dir)
    batch = reliability.outbox_next_batch(outbox)
    marked = reliability.mark_published(outbox, batch, F.lit(NOW).cast("timestamp_ntz"))
    return marked.select("seq", "published_at")


def outbox_relay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches relayed by an outbox of open and closed segments; then all its rows."""
    rows = _outbox(spark, sf_dir)
    unmarked = rows.drop("published_at")
    box = Outbox(spark, scratch_path(spark, "outbox"), unmarked.schema, RELAY_SEGMENT).create()
    box.append(unmarked)
    box.mark(rows.filter("published_at IS NOT NULL"), F.col("published_at"))
    for _ in range(2):
        published = written(box.next_batch(), "published")  # where a relay would publish
        box.mark(published, F.lit(NOW).cast("timestamp_ntz"))
    return box.table().select("seq", "published_at")


def outbox_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reliability.outbox_backlog(_outbox(spark, sf_dir))


QUERIES = {
    "dedup_events": dedup_events,
    "seed_if_absent": seed_if_absent,
    "dlq_route": dlq_route,
    "good_route": good_route,
    "dlq_summary": dlq_summary,
    "dlq_replay": dlq_replay,
    "retry_due": retry_due,
    "retry_requeue": retry_requeue,
    "failure_records": failure_records,
    "consume_orders": consume_orders,
    "outbox_envelope": outbox_envelope,
    "outbox_next_batch": outbox_next_batch,
    "outbox_mark_published": outbox_mark_published,
    "outbox_backlog": outbox_backlog,
    "outbox_relay": outbox_relay,
}

_STRICT = f"WITH {sql.LOG}, {sql.RECORDS}, {sql.STRICT}"
_NOW = f"TIMESTAMP '{NOW}'"
_OUTBOX = f"""outbox AS (
  SELECT seq, {sql.topic("event_type")} AS topic, key, event_time AS created_at,
         CASE WHEN event_type <> 'PaymentFailed' THEN event_time END AS published_at
  FROM log)"""
_NEXT = f"""next AS (
  SELECT * FROM outbox WHERE published_at IS NULL ORDER BY seq LIMIT {C.OUTBOX_BATCH_SIZE})"""

DEDUP = f"""WITH {sql.LOG}
SELECT md5(order_id) AS event_id, seq, 1 AS delivery, event_type, key
FROM log WHERE event_type <> 'view'"""

CONSUMED = f"""{_STRICT},
copies AS (
  SELECT *, "offset" AS place, error AS first_error, 1 AS delivery FROM strict
  UNION ALL
  SELECT * REPLACE (CASE WHEN event_type = 'OrderCreated' AND k BETWEEN 10 AND 14 THEN NULL
                         ELSE error END AS error),
         "offset" + {SECOND_DELIVERY} AS place, error AS first_error, 2 AS delivery
  FROM strict),
consumed AS (
  SELECT place AS "offset", error, event_type, id,
    CASE WHEN error IN ('decode event:', 'invalid eventId') THEN 'dead letter'
         WHEN event_type = 'view' OR (delivery = 2 AND first_error IS NULL) THEN 'duplicate'
         WHEN error IS NOT NULL THEN 'dead letter'
         WHEN event_type IN ('OrderCreated', 'PaymentCompleted', 'PaymentFailed') THEN 'effect'
         ELSE 'ignored' END AS outcome
  FROM copies)"""

_FAILURES = """failures AS (
  SELECT seq, key, CAST(1 + quantity // 40 AS INTEGER) AS attempt, event_time AS failed_at,
         'order ' || key AS value
  FROM log WHERE event_type = 'PaymentFailed')"""

RETRIED = f"""WITH {sql.LOG}, {_FAILURES},
retried AS (
  SELECT seq, key, attempt + 1 AS attempt FROM failures
  WHERE attempt < {C.MAX_HANDLE_ATTEMPTS} AND failed_at + to_seconds(attempt) <= {_NOW})"""

ORACLE = {
    "retry_requeue": f"""{RETRIED}
SELECT * FROM retried""",
    "failure_records": f"""WITH {sql.LOG}, {_FAILURES}
SELECT value AS original_event, '{C.PAYMENT_DECLINED}' AS failure_reason,
       attempt AS attempt_count, failed_at, '{GROUP}' AS service
FROM failures WHERE attempt >= {C.MAX_HANDLE_ATTEMPTS}""",
    "consume_orders": f"""{CONSUMED}
SELECT "offset", outcome, error FROM consumed""",
    "dedup_events": DEDUP,
    "seed_if_absent": """SELECT CAST(p_partkey AS VARCHAR) AS item,
  CASE WHEN p_size > 5 THEN p_size * 10 ELSE 100 END AS available_quantity FROM part""",
    "dlq_route": f"""{_STRICT}
SELECT '{GROUP}.dlq' AS topic, key, value, topic AS original_topic,
       partition AS original_partition, "offset" AS original_offset, error,
       strftime({_NOW}, '{sql.ISO}') AS failed_at
FROM strict WHERE error IS NOT NULL""",
    "good_route": f"""{_STRICT}
SELECT "offset", value FROM strict WHERE error IS NULL""",
    "dlq_summary": f"""{_STRICT}
SELECT topic AS original_topic, error, count(*) AS parked_count
FROM strict WHERE error IS NOT NULL GROUP BY topic, error""",
    "dlq_replay": f"""{_STRICT}
SELECT topic, key, value FROM strict
WHERE error IS NOT NULL AND NOT (event_type = 'view' AND k >= 10 AND k NOT BETWEEN 30 AND 34 AND k <> 91)""",
    "retry_due": f"""WITH {sql.LOG}, f AS (
  SELECT seq, CAST(1 + quantity // 40 AS INTEGER) AS attempt, event_time AS failed_at
  FROM log WHERE event_type = 'PaymentFailed')
SELECT *, failed_at + to_seconds(attempt) AS due_at,
       CASE WHEN attempt >= {C.MAX_HANDLE_ATTEMPTS} THEN 'dlq'
            WHEN failed_at + to_seconds(attempt) <= {_NOW} THEN 'retry' ELSE 'wait' END AS action
FROM f""",
    "outbox_envelope": f"""WITH {sql.LOG}, {sql.CREATED}
SELECT seq, {sql.derived_id("order_id", "event_type")} AS event_id, 'order.events' AS topic,
       order_id AS key,
       '{{"eventId":"' || {sql.derived_id("order_id", "event_type")}
       || '","eventType":"OrderCreated","aggregateId":"' || order_id || '","timestamp":"'
       || strftime(event_time, '%Y-%m-%dT%H:%M:%S.%fZ') || '","payload":{{"orderId":"' || order_id
       || '","item":"' || item || '","quantity":' || quantity || '}}}}' AS value
FROM created""",
    "outbox_next_batch": f"""WITH {sql.LOG}, {_OUTBOX}, {_NEXT}
SELECT seq, topic, key, created_at FROM next""",
    "outbox_mark_published": f"""WITH {sql.LOG}, {_OUTBOX}, {_NEXT}
SELECT seq, CASE WHEN seq IN (SELECT seq FROM next) THEN {_NOW} ELSE published_at END
         AS published_at
FROM outbox""",
    "outbox_relay": f"""WITH {sql.LOG}, {_OUTBOX},
relayed AS (SELECT seq FROM outbox WHERE published_at IS NULL ORDER BY seq
            LIMIT {2 * C.OUTBOX_BATCH_SIZE})
SELECT seq, CASE WHEN seq IN (SELECT seq FROM relayed) THEN {_NOW} ELSE published_at END
         AS published_at
FROM outbox""",
    "outbox_backlog": f"""WITH {sql.LOG}, {_OUTBOX}
SELECT topic, count(*) AS backlog, min(seq) AS oldest_seq, min(created_at) AS oldest_created_at
FROM outbox WHERE published_at IS NULL GROUP BY topic""",
}
