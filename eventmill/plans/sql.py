"""SQL text shared by the oracle queries."""

from __future__ import annotations

from eventmill import constants as C

LOG = """log AS (
  SELECT event_id AS seq,
         CASE event_type WHEN 'signup' THEN 'OrderCreated'
                         WHEN 'purchase' THEN 'PaymentCompleted'
                         WHEN 'error' THEN 'PaymentFailed'
                         ELSE event_type END AS event_type,
         CAST(user_id AS VARCHAR) AS key,
         CAST(user_id AS VARCHAR) AS item,
         CAST(event_id AS VARCHAR) AS order_id,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS quantity,
         value AS amount,
         ts AS event_time,
         CAST(user_id % 3 AS INTEGER) AS partition
  FROM events)"""

CREATED = "created AS (SELECT * FROM log WHERE event_type = 'OrderCreated')"
PAID = "paid AS (SELECT * FROM log WHERE event_type = 'PaymentCompleted')"
FAILED = "failed AS (SELECT * FROM log WHERE event_type = 'PaymentFailed')"

STOCK = """stock AS (
  SELECT CAST(p_partkey AS VARCHAR) AS item, CAST(p_size * 10 AS INTEGER) AS available_quantity
  FROM part WHERE p_size > 5)"""

PRICES = """prices AS (
  SELECT CAST(p_partkey AS VARCHAR) AS item, p_retailprice AS price
  FROM part WHERE p_size <= 25)"""

ISO = "%Y-%m-%dT%H:%M:%SZ"
DASHED = r"'^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\1-\2-\3-\4-\5'"


def derived_id(*parts: str) -> str:
    return f"regexp_replace(md5(concat_ws('|', {', '.join(parts)})), {DASHED})"


def draw(key: str) -> str:
    return f"(CAST('0x' || substr(md5({key}), 1, 8) AS BIGINT) / 4294967296.0)"


def topic(event_type: str) -> str:
    return (
        f"CASE WHEN {event_type} LIKE 'Payment%' THEN '{C.PAYMENT_EVENTS}' "
        f"ELSE '{C.ORDER_EVENTS}' END"
    )


# The topic records, damaged by k in the same way as the Spark view of them.
RECORDS = f"""damaged AS (
  SELECT *, quantity AS k, md5(order_id) AS id,
         regexp_replace(md5(order_id), {DASHED}) AS dashed
  FROM log),
parts AS (
  SELECT *,
    CASE WHEN k BETWEEN 30 AND 34 THEN 'event-' || order_id
         WHEN k BETWEEN 80 AND 84 THEN '{{' || upper(dashed) || '}}'
         WHEN k BETWEEN 85 AND 89 THEN dashed
         ELSE id END AS id_text,
    CASE WHEN k BETWEEN 45 AND 49 THEN ',"timestamp":"' || strftime(event_time, '%Y-%m-%d') || '"'
         WHEN k BETWEEN 50 AND 54 THEN ''
         WHEN k = 95 THEN ',"timestamp":"' || strftime(event_time, '%Y-%m-%dt%H:%M:%S.%fz') || '"'
         WHEN k = 96
           THEN ',"timestamp":"' || strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f0000Z') || '"'
         ELSE ',"timestamp":"' || strftime(event_time, '%Y-%m-%dT%H:%M:%S.%fZ') || '"'
         END AS time_part,
    CASE WHEN k = 97 AND event_type IN ('OrderCreated', 'PaymentCompleted', 'PaymentFailed')
         THEN '\\u00' || lower(to_hex(ascii(event_type))) || substr(event_type, 2)
         ELSE event_type END AS type_text,
    CASE WHEN k BETWEEN 10 AND 14 THEN ',"quantity":"7"'
         WHEN k BETWEEN 15 AND 19 THEN ',"quantity":7.9'
         WHEN k BETWEEN 20 AND 24 THEN ''
         WHEN k BETWEEN 25 AND 29 THEN ',"quantity":null'
         WHEN k BETWEEN 60 AND 64 THEN ',"quantity":true'
         WHEN k BETWEEN 65 AND 69 THEN ',"quantity":3000000000'
         WHEN k = 92 THEN ',"quantity":NaN'
         WHEN k = 93 THEN ',"quantity":' || k || ',"Quantity":7'
         ELSE ',"quantity":' || k END AS quantity_part,
    CASE WHEN k BETWEEN 20 AND 24 THEN ''
         WHEN k BETWEEN 25 AND 29 THEN ',"item":null'
         WHEN k BETWEEN 70 AND 74 THEN ',"item":{{"id":1}}'
         WHEN k BETWEEN 75 AND 79 THEN ',"item":7'
         ELSE ',"item":"' || item || '"' END AS item_part
  FROM damaged),
bodies AS (
  SELECT *,
    CASE event_type
      WHEN 'OrderCreated'
        THEN '{{"orderId":"' || order_id || '"' || item_part || quantity_part
             || ',"note":"as it came"}}'
      WHEN 'PaymentCompleted'
        THEN '{{"orderId":"' || key || '","paymentId":"' || order_id || '","amount":'
             || CAST(amount AS VARCHAR) || '}}'
      WHEN 'PaymentFailed'
        THEN '{{"orderId":"' || key || '","reason":"{C.PAYMENT_DECLINED}"}}'
      ELSE '{{}}' END AS body
  FROM parts),
texts AS (
  SELECT *,
    CASE WHEN k = 94 THEN '{{"EventId":"' ELSE '{{"eventId":"' END || id_text
    || CASE WHEN k BETWEEN 55 AND 59 THEN '","EventType":"' ELSE '","eventType":"' END
    || type_text || '","aggregateId":"' || key || '"' || time_part
    || CASE WHEN k BETWEEN 35 AND 39 THEN ''
            WHEN k BETWEEN 40 AND 44 THEN ',"payload":null'
            ELSE ',"payload":' || body END
    || '}}' AS json
  FROM bodies),
records AS (
  SELECT *, {topic('event_type')} AS topic, seq AS "offset",
    CASE WHEN k < 5 THEN left(json, length(json) - 2)
         WHEN k < 10 THEN 'this is not json'
         WHEN k = 90 THEN json || ' x'
         WHEN k = 91 THEN replace(json, '"', '\'\'')
         ELSE json END AS value
  FROM texts)"""

# Records the lenient reader does not skip, and the quantity it reads.
LENIENT = "k >= 10 AND k <> 91 AND NOT (k = 92 AND event_type = 'OrderCreated')"
LENIENT_QUANTITY = """CAST(CASE WHEN k BETWEEN 10 AND 19 THEN 7
       WHEN k BETWEEN 20 AND 29 OR k BETWEEN 35 AND 44 THEN 0
       WHEN k BETWEEN 60 AND 64 THEN 1
       WHEN k BETWEEN 65 AND 69 THEN 3000000000 - 4294967296
       ELSE k END AS INTEGER)"""

# What a strict reader handling all three types says about each record.
STRICT = """strict AS (
  SELECT *,
    CASE WHEN k < 10 OR k BETWEEN 45 AND 49 OR k IN (90, 91, 95)
              OR (k = 92 AND event_type = 'OrderCreated') THEN 'decode event:'
         WHEN k BETWEEN 30 AND 34 THEN 'invalid eventId'
         WHEN event_type IN ('OrderCreated', 'PaymentCompleted', 'PaymentFailed')
              AND k BETWEEN 35 AND 39 THEN 'bad ' || event_type || ' payload:'
         WHEN event_type = 'OrderCreated'
              AND (k BETWEEN 10 AND 19 OR k BETWEEN 60 AND 64 OR k BETWEEN 70 AND 79)
           THEN 'bad OrderCreated payload:'
         WHEN event_type = 'OrderCreated' AND k BETWEEN 65 AND 69
           THEN 'OrderCreated value out of range'
         END AS error
  FROM records)"""


def fold(requests: str) -> str:
    """Recursive fold of ``requests`` (seq, item, quantity, holds) over the stock."""
    return f"""numbered AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY seq) AS rn FROM {requests}),
fold AS (
  SELECT item, CAST(0 AS BIGINT) AS rn, CAST(available_quantity AS BIGINT) AS after_it,
         CAST(NULL AS BIGINT) AS available_before, false AS reserved, CAST(NULL AS BIGINT) AS seq
  FROM stock
  UNION ALL
  SELECT f.item, n.rn,
         CASE WHEN f.after_it >= n.quantity AND n.holds
              THEN f.after_it - n.quantity ELSE f.after_it END,
         f.after_it, f.after_it >= n.quantity, n.seq
  FROM fold f JOIN numbered n ON n.item = f.item AND n.rn = f.rn + 1),
decided AS (
  SELECT n.* EXCLUDE (rn), f.available_before, coalesce(f.reserved, false) AS reserved
  FROM numbered n LEFT JOIN fold f ON f.seq = n.seq)"""
