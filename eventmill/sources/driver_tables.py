"""The given parquet tables seen as events, topics, orders, stock and prices.

``events`` is the event log: ``event_id`` is the arrival order, ``user_id`` serves as key and
item, ``props.k`` (0 to 99) as quantity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill import constants as C
from eventmill.sources import topics

#: Tasks for each core that make and decode topic records.
TASKS_PER_CORE = 4

EVENT_TYPES = {
    "signup": C.ORDER_CREATED,
    "purchase": C.PAYMENT_COMPLETED,
    "error": C.PAYMENT_FAILED,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, name: str, **options: str) -> DataFrame:
    """A table as a stream of files (a glob, since a stream source wants a folder or glob)."""
    schema = table(spark, sf_dir, name).schema
    return topics.stream_files(spark, f"{sf_dir}/{name}.parquet*", schema, **options)


def _quantity() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _typed(raw: DataFrame, time: Column) -> DataFrame:
    kind = F.col("event_type")
    for source, target in EVENT_TYPES.items():
        kind = F.when(F.col("event_type") == source, target).otherwise(kind)
    return raw.select(
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("source_type"),
        kind.alias("event_type"),
        F.col("user_id").cast("string").alias("key"),
        F.col("user_id").cast("string").alias("item"),
        F.col("event_id").cast("string").alias("order_id"),
        _quantity().alias("quantity"),
        F.col("value").alias("amount"),
        time.alias("event_time"),
        F.pmod(F.col("user_id"), F.lit(C.TOPIC_PARTITIONS)).cast("int").alias("partition"),
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events with typed columns; times are zone-free, as in the table."""
    return _typed(table(spark, sf_dir, "events"), F.col("ts"))


def event_stream(spark: SparkSession, sf_dir: str, **options: str) -> DataFrame:
    """The same columns as a stream; times are TIMESTAMP, as watermarks need."""
    raw = stream_table(spark, sf_dir, "events", **options)
    return _typed(raw, F.col("ts").cast("timestamp"))


def of_type(events: DataFrame, event_type: str) -> DataFrame:
    """Events of one type, filtered on the table's own column so that the scan does it."""
    if "source_type" not in events.columns:
        return events.filter(F.col("event_type") == event_type)
    source = {target: source for source, target in EVENT_TYPES.items()}[event_type]
    return events.filter(F.col("source_type") == source)


def orders_in(events: DataFrame) -> DataFrame:
    return of_type(events, C.ORDER_CREATED)


def payments_in(events: DataFrame) -> DataFrame:
    return of_type(events, C.PAYMENT_COMPLETED).withColumnRenamed("order_id", "payment_id")


def stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock per item: ten times the part size; parts of size 5 or less are not stocked."""
    return (
        table(spark, sf_dir, "part")
        .filter(F.col("p_size") > 5)
        .select(
            F.col("p_partkey").cast("string").alias("item"),
            (F.col("p_size") * 10).alias("available_quantity"),
        )
    )


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price per item; parts larger than 25 are not priced."""
    return (
        table(spark, sf_dir, "part")
        .filter(F.col("p_size") <= 25)
        .select(
            F.col("p_partkey").cast("string").alias("item"), F.col("p_retailprice").alias("price")
        )
    )


def late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log with every event created ``quantity`` minutes before it arrived."""
    log = event_log(spark, sf_dir)
    earlier = F.expr("event_time - make_dt_interval(0, 0, quantity, 0)")
    return log.withColumn("event_time", earlier)


def _spread(raw: DataFrame) -> DataFrame:
    """The events dealt over all cores. A file of few row groups is read by as few tasks, which then
    would make and decode all records, at many times the cost of moving the plain events."""
    tasks = TASKS_PER_CORE * raw.sparkSession.sparkContext.defaultParallelism
    return raw.repartition(tasks, "event_id", "user_id")


# Damage done to a record, by ``k``: the first matching range changes the named parts.
# A part of None leaves the field out.
DAMAGE = [
    (10, 14, {"quantity": '"7"'}),
    (15, 19, {"quantity": "7.9"}),
    (20, 24, {"quantity": None, "item": None}),
    (25, 29, {"quantity": "null", "item": "null"}),
    (30, 34, {"eventId": "event-@order@"}),
    (35, 39, {"payload": None}),
    (40, 44, {"payload": "null"}),
    (45, 49, {"timestamp": "@date@"}),
    (50, 54, {"timestamp": None}),
    (55, 59, {"eventType name": "EventType"}),
    (60, 64, {"quantity": "true"}),
    (65, 69, {"quantity": "3000000000"}),
    (70, 74, {"item": '{"id":1}'}),
    (75, 79, {"item": "7"}),
    (80, 84, {"eventId": "{@DASHED@}"}),
    (85, 89, {"eventId": "@dashed@"}),
    (90, 90, {"after": " x"}),
    (91, 91, {"quotes": "'"}),
    (92, 92, {"quantity": "NaN"}),
    (93, 93, {"quantity": '@k@,"Quantity":7'}),
    (94, 94, {"eventId name": "EventId"}),
    (95, 95, {"timestamp": "@lower time@"}),
    (96, 96, {"timestamp": "@long time@"}),
    (97, 97, {"escaped type": True}),
]


def _body(event_type: str, parts: dict) -> str:
    if event_type == C.ORDER_CREATED:
        fields = {
            "orderId": '"@order@"',
            "item": parts.get("item", '"@item@"'),
            "quantity": parts.get("quantity", "@k@"),
            "note": '"as it came"',
        }
    elif event_type == C.PAYMENT_COMPLETED:
        fields = {"orderId": '"@key@"', "paymentId": '"@order@"', "amount": "@amount@"}
    elif event_type == C.PAYMENT_FAILED:
        fields = {"orderId": '"@key@"', "reason": f'"{C.PAYMENT_DECLINED}"'}
    else:
        fields = {}
    return "{" + ",".join(f'"{n}":{v}' for n, v in fields.items() if v is not None) + "}"


def _template(event_type: str, k: int) -> str:
    """JSON text of a record of this type and ``k``, with places for the row's values."""
    if 5 <= k < 10:
        return "this is not json"
    parts = next((changed for low, high, changed in DAMAGE if low <= k <= high), {})
    escaped = "escaped type" in parts and event_type
    type_text = f"\\u{ord(event_type[0]):04x}{event_type[1:]}" if escaped else "@type@"
    fields = {
        parts.get("eventId name", "eventId"): f'"{parts.get("eventId", "@id@")}"',
        parts.get("eventType name", "eventType"): f'"{type_text}"',
        "aggregateId": '"@key@"',
        "timestamp": f'"{parts.get("timestamp", "@time@")}"',
        "payload": parts.get("payload", _body(event_type, parts)),
    }
    missing = [n for n in ("timestamp", "payload") if n in parts and parts[n] is None]
    text = ",".join(f'"{n}":{v}' for n, v in fields.items() if n not in missing)
    text = "{" + text + "}" + parts.get("after", "")
    text = text.replace('"', parts.get("quotes", '"'))
    return text[:-2] if k < 5 else text


def _template_of(event_type: str) -> Column:
    texts = F.array(*[F.lit(_template(event_type, k)) for k in range(100)])
    return F.element_at(texts, F.col("quantity") + 1)


def topic_records(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    """All events as topic records with JSON values, many of them damaged.

    The kind of damage depends on ``k`` (see ``DAMAGE``; below 5 the text is cut short, below
    10 it is no JSON at all); from 80 on records are sound. Offsets are the event ids, so
    they grow within a partition with gaps, as in a compacted topic.
    """
    if streaming:
        raw, time = stream_table(spark, sf_dir, "events"), F.col("ts").cast("timestamp")
    else:
        raw, time = table(spark, sf_dir, "events"), F.col("ts")
    log = _typed(_spread(raw), time)
    md5 = F.md5("order_id")
    dashed = F.regexp_replace(md5, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    value = _template_of("")
    for event_type in EVENT_TYPES.values():
        value = F.when(F.col("event_type") == event_type, _template_of(event_type)).otherwise(value)
    places = {
        "@id@": md5,
        "@dashed@": dashed,
        "@DASHED@": F.upper(dashed),
        "@type@": F.col("event_type"),
        "@key@": F.col("key"),
        "@item@": F.col("item"),
        "@order@": F.col("order_id"),
        "@k@": F.col("quantity").cast("string"),
        "@amount@": F.col("amount").cast("string"),
        "@time@": F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
        "@lower time@": F.date_format("event_time", "yyyy-MM-dd't'HH:mm:ss.SSSSSS'z'"),
        "@long time@": F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'0000Z'"),
        "@date@": F.date_format("event_time", "yyyy-MM-dd"),
    }
    for place, column in places.items():
        value = F.replace(value, F.lit(place), column)
    payment = F.col("event_type").startswith("Payment")
    records = log.select(
        "key",
        value.alias("value"),
        F.when(payment, C.PAYMENT_EVENTS).otherwise(C.ORDER_EVENTS).alias("topic"),
        "partition",
        F.col("seq").alias("offset"),
        (F.col("event_time").cast("timestamp") + F.expr("INTERVAL 5 SECONDS")).alias("timestamp"),
        F.lit(None).cast("array<struct<key:string,value:binary>>").alias("headers"),
    )
    # Also keeps making the records out of the code generated for decoding them, which the
    # JIT would refuse to compile as one method.
    return topics.traced(records, "topic records")


def processed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids the service recorded before: those of all view events."""
    views = table(spark, sf_dir, "events").filter(F.col("event_type") == "view")
    return views.select(F.md5(F.col("event_id").cast("string")).alias("event_id"))


def redelivered_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log with ids, then all its purchases a second time."""
    log = event_log(spark, sf_dir).withColumn("event_id", F.md5("order_id"))
    again = of_type(log, C.PAYMENT_COMPLETED)
    return log.withColumn("delivery", F.lit(1)).unionByName(again.withColumn("delivery", F.lit(2)))


def order_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a status of the saga's own set."""
    status = (
        F.when(F.col("o_orderstatus") == "F", C.COMPLETED)
        .when(F.col("o_orderstatus") == "O", C.PENDING)
        .otherwise(C.CANCELLED)
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("total"),
        status.alias("status"),
    )

