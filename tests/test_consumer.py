"""The idempotent consumer on a stream: ids of earlier micro-batches, restarts, odd records."""

import uuid

from eventmill.operators import reliability
from eventmill.streaming import jobs, runner

HANDLED = ("OrderCreated",)
SCHEMA = (
    "key string, value string, topic string, partition int, offset bigint, timestamp timestamp, "
    "headers array<struct<key:string,value:binary>>"
)


def event_id(i):
    return str(uuid.UUID(int=i))


def value(i, kind="OrderCreated", quantity="1"):
    return (
        f'{{"eventId":"{event_id(i)}","eventType":"{kind}","aggregateId":"a",'
        f'"payload":{{"orderId":"o","item":"x","quantity":{quantity}}}}}'
    )


class Service:
    """One consumer over a folder of record files, run until the input is used up."""

    def __init__(self, spark, processed=(), buckets=7):
        self.spark, self.buckets = spark, buckets
        self.root, _ = runner.job_paths(spark, "service")
        self.sinks = {n: f"{self.root}/{n}" for n in ("effects", "dead_letters", "processed")}
        self.processed = spark.createDataFrame([(p,) for p in processed], "event_id string")
        self.sent = 0

    def send(self, *values):
        rows = [("k", v, "orders", 0, self.sent + i, None, None) for i, v in enumerate(values)]
        self.sent += len(values)
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(
            f"{self.root}/in"
        )

    def run(self):
        records = self.spark.readStream.schema(SCHEMA).parquet(f"{self.root}/in")
        outcomes = jobs.consume_stream(records, self.processed, HANDLED, self.buckets)
        write = jobs.consumer(self.sinks, f"{self.root}/marker", "svc")
        runner.run_batches(outcomes, write, f"{self.root}/checkpoint")

    def rows(self, name):
        return runner.read_committed(self.spark, self.sinks[name], f"{self.root}/marker")

    def offsets(self):
        effects = sorted(r["offset"] for r in self.rows("effects").collect())
        letters = reliability.parked(self.rows("dead_letters")).select("original_offset").collect()
        return effects, sorted(r[0] for r in letters)


def test_each_id_takes_effect_once_over_batches_and_restarts(spark):
    service = Service(spark, processed=[event_id(9).upper()])
    service.send(value(1), value(1), value(2, quantity='"7"'), "no json", value(9), value(3, "other"))
    service.run()
    assert service.offsets() == ([0], [2, 3])
    # A parked record may be repaired; what took effect, was ignored or was known may not.
    service.send(value(2), value(1), value(3), value(9), value(2, quantity='"7"'), value(4))
    service.run()
    assert service.offsets() == ([0, 6, 11], [2, 3])
    assert {r["event_id"] for r in service.rows("processed").collect()} == {
        event_id(i).replace("-", "") for i in (1, 2, 3, 4)
    }


def test_stream_equals_batch(spark):
    values = [value(i % 40, quantity='"7"' if i % 3 else "1") for i in range(120)] + ["{}"] * 5
    service = Service(spark)
    for start in range(0, len(values), 25):
        service.send(*values[start : start + 25])
        service.run()
    from eventmill.operators import decode

    records = spark.read.schema(SCHEMA).parquet(f"{service.root}/in")
    whole = reliability.consume(decode.decode_strict(records, HANDLED), service.processed, HANDLED)
    expected = {k: [] for k in ("effect", "dead letter", "duplicate", "ignored")}
    for r in whole.select("offset", "outcome").orderBy("offset").collect():
        expected[r["outcome"]].append(r["offset"])
    assert service.offsets() == (expected["effect"], expected["dead letter"])
    assert expected["effect"] and expected["dead letter"] and expected["duplicate"]


def test_a_micro_batch_reads_no_earlier_output(spark):
    """What a run reads besides its checkpoint and its input is gone before it starts."""
    service = Service(spark)
    service.send(value(1))
    service.run()
    moved = {n: f"{service.root}/moved-{n}" for n in service.sinks}
    service.sinks = moved  # earlier outputs are out of reach; only state can know id 1
    service.send(value(1), value(2))
    service.run()
    assert [r["offset"] for r in spark.read.parquet(moved["effects"]).collect()] == [2]


def test_no_sort_aggregate(spark):
    rows = spark.createDataFrame([("e", 0, 1, None, "t")], "event_id string, partition int, offset bigint, error string, event_type string")
    done = spark.createDataFrame([("x",)], "event_id string")
    plan = reliability.consume(rows, done, HANDLED)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
