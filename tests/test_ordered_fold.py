"""The ordered fold with a user's function, in batch and as a stream."""

import random

import pandas as pd
import pytest

from eventmill.operators.ordered_fold import fold_in_order
from eventmill.streaming import jobs, runner

SCHEMA = "key string, seq bigint, total bigint"


def start(key):
    return 0


def step(key, state, rows):
    totals = state + rows["v"].cumsum()
    out = pd.DataFrame({"key": key[0], "seq": rows["seq"], "total": totals})
    return int(totals.iloc[-1]), out


def rows_of(n=400):
    rng = random.Random(5)
    return [(rng.choice(["a", "b", "c"]), i, rng.randint(0, 9)) for i in range(n)]


def expected(rows):
    totals, out = {}, {}
    for key, seq, v in rows:
        totals[key] = totals.get(key, 0) + v
        out[seq] = (key, totals[key])
    return out


@pytest.mark.parametrize("batch", [7, 10_000])
def test_batch(spark, batch):
    rows = rows_of()
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        df = spark.createDataFrame(rows, "key string, seq bigint, v bigint").repartition(6)
        out = fold_in_order(df, ["key"], "seq", start, step, SCHEMA).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert {r["seq"]: (r["key"], r["total"]) for r in out} == expected(rows)


def test_stream_goes_on_after_a_restart(spark):
    rows = rows_of(120)
    root, checkpoint = runner.job_paths(spark, "fold")
    schema = "key string, seq bigint, v bigint"
    for part in (rows[:50], rows[50:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{root}-in")
        stream = spark.readStream.schema(schema).parquet(f"{root}-in")
        folded = jobs.fold_stream(stream, ["key"], "seq", start, step, SCHEMA)
        runner.run_append(folded, root, checkpoint)
    out = spark.read.parquet(root).collect()
    assert {r["seq"]: (r["key"], r["total"]) for r in out} == expected(rows)


def test_service_runs_until_it_is_stopped(spark):
    sink, checkpoint = runner.job_paths(spark, "service")
    spark.range(5).write.parquet(f"{sink}-in")
    stream = spark.readStream.schema("id bigint").parquet(f"{sink}-in")
    query = runner.start_service(stream, sink, checkpoint)
    try:
        query.processAllAvailable()
        assert query.isActive
        assert spark.read.parquet(sink).count() == 5
    finally:
        query.stop()
