"""Running streaming queries over the data at hand, and idempotent sinks.

A job is a query with a checkpoint. One checkpoint per job and topic is what one consumer
group is per topic: a restart goes on where the job stopped, a fresh checkpoint reads the
topic from the start with empty state.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from eventmill.session import ROCKSDB, scratch_path

BATCH_ID = "batch_id"
SERVICE_TRIGGER = {"processingTime": "1 second"}
JOB_TRIGGER = {"availableNow": True}


@contextmanager
def _state_settings(spark: SparkSession) -> Iterator[None]:
    """Keyed state on RocksDB. The number of state partitions is the session's own
    ``spark.sql.shuffle.partitions``, or ``eventmill.state.partitions`` where that is set."""
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        # Changes instead of whole snapshots per batch: less to upload for large state.
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    partitions = spark.conf.get("eventmill.state.partitions", None)
    if partitions:
        wanted["spark.sql.shuffle.partitions"] = partitions
    before = {k: spark.conf.get(k, None) for k in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def _finish(query: StreamingQuery) -> None:
    try:
        query.awaitTermination()
    finally:
        query.stop()


def run_append(
    stream: DataFrame, sink: str, checkpoint: str, trigger: dict | None = None
) -> None:
    """Process what is there and append the results to a folder, each exactly once."""
    with _state_settings(stream.sparkSession):
        query = (
            stream.writeStream.format("parquet")
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or JOB_TRIGGER))
            .start(sink)
        )
        _finish(query)


def start_service(stream: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """Start a job that keeps running, one micro-batch a second; the caller stops it."""
    with _state_settings(stream.sparkSession):
        return (
            stream.writeStream.format("parquet")
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(**SERVICE_TRIGGER)
            .start(sink)
        )


def run_batches(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    trigger: dict | None = None,
) -> None:
    """Process what is there, handing each micro-batch to ``write``."""
    with _state_settings(stream.sparkSession):
        query = (
            stream.writeStream.foreachBatch(write)
            .outputMode(mode)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or JOB_TRIGGER))
            .start()
        )
        _finish(query)


def _batch_folder(sink: str, batch_id: int) -> str:
    return f"{sink}/{BATCH_ID}={batch_id}"


def upsert_batch(sink: str) -> Callable[[DataFrame, int], None]:
    """Writer that keeps each micro-batch in its own folder; a repeated batch replaces it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(_batch_folder(sink, batch_id))

    return write


# --- tables kept by a stream -----------------------------------------------------------------

#: Buckets of a table kept by an update sink; fixed for the life of the sink.
SINK_BUCKETS = 16
_BUCKET, _SLOT = "_bucket", "_slot"
_MANIFEST = f"{_BUCKET} INT, {_SLOT} INT, table_schema STRING, batch BIGINT"


class KeyedTable:
    """A table of current rows by key, as a stream's micro-batches change it.

    Rows are in buckets of their keys, and a bucket has two slots, one of which is current. A
    micro-batch reads and rewrites only the buckets it touches, each into its other slot, and then
    writes a manifest of the current slots; manifests of odd and even batches take turns. So files
    do not pile up, a reader sees a whole batch or none of it, and a repeated batch starts from the
    manifest before it and replaces itself. A reader that outlasts two batches reads again. One
    checkpoint writes a table, from batch 0 on.
    """

    def __init__(self, sink: str, keys: list[str], buckets: int = SINK_BUCKETS) -> None:
        self.sink, self.keys, self.buckets = sink, list(keys), buckets

    def _manifest(self, spark: SparkSession, before: int | None) -> tuple[dict, StructType | None]:
        """Slot by bucket and the schema, as of the last batch (before ``before``); the rows of two
        manifests are collected, at most one per bucket each."""
        if before == 0:
            return {}, None
        rows = spark.read.schema(_MANIFEST).parquet(f"{self.sink}/manifest")
        rows = [r for r in rows.collect() if before is None or r["batch"] < before]
        last = max((r["batch"] for r in rows), default=None)
        rows = [r for r in rows if r["batch"] == last]
        schema = StructType.fromJson(json.loads(rows[0]["table_schema"])) if rows else None
        return {r[_BUCKET]: r[_SLOT] for r in rows if r[_BUCKET] >= 0}, schema

    def _read(self, spark: SparkSession, slots: dict, schema: StructType) -> DataFrame:
        if not slots:
            return spark.createDataFrame([], schema)
        placed = StructType([*schema.fields, *StructType.fromDDL(f"{_BUCKET} INT, {_SLOT} INT").fields])
        current = F.lit(False)
        for slot in (0, 1):
            of_slot = [b for b, s in slots.items() if s == slot]
            current |= (F.col(_SLOT) == slot) & F.col(_BUCKET).isin(of_slot)
        rows = spark.read.schema(placed).parquet(f"{self.sink}/data")
        return rows.filter(current).drop(_BUCKET, _SLOT)

    def rows(self, spark: SparkSession) -> DataFrame:
        """The current rows."""
        slots, schema = self._manifest(spark, None)
        return self._read(spark, slots, schema)

    def rows_before(self, batch: DataFrame, batch_id: int, schema: StructType) -> DataFrame:
        """The rows as they were before a batch, of the buckets that its keys fall into."""
        slots, _ = self._manifest(batch.sparkSession, batch_id)
        touched = self._touched(batch)
        return self._read(batch.sparkSession, {b: s for b, s in slots.items() if b in touched}, schema)

    def _bucket_of(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _touched(self, rows: DataFrame) -> set[int]:
        return {r[0] for r in rows.select(self._bucket_of()).distinct().collect()}

    def write(self, changed: DataFrame, batch_id: int) -> None:
        """Put the rows of one micro-batch, one per key, in place of the earlier rows of their keys."""
        spark = changed.sparkSession
        changed.persist()
        try:
            before, _ = self._manifest(spark, batch_id)
            touched = self._touched(changed)
            slots = before | {b: 1 - before.get(b, 1) for b in touched}
            earlier = self._read(
                spark, {b: s for b, s in before.items() if b in touched}, changed.schema
            )
            same = [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in self.keys]
            kept = earlier.alias("old").join(
                changed.select(*self.keys).alias("new"), functools.reduce(lambda a, b: a & b, same), "left_anti"
            )
            slot = F.lit(0)
            for bucket in touched:
                slot = F.when(F.col(_BUCKET) == bucket, slots[bucket]).otherwise(slot)
            if touched:
                rows = kept.unionByName(changed).withColumn(_BUCKET, self._bucket_of())
                rows.withColumn(_SLOT, slot).repartition(_BUCKET).write.mode("overwrite").option(
                    "partitionOverwriteMode", "dynamic"
                ).partitionBy(_BUCKET, _SLOT).parquet(f"{self.sink}/data")
            schema = changed.schema.json()
            entries = [(-1, 0, schema, batch_id), *[(b, s, schema, batch_id) for b, s in slots.items()]]
            manifest = spark.createDataFrame(entries, _MANIFEST).coalesce(1)
            manifest.write.mode("overwrite").parquet(f"{self.sink}/manifest/turn={batch_id % 2}")
        finally:
            changed.unpersist()


def run_update(
    stream: DataFrame, sink: str, checkpoint: str, keys: list[str], trigger: dict | None = None
) -> None:
    """Process what is there and keep the last row of every key in a :class:`KeyedTable`."""
    run_batches(stream, KeyedTable(sink, keys).write, checkpoint, "update", trigger)


def read_latest(spark: SparkSession, sink: str, keys: list[str]) -> DataFrame:
    """Current rows of an update sink: the last version of each key."""
    return KeyedTable(sink, keys).rows(spark)


# --- several outputs of one batch, visible together ------------------------------------------


def atomic_sinks(sinks: dict[str, str], marker: str, split: Callable[[DataFrame, int], dict]):
    """Writer that stores the outputs of one micro-batch and then marks it complete.

    ``split`` turns a batch and its number into one DataFrame per name in ``sinks``, such as the
    changed state and the events that announce it. A reader that keeps to marked batches
    (:func:`read_committed`) sees all outputs of a batch or none.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, rows in split(batch, batch_id).items():
                rows.write.mode("overwrite").parquet(_batch_folder(sinks[name], batch_id))
            mark = batch.sparkSession.range(1).select(F.lit(batch_id).alias("committed_batch"))
            mark.write.mode("overwrite").parquet(_batch_folder(marker, batch_id))
        finally:
            batch.unpersist()

    return write


def read_committed(spark: SparkSession, sink: str, marker: str) -> DataFrame:
    """Rows of marked batches only."""
    marked = spark.read.parquet(marker).select(F.col(BATCH_ID))
    return spark.read.parquet(sink).join(marked, BATCH_ID, "left_semi")


def job_paths(spark: SparkSession, name: str) -> tuple[str, str]:
    """Fresh sink and checkpoint folders of a job run from scratch."""
    root = scratch_path(spark, name)
    return f"{root}/sink", f"{root}/checkpoint"
