"""Topics as DataFrames with the columns of Spark's Kafka source.

A topic is either a broker topic (format ``kafka``) or a folder of files with the same
columns; everything downstream is the same for both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventmill.functions import envelope
from eventmill.schemas import TOPIC_RECORD

# Upper bound on new data per micro-batch, so that a replay of a long history does not
# become one huge batch.
BATCH_BYTES = str(64 * 1024**3)


def read_topic(
    spark: SparkSession, location: str, format: str = "parquet", **options: str
) -> DataFrame:
    """All records of a topic. ``location`` is a folder, or the topic name for ``kafka``."""
    if format == "kafka":
        reader = spark.read.format("kafka").option("subscribe", location).options(**options)
        return _text_columns(reader.load())
    return spark.read.schema(TOPIC_RECORD).format(format).options(**options).load(location)


def stream_topic(
    spark: SparkSession, location: str, format: str = "parquet", **options: str
) -> DataFrame:
    """New records of a topic, from the earliest on a fresh checkpoint."""
    if format == "kafka":
        reader = spark.readStream.format("kafka").option("subscribe", location)
        reader = reader.option("startingOffsets", "earliest").options(**options)
        return _text_columns(reader.load())
    return stream_files(spark, location, TOPIC_RECORD, format, **options)


def stream_files(
    spark: SparkSession,
    location: str,
    schema: StructType | str,
    format: str = "parquet",
    **options: str,
) -> DataFrame:
    """Files of a folder or glob as a stream, bounded per micro-batch."""
    if "maxFilesPerTrigger" not in options:
        options = {"maxBytesPerTrigger": BATCH_BYTES, **options}
    return spark.readStream.schema(schema).format(format).options(**options).load(location)


def _text_columns(records: DataFrame) -> DataFrame:
    return records.withColumn("key", F.col("key").cast("string")).withColumn(
        "value", F.col("value").cast("string")
    )


def traced(df: DataFrame, name: str, *metrics: Column) -> DataFrame:
    """Count rows (and any other aggregates) as they pass this point.

    The numbers reach query listeners and, for streams, the query progress. The rows pass
    through unchanged.
    """
    return df.observe(name, F.count(F.lit(1)).alias("rows"), *metrics)


def partition_of(key: Column, partitions: int) -> Column:
    """Partition of a key; the same key is always in the same partition."""
    return F.pmod(F.crc32(key.cast("binary")), F.lit(partitions)).cast("int")


def json_records(df: DataFrame, key: str, *columns: str) -> DataFrame:
    """Sink form of a JSON topic: ``key`` and the other columns as JSON text."""
    return df.select(F.col(key).alias("key"), F.to_json(F.struct(*columns)).alias("value"))


def long_records(df: DataFrame, key: str, number: str) -> DataFrame:
    """Sink form of a long-valued topic: ``key`` and 8 big-endian bytes."""
    return df.select(F.col(key).alias("key"), envelope.long_wire(F.col(number)).alias("value"))


def write_topic(records: DataFrame, location: str, format: str = "parquet", **options: str) -> None:
    """Append records to a topic (batch). For ``kafka``, ``location`` is the topic name."""
    if format == "kafka":
        records.write.format("kafka").option("topic", location).options(**options).save()
    else:
        records.write.mode("append").format(format).options(**options).save(location)
