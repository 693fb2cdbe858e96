"""Reading the state of a running or stopped streaming query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_counts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """All entries of a keyed-count state: key columns and the count, from every partition."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select("key.*", F.col("value.count").alias("order_count"))
