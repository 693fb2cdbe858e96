"""What the operators share: reading documents, row identity and settings for Python stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()

#: Rows and bytes of one Arrow batch: bounds the memory of a Python worker, whatever the rows' size.
BATCH_ROWS = 2000
BATCH_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def bound_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def whole(text: Column | str) -> Column:
    """The text; empty for null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is (``lower`` would change those too)."""
    return F.when(
        text.rlike(r"[^\x00-\x7F]"), F.translate(text, ASCII_UPPER, ASCII_LOWER)
    ).otherwise(F.lower(text))


def hash128(*columns: Column | str) -> list[Column]:
    """Two 64-bit hashes of the columns, named h1 and h2: together safe against collisions."""
    return [
        F.xxhash64(*columns).alias("h1"),
        F.xxhash64(F.lit("second"), *columns).alias("h2"),
    ]
