"""An outbox whose relay reads and writes only what is open.

Rows lie in segments of their number, marks of published rows beside them; both are only appended
to. A cursor names the first segment with an unpublished row, so a relay reads from there on, and
marking 100 rows writes 100 marks, whatever the outbox holds. A relay that stops between publishing
and marking publishes again: delivery is at least once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from eventmill import constants as C

SEGMENT_ROWS = 1_000_000


class Outbox:
    """An outbox under ``folder``; one process writes it. ``schema``: its rows without
    ``published_at``, with a whole number ``seq``, unique and roughly dense."""

    def __init__(
        self, spark: SparkSession, folder: str, schema: StructType, segment_rows: int = SEGMENT_ROWS
    ) -> None:
        self.spark, self.folder, self.schema = spark, folder, schema
        self.segment_rows = segment_rows

    def _segment(self) -> Column:
        return F.expr(f"seq DIV {self.segment_rows}").cast("bigint")

    def _add(self, rows: DataFrame, name: str) -> None:
        placed = rows.withColumn("segment", self._segment()).repartition("segment")
        placed.write.mode("append").partitionBy("segment").parquet(f"{self.folder}/{name}")

    def _rows(self) -> DataFrame:
        schema = StructType([*self.schema.fields, StructField("segment", LongType())])
        return self.spark.read.schema(schema).parquet(f"{self.folder}/rows")

    def _marks(self) -> DataFrame:
        schema = "seq BIGINT, published_at TIMESTAMP_NTZ, segment BIGINT"
        return self.spark.read.schema(schema).parquet(f"{self.folder}/marks")

    def create(self) -> "Outbox":
        """An empty outbox."""
        self._add(self.spark.createDataFrame([], self.schema), "rows")
        self._add(self.spark.createDataFrame([], "seq BIGINT, published_at TIMESTAMP_NTZ"), "marks")
        self._set_cursor(0, None)
        return self

    # The cursor's two files take turns, so that one is always whole.
    def _cursor(self) -> tuple[int, int | None]:
        kept = self.spark.read.schema("number BIGINT, first_open BIGINT").parquet(f"{self.folder}/cursor")
        last = max(kept.collect(), key=lambda r: r["number"])
        return last["number"], last["first_open"]

    def _set_cursor(self, number: int, first_open: int | None) -> None:
        row = self.spark.createDataFrame([(number, first_open)], "number BIGINT, first_open BIGINT")
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/cursor/turn={number % 2}")

    def append(self, rows: DataFrame) -> None:
        """Add rows that are not published. Rows of a segment that was closed open it again."""
        self._add(rows.select(*self.schema.names), "rows")
        least = rows.agg(F.min(self._segment())).first()[0]
        number, first_open = self._cursor()
        if least is not None and (first_open is None or least < first_open):
            self._set_cursor(number + 1, least)

    def unpublished(self) -> DataFrame:
        """Rows without a mark; closed segments are not read."""
        _, first_open = self._cursor()
        if first_open is None:
            return self.spark.createDataFrame([], self.schema)
        open_ = F.col("segment") >= first_open
        marks = self._marks().filter(open_).select("segment", "seq")
        rows = self._rows().filter(open_).join(marks, ["segment", "seq"], "left_anti")
        return rows.select(*self.schema.names)

    def next_batch(self, size: int = C.OUTBOX_BATCH_SIZE) -> DataFrame:
        """The oldest unpublished rows, in order."""
        return self.unpublished().orderBy("seq").limit(size)

    def mark(self, published: DataFrame, now: Column) -> None:
        """Note that rows are published, and close the segments that are done."""
        self._add(published.select("seq", now.cast("timestamp_ntz").alias("published_at")), "marks")
        number, first_open = self._cursor()
        least = self.unpublished().agg(F.min(self._segment())).first()[0]
        if least != first_open:
            self._set_cursor(number + 1, least)

    def table(self) -> DataFrame:
        """All rows, with the time of their first mark."""
        marks = self._marks().groupBy("segment", "seq").agg(F.min("published_at").alias("published_at"))
        joined = self._rows().join(marks, ["segment", "seq"], "left")
        return joined.select(*self.schema.names, "published_at")

    def backlog(self) -> DataFrame:
        """Unpublished rows per topic: how many and the oldest number."""
        return self.unpublished().groupBy("topic").agg(
            F.count(F.lit(1)).alias("backlog"), F.min("seq").alias("oldest_seq")
        )
