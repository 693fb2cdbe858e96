"""Small tables that the tests of the text operators share."""

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

#: Names that the operators use inside.
CLASHING = (
    "row", "id", "key", "place", "line", "text_hash", "gone", "labels", "words", "spans", "base",
    "n", "c1", "c2", "a", "b", "part", "node", "shard", "size", "slot", "bucket", "mark", "task",
    "length", "score", "toxic", "hits", "signatures", "shingles", "kept_text", "component_id",
)

LONG = "word and the thing of note " * 8000

ODD_ROWS = [
    (1, None, None, None, None),
    (2, "", "en", "src0", 0),
    (None, "a text without a number, long enough to be a line", "en", None, 48),
    (4, LONG, "en", "src1", len(LONG)),
    (5, "\n\n\n", "en", "src1", 3),
    (6, "one two three", "fr", "src2", 13),
    (7, "one two three", "fr", "src3", 13),
    (8, "the same row twice, with a text that is long enough", "es", "src3", 51),
    (8, "the same row twice, with a text that is long enough", "es", "src3", 51),
    (9, "Été \U0001f600 日本語 ...", "fr", "src2", 13),
]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def odd(spark):
    """Nulls, empty and very long texts, ties, a repeated row, and clashing extra columns."""
    out = frame(spark, ODD_ROWS)
    for name in CLASHING:
        out = out.withColumn(name, F.lit("extra"))
    return out


def empty(spark):
    return frame(spark, [])


def texts(spark, values, first=0):
    return frame(
        spark, [(first + i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(values)]
    )
