"""Lines that many documents repeat, found with levelled sorted runs of line hashes.

A line's key is the line stripped of ASCII white space, A-Z lower-cased. ``LineRuns`` keeps, for
every key of at least ``MIN_CHARS`` code points, how many documents hold it and the largest doc_id
of them, as runs sorted by the key's 128-bit hash. Each batch of documents adds one run of level 0;
as soon as a level has ``fanout`` runs, they are merged into one run of the next level. A batch's
lines are then anti-joined (a sorted merge on the hash) with the keys in at least ``min_docs``
documents, and what is left is the text kept.

Everything is DataFrame functions. A line that a third of all documents hold is one row per task
before the shuffle when runs are built; in the anti-join, adaptive execution splits it, since both
sides are shuffled for the join alone.

Defined results: a null or empty text is one empty line; a null doc_id counts as the smallest;
repeated rows are documents of their own, and all rows with a key's largest doc_id keep it; an
empty table gives an empty result; other columns are passed through whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.llm.common import ascii_lower, documents, hash128, whole
from eventmill.session import scratch_path

MIN_CHARS = 20
MIN_DOCS = 3
FANOUT = 2
BATCHES = 2
STRIPPED = " \t\n\x0b\x0c\r"


def lines(text: Column) -> Column:
    return F.split(whole(text), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(STRIPPED)))


def _merged(entries: DataFrame) -> DataFrame:
    return entries.groupBy("h1", "h2").agg(
        F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc")
    )


class LineRuns:
    """Sorted runs (h1, h2, n_docs, last_doc) of line keys under a shared folder."""

    def __init__(self, spark: SparkSession, folder: str, fanout: int = FANOUT):
        self.spark, self.folder, self.fanout = spark, folder, fanout
        self.levels: list[list[str]] = [[]]
        self.written = 0

    def _write(self, run: DataFrame, level: int) -> None:
        path = f"{self.folder}/level-{level}-run-{self.written}"
        run.sortWithinPartitions("h1", "h2").write.parquet(path)
        self.written += 1
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)

    def add(self, docs: DataFrame) -> None:
        """Add one batch (doc_id, text) as a run, and compact the levels that are full."""
        keys = F.array_distinct(
            F.filter(
                F.transform(lines(F.col("text")), line_key),
                lambda key: F.char_length(key) >= MIN_CHARS,
            )
        )
        held = docs.select("doc_id", F.explode(keys).alias("key"))
        self._write(
            held.select("doc_id", *hash128("key"))
            .groupBy("h1", "h2")
            .agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc")),
            0,
        )
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._write(_merged(self.spark.read.parquet(*full)), level + 1)
            level += 1

    def frequent(self, min_docs: int = MIN_DOCS) -> DataFrame:
        """The keys in at least ``min_docs`` documents, over all runs."""
        runs = [path for level in self.levels for path in level]
        entries = self.spark.read.parquet(*runs)
        merged = entries if len(runs) == 1 else _merged(entries)
        return merged.where(F.col("n_docs") >= min_docs).select("h1", "h2", "last_doc")


def build_runs(docs: DataFrame, batches: int = BATCHES) -> LineRuns:
    """Runs over all documents, added in batches dealt by a hash of doc_id."""
    spark = docs.sparkSession
    runs = LineRuns(spark, scratch_path(spark, "line-runs"))
    dealt = docs.select("doc_id", "text")
    for batch in range(batches):
        runs.add(dealt.where(F.pmod(F.xxhash64("doc_id"), F.lit(batches)) == batch))
    return runs


def without(values: Column, places: Column) -> Column:
    """The array without the elements at ``places`` (from 0; null: none), in time linear in both:
    a hash set of places, not a search per element."""
    # The one-element array binds the values, so that they are computed once per row.
    return F.when(places.isNull(), values).otherwise(
        F.transform(
            F.array(values),
            lambda every: F.transform(
                F.array_except(
                    F.sequence(F.lit(0), F.size(every)), F.array_append(places, F.size(every))
                ),
                lambda place: F.get(every, place),
            ),
        )[0]
    )


def line_dedup(docs: DataFrame, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """Each row of ``docs`` as struct ``row``, with kept_text, n_lines and n_dropped."""
    runs = build_runs(docs, batches)
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").alias("id"),
        F.xxhash64("text").alias("text_hash"),
    )
    placed = (
        docs.select(
            F.col("doc_id").alias("id"),
            F.xxhash64("text").alias("text_hash"),
            lines(F.col("text")).alias("lines"),
        )
        # In a select of its own, so that a text is hashed once and not once per line.
        .select("id", "text_hash", F.posexplode("lines").alias("place", "line"))
        .select("id", "text_hash", "place", line_key(F.col("line")).alias("key"))
        .where(F.char_length("key") >= MIN_CHARS)
        .select("id", "text_hash", "place", *hash128("key"))
    )
    repeated = placed.join(runs.frequent(min_docs), ["h1", "h2"]).where(
        ~F.col("id").eqNullSafe(F.col("last_doc"))
    )
    # Rows that agree in id and text have the same places, once per copy.
    dropped = (
        repeated.select("id", "text_hash", "place")
        .groupBy("id", "text_hash")
        .agg(F.collect_set("place").alias("gone"))
    )
    joined = keyed.alias("d").join(
        dropped.alias("g"),
        F.col("d.id").eqNullSafe(F.col("g.id")) & (F.col("d.text_hash") == F.col("g.text_hash")),
        "left",
    )
    every = lines(F.col("row.text"))
    return joined.select(
        "row",
        F.array_join(without(every, F.col("gone")), "\n").alias("kept_text"),
        F.size(every).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` with its repeated lines gone; rows without such lines come back unchanged."""
    result = line_dedup(docs)
    changed = F.col("n_dropped") > 0
    values = {
        "text": F.when(changed, F.col("kept_text")).otherwise(F.col("row.text")),
        "n_chars": F.when(changed, F.char_length("kept_text").cast("long")).otherwise(
            F.col("row.n_chars") if "n_chars" in docs.columns else F.lit(None)
        ),
    }
    return result.select(
        *[values.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns]
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = line_dedup(documents(spark, sf_dir))
    return result.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_lines",
        "n_dropped",
        F.sha2(F.col("kept_text"), 256).alias("kept_sha256"),
    )


QUERIES = {"op7_line_dedup": op7_line_dedup}

ORACLE = {
    "op7_line_dedup": r"""
WITH rows AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
placed AS (
  SELECT r, doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS place
  FROM (SELECT *, string_split(text, chr(10)) AS l FROM rows)),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM placed),
frequent AS (
  SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT r) >= 3),
marked AS (
  SELECT k.*, f.key IS NOT NULL AND k.doc_id IS DISTINCT FROM f.last_doc AS gone
  FROM keyed k LEFT JOIN frequent f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines,
       CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), ''))
         AS kept_sha256
FROM marked GROUP BY r, doc_id
"""
}
