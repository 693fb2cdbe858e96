"""Document fingerprints from spot signatures.

Wherever a common word (an anchor) stands, it and the next ``CHAIN`` content words after it form a
signature; a document's fingerprint is its set of signatures, as sorted 32-bit hashes in
hexadecimal. Navigation, markup and lists hold few common words, so the signatures gather in running
text. Likeness of two fingerprints is the Jaccard of their sets.

``near_pairs`` finds all pairs of fingerprints of at least a given likeness: sets are partitioned by
length (a pair's lengths differ by at most the factor of the threshold, so only a band and the next
one meet), each set is listed under its first signatures in hash order only (pairs that reach the
threshold share one of them), and pairs are pruned by length and position before they are compared.

The query also compares each document with its own edited text and with the next document. Documents
are cut into buckets of ascending doc_id at sampled quantiles, and each bucket gets a copy of the row
that follows it, so neighbours meet in one pass over sorted rows with one row kept at a time.

Defined results: a null or empty text has the empty fingerprint; two empty fingerprints have likeness
1, an empty and another one 0; a text without anchors followed by content words has a single
signature of all its words, and one without words a signature of the text itself; a null doc_id comes
first; rows with equal doc_id follow each other by text; a single document is its own next one; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.llm.common import documents

CHAIN = 2
THRESHOLD = 0.75
#: Bytes of text in a bucket, and the least number of buckets.
BUCKET_BYTES, LEAST_BUCKETS = 64 << 20, 64

#: Common words after which a signature starts, and further words that are no content.
ANCHORS = frozenset(
    (
        "the a an is are was were be to of and in that it for with on "
        "der die das und ist ein eine nicht zu den von mit "
        "le la les de des un une est et que dans pour "
        "el los las en y por con del una es"
    ).split()
)
NO_CONTENT = ANCHORS | frozenset(
    (
        "this as by at from or not have has had but they he she his her we you i "
        "auf im sich auch dem als für an bei so wie wir sie er es "
        "du au aux ce ces par sur plus ne pas se qui il elle "
        "al lo su sus se no más como para o"
    ).split()
)
WORD = re.compile(r"[^\W_]+")


def signatures(text: str | None, chain: int = CHAIN) -> frozenset[int]:
    """32-bit hashes of a text's spot signatures."""
    if not text:
        return frozenset()
    words = WORD.findall(text.lower())
    content: list[str] = []
    spots: list[tuple[str, int]] = []
    for word in words:
        if word in ANCHORS:
            spots.append((word, len(content)))
        elif word not in NO_CONTENT:
            content.append(word)
    crc = zlib.crc32
    last = len(content) - chain
    found = frozenset(
        crc(f"{word} {' '.join(content[at : at + chain])}".encode())
        for word, at in spots
        if at <= last
    )
    if found:
        return found
    return frozenset([crc((" ".join(words) or text).encode("utf-8", "surrogatepass"))])


def fingerprint(found: frozenset[int]) -> str:
    return np.sort(np.fromiter(found, ">u4", len(found))).astype(">u4").tobytes().hex()


def likeness(a: frozenset[int], b: frozenset[int]) -> float:
    """Jaccard; 0 at once where the sizes or sets share nothing."""
    if not a or not b:
        return 1.0 if not a and not b else 0.0
    shared = len(a & b)
    return shared / (len(a) + len(b) - shared)


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


# --- all pairs --------------------------------------------------------------------------------


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and sorted signatures of every row."""

    @F.udf("array<long>", useArrow=True)
    def of(text):
        return sorted(signatures(text))

    return docs.select("doc_id", of(F.col("text").cast("string")).alias("signatures"))


def near_pairs(prints: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(left_id, right_id, likeness) of fingerprints at least ``threshold`` alike.

    Rows with equal signatures form one class, represented by its smallest id.
    """
    classes = (
        prints.where(F.size("signatures") > 0)
        .groupBy("signatures")
        .agg(F.min("doc_id").alias("id"))
        .withColumn("n", F.size("signatures"))
    )
    band = F.floor(F.log("n") / F.lit(math.log(1 / threshold)) + 1e-9).cast("int")
    prefix = F.col("n") - F.ceil(F.col("n") * threshold - 1e-9).cast("int") + 1
    listed = classes.select("id", "n", "signatures", band.alias("band"), prefix.alias("prefix"))
    spots = listed.select(
        "id",
        "n",
        "band",
        F.posexplode(F.slice("signatures", F.lit(1), F.col("prefix"))).alias("at", "signature"),
    )
    # The larger set of a pair is in the band of the smaller one or in the next.
    upper = spots.withColumn("band", F.explode(F.array("band", F.col("band") - 1)))
    a, b = spots.alias("a"), upper.alias("b")
    enough = F.ceil(
        (F.col("a.n") + F.col("b.n")) * (threshold / (1 + threshold)) - F.lit(1e-9)
    )
    # From a pair's first common signature on, both must still have enough.
    bound = F.least(F.col("a.n") - F.col("a.at"), F.col("b.n") - F.col("b.at"))
    candidates = (
        a.join(b, ["band", "signature"])
        .where(
            (F.struct("a.n", "a.id") < F.struct("b.n", "b.id"))
            & (F.col("a.n") >= F.col("b.n") * threshold - 1e-9)
            & (bound >= enough)
        )
        .select(F.col("a.id").alias("left_id"), F.col("b.id").alias("right_id"))
        .distinct()
    )
    left = listed.select(F.col("id").alias("left_id"), F.col("signatures").alias("ls"))
    right = listed.select(F.col("id").alias("right_id"), F.col("signatures").alias("rs"))
    shared = F.size(F.array_intersect("ls", "rs"))
    return (
        candidates.join(left, "left_id")
        .join(right, "right_id")
        .withColumn("likeness", shared / (F.size("ls") + F.size("rs") - shared))
        .where(F.col("likeness") >= threshold - 1e-12)
        .select("left_id", "right_id", "likeness")
    )


# --- neighbours -------------------------------------------------------------------------------


def _bucket(key: Column, bounds: list[int], group: int = 512) -> Column:
    """How many bounds are at most the key, looked up in two steps."""
    if not bounds:
        return F.lit(0)
    every = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<long>")
    coarse = F.split(F.lit(",".join(map(str, bounds[::group]))), ",").cast("array<long>")
    passed = F.size(F.filter(coarse, lambda b: b <= key))
    first = F.greatest(passed - 1, F.lit(0)) * group
    fine = F.slice(every, first + 1, F.lit(group))
    return first + F.size(F.filter(fine, lambda b: b <= key))


def with_following(docs: DataFrame) -> tuple[DataFrame, int]:
    """Rows (bucket, mark, key, doc_id, text) and the number of buckets: ascending doc_id within
    and across buckets, and in each bucket a marked row, the one that follows the bucket's last."""
    keyed = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("key"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    size = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, size // BUCKET_BYTES)
    shares = [i / buckets for i in range(1, buckets)]
    bounds = keyed.agg(
        F.percentile_approx("key", shares, F.lit(min(1_000_000, 20 * buckets)))
    ).first()[0]
    bounds = sorted(set(bounds or []))
    placed = keyed.withColumn("bucket", _bucket(F.col("key"), bounds))
    # One row per bucket: its smallest key, and the bucket before it that holds rows.
    firsts = placed.groupBy("bucket").agg(F.min("key").alias("key")).collect()
    firsts.sort(key=lambda r: r["bucket"])
    marks = [
        (firsts[i - 1]["bucket"], r["key"]) for i, r in enumerate(firsts)
    ]  # the first bucket's row follows the last bucket
    if not marks:
        return placed.withColumn("mark", F.lit(0)), buckets
    marked = docs.sparkSession.createDataFrame(marks, "bucket int, key long")
    # Broadcast: one row of two numbers per bucket.
    following = keyed.join(F.broadcast(marked), "key").withColumn("mark", F.lit(1))
    columns = ["bucket", "mark", "key", "doc_id", "text"]
    return (
        placed.withColumn("mark", F.lit(0)).select(columns).union(following.select(columns)),
        buckets,
    )


SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)
DDL = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def compare_neighbours(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    rows, buckets = with_following(docs)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None  # bucket, doc_id, text and signatures of the row before
        for batch in batches:
            out = []
            for bucket, mark, doc_id, text in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if mark and (kept is None or kept[0] != bucket):
                    continue  # a further row with the following key
                own = signatures(text)
                if kept is not None and kept[0] == bucket:
                    _, before_id, before, found = kept
                    changed = edited(before, text)
                    other = signatures(changed)
                    out.append(
                        (
                            before_id,
                            len(before),
                            hashlib.sha256(changed.encode()).hexdigest(),
                            fingerprint(found),
                            fingerprint(other),
                            likeness(found, other),
                            likeness(found, own),
                        )
                    )
                kept = None if mark else (bucket, doc_id, text, own)
            columns = zip(*out, strict=True) if out else [[] for _ in SCHEMA]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, SCHEMA.types, strict=True)],
                schema=SCHEMA,
            )

    return (
        rows.repartition(buckets, "bucket")
        .sortWithinPartitions("bucket", "mark", "key", "text")
        .select("bucket", "mark", "doc_id", "text")
        .mapInArrow(compare, DDL)
    )


def op9_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_neighbours(documents(spark, sf_dir))


QUERIES = {"op9_spot_signatures": op9_spot_signatures}

ORACLE: dict[str, str] = {}
