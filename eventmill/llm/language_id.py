"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

A text is lower-cased, everything but letters becomes single blanks, and its character n-grams of 1
to 3 are hashed into ``BUCKETS`` features, weighted by TF-IDF and scaled to length 1. How many
documents hold a feature is counted over all documents that may be learned from. The model is fitted
by follow-the-regularised-leader (proximal, a learning rate per coordinate) with an elastic net: the
L1 part keeps most weights at exactly 0, the L2 part bounds the rest. One in ``CALIBRATION`` sampled
texts is kept out of the fit; on those a temperature is chosen by which the scores are calibrated.

Bounds: the fit sees at most ``SAMPLE`` different texts (or one per language), as many of each
language, those with the smallest hashes, so it does not depend on the order of rows or on how often
a text is repeated. A sampled text is its features, at most ``BUCKETS`` of them. The driver holds the
sample, the counts (``BUCKETS`` numbers) and the model (``BUCKETS`` numbers a language); the workers
get the last two. Documents are scored each by itself.

Defined results: ``held_out`` is false for a row without a doc_id, which is learned from if it has a
language; ``und`` with score 0 for a text that is null or has no letter, and for every text where
nothing could be learned; ties go to the smallest language name; equal texts get equal results, and
repeated rows are scored each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventmill.llm.common import documents, hash128

BUCKETS = 1 << 16
SAMPLE = 4000
CALIBRATION = 5
EPOCHS = 2
#: Learning rate and its offset, L1 and L2 of the fit.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.05
UNKNOWN = "und"

_NO_LETTER = re.compile(r"[\W\d_]+")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


# --- features -----------------------------------------------------------------------------------


def letters(text: str | None) -> str:
    """The text's words in lower case, one blank around each; empty if it has no letter."""
    words = _NO_LETTER.sub(" ", (text or "").lower()).strip()
    return f" {words} " if any(map(str.isalpha, words)) else ""


def ngrams(clean: str, buckets: int = BUCKETS) -> np.ndarray:
    """The feature of every character 1-, 2- and 3-gram of a cleaned text."""
    c = np.frombuffer(clean.encode("utf-32-le", "surrogatepass"), np.uint32)
    a, b = c * np.uint32(0x9E3779B1), c * np.uint32(0x85EBCA77)
    two = a[:-1] ^ (b[1:] + np.uint32(2))
    three = (two[:-1] * np.uint32(0xC2B2AE3D)) ^ (b[2:] + np.uint32(3))
    hashed = np.concatenate([a + np.uint32(1), two, three])
    hashed = (hashed ^ (hashed >> np.uint32(15))) * np.uint32(0x27D4EB2F)
    return (hashed ^ (hashed >> np.uint32(13))) & np.uint32(buckets - 1)


def features(clean: str, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """The features a cleaned text has, and how often."""
    counts = np.bincount(ngrams(clean, buckets), minlength=buckets)
    held = np.flatnonzero(counts)
    return held, counts[held]


def weighted(held: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = counts * idf[held]
    return x / math.sqrt(float(x @ x))


# --- the fit --------------------------------------------------------------------------------------


def _document_counts(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets + 1, np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                clean = letters(text)
                if clean:
                    total[features(clean, buckets)[0]] += 1
                total[buckets] += 1
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int32()), pa.array(total[held], pa.int64())], ["feature", "n"]
        )

    return run


def inverse_frequencies(learned: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The IDF of every feature over all rows of ``learned``."""
    counted = (
        learned.select("text")
        .mapInArrow(_document_counts(buckets), "feature int, n long")
        .groupBy("feature")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    n = np.zeros(buckets + 1)
    for row in counted:
        n[row["feature"]] = row["n"]
    return np.log((1 + n[buckets]) / (1 + n[:buckets])) + 1


def _sample_features(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [features(letters(t), buckets) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("lang"),
                    batch.column("h1"),
                    batch.column("h2"),
                    pa.array([held.astype("<i4").tobytes() for held, _ in pairs], pa.binary()),
                    pa.array([counts.astype("<i4").tobytes() for _, counts in pairs], pa.binary()),
                ],
                ["lang", "h1", "h2", "held", "counts"],
            )

    return run


def fitting_sample(learned: DataFrame, size: int = SAMPLE, buckets: int = BUCKETS) -> pa.Table:
    """Features of as many different texts of each language, ``size`` in all at most (but one of
    each language), by the smallest hashes."""
    lettered = learned.where(F.col("text").rlike(r"\p{L}")).select(
        "lang", "text", *hash128("text")
    )
    kinds = lettered.groupBy("lang", "h1", "h2").agg(F.count(F.lit(1)).alias("n"))
    languages = lettered.agg(F.count_distinct("lang")).first()[0]
    each = max(1, size // max(languages, 1))
    rank = F.row_number().over(W.partitionBy("lang").orderBy("h1", "h2"))
    chosen = kinds.withColumn("rank", rank).where(F.col("rank") <= each).drop("rank", "n")
    texts = (
        lettered.join(chosen, ["lang", "h1", "h2"], "left_semi")
        .groupBy("lang", "h1", "h2")
        .agg(F.first("text").alias("text"))
    )
    schema = "lang string, h1 long, h2 long, held binary, counts binary"
    found = texts.select("lang", "h1", "h2", "text").mapInArrow(_sample_features(buckets), schema)
    return found.toArrow().sort_by([("h1", "ascending"), ("h2", "ascending"), ("lang", "ascending")])


class Model:
    """Weights of every feature and language, and the temperature of the scores."""

    def __init__(self, languages: list[str], idf: np.ndarray, weights: np.ndarray, bias: np.ndarray):
        self.languages, self.idf, self.weights, self.bias = languages, idf, weights, bias
        self.temperature = 1.0

    def logits(self, held: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return weighted(held, counts, self.idf) @ self.weights[held] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        clean = letters(text) if self.languages else ""
        if not clean:
            return UNKNOWN, 0.0
        p = softmax(self.logits(*features(clean, len(self.idf))) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max())
    return e / e.sum()


def fit_ftrl(
    rows: list[tuple[np.ndarray, np.ndarray, int]],
    idf: np.ndarray,
    classes: int,
    epochs: int = EPOCHS,
    rates: tuple[float, float, float, float] = (ALPHA, BETA, L1, L2),
) -> tuple[np.ndarray, np.ndarray]:
    """Weights (feature by class) and bias, from (features, counts, class) in this order.

    The bias is a feature that every row has, with value 1 and without L1.
    """
    alpha, beta, l1, l2 = rates
    z, n = np.zeros((len(idf), classes)), np.zeros((len(idf), classes))
    zb, nb = np.zeros(classes), np.zeros(classes)

    def proximal(z, n, l1):
        shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0)
        return -shrunk / ((beta + np.sqrt(n)) / alpha + l2)

    for _ in range(epochs):
        for held, counts, label in rows:
            x = weighted(held, counts, idf)
            zh, nh = z[held], n[held]
            w, b = proximal(zh, nh, l1), proximal(zb, nb, 0)
            wrong = softmax(x @ w + b)
            wrong[label] -= 1
            g = x[:, None] * wrong
            z[held] = zh + g - (np.sqrt(nh + g * g) - np.sqrt(nh)) / alpha * w
            n[held] = nh + g * g
            zb += wrong - (np.sqrt(nb + wrong * wrong) - np.sqrt(nb)) / alpha * b
            nb += wrong * wrong
    return proximal(z, n, l1), proximal(zb, nb, 0)


def best_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least negative log-likelihood, by golden section on its logarithm."""

    def loss(log_t: float) -> float:
        scaled = logits / math.exp(log_t)
        top = scaled.max(axis=1)
        total = np.log(np.exp(scaled - top[:, None]).sum(axis=1)) + top
        return float((total - scaled[np.arange(len(labels)), labels]).mean())

    low, high, ratio = math.log(0.02), math.log(20.0), (math.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return math.exp((low + high) / 2)


def fit(learned: DataFrame, size: int = SAMPLE, buckets: int = BUCKETS) -> Model:
    """The model of all rows of ``learned`` (text, lang)."""
    learned = learned.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    idf = inverse_frequencies(learned, buckets)
    sample = fitting_sample(learned, size, buckets)
    names = sample.column("lang").to_pylist()
    languages = sorted(set(names))
    place = {name: i for i, name in enumerate(languages)}
    rows = [
        (np.frombuffer(held, "<i4"), np.frombuffer(counts, "<i4"), place[name])
        for held, counts, name in zip(
            sample.column("held").to_pylist(), sample.column("counts").to_pylist(), names, strict=True
        )
    ]
    # Rows are in the order of a hash, so every fifth is a random fifth.
    fitted = [row for i, row in enumerate(rows) if i % CALIBRATION] or rows
    model = Model(languages, idf, *fit_ftrl(fitted, idf, len(languages)))
    kept = rows[::CALIBRATION]
    if len(languages) > 1 and len(kept) >= CALIBRATION:
        logits = np.array([model.logits(held, counts) for held, counts, _ in kept])
        model.temperature = best_temperature(logits, np.array([label for *_, label in kept]))
    return model


# --- the scan -------------------------------------------------------------------------------------


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``lang_pred`` and ``score`` of every row of (doc_id, text, held_out)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array([lang for lang, _ in found], pa.string()),
                    pa.array([score for _, score in found], pa.float64()),
                ],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "held_out", "text").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, lang_pred string, score double"
    )


def language_id(docs: DataFrame, size: int = SAMPLE, buckets: int = BUCKETS) -> DataFrame:
    """The language of every row of (doc_id, text, lang), learned from those not held out."""
    rows = docs.select("doc_id", "text", "lang", held_out(F.col("doc_id")).alias("held_out"))
    model = fit(rows.where(~F.col("held_out")).select("text", "lang"), size, buckets)
    return identify(rows, model)


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(documents(spark, sf_dir))


QUERIES = {"op12_language_id": op12_language_id}
ORACLE: dict[str, str] = {}
