"""Secret scan: fixed patterns, and strings that look random to character Markov models.

Two first-order Markov models over characters are trained: one of random strings, one of ordinary
identifiers. A candidate (a run of ``CANDIDATE_CHARS`` or more identifier characters, cut where base
spans stand) is reported when the log-likelihood ratio of the two models is at least ``MARGIN`` in
all and ``PER_CHAR`` per character; so the shorter a run, the clearer each character must speak.

Training samples are labelled by the base patterns over the whole corpus: values those patterns
find are random strings; runs of 8 or more characters (``TRAINING``) outside them are ordinary
identifiers, but for those of ``UNSURE_CHARS`` or more with a digit, which may be secrets. Only pair
counts leave a task, at most ``67 * 67`` per model, so what is gathered does not depend on the corpus'
size while every row is counted. Copies weigh as often as they occur, but
the models' weight per pair is bounded by smoothing: the random model starts from ``PRIOR`` counts
of uniform letters, digits and hexadecimal digits, so it is defined where no secret was found.

Python runs over Arrow batches of bounded size. Defined results: a null or empty text has no spans;
a very long run is judged by all of its characters like any other; repeated rows are scanned each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.llm.common import documents

#: The base patterns, in the order in which their kinds are listed.
NAMES = "password", "passwd", "secret", "token", "api_?key"


def _either_case(name: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in name)


ASSIGN = re.compile(
    "(" + "|".join(map(_either_case, NAMES)) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "markov")
ASSIGN_CHARS, ACCESS_CHARS = 8, 16

#: Candidates of the Markov models.
CANDIDATE_CHARS = 8
UNSURE_CHARS = 20
DIGIT = re.compile("[0-9]")
TRAINING = re.compile(r"[A-Za-z0-9+/_=-]{8,}")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
START = len(ALPHABET)
STATES = START + 1
PRIOR = 20_000.0
MARGIN = 12.0
PER_CHAR = 0.4

_CODE = np.full(256, -1, "int16")
_CODE[[ord(c) for c in ALPHABET]] = range(START)

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) of the base patterns, by start and then kind."""
    spans: list[Span] = []
    lower = text.lower()
    if any(word in lower for word in ("passw", "secret", "token", "key")):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= ASSIGN_CHARS:
                spans.append((m.start(), m.end(), "assign"))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= ACCESS_CHARS:
                spans.append((m.start(), m.end(), "access"))
    spans.extend((m.start(), m.end(), "hex") for m in HEX.finditer(text))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def secret_values(text: str, spans: list[Span]) -> list[str]:
    """The random strings that base spans hold."""
    out = []
    for start, end, kind in spans:
        part = text[start:end]
        out.append(ASSIGN.match(part)[2] if kind == "assign" else part)
    return out


def pair_counts(runs: list[str]) -> np.ndarray:
    """Counts of the transitions of all runs, as a flat STATES x STATES table."""
    total = np.zeros(STATES * STATES, "int64")
    if runs:
        # One string with a separator: its code is the start state.
        joined = np.frombuffer((" " + " ".join(runs)).encode("ascii", "replace"), "uint8")
        states = _CODE[joined].astype("int64")
        states[joined == 32] = START
        before, after = states[:-1], states[1:]
        good = (before >= 0) & (after >= 0) & (after != START)
        total += np.bincount(before[good] * STATES + after[good], minlength=STATES * STATES)
    return total


def _outside(text: str, spans: list[Span], pattern: re.Pattern) -> list[tuple[int, int]]:
    """Runs that overlap no span."""
    out = []
    at = 0
    ordered = sorted((s, e) for s, e, _ in spans)
    reach = 0
    for m in pattern.finditer(text):
        while at < len(ordered) and ordered[at][0] < m.end():
            reach = max(reach, ordered[at][1])
            at += 1
        if reach <= m.start():
            out.append((m.start(), m.end()))
    return out


def train(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Log transition probabilities (random, ordinary) from all rows of ``docs``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        secret = np.zeros(STATES * STATES, "int64")
        ordinary = np.zeros(STATES * STATES, "int64")
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if not text:
                    continue
                spans = base_spans(text)
                if spans:
                    secret += pair_counts(secret_values(text, spans))
                    runs = [text[s:e] for s, e in _outside(text, spans, TRAINING)]
                else:
                    runs = TRAINING.findall(text)
                ordinary += pair_counts(
                    [r for r in runs if len(r) < UNSURE_CHARS or not DIGIT.search(r)]
                )
        for name, table in ((0, secret), (1, ordinary)):
            at = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), name)), pa.array(at), pa.array(table[at])],
                names=["model", "pair", "n"],
            )

    counted = (
        docs.select(F.col("text").cast("string"))
        .mapInArrow(count, "model long, pair long, n long")
        .groupBy("model", "pair")
        .agg(F.sum("n").alias("n"))
    )
    tables = np.zeros((2, STATES * STATES))
    for row in counted.collect():  # at most 2 * STATES * STATES rows
        tables[row["model"], row["pair"]] = row["n"]
    return models(*tables)


def models(secret: np.ndarray, ordinary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log transition probabilities from pair counts, smoothed."""
    hexadecimal = np.zeros(STATES)
    hexadecimal[[ALPHABET.index(c) for c in "0123456789abcdef"]] = 1 / 16
    uniform = np.zeros(STATES)
    uniform[:START] = 1 / START
    prior = 0.5 * uniform + 0.5 * hexadecimal
    # Counts are scaled to the prior's weight, so that the corpus' size does not tip the balance.
    secret, ordinary = (t.reshape(STATES, STATES).astype(float) for t in (secret, ordinary))
    if secret.sum():
        secret = secret * min(1.0, PRIOR / secret.sum())
    random = secret + PRIOR / STATES * prior[None, :] + 1e-3
    usual = ordinary + 0.5 * uniform[None, :] + 1e-3
    return tuple(
        np.log(t / t.sum(axis=1, keepdims=True)).astype("float64") for t in (random, usual)
    )


def markov_spans(
    text: str, spans: list[Span], random: np.ndarray, ordinary: np.ndarray
) -> list[tuple[int, int, str, float]]:
    """Candidate runs outside the base spans that look random, with their log-likelihood ratio."""
    code = _CODE[np.frombuffer(text.encode("ascii", "replace"), "uint8")]
    for start, end, _ in spans:
        code[start:end] = -1
    inside = np.concatenate(([False], code >= 0, [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    runs = edges.reshape(-1, 2)
    runs = runs[runs[:, 1] - runs[:, 0] >= CANDIDATE_CHARS]
    if not len(runs):
        return []
    before = np.concatenate((np.array([START], "int16"), code[:-1]))
    before[before < 0] = START  # a run begins in the start state
    gain = np.append((random - ordinary)[before, code], 0.0)
    ratios = np.add.reduceat(gain, runs.ravel())[::2]
    found = ratios >= np.maximum(MARGIN, PER_CHAR * (runs[:, 1] - runs[:, 0]))
    return [
        (int(start), int(end), "markov", float(ratio))
        for (start, end), ratio in zip(runs[found], ratios[found], strict=True)
    ]


SPANS = "array<struct<start:int,end:int,kind:string,ratio:double>>"


def secret_scan(docs: DataFrame, trained: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """doc_id and all spans (start, end, kind, ratio; ratio null for base kinds) of every row."""
    random, ordinary = trained if trained is not None else train(docs)

    @F.pandas_udf(SPANS)
    def spans_of(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            base = base_spans(text) if text else []
            method = markov_spans(text, base, random, ordinary) if text else []
            rows = [(*s, None) for s in base] + method
            rows.sort(key=lambda s: (s[0], KINDS.index(s[2])))
            out.append([dict(zip(("start", "end", "kind", "ratio"), r, strict=True)) for r in rows])
        return pd.Series(out, dtype=object)

    return docs.select("doc_id", spans_of(F.col("text").cast("string")).alias("spans"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan(documents(spark, sf_dir))

    def text_of(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def of_kind(kind):
        return F.filter("spans", lambda s: s["kind"] == kind)

    base = F.filter("spans", lambda s: s["kind"] != "markov")
    return found.select(
        "doc_id",
        *[F.size(of_kind(kind)).cast("long").alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(text_of(base), 256).alias("base_sha256"),
        text_of(F.col("spans")).alias("spans"),
    )


QUERIES = {"op2_secret_scan": op2_secret_scan}

ORACLE: dict[str, str] = {}
