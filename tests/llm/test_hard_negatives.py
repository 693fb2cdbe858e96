"""Hard negatives against a plain search of all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventmill.llm import hard_negatives as hard

SCHEMA = "vec_id long, embedding array<float>, label int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(rows):
    usable = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or not all(x is not None and math.isfinite(x) for x in vector):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        usable.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in vector], label))

    def order(found):
        return sorted(found, key=lambda f: (-f[0], f[1] is None, f[1] or 0))

    out = []
    for i, (anchor, q, label) in enumerate(usable):
        if anchor is None or anchor % 100:
            continue
        scores = [
            (sum(x * y for x, y in zip(q, other)), vec_id, own == label)
            for j, (vec_id, other, own) in enumerate(usable)
            if j != i
        ]
        for p, positive, _ in order(s for s in scores if s[2])[:5]:
            fitting = [s for s in scores if not s[2] and 30 * p <= 100 * s[0] <= 90 * p]
            for rank, (n, negative, _) in enumerate(order(fitting)[:10], 1):
                out.append((anchor, positive, rank, negative, p, n))
    return sorted(out, key=repr)


def result(spark, rows, schema=SCHEMA):
    df = hard.hard_negatives(spark.createDataFrame(rows, schema))
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=repr)


def vectors(rng, n, width=6, labels=4, spread=1.0):
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(5)]
    for vec_id in range(n):
        centre = rng.choice(centres)
        yield vec_id, [c + rng.gauss(0, spread) for c in centre], rng.randrange(labels)


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_equals_the_search_of_all_pairs(spark, monkeypatch, spread):
    monkeypatch.setattr(hard, "BLOCK_ROWS", 16)
    monkeypatch.setattr(hard, "ANCHOR_ROWS", 3)
    rows = list(vectors(random.Random(4), 901, spread=spread))
    found = result(spark, rows)
    assert found == plain(rows) and found


def test_one_label_holds_most_rows(spark, monkeypatch):
    monkeypatch.setattr(hard, "BLOCK_ROWS", 8)
    rows = [(i, v, 0 if i % 3 else label) for i, v, label in vectors(random.Random(5), 501)]
    assert result(spark, rows) == plain(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 1), (100, [1.0], 1), (200, [], 1), (300, [0.0, 0.0], 2), (400, None, 1),
        (500, [1.0, None], 1), (600, [nan, 1.0], 1), (700, [inf, 1.0], 1), (800, [1.0, 1.0], None),
        (None, [1.0, 2.0], 2), (None, [0.5, 0.5], 2), (None, [0.9, 0.2], 1), (1, [0.4, 0.6], 3),
        (1, [0.4, 0.6], 3), (2, [0.4, 0.6], 1), (2, [0.4, 0.6], 1), (900, [-1.0, 2.0], 3),
        (900, [-1.0, 2.0], 3), (3, [-1.0, 1.0], 2), (4, [1.0, 2.0, 3.0, 4.0], 2), (-100, [2.0, 2.0], 1),
        (-7, [0.7, 0.7], 9),
    ]
    rows += [(10 + i, [0.3, 0.7], 5) for i in range(12)]  # ties
    found = result(spark, rows)
    assert found == plain(rows) and found


def test_scores_beyond_doubles_are_exact(spark):
    rng = random.Random(6)
    rows = [(i, [rng.randint(-(2**21), 2**21) + 0.123 for _ in range(3)], i % 2) for i in range(120)]
    found = result(spark, rows, SCHEMA.replace("float", "double"))
    assert found == _plain_double(rows) and max(r[4] for r in found) > 2**54


def _plain_double(rows):
    saved, np.float32 = np.float32, float
    try:
        return plain(rows)
    finally:
        np.float32 = saved


def test_empty_and_extra_columns(spark):
    assert result(spark, []) == []
    rows = list(vectors(random.Random(8), 201))
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("rid", "q", "block", "payload", "score", "place", "lane", "group", "a", "low", "theta"):
        df = df.withColumn(name, F.lit("extra"))
    assert sorted(tuple(r) for r in hard.hard_negatives(df).collect()) == sorted(plain(rows))


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(1)
    q = np.floor(256 * (rng.normal(size=(4, 1, 8)) + 0.1 * rng.normal(size=(4, 50, 8)))).astype(int)
    q = q.reshape(200, 8)
    norms, theta = hard.angles(q, hard.directions(q))
    low, high = hard.score_bounds(norms, theta, norms, theta)
    scores = hard.exact_scores(q, q)
    assert (low <= scores).all() and (scores <= high).all()
    assert (high - low).mean() < 0.7 * 2 * np.outer(norms, norms).mean()


def test_bounds_of_blocks_hold(spark, monkeypatch):
    monkeypatch.setattr(hard, "BLOCK_ROWS", 20)
    rows = list(vectors(random.Random(9), 300, spread=0.1))
    q = np.array([[math.floor(256 * x) for x in v] for _, v, _ in rows])
    source = hard.prepared(spark.createDataFrame(rows, SCHEMA.replace("float", "double")))
    made = hard.blocks(hard.with_angles(source, hard.directions(q)), 20)
    low, high = hard.extreme_bounds("a", "b")
    pairs = made.alias("a").join(made.alias("b"), F.col("a.block") <= F.col("b.block"))
    seen = 0
    for r in pairs.select("a.payload", F.col("b.payload").alias("other"), low.alias("low"), high.alias("high")).collect():
        sides = [hard.matrix(hard.unpack(r[n]).column("q")) for n in ("payload", "other")]
        scores = hard.exact_scores(*sides)
        assert r["low"] <= scores.min() and scores.max() <= r["high"]
        seen += 1
    assert seen > 100
