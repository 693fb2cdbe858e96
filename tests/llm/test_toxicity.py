import random
import zlib

import numpy as np
from cases import empty, frame, odd, texts
from pyspark.sql import functions as F

from eventmill.llm import toxicity as tx

SCHEMA = "doc_id long, quality int, toxic int"


def kinds(text, stems=()):
    matcher = tx.Matcher(stems)
    return {k for k, n in zip(matcher.kinds, matcher.counts(text), strict=True) if n}


def test_grammar_reads_clauses():
    assert kinds("You are an idiot.") == {"aimed_insult"}
    assert kinds("What an idiot") == {"insult"}
    assert kinds("He is not an idiot") == {"negated_insult"}
    assert kinds("She said you are an idiot") == {"reported_insult"}
    assert kinds("She said you are not an idiot") == {"reported_negated_insult"}
    assert kinds("I will kill you!") == {"aimed_threat"}
    assert kinds("I will not hurt you") == {"negated_threat"}
    assert kinds("They kill time. You wait") == set()
    assert kinds("She said so. An idiot!") == {"insult"}
    assert kinds("idiotic nonidiot") == set()
    assert kinds("you ZORGblat", ("zorg",)) == {"aimed_insult"}
    assert kinds("") == kinds(None) == set()


def test_composition_equals_running_in_turn():
    rng = random.Random(1)
    inputs = ["word", "insult", "harm", "target", "negation", "report"]
    chain = [tx.threats(), tx.negation(), tx.reported_speech(), tx.aim()]
    machine = tx.grammar()
    for _ in range(300):
        state, states = machine.start, [t.start for t in chain]
        for _ in range(10):
            symbol = rng.choice(inputs)
            state, got, weight = machine.step(state, symbol)
            for i, t in enumerate(chain):
                states[i], symbol, _ = t.step(states[i], symbol)
            assert got == symbol and weight == tx.KINDS.get(got, 0.0)


def test_weights_order_the_kinds():
    model = tx.Model([], np.array(list(tx.KINDS.values())), tx.BIAS)
    matcher = tx.Matcher()

    def score(text):
        return model.score(matcher.counts(text)[None, :])[0]

    assert score("you are an idiot") >= tx.REJECT > score("you are not an idiot")
    assert score("a clean text") < score("he said you are an idiot") < score("you are an idiot")


def _corpus(spark, rng, n=400):
    plain = ["river", "stone", "the", "and", "green", "walks", "under", "light", "music"]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        words = rng.choices(plain, k=rng.randint(8, 40))
        if toxic:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), "blurg" + rng.choice(["en", "ach", "it"]))
        rows.append(" ".join(words))
        labels.append((i, 1, int(toxic)))
    return texts(spark, rows), spark.createDataFrame(labels, SCHEMA)


def test_held_out_accuracy_with_learned_stems(spark):
    docs, labels = _corpus(spark, random.Random(2))
    model = tx.train(docs, labels)
    assert any("blurg".startswith(s) or s.startswith("blurg") for s in model.learned)
    scored = (
        docs.select("doc_id", tx.toxicity_score(model, F.col("text")).alias("score"),
                    tx.held_out("doc_id").alias("held_out"))
        .join(labels, "doc_id").collect()
    )
    for r in scored:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    held = [r for r in scored if r["held_out"]]
    assert len(held) > 60
    right = sum((r["score"] >= tx.REJECT) == bool(r["toxic"]) for r in held)
    assert right >= 0.97 * len(held)


def test_held_out_labels_are_never_used(spark):
    docs, labels = _corpus(spark, random.Random(3), 120)
    flipped = labels.withColumn(
        "toxic", F.when(tx.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    a, b = tx.train(docs, labels), tx.train(docs, flipped)
    assert a.learned == b.learned and np.array_equal(a.weights, b.weights) and a.bias == b.bias


def test_sample_is_bounded(spark):
    docs, labels = _corpus(spark, random.Random(4), 80)
    assert tx.labelled_sample(docs, labels, 10).count() == 10


def test_near_copies_teach_no_stems(spark):
    clean = [f"plain text number {i} of the lot" for i in range(40)]
    copies = ["wherein zzzfoo barqux stands and quuxly wobbles"] * 30
    labels = [(i, 1, 0) for i in range(40)] + [(40 + i, 1, 1) for i in range(30)]
    model = tx.train(texts(spark, clean + copies), spark.createDataFrame(labels, SCHEMA))
    assert model.learned == []


def test_odd_and_empty_tables(spark):
    labels = spark.createDataFrame(
        [(1, 1, 1), (1, None, 0), (None, 1, 1), (4, 1, None), (6, 0, 7), (8, 1, 0)], SCHEMA
    )
    df = odd(spark)
    model = tx.train(df, labels)
    rows = df.select(tx.toxicity_score(model, F.col("text")).alias("s")).collect()
    assert len(rows) == 10 and all(0 <= r["s"] <= 1 for r in rows)
    none = tx.train(empty(spark), labels.where("false"))
    assert none.bias == tx.BIAS and none.learned == []
    assert empty(spark).select(tx.toxicity_score(none, F.col("text"))).count() == 0


def test_stage_keeps_clean_rows_and_columns(spark, tmp_path):
    docs, labels = _corpus(spark, random.Random(5))
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    kept = tx.toxicity_stage(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert {i for i in range(400) if i % 4} <= ids and len(ids) <= 305


def test_fit_does_not_depend_on_the_order_of_rows(spark):
    """One doc_id with several texts: the same one is learned from, wherever it stands."""
    rows = [(i, t, "en", "s", 0) for i in range(60) for t in (f"you are an idiot {i}", f"a calm walk {i}")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    models = [
        tx.train(frame(spark, some).repartition(parts), labels)
        for some, parts in ((rows, 3), (rows[::-1], 5))
    ]
    assert models[0].learned == models[1].learned
    assert models[0].bias == models[1].bias
    assert (models[0].weights == models[1].weights).all()
