"""Language identification: the fit against a plain version, held-out accuracy, odd rows."""

import math
import random
import zlib

import cases
import numpy as np
from pyspark.sql import functions as F

from eventmill.llm import language_id as lang

WORDS = {
    "en": "the of and is that was with this from which are have not by".split(),
    "de": "der die und ist nicht das ein mit auf für eine auch wird über".split(),
    "fr": "le la et les des est que dans pour une qui été être à".split(),
}


def sentence(rng, language, n=12):
    return " ".join(rng.choice(WORDS[language]) for _ in range(n)) + "."


def corpus(rng, n):
    return [
        (i, sentence(rng, name), name, "s", 0)
        for i in range(n)
        for name in [rng.choice(sorted(WORDS))]
    ]


def plain_ftrl(rows, idf, classes, epochs, alpha, beta, l1, l2):
    """The same fit, a number at a time."""
    z, n = {}, {}

    def weight(key, own_l1):
        zi, ni = z.get(key, 0.0), n.get(key, 0.0)
        if abs(zi) <= own_l1:
            return 0.0
        return -(zi - math.copysign(own_l1, zi)) / ((beta + math.sqrt(ni)) / alpha + l2)

    for _ in range(epochs):
        for held, counts, label in rows:
            x = {int(f): float(c) * idf[f] for f, c in zip(held, counts)}
            size = math.sqrt(sum(v * v for v in x.values()))
            x = {f: v / size for f, v in x.items()} | {"bias": 1.0}
            w = {(f, c): weight((f, c), 0 if f == "bias" else l1) for f in x for c in range(classes)}
            logits = [sum(v * w[f, c] for f, v in x.items()) for c in range(classes)]
            top = max(logits)
            total = sum(math.exp(v - top) for v in logits)
            for c in range(classes):
                wrong = math.exp(logits[c] - top) / total - (c == label)
                for f, v in x.items():
                    g, old = wrong * v, n.get((f, c), 0.0)
                    step = (math.sqrt(old + g * g) - math.sqrt(old)) / alpha
                    z[f, c] = z.get((f, c), 0.0) + g - step * w[f, c]
                    n[f, c] = old + g * g
    return lambda f, c: weight((f, c), 0 if f == "bias" else l1)


def test_fit_equals_the_plain_one():
    rng = random.Random(1)
    idf = np.array([1 + rng.random() for _ in range(64)])
    rows = []
    for _ in range(40):
        held = np.array(sorted(rng.sample(range(64), rng.randint(1, 12))))
        rows.append((held, np.array([rng.randint(1, 5) for _ in held]), rng.randrange(3)))
    rates = (0.3, 1.0, 0.1, 0.05)
    weights, bias = lang.fit_ftrl(rows, idf, 3, 3, rates)
    plain = plain_ftrl(rows, idf, 3, 3, *rates)
    expected = np.array([[plain(f, c) for c in range(3)] for f in range(64)])
    np.testing.assert_allclose(weights, expected, atol=1e-9)
    np.testing.assert_allclose(bias, [plain("bias", c) for c in range(3)], atol=1e-9)
    assert (weights == 0).mean() > 0.05 and (weights != 0).any()


def test_ngrams_are_those_of_the_text():
    clean = lang.letters("Ab, c!")
    assert clean == " ab c "
    grams = [clean[i : i + k] for k in (1, 2, 3) for i in range(len(clean) - k + 1)]
    assert len(lang.ngrams(clean)) == len(grams)
    held, counts = lang.features(clean)
    assert counts.sum() == len(grams) and len(held) == len(set(grams))
    assert lang.letters("12 ... _ ½") == "" == lang.letters(None)


def test_temperature_is_the_best_of_a_grid():
    rng = np.random.default_rng(2)
    labels = rng.integers(0, 3, 400)
    logits = rng.normal(size=(400, 3)) + 1.2 * np.eye(3)[labels]
    logits *= 4
    best = lang.best_temperature(logits, labels)

    def loss(t):
        scaled = logits / t
        return (np.log(np.exp(scaled).sum(1)) - scaled[np.arange(400), labels]).mean()

    assert loss(best) <= min(loss(t) for t in np.geomspace(0.05, 19, 200)) + 1e-6


def test_document_counts_are_of_all_rows(spark):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(["ab", "ab", "b c", "", "12", "ab " * 5000])]
    docs = cases.frame(spark, rows).repartition(3)
    idf = lang.inverse_frequencies(docs)
    for gram, n in ((" ab", 3), ("b", 4), ("c", 1), ("zzz", 0)):
        alone = lang.ngrams(gram)[-1] if len(gram) == 3 else lang.ngrams(gram)[0]
        assert idf[alone] == math.log(7 / (1 + n)) + 1


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = lang.language_id(docs).join(docs, "doc_id").where("held_out AND lang IS NOT NULL")
    right = out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97


def test_learns_only_from_rows_not_held_out(spark):
    rows = corpus(random.Random(3), 300)
    held = {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    changed = [(i, t, "xx" if i in held else name, s, n) for i, t, name, s, n in rows]
    found = [
        {r["doc_id"]: tuple(r) for r in lang.language_id(cases.frame(spark, some)).collect()}
        for some in (rows, changed)
    ]
    assert found[0] == found[1]
    assert {i for i, r in found[0].items() if r[1]} == held
    right = sum(found[0][i][2] == name for i, _, name, *_ in rows if i in held)
    assert right > 0.95 * len(held)


def test_order_and_copies_of_rows_do_not_change_the_sample(spark):
    rows = corpus(random.Random(4), 200)
    shuffled = rows + [rows[3]] * 70
    random.Random(5).shuffle(shuffled)
    samples = [
        lang.fitting_sample(cases.frame(spark, some).repartition(k), 60)
        for some, k in ((rows, 2), (shuffled, 7))
    ]
    assert samples[0].equals(samples[1]) and samples[0].num_rows == 60


def test_odd_rows(spark):
    df = cases.odd(spark)
    found = lang.language_id(df).collect()
    assert len(found) == len(cases.ODD_ROWS)
    by_id = {r["doc_id"]: r for r in found}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (1, 2, 5))
    assert by_id[9]["lang_pred"] in ("en", "fr", "es") and 0 < by_id[9]["score"] <= 1
    assert by_id[6][2:] == by_id[7][2:] and by_id[None]["held_out"] is False
    assert lang.language_id(cases.empty(spark)).collect() == []


def test_nothing_to_learn_from(spark):
    rows = [(1, "some text", None, "s", 9), (2, None, "en", "s", 0)]
    found = lang.language_id(cases.frame(spark, rows)).collect()
    assert {tuple(r)[2:] for r in found} == {("und", 0.0)}
