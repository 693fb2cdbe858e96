import random
import re

from cases import empty, odd, texts

from eventmill.llm import license_scan as ls


def python_matches(text, templates, threshold):
    out = {}
    for line in (text or "").split("\n"):
        held = set(re.findall(ls.WORD, line.lower()))
        for _, label, own in ls.template_sets(templates):
            share = len(held & set(own)) / len(own)
            if len(held & set(own)) >= ls.needed(len(own), threshold):
                out[label] = max(out.get(label, 0), share)
    return out


def test_join_equals_all_pairs(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(14)]
    templates = [(" ".join(rng.sample(words, rng.randint(1, 9))), f"t{i}") for i in range(12)]
    docs = [
        "\n".join(" ".join(rng.choices(words, k=rng.randint(0, 14))) for _ in range(3))
        for _ in range(60)
    ]
    for threshold in (0.5, 0.8, 1.0):
        rows = ls.license_matches(texts(spark, docs), templates, threshold).collect()
        got = {}
        for r in rows:
            key = (r["doc_id"], r["label"])
            got[key] = max(got.get(key, 0), r["containment"])
        want = {
            (i, label): share
            for i, text in enumerate(docs)
            for label, share in python_matches(text, templates, threshold).items()
        }
        assert got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_phrases_and_labels(spark):
    rows = ls.license_scan(
        texts(
            spark,
            [
                "The MIT License and the Apache license.\nmit\nlicense",
                "GNU General Public LICENSE, Mit-license",
                "Licensed under: CC, BY-NC (4.0)",
                "nothing here",
            ],
        )
    ).collect()
    by_id = {r["doc_id"]: r for r in rows}
    assert (by_id[0]["n_base"], by_id[0]["first_word"], by_id[0]["last_word"]) == (3, 1, 7)
    assert by_id[0]["base_labels"] == "apache,mit"
    assert by_id[1]["base_labels"] == "gpl,mit"
    assert (by_id[2]["labels"], by_id[2]["n_base"], by_id[2]["first_word"]) == ("cc-by,cc-by-nc", 0, None)
    assert 0.8 <= by_id[2]["score"] <= 1
    assert (by_id[3]["labels"], by_id[3]["score"]) == ("", 0.0)


def test_odd_and_empty_tables(spark):
    rows = ls.license_scan(odd(spark)).collect()
    assert len(rows) == 10
    assert [r["n_words"] for r in rows if r["doc_id"] in (1, 2)] == [0, 0]
    assert ls.license_scan(empty(spark)).count() == 0
