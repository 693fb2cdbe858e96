import hashlib
import random

from cases import ODD_ROWS, empty, odd, texts

from eventmill.llm import spot_signatures as sp

WORDS = "the a of is und les el river stone green walks light music under tree cloud house".split()


def _values(seed=1, n=70):
    rng = random.Random(seed)
    out = [" ".join(rng.choices(WORDS, k=rng.randint(0, 60))) for _ in range(n)]
    for i in range(0, n, 5):  # near copies
        words = out[i].split()
        if words:
            words[rng.randrange(len(words))] = "changed"
        out.append(" ".join(words))
    return [*out, out[3], "", "", "\U0001f600 x"]


def check(rows, docs):
    """``docs`` in their order."""
    got = sorted(
        (
            (
                -1 if r["doc_id"] is None else r["doc_id"], r["n_chars"], r["edited_sha256"],
                r["fingerprint"], r["edited_fingerprint"], r["near_edited"], r["near_next"],
            )
            for r in rows
        )
    )
    want = []
    for k, (doc_id, text) in enumerate(docs):
        text, following = text or "", docs[(k + 1) % len(docs)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        a, b, c = sp.signatures(text), sp.signatures(edited), sp.signatures(following)
        want.append(
            (
                -1 if doc_id is None else doc_id, len(text),
                hashlib.sha256(edited.encode()).hexdigest(), sp.fingerprint(a), sp.fingerprint(b),
                sp.likeness(a, b), sp.likeness(a, c),
            )
        )
    assert got == sorted(want)


def test_signatures():
    one = sp.signatures("The river of stone walks under the green tree")
    assert len(one) == 3  # the river stone, of stone walks, the green tree
    assert sp.signatures("THE RIVER, of stone? walks under the green tree") == one
    assert sp.signatures("river") and sp.signatures("river") == sp.signatures("River!")
    assert sp.signatures("...") != sp.signatures("!!!")
    assert sp.signatures("") == sp.signatures(None) == frozenset()
    assert sp.likeness(frozenset(), frozenset()) == 1.0 and sp.likeness(frozenset(), one) == 0.0


def test_neighbours_equal_a_plain_loop(spark):
    values = _values()
    order = list(range(len(values)))
    random.Random(2).shuffle(order)
    df = texts(spark, values).orderBy("text").repartition(5)
    check(sp.compare_neighbours(df).collect(), list(enumerate(values)))


def test_pairs_equal_all_pairs(spark):
    values = _values(4)
    prints = {i: sp.signatures(t) for i, t in enumerate(values)}
    first = {}
    for i, s in prints.items():
        first.setdefault(s, i)
    reps = [i for s, i in first.items() if s]
    for threshold in (0.5, 0.75, 0.9):
        want = {
            (min(i, j), max(i, j)): sp.likeness(prints[i], prints[j])
            for i in reps
            for j in reps
            if i != j and sp.likeness(prints[i], prints[j]) >= threshold
        }
        got = {
            tuple(sorted((r["left_id"], r["right_id"]))): r["likeness"]
            for r in sp.near_pairs(sp.fingerprints(texts(spark, values)), threshold).collect()
        }
        assert got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_buckets_are_cut_at_bounds(spark):
    bounds = [b * 10 for b in range(1, 1500)]
    rows = spark.range(0, 15100, 7).select("id", sp._bucket(sp.F.col("id"), bounds).alias("b"))
    assert all(r["b"] == min(r["id"] // 10, 1499) for r in rows.collect())


def test_odd_and_empty_tables(spark):
    docs = sorted(
        ((r[0], r[1]) for r in ODD_ROWS), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")
    )
    check(sp.compare_neighbours(odd(spark)).collect(), docs)
    assert sp.compare_neighbours(empty(spark)).count() == 0
    assert sp.near_pairs(sp.fingerprints(empty(spark))).count() == 0
    one = sp.compare_neighbours(texts(spark, ["the only one is here"])).collect()
    check(one, [(0, "the only one is here")])
