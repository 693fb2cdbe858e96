import random
import re

from cases import empty, odd, texts
from pyspark.sql import functions as F

from eventmill.llm import pii


def plain_base(s):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", s):
        out.append((m.start(), 0, m.end(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", s):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", s):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        total = sum(v if i % 2 == 0 else v * 2 - 9 * (v > 4) for i, v in enumerate(d))
        if 12 <= len(d) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", s):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end(), "phone"))
    return [(s, e, k) for s, _, e, k in sorted(out)]


def test_base_spans_equal_the_plain_patterns(spark):
    rng = random.Random(3)
    pieces = [
        "a.b@mail.example.com", "x@y", "x@y.z_d@e.f", "a@b@c.de", "..@a-b.c.d..", "1.2.3.4.5.6.7.8",
        "256.1.1.1", "001.02.3.255", "4111 1111 1111 1111", "4111-1111 11111111", "41111111111111111",
        "12  34", "+1 (310) 555-4510", "+1-2", "+44 20 7946 0958", "+123456789012345678", "\U0001f600é",
        "4222222222222", "5", "0", "-", " ", "\n", "@", "+", ".", "37828224631000", "é@é.é", "٣٤٥",
    ]
    values = [
        rng.choice(["", " ", "-", "."]).join(rng.choices(pieces, k=rng.randint(0, 9)))
        for _ in range(500)
    ]
    df = texts(spark, values).select(
        "doc_id", F.array_sort(F.concat(*[pii.base_spans(F.col("text"), k) for k in pii.KINDS])).alias("s")
    )
    for r in df.collect():
        assert [(s["start"], s["end"], s["kind"]) for s in r["s"]] == plain_base(values[r["doc_id"]])


def test_contexts_discover_unseen_identifiers(spark):
    rng = random.Random(4)
    values = [f"please call me at +1 (310) 555-{4000 + i} tonight" for i in range(30)]
    values += [f"please call me at 310.555.{4000 + i} tonight" for i in range(3)]
    values += [f"version {rng.randint(1000, 9999)}.{i} of the tool" for i in range(20)]
    values += [f"the year {1900 + i} was fine" for i in range(20)]
    rows = {r["doc_id"]: r for r in pii.pii_scan(texts(spark, values)).collect()}
    for i, text in enumerate(values):
        new = [text[s["start"] : s["end"]] for s in rows[i]["spans"] if s["kind"] == "context"]
        assert new == ([f"310.555.{4000 + i - 30}"] if 30 <= i < 33 else []), text


def test_very_long_and_hostile_texts(spark):
    values = ["1 " * 6_000, "a" * 200_000, "a@" * 5_000, "+1" * 4_000, "1." * 6_000,
              "a@b" + ".c" * 6_000, "." * 100_000 + "@"]
    rows = pii.pii_scan(texts(spark, values)).collect()
    for r in rows:
        assert [(s["start"], s["end"], s["kind"]) for s in r["base"]] == plain_base(
            values[r["doc_id"]]
        )


def test_odd_and_empty_tables(spark):
    rows = pii.pii_scan(odd(spark)).collect()
    assert len(rows) == 10 and not any(r["spans"] for r in rows)
    assert pii.pii_scan(empty(spark)).count() == 0


def test_identifiers_with_lower_case_letters_are_instances(spark):
    values = ["account kx73-qd08 please", "ab12cd34", "a1b2c3 only three", "a1b2c3d4", "x@y", "é1é2é3é4"]
    rows = pii.occurrences(texts(spark, values)).collect()
    assert {(r["doc_id"], r["instance"]) for r in rows} == {
        (0, "kx73-qd08"), (1, "ab12cd34"), (3, "a1b2c3d4"), (4, "x@y"), (5, "1é2é3é4"),
    }


def test_texts_of_very_many_matches(spark):
    # The plain patterns take quadratic time here, so the places are counted instead.
    n = 30_000
    values = ["x@y.z " * n, "1.2.3.4 " * n, "1 " * n]
    kinds, lengths = ("email", "ip"), (5, 7)
    for r in pii.pii_scan(texts(spark, values)).collect():
        i = r["doc_id"]
        step = lengths[i] + 1 if i < 2 else 0
        want = [(at * step, at * step + lengths[i], kinds[i]) for at in range(n)] if i < 2 else []
        assert [(s["start"], s["end"], s["kind"]) for s in r["base"]] == want
