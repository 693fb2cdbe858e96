"""Conversation repair against a plain version that compares whole audits."""

import functools
import hashlib
import random
import sys
import zlib

import pytest
from pyspark.sql import functions as F

from eventmill.llm import conversation_repair as repair

SCHEMA = "conv_id long, turn long, role string, text string"
sys.setrecursionlimit(20_000)
SPACE = " \t\n\v\f\r"
COLUMNS = (
    "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
    "repaired_sha256",
)


def plain_damage(rows):
    """Rows after the damage, per conversation in order."""
    out = {}
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = role if role is not None else " ", text if text is not None else " "
        hit = zlib.crc32(key.encode()) % 20
        text = "" if hit == 1 else text
        text = "".join(c for c in text if c not in ".!?") if hit == 2 else text
        role = "user" if hit == 4 else role
        out.setdefault(conv, []).extend([(turn, role, text)] * {0: 0, 3: 2}.get(hit, 1))
    for conv in out:
        out[conv].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return out


def plain_edits(rows):
    """(cost, audit) by trying everything: the least pair of cost and audit."""

    @functools.cache
    def best(i, emitted, inserts):
        s, rest = emitted
        ways = []
        if i == len(rows) and (emitted == (0, "") or rest == "a"):
            ways.append((0, ""))
        if inserts < 3:
            turn = "a" if rest == "u" else "u"
            cost, audit = best(i, (s, turn), inserts + 1)
            ways.append((2 + cost, "I" + audit))
        if i < len(rows):
            initial, fault = rows[i]
            cost, audit = best(i + 1, emitted, 0)
            ways.append((3 + cost, "D" + audit))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                wanted = "a" if rest == "u" else "u"
                if initial == wanted:
                    cost, audit = best(i + 1, (s, wanted), 0)
                    ways.append((more + cost, "K" + audit))
                if initial == "s" and emitted == (0, ""):
                    cost, audit = best(i + 1, (1, ""), 0)
                    ways.append((more + cost, "K" + audit))
                cost, audit = best(i + 1, (s, wanted), 0)
                ways.append((more + 2 + cost, "R" + audit))
        return min(ways, default=(10**9, ""))

    return best(0, (0, ""), 0)


def plain_repair(rows):
    damaged, out = plain_damage(rows), {}
    for conv in {r[0] for r in rows}:
        kept, seen, kinds = damaged.get(conv, []), set(), []
        for _, role, text in kept:
            shown = text.rstrip(SPACE)
            if not shown:
                kinds.append("blank")
            elif (role, text) in seen:
                kinds.append("duplicate")
            else:
                kinds.append("" if shown[-1] in ".!?" else "truncated")
            seen.add((role, text))
        initials = [role[:1] for _, role, _ in kept]
        cost, audit = plain_edits(tuple(zip(initials, kinds, strict=True)))
        turns = [t for t, *_ in kept if t is not None]
        lines, i, wanted = [], 0, "user"
        for edit in audit:
            role, text = kept[i][1:] if edit != "I" else ("", "")
            i += edit != "I"
            if edit == "D":
                continue
            if edit == "K" and role[:1] == "s":
                lines.append(f"{role}:{text}")
                continue
            lines.append(f"{role if edit == 'K' else wanted}:{text}")
            wanted = "assistant" if wanted == "user" else "user"
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            kinds.count("blank"),
            kinds.count("duplicate"),
            kinds.count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost,
            audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def result(spark, rows, **options):
    df = repair.repair(spark.createDataFrame(rows, SCHEMA), **options)
    assert tuple(df.columns) == COLUMNS
    found = df.collect()
    assert len({r["conv_id"] for r in found}) == len(found)
    return {r["conv_id"]: tuple(r)[1:] for r in found}


def conversation(rng, conv, turns):
    roles = ("system", "user", "assistant", "user", "assistant", "tool", "", None)
    texts = ("A word.", "No end", "  ", "", None, "Why? ", "Yes!\n", "é 日本", "a.b")
    turn = 0
    for _ in range(turns):
        turn += rng.choice((0, 1, 1, 1, 1, 2))
        own = f" {turn}" * rng.randint(0, 1)
        text = rng.choice(texts)
        yield (
            conv,
            None if rng.random() < 0.05 else turn,
            rng.choice(roles),
            text if text is None else own + text,
        )


@pytest.mark.parametrize("chunk_rows", [1, 4, 4096])
def test_equals_the_plain_version(spark, chunk_rows):
    rng = random.Random(3)
    rows = [r for conv in range(120) for r in conversation(rng, conv, rng.randint(0, 9))]
    rows += [(None, t, "user", f"Null {t}.") for t in range(6)]
    rng.shuffle(rows)
    assert result(spark, rows, chunk_rows=chunk_rows) == plain_repair(rows)


@pytest.mark.parametrize("role", ["tool", "user", "mixed"])
def test_one_long_conversation_in_many_chunks(spark, role):
    """Rows of other roles keep two parities apart, so chunks of them do not converge."""
    rng = random.Random(role)
    roles = ["system", "user", "assistant"] if role == "mixed" else [role]
    rows = [(1, t, rng.choice(roles), f"Text {t}" + rng.choice(".,")) for t in range(150)]
    rows += [(2, t, ["user", "assistant"][t % 2], f"Other {t}.") for t in range(40)]
    assert result(spark, rows, chunk_rows=8) == plain_repair(rows)


def test_copies_in_a_third_of_all_rows(spark):
    rows = [(7, t, "user", "The same again.") for t in range(150)]
    rows += [(c, t, ["user", "assistant"][t % 2], f"{c} {t}.") for c in range(20, 60) for t in range(10)]
    assert result(spark, rows, chunk_rows=16) == plain_repair(rows)


def test_odd_rows_and_extra_columns(spark):
    long_text = "word and the thing of note. " * 20_000
    rows = [(1, None, None, None), (1, 0, "user", long_text), (1, 1, "assistant", " " * 100_000),
            (2, 5, "user", None), (2, 5, "user", "x."), (2, 5, "user", "x."), (3, -4, "s", "\n\n"),
            (None, None, None, None), (9, 2**40, "assistant", "Last.")]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("pos", "chunk", "part", "fault", "edits", "h1", "c", "n", "copy", "hit", "map", "out"):
        df = df.withColumn(name, F.lit("extra"))
    found = {r["conv_id"]: tuple(r)[1:] for r in repair.repair(df).collect()}
    assert found == plain_repair(rows)


def test_no_rows_after_the_damage(spark):
    conv = next(c for c in range(100) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    nothing = hashlib.sha256(b"").hexdigest()
    assert result(spark, [(conv, 0, "user", "Gone.")]) == {conv: (0, 0, 0, 0, 0, 0, "", nothing)}
    assert repair.repair(spark.createDataFrame([], SCHEMA)).collect() == []


def test_vectors_are_few_and_end_first():
    step, trace = repair._tables()
    assert len(step[0]) < 64 and len(step) == len(trace) == len(repair.KINDS)


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert result(spark, rows) == plain_repair(rows)
