import random

from cases import ODD_ROWS, empty, odd, texts
from pyspark.sql import functions as F

from eventmill.llm import line_dedup as ld

LINE = "This line is long enough to count"


def plain(rows, least=3):
    def key(line):
        k = line.strip(" \t\n\x0b\x0c\r")
        return "".join(c.lower() if c.isascii() else c for c in k)

    held = {}
    for row, (doc, text) in enumerate(rows):
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= 20:
                held.setdefault(k, []).append(-1 if doc is None else doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        own = -1 if doc is None else doc
        kept = [
            x
            for x in lines
            if len(key(x)) < 20 or len(held[key(x)]) < least or max(held[key(x)]) == own
        ]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def run(df, **options):
    rows = ld.line_dedup(df, **options).collect()
    return sorted(
        ((r["row"]["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in rows),
        key=repr,
    )


VALUES = [
    f"{LINE}\nown line of document {i} here\n  {LINE.upper()}\t" if i % 2 else f"{LINE}\nx\n"
    for i in range(9)
] + ["ÉTÉ À LA PLAGE ET AILLEURS\nétÉ à la plage et ailleurs", "only " + LINE, "only " + LINE]


def test_lines_in_three_documents_stay_in_the_last(spark):
    df = texts(spark, VALUES)
    want = plain(list(enumerate(VALUES)))
    for batches in (1, 2, 5):
        assert run(df, batches=batches) == want


def test_runs_are_compacted(spark, tmp_path):
    runs = ld.LineRuns(spark, str(tmp_path), fanout=2)
    for part in range(5):
        runs.add(texts(spark, VALUES[part * 2 : part * 2 + 2], first=part * 2))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    frequent = runs.frequent(3).collect()
    assert [r["last_doc"] for r in frequent] == [8]


def test_odd_and_empty_tables(spark):
    assert run(odd(spark)) == plain([(r[0], r[1]) for r in ODD_ROWS])
    assert run(empty(spark)) == []


def test_stage_keeps_columns(spark):
    df = odd(spark)
    out = ld.dedup_stage(spark, df, "")
    assert out.columns == df.columns and out.count() == len(ODD_ROWS)
    changed = {r["doc_id"]: r for r in ld.dedup_stage(spark, texts(spark, VALUES), "").collect()}
    assert changed[0]["text"] == "x\n" and changed[0]["n_chars"] == 2
    assert changed[8]["text"] == VALUES[8]


def test_without_places(spark):
    rng = random.Random(5)
    rows = []
    for n in (0, 1, 2, 7, 30):
        values = [str(i) for i in range(n)]
        for share in (0.0, 0.3, 1.0):
            gone = [i for i in range(n) if rng.random() < share]
            rng.shuffle(gone)
            rows += [(values, gone), (values, None)]
    df = spark.createDataFrame(rows, "v array<string>, g array<int>")
    out = df.select("v", "g", ld.without(F.col("v"), F.col("g")).alias("kept")).collect()
    for r in out:
        assert r["kept"] == [x for i, x in enumerate(r["v"]) if i not in (r["g"] or [])]


def test_texts_of_very_many_lines(spark):
    n = 200_000
    common = "\n".join(f"line number {i} that several hold" for i in range(n))
    df = texts(spark, [common, f"x\n{common}", f"{common}\ny", "z"])
    rows = {r[0]: r for r in run(df)}
    assert [rows[i][1:3] for i in range(4)] == [(n, n), (n + 1, n), (n + 1, 0), (1, 0)]
    assert [rows[i][3] for i in (0, 1, 3)] == ["", "x", "z"] and rows[2][3] == f"{common}\ny"
