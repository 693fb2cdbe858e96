import random

import numpy as np
from cases import ODD_ROWS, empty, frame, odd, texts
from plain import linked, shingle_set

from eventmill.llm import ngram_join as nj


def pairs_at(rng, n, differ):
    """Two random sets of about n hashes that differ in ``differ`` of them."""
    base = np.unique(np.array([rng.getrandbits(64) for _ in range(n)], "uint64"))
    cut = rng.randint(0, min(differ, len(base) - 1))
    new = np.array([rng.getrandbits(64) for _ in range(differ - cut)], "uint64")
    return base, np.unique(np.concatenate([base[cut:], new]))


def jaccard_ok(a, b):
    return nj.qualifies(len(np.intersect1d(a, b)), len(a), len(b))


def test_qualifying_sets_share_a_key():
    rng = random.Random(1)
    seen = 0
    for trial in range(1500):
        n = rng.choice([1, 2, 3, 4, 5, 6, 7, 8, 9, 12, 16, 17, 30, 31, 33, 64, 100, 127, 130, 300])
        a, b = pairs_at(rng, n, rng.randint(1, max(1, n // 3)))
        if not jaccard_ok(a, b):
            continue
        seen += 1
        # Frequent keys: none, some, or nearly all of a.
        share = rng.choice([0, 0, 0.2, 0.9, 1.0])
        chosen = [x for x in nj.part_keys(a) if rng.random() < share]
        frequent = nj.Frequent(np.array(chosen, "uint64"))
        own, other = nj.part_keys(a, frequent), nj.part_keys(b, frequent)
        if not np.array_equal(a, b):
            assert len(np.intersect1d(own, other)), (n, trial)
    assert seen > 400


def test_partners_are_in_the_same_or_the_next_band():
    for band in range(40):
        assert nj._largest_partner(nj.EDGES[band + 1] - 1) < nj.EDGES[band + 2]


def test_sketches_bound_the_difference(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(120):
        a, b = pairs_at(rng, rng.randint(1, 2500), rng.randint(0, 300))
        if min(len(a), len(b)) * 2 > max(len(a), len(b)):
            rows.append((nj.sketch(a).tolist(), nj.sketch(b).tolist(), len(np.setxor1d(a, b))))
    df = spark.createDataFrame(rows, "a array<long>, b array<long>, differ int")
    got = df.select("differ", nj._distance(df["a"], df["b"]).alias("d"), df["a"], df["b"]).collect()
    assert any(len(r["a"]) != len(r["b"]) for r in got)
    assert all(r["d"] <= r["differ"] and r["d"] % 2 == r["differ"] % 2 for r in got)


def test_shingles_equal_the_plain_ones():
    rng = random.Random(3)
    seen = {}
    for _ in range(400):
        text = rng.choice(["", " ", "\n\t "]) + rng.choice([" ", "\x0b", "\r\n"]).join(
            rng.choices(["a", "A", "bb", "É", "é", "\U0001f600", "c\x00", "c", "\xa0"], k=rng.randint(0, 9))
        )
        found = nj.shingles(text)
        want = shingle_set(text)
        assert len(found) == len(want)
        key = nj.set_numbers(found) if len(found) else None
        assert seen.setdefault(want, key) == key
    assert len(set(seen.values())) == len(seen)


def _corpus(seed=5):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    values = []
    for _ in range(60):
        base = rng.choices(words, k=rng.randint(1, 120))
        values.append(" ".join(base))
        for _ in range(rng.randint(0, 3)):  # near copies, some beyond the threshold
            near = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 15))):
                near[rng.randrange(len(near))] = rng.choice(words)
            values.append(" ".join(near + rng.choices(words, k=rng.randint(0, 4))))
    passage = " ".join(rng.choices(words, k=60))  # shared by many that are not linked
    values += [passage + " " + " ".join(rng.choices(words, k=60)) for _ in range(40)]
    hot = rng.choices(words, k=90)  # one large group of near copies, in a chain
    for i in range(80):
        hot = list(hot)
        hot[(i * 7) % 90] = f"x{i}"
        values.append(" ".join(hot))
    values += ["copy of one text that many hold " * 3] * 30
    rng.shuffle(values)
    return values


def run(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in nj.linked_documents(df).collect()}


def test_components_equal_all_pairs(spark):
    values = _corpus()
    want = linked(list(enumerate(values)))
    got = run(texts(spark, values))
    assert {i: c for i, (_, c) in got.items()} == want
    assert all(n == len(shingle_set(values[i])) for i, (n, _) in got.items())


def test_frequent_keys_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(nj, "FREQUENT", 1)
    values = _corpus(6)
    assert {i: c for i, (_, c) in run(texts(spark, values)).items()} == linked(
        list(enumerate(values))
    )


def test_odd_and_empty_tables(spark):
    rows = nj.linked_documents(odd(spark)).collect()
    assert len(rows) == len(ODD_ROWS)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert got[1] == (0, 1) and got[2] == (0, 2) and got[5] == (0, 5)
    assert got[6] == (1, 6) and got[7] == (1, 6) and got[8][1] == 8
    assert got[None][0] > 0 and got[None][1] is None
    assert nj.linked_documents(empty(spark)).count() == 0


def test_stage_keeps_one_of_each_group(spark):
    values = _corpus(7)
    want = linked(list(enumerate(values)))
    kept = nj.ngram_join_stage(spark, texts(spark, values), "")
    assert {r["doc_id"] for r in kept.collect()} == set(want.values())
    df = odd(spark)
    out = nj.ngram_join_stage(spark, df, "")
    assert out.columns == df.columns
    ids = sorted(r["doc_id"] or -1 for r in out.select("doc_id").collect())
    assert ids == [-1, 1, 2, 4, 5, 6, 8, 9]


def test_stage_keeps_rows_that_only_share_a_number(spark):
    def text(name):
        return " ".join(f"{name}{i}" for i in range(30))

    rows = [
        (None, text("a")), (None, text("b")), (None, text("a")),
        (10, text("c")), (10, text("d")),  # two texts under one number
        (11, text("d")),
        (3, text("e")), (12, text("e")), (12, text("f")),  # one of number 12 is linked away
        (13, text("g")), (13, text("g")),
        (14, text("h")), (14, text("h").upper()),
        (15, ""), (15, None), (15, ""),
        (None, text("e")),
    ]
    df = frame(spark, [(i, t, "en", "src0", 0) for i, t in rows])
    out = nj.ngram_join_stage(spark, df, "")
    got = [(r["doc_id"], r["text"]) for r in out.collect()]
    gone = [(11, text("d")), (12, text("e")), (13, text("g"))]
    either = [x for x in got if x[0] == 14]
    assert len(either) == 1
    want = [x for x in rows if x[0] != 14]
    for x in gone:
        want.remove(x)
    key = lambda x: (x[0] is None, x[0] or 0, x[1] or "")
    assert sorted((x for x in got if x[0] != 14), key=key) == sorted(want, key=key)


def test_large_key_groups_are_dealt_into_bounded_chunks(spark, monkeypatch):
    monkeypatch.setattr(nj, "HUB_ROWS", 16)
    rng = random.Random(8)
    base = [np.array([rng.getrandbits(64) for _ in range(100)], "uint64") for _ in range(6)]
    sets = [np.concatenate([rng.choice(base)[:97], base[0][: i % 3]]) for i in range(200)]
    sets = [np.unique(np.append(s, U)) for s, U in zip(sets, map(np.uint64, range(200)), strict=True)]
    classes = spark.createDataFrame(
        [(i, len(s), nj.sketch(s).tolist()) for i, s in enumerate(sets)],
        "c1 long, n long, sketch array<long>",
    )
    part = [0 if i < 120 else rng.randint(1, 9) for i in range(200)]
    small = set(rng.sample(range(200), 9)) | {0}
    open_ = spark.createDataFrame(
        [(7, 0, i, part[i]) for i in range(200)] + [(8, 0, i, part[i]) for i in small],
        "key_group long, hub long, c1 long, part long",
    )
    rows = nj.open_rows(open_, classes).collect()
    chunks = {}
    for r in rows:
        if not r["turn"]:
            chunks.setdefault((r["key_group"], r["chunk"]), set()).add(r["c1"])
    assert len(chunks) > 10 and max(map(len, chunks.values())) <= 40
    assert {c for (g, _), m in chunks.items() if g == 7 for c in m} == set(range(200))
    assert not any(r["main"] for r in rows if r["turn"])

    def may(a, b):
        d = sum(
            (int(x) ^ int(y)).bit_count()
            for x, y in zip(
                nj.sketch(sets[a]).view("uint64"), nj.sketch(sets[b]).view("uint64"), strict=True
            )
        )
        n, m = len(sets[a]), len(sets[b])
        return part[a] != part[b] and 4 * min(n, m) >= 3 * max(n, m) and d * 7 <= n + m

    want = {(a, b) for a in range(200) for b in range(a + 1, 200) if may(a, b)}
    rows = nj.open_pairs(open_, classes, 200).collect()
    got = [(r["a"], r["b"]) for r in rows]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 100
    assert not any(r["more"] for r in rows)

    first = nj.open_pairs(open_, classes, 1).collect()
    few = {(r["a"], r["b"]) for r in first}
    assert few < want and any(r["more"] for r in first)
    asked = {x for x in range(200) if part[x] and any(x in p for p in want)}
    assert asked <= {x for p in few for x in p}
    assert len(few) <= len(nj.open_rows(open_, classes).collect())


def test_pairs_of_a_group_of_near_copies_are_as_many_as_its_members(spark, monkeypatch):
    monkeypatch.setattr(nj, "SAMPLE", 100)
    rng = random.Random(9)
    base = [f"b{i}" for i in range(150)]
    values = []
    for i in range(600):  # most are linked with a few only, so that no star joins them
        words = list(base)
        for at in rng.sample(range(150), rng.choice([2, 3, 3, 4, 4, 4])):
            words[at] = f"v{i}x{at}"
        values.append(" ".join(words))
    made = []
    plain = nj.open_pairs

    def counted(open_, classes, limit):
        out = nj.written(plain(open_, classes, limit), "counted")
        made.append((limit, out.count()))
        return out

    monkeypatch.setattr(nj, "open_pairs", counted)
    got = run(texts(spark, values))
    assert {i: c for i, (_, c) in got.items()} == linked(list(enumerate(values)))
    assert made[0][0] == 1 and sum(n for _, n in made) < 4 * len(values), made


def test_only_keys_whose_classes_had_others_get_a_further_round(spark, monkeypatch):
    monkeypatch.setattr(nj, "SAMPLE", 100)
    rng = random.Random(10)
    base = [f"b{i}" for i in range(150)]
    values = []
    for i in range(120):
        words = list(base)
        for at in rng.sample(range(150), rng.choice([2, 3, 3, 4, 4, 4])):
            words[at] = f"v{i}x{at}"
        values.append(" ".join(words))
    for i in range(100):  # two texts that share half of their words stay apart for ever
        same, own = [f"s{i}x{j}" for j in range(60)], [[f"{o}{i}x{j}" for j in range(60)] for o in "pq"]
        values += [" ".join(same + own[0]), " ".join(same + own[1])]
    rounds = []
    plain = nj.open_pairs

    def counted(open_, classes, limit):
        out = nj.written(plain(open_, classes, limit), "counted")
        rounds.append(
            (
                {r[0] for r in open_.select("key_group").collect()},
                {g for r in out.collect() for g in r["more"]},
            )
        )
        return out

    monkeypatch.setattr(nj, "open_pairs", counted)
    got = run(texts(spark, values))
    assert {i: c for i, (_, c) in got.items()} == linked(list(enumerate(values)))
    assert len(rounds) > 1 and len(rounds[0][0]) > 100
    for (_, more), (groups, _) in zip(rounds, rounds[1:]):
        assert groups <= more
    assert len(rounds[1][0]) <= len(rounds[0][0]) - 100


def test_sets_and_keys_of_many_texts_are_worked_out_together(monkeypatch):
    rng = random.Random(11)
    values = [None, "", " \n", "one", "One two", "a\x0bb c d e"] + [
        " ".join(rng.choices(["a", "B", "é", "dd", "\U0001f600", "x"], k=rng.choice([3, 5, 40, 700])))
        for _ in range(300)
    ]
    values += values[40:50]
    seen = []
    plain = nj.mix
    monkeypatch.setattr(nj, "mix", lambda *args: seen.append(1) or plain(*args))
    blocks = list(nj._text_blocks(values))
    assert [text for block in blocks for text in block] == values
    frequent = nj.Frequent(nj.part_keys(nj.shingles(values[-1]))[::3])
    seen.clear()
    found, bounds = nj.shingle_sets(values)
    numbers = nj.numbers_of(found, bounds)
    flat, ends = nj.sketches_of(found, bounds)
    keys, key_ends = nj.keys_of(found, bounds)
    assert len(seen) < 20  # not some for each text
    first, first_ends = nj.keys_of(found, bounds, frequent)
    for i, text in enumerate(values):
        own = found[bounds[i] : bounds[i + 1]]
        assert len(own) == len(shingle_set(text)) and (np.diff(own.view("uint64")) > 0).all()
        assert np.array_equal(own, nj.shingles(text))
        if len(own):
            assert tuple(numbers[:, i].tolist()) == nj.set_numbers(own)
            assert np.array_equal(flat[ends[i] : ends[i + 1]], nj.sketch(own))
        else:
            assert not numbers[:, i].any() and ends[i] == ends[i + 1]
        for got, at, chosen in ((keys, key_ends, None), (first, first_ends, frequent)):
            want = nj.part_keys(own, chosen)
            assert np.array_equal(np.sort(got[at[i] : at[i + 1]]), np.sort(want))
    # A bound on what is held at once does not change the keys.
    monkeypatch.setattr(nj, "TOGETHER", 100)
    assert np.array_equal(nj.keys_of(found, bounds, frequent)[0], first)


def test_nearest_of_many_groups_are_compared_together():
    rng = random.Random(12)
    base = np.array([rng.getrandbits(64) for _ in range(200)], "uint64")
    jobs, want, more = [], set(), set()
    for group in range(60):
        size = rng.choice([2, 3, 9])
        sets = [
            np.unique(np.append(base[rng.randrange(30) :], [np.uint64(group), np.uint64(1000 + k)]))
            for k in range(size)
        ]
        c1 = np.array(rng.sample(range(group * 100, group * 100 + 100), size))
        part = np.array([rng.randrange(3) for _ in range(size)])
        n = np.array([len(x) for x in sets])
        rows = (c1, part, n, np.stack([nj.sketch(x) for x in sets]))
        asking = np.flatnonzero(part > 0)
        jobs.append((group, tuple(c[asking] for c in rows), rows))
        for i in asking:
            near = []
            for j in range(size):
                differ = (rows[3][i] ^ rows[3][j]).view("uint64")
                distance = int(np.bitwise_count(differ).sum())
                small, large = sorted((int(n[i]), int(n[j])))
                if part[i] != part[j] and 4 * small >= 3 * large and 7 * distance <= small + large:
                    near.append((distance, int(c1[j])))
            want |= {(min(c, int(c1[i])), max(c, int(c1[i]))) for _, c in sorted(near)[:2]}
            more |= {group} if len(near) > 2 else set()
    batch = nj._paired([nj._nearest(jobs[:35], 2), nj._nearest(jobs[35:], 2)])
    rows = batch.to_pylist()
    got = [(r["a"], r["b"]) for r in rows]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 60
    # A group is noted once, at a pair of its own.
    noted = [(g, r["a"] // 100) for r in rows for g in r["more"]]
    assert all(g == of for g, of in noted) and more
    assert sorted(g for g, _ in noted) == sorted(more)


def test_components_are_worked_out_anew_only_after_new_links(spark, monkeypatch):
    values = []
    for i in range(10):  # any two differ by just more than the threshold
        words = [f"b{j}" for j in range(150)]
        for at in (0, 5 + 14 * i, 12 + 14 * i):
            words[at] = f"v{i}x{at}"
        values.append(" ".join(words))
    calls = []
    for name in ("verified", "components"):
        plain = getattr(nj, name)
        monkeypatch.setattr(
            nj, name, lambda *args, n=name, f=plain: calls.append(n) or f(*args)
        )
    got = run(texts(spark, values))
    assert {i: c for i, (_, c) in got.items()} == {i: i for i in range(10)}
    assert calls.count("verified") > 1 and calls.count("components") == 1
