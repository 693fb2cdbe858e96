import random

from cases import empty, odd, texts

from eventmill.llm import decontamination as dc


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def best_place(pattern, text):
    """Least edits of the pattern against any part of the text."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(pattern, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def _words(rng, n):
    return " ".join(
        "".join(rng.choices(["the", "an", "er", "in", "on", "st", "re"], k=rng.randint(1, 3)))
        for _ in range(n)
    )


def _edit(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.choice("ids")
        if kind == "i":
            out.insert(at, rng.choice("qwx "))
        elif kind == "d":
            del out[at]
        else:
            out[at] = rng.choice("qwxz")
    return "".join(out)


def test_finds_what_all_pairs_find():
    rng = random.Random(11)
    items = [(i, _words(rng, rng.randint(8, 30))) for i in range(15)]
    index = dc.build_index(items)
    for _ in range(60):
        item, text = rng.choice(items)
        edited = _edit(rng, text, rng.randint(0, dc.edit_budget(len(text)) + 2))
        host = f"{_words(rng, rng.randint(0, 20))} {edited} {_words(rng, rng.randint(0, 20))}"
        found = dc.find_items(host, index)
        want = {
            i
            for i, t in items
            if best_place(dc.normal(t), dc.normal(host)) <= dc.edit_budget(len(t))
        }
        assert {h[0] for h in found} == want
        for i, start, end, edits in found:
            assert distance(dc.normal(dict(items)[i]), dc.normal(host[start:end])) == edits


def test_all_places_are_found_in_long_texts(monkeypatch):
    rng = random.Random(12)
    item = _words(rng, 20)
    monkeypatch.setattr(dc, "STRETCH", 300)
    index = dc.build_index([(7, item)])
    text = ""
    places = []
    for _ in range(6):
        text += _words(rng, 60) + "\n"
        places.append(len(text))
        text += item.upper() + "\n"
    assert [(h[1], h[2]) for h in dc.find_items(text, index)] == [
        (p, p + len(item)) for p in places
    ]


def test_short_null_and_equal_items():
    index = dc.build_index([(1, "short"), (2, None), (3, ""), (4, "a much longer benchmark item"),
                            (5, "a much longer benchmark item")])
    assert dc.find_items("Short", index) == [(1, 0, 5, 0)]
    assert dc.find_items("is short here", index) == []
    assert [h[0] for h in dc.find_items("x a much\nlonger benchmark item y", index)] == [4, 5]
    assert dc.find_items("", index) == dc.find_items(None, index) == []


def test_operator_in_blocks(spark, monkeypatch):
    rng = random.Random(13)
    items = [(i, _words(rng, 15)) for i in range(12)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    values = [_words(rng, 30) + " " + items[i][1] for i in range(12)] + [_words(rng, 40)]
    docs = texts(spark, values)
    assert len(list(dc.benchmark_blocks(bench, 300))) > 3
    for chars in (300, dc.BLOCK_CHARS):
        monkeypatch.setattr(dc, "BLOCK_CHARS", chars)
        rows = dc.all_matches(docs, bench).collect()
        assert sorted((r["doc_id"], r["item_id"]) for r in rows) == [(i, i) for i in range(12)]
        assert [r["doc_id"] for r in dc.clean(docs, bench).collect()] == [12]


def test_odd_and_empty_tables(spark):
    bench = spark.createDataFrame(
        [(1, "the same row twice, with a text"), (2, None), (None, "one two three")],
        "item_id long, text string",
    )
    docs = odd(spark)
    rows = dc.all_matches(docs, bench).collect()
    assert sorted(r["doc_id"] for r in rows) == [6, 7, 8, 8]
    none = bench.where("false")
    assert dc.all_matches(docs, none).count() == 0
    assert dc.clean(docs, none).count() == docs.count()
    nothing = empty(spark)
    assert dc.all_matches(nothing, bench).count() == dc.clean(nothing, bench).count() == 0


def test_white_space_is_one_blank_and_places_are_of_the_text():
    item = "def first():\n        return the_first_of_them\n"
    index = dc.build_index([(3, item)])
    for indent in (" ", "\t\t", " " * 400):
        head = f"\n\n{indent}x = 1  \n"
        text = head + item.strip().replace("        ", indent) + "\n\n  y"
        ((i, start, end, edits),) = dc.find_items(text, index)
        assert (i, edits, text[start:end]) == (3, 0, text[len(head) : -len("\n\n  y")])


def test_repeated_characters_stay_cheap():
    rng = random.Random(14)
    runs = [" " * 40, "=" * 40, "-=" * 20, "ab" * 20]
    items = [(i, runs[i % 4] + _words(rng, 20) + runs[i % 4]) for i in range(20)]
    items.append((20, "=" * 60))
    index = dc.build_index(items)
    for filler in (" " * 1_000_000, "-=" * 20_000, "ab" * 20_000):
        text = filler + items[5][1] + filler
        assert [h[0] for h in dc.find_items(text, index)] == [5]
    hits = dc.find_items("=" * 50_000 + items[5][1], index)
    assert [h[0] for h in hits if h[0] != 20] == [5]
    # The item of one character is found in places that do not overlap.
    ends = [(h[1], h[2]) for h in hits if h[0] == 20]
    assert len(ends) > 400 and all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))


def test_slices_of_postings_change_nothing(monkeypatch):
    rng = random.Random(15)
    items = [(i, _words(rng, 12) + "=" * (i % 3) * 10) for i in range(10)]
    index = dc.build_index(items)
    hosts = [_words(rng, 9) + "=" * 90 + _edit(rng, items[i][1], 2) + _words(rng, 9) for i in range(10)]
    before = [dc.find_items(h, index) for h in hosts]
    monkeypatch.setattr(dc, "POSTINGS", 7)
    assert [dc.find_items(h, index) for h in hosts] == before
    assert sum(map(bool, before)) >= 9
