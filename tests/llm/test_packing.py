import random
import zlib
from collections import Counter

import numpy as np
import pytest
from cases import ODD_ROWS, empty, odd, texts

from eventmill.llm import packing as pk


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(pk.vocabulary_path())


def ids_of(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
    return np.array(ids, "<u4")


def test_chunked_ids_equal_the_tokenizer(tokenizer):
    words = pk.WordIds(pk.vocabulary_path())
    values = [
        "", "Hello, World! It's they'll 'S x.'s", "Straße ÀÉ ǅ İstanbul ſ µ ŉ K ﬁ", "é İ Á.",
        "<|endoftext|> <|EndOfText|> a<|startoftext|>", "a\x1cb\x85c\td e f 12 3,456...!?",
        "日本語 text. ΟΔΟΣ, ß.. é.é, naïve.", "don't.,;:!? word.' ''", ".. , ,, word,word",
    ]
    for text in values:
        assert words.of(text) == ids_of(tokenizer, text)[:-1].tobytes(), text


def fewest(lengths, capacity):
    """Fewest sequences by trying all partitions (few pieces only)."""
    best = len(lengths)

    def place(left, open_):
        nonlocal best
        if len(open_) >= best:
            return
        if not left:
            best = len(open_)
            return
        for i in {v: k for k, v in enumerate(open_)}.values():
            if open_[i] + left[0] <= capacity:
                place(left[1:], [*open_[:i], open_[i] + left[0], *open_[i + 1 :]])
        place(left[1:], [*open_, left[0]])

    place(sorted(lengths, reverse=True), [])
    return best


def test_plan_is_optimal_on_small_cases():
    rng = random.Random(1)
    for _ in range(60):
        lengths = [rng.randint(1, 100) for _ in range(rng.randint(1, 9))]
        plan = pk.bin_completion(Counter(lengths), 100)
        assert sum(n for _, n in plan) == fewest(lengths, 100)


def test_plan_uses_every_piece_once_and_beats_best_fit():
    rng = random.Random(3)
    for low, high, n in ((1, 2048, 3000), (300, 1200, 1500), (700, 1000, 900), (2048, 2048, 5)):
        counts = Counter(rng.randint(low, high) for _ in range(n))
        plan = pk.bin_completion(counts)
        used = Counter()
        for bin_, times in plan:
            assert sum(bin_) <= pk.CAPACITY and times > 0
            for length in bin_:
                used[length] += times
        assert used == counts
        listed = [counts.get(i, 0) for i in range(pk.CAPACITY + 1)]
        total = sum(t for _, t in plan)
        assert pk.least_sequences(listed, pk.CAPACITY) <= total
        assert total <= sum(t for _, t in pk.best_fit(listed, pk.CAPACITY))


def test_lower_bound_holds():
    rng = random.Random(8)
    for _ in range(60):
        lengths = [rng.randint(1, 60) for _ in range(rng.randint(1, 8))]
        listed = [lengths.count(i) for i in range(61)]
        assert pk.least_sequences(listed, 60) <= fewest(lengths, 60)


def check(rows, docs, tokenizer, capacity):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    got = Counter(
        (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows
    )
    want = Counter()
    for doc_id, text in docs:
        ids = ids_of(tokenizer, text)
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            want[doc_id, piece, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert got == want


def test_round_trip(spark, tokenizer):
    rng = random.Random(6)
    values = [" ".join(rng.choices(["alpha", "Beta,", "γ.", "x1"], k=rng.randint(0, 90))) for _ in range(80)]
    rows = pk.pack(texts(spark, values), capacity=64).collect()
    check(rows, list(enumerate(values)), tokenizer, 64)


def test_odd_and_empty_tables(spark, tokenizer):
    check(pk.pack(odd(spark)).collect(), [r[:2] for r in ODD_ROWS], tokenizer, pk.CAPACITY)
    assert pk.pack(empty(spark)).count() == 0


def test_exact_capacity_is_one_piece(tokenizer):
    ids = pk.WordIds(pk.vocabulary_path())
    text = "the " * 9
    assert len(pk.cut(text, ids, 10)) == 1 and len(pk.cut(text + "the", ids, 10)) == 2
