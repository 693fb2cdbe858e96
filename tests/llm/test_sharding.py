import random
import zlib
from collections import Counter, defaultdict

from cases import ODD_ROWS, empty, frame, odd

from eventmill.llm import sharding as sh


def rows_of(spark, n=3000, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        text = "the hot copy" * 9 if i % 3 == 0 else f"{i} " + "x" * rng.randint(0, 200)
        if i % 50 == 7:
            text = f"pair {i // 100}"
        out.append((i, text, rng.choice(["en", "de"]), f"src{rng.randint(0, 9)}", len(text)))
    return out


def test_bytes_are_near_equal_and_slots_gapless(spark):
    rows = rows_of(spark)
    got = sh.with_slots(sh.shard(frame(spark, rows))).collect()
    text = {r[0]: r[1] for r in rows}
    assert Counter(r["doc_id"] for r in got) == Counter(text.keys())
    sizes, slots = Counter(), defaultdict(list)
    for r in got:
        assert r["size"] == len(text[r["doc_id"]].encode()) + 1
        assert r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode())
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    mean = sum(sizes.values()) / 16
    assert set(sizes) == set(range(16))
    assert all(abs(s - mean) <= 0.04 * mean for s in sizes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_small_groups_of_copies_stay_together(spark):
    rows = rows_of(spark)
    shards = defaultdict(set)
    text = {r[0]: r[1] for r in rows}
    for r in sh.shard(frame(spark, rows)).collect():
        shards[text[r["doc_id"]]].add(r["shard"])
    assert all(len(s) == 1 for t, s in shards.items() if t.startswith("pair"))
    assert len(shards["the hot copy" * 9]) > 1


def test_widest_dimension_is_split_first(spark):
    # One dimension varies, so shards are ranges of it.
    rows = [(i, f"text {i:05d}", "en", "src0", i * 7) for i in range(1600)]
    got = {r["doc_id"]: r["shard"] for r in sh.shard(frame(spark, rows)).collect()}
    assert [got[i] for i in range(1600)] == sorted(got[i] for i in range(1600))


def test_odd_and_empty_tables(spark):
    got = sh.with_slots(sh.shard(odd(spark))).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in ODD_ROWS)
    assert {r["size"] for r in got if r["doc_id"] in (1, 2)} == {1}
    assert sh.with_slots(sh.shard(empty(spark))).count() == 0


def test_rows_without_or_with_one_doc_id_are_dealt_evenly(spark):
    rng = random.Random(2)
    rows = []
    for i in range(4500):
        hot = i % 3 == 0
        doc_id = (None if i % 2 else 7) if hot else i
        text = "the hot copy " * 5 if hot else f"{i} " + "y" * rng.randint(0, 80)
        rows.append((doc_id, text, "en", "src0", len(text)))
    got = sh.with_slots(sh.shard(frame(spark, rows))).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    sizes, slots = Counter(), defaultdict(list)
    for r in got:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    mean = sum(sizes.values()) / 16
    assert set(sizes) == set(range(16))
    assert all(abs(s - mean) <= 0.04 * mean for s in sizes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
