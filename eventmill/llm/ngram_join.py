"""Exact Jaccard join on word shingles by parity sketches.

A document's set holds the 64-bit hashes of its distinct shingles. Two sets of sizes a and b reach a
Jaccard of t only if they differ in at most ``D = (a + b) (1 - t) / (1 + t)`` shingles. Parity
sketches bound that difference from below without the sets:

* Pigeonhole join. Sizes are cut into bands. For a band (and for each pair of neighbouring bands,
  whose sets may meet too) shingles are dealt into P parts by hash, and each part is folded into its
  parity, the XOR of its shingles' hashes: a key (band, part, parity). Every differing shingle
  changes one part, so two sets that qualify disagree in at most D parts, and of the keys of a set
  that has more than D at most D are not those of the other. So if both sets are listed under their
  first D + 1 keys in one common order, they share one of these (prefix filter). The order puts keys
  last that a bounded sample of documents shows to be frequent, so a passage shared by many
  documents makes few candidates. A set with at most D parts that are not empty (rare, by chance) is
  listed under all its keys and its empty parts, which only such sets have.
* Hamming filter. Each set has a bit sketch of about its own size, every shingle flips one bit; the
  Hamming distance of two sketches is at most the sets' difference, so pairs beyond D are dropped.
* Verification on the sets themselves.

Groups of copies are never expanded: documents with equal sets form one class, and the classes that
share a key are compared with the smallest of them first (a star). Where a key's classes are still
in several components, each class outside the largest one meets all of the others' sketches in the
task that has the key's classes, and is compared with its nearest in another component; then
components are joined anew, and only keys that are still apart and in which a class had others go on,
with eight times as many of the nearest each round, until no class has one left that the Hamming
filter lets pass. So no link is lost, and a group of near copies costs about as many comparisons as
it has members.

Python (numpy) hashes texts and counts keys within tasks; Spark moves keys by hash slot (packed, 5
bytes a key), so a frequent key's classes are spread over all slots of their other keys. Components
are found by alternating star contractions over written tables.

Defined results: a null or empty text, or one without words, has the empty set and is linked with
nothing; texts of fewer words than a shingle have one shingle of all words; a null doc_id is never a
component's number unless all its documents have none; repeated rows are copies; an empty table
gives an empty result; other columns are not read by the query and passed through by the stage.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.llm.common import documents, hash128
from eventmill.session import written

WORDS = 5
#: The Jaccard threshold as a fraction.
THRESHOLD = (75, 100)
#: Least bits of a sketch.
BITS = 1024
#: About how many characters of texts are hashed together.
TOGETHER = 1 << 18
#: Keys of one hash slot, and the least number of slots.
SLOT_KEYS, LEAST_SLOTS = 1_000_000, 64
#: Documents sampled for frequent keys, and how many of them must have one. Only the order of keys,
#: not the result, depends on it.
SAMPLE, FREQUENT = 4000, 3
#: About how many partners of a class are compared in one group of rows.
BLOCK = 64
#: Rows of the keys of one hub that one group of rows holds, and bytes of the sketches of a key's
#: classes that one task holds.
HUB_ROWS, HELD_BYTES = 4000, 32 << 20
#: Pairs that a task collects before it puts them out, and 64-bit words of sketches that it compares
#: at once.
HELD_PAIRS, HELD_WORDS = 1_000_000, 1 << 20
#: How many times as many of its nearest a class is compared with in each further round.
MORE = 8
BLOOM_BITS = 1 << 25

U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray, seed: int | np.ndarray = 0) -> np.ndarray:
    """A 64-bit finalizer: every bit of the input changes about half of the output's."""
    if isinstance(seed, int):
        x = x + U((seed * 2 + 1) * 0xD1B54A32D192ED03 % (1 << 64))
    else:
        x = x + (seed * U(2) + U(1)) * U(0xD1B54A32D192ED03)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _powers(factor: int, n: int) -> np.ndarray:
    """factor ** 0 .. n - 1 modulo 2 ** 64."""
    have = _POWERS.get(factor)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.full(size, U(factor))
        have[0] = U(1)
        have = np.multiply.accumulate(have)
        if size <= 1 << 22:
            _POWERS[factor] = have
    return have[:n]


def _bounds(sizes: np.ndarray | list[int]) -> np.ndarray:
    """Where each of several runs of these sizes begins, one after another, and where the last ends."""
    out = np.zeros(len(sizes) + 1, "int64")
    np.cumsum(sizes, out=out[1:])
    return out


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of UTF-8 bytes, from prefix sums of a polynomial, and where the
    words start. A hash does not depend on its place."""
    space = np.ones(len(raw) + 2, bool)
    np.take(_SPACE, raw, out=space[1:-1])
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(raw) + 1, "uint64")
    np.cumsum((raw + U(1)) * _powers(_FACTOR, len(raw)), out=sums[1:])
    values = (sums[ends] - sums[starts]) * _powers(_INVERSE, len(raw))[starts]
    return mix(values ^ (ends - starts).astype("uint64")), starts


def shingle_sets(texts: list[str | None], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The sets of texts, A-Z lower-cased, one after another: sorted distinct 64-bit shingle hashes;
    and the sets' bounds."""
    encoded = [(text or "").encode("utf-8", "surrogatepass") for text in texts]
    hashed, starts = word_hashes(np.frombuffer(b" ".join(encoded).lower(), "uint8"))
    word = np.searchsorted(starts, _bounds([len(raw) + 1 for raw in encoded]))
    counts = np.diff(word)
    sizes = np.where(counts < words, counts > 0, counts - words + 1)
    bounds = _bounds(sizes)
    total = np.full(max(0, len(hashed) - words + 1), U(words))
    for i in range(words):
        total *= U(0xFF51AFD7ED558CCD)
        total += hashed[i : i + len(total)]
    found = np.zeros(bounds[-1], "uint64")
    long = np.repeat(counts >= words, sizes)
    found[long] = total[(np.arange(len(found)) + np.repeat(word[:-1] - bounds[:-1], sizes))[long]]
    for width in range(1, words):  # texts of fewer words than a shingle
        of = np.flatnonzero(counts == width)
        if len(of):
            short = np.full(len(of), U(width))
            for i in range(width):
                short = short * U(0xFF51AFD7ED558CCD) + hashed[word[of] + i]
            found[bounds[of]] = short
    found = mix(found, 1)
    for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        found[start:end].sort()
    fresh = np.ones(len(found), bool)
    fresh[1:] = found[1:] != found[:-1]
    fresh[bounds[:-1][sizes > 0]] = True
    return found[fresh], _bounds(fresh)[bounds]


def _text_blocks(texts: list[str | None]) -> Iterator[list[str | None]]:
    """The texts in blocks of about ``TOGETHER`` characters."""
    start = held = 0
    for end, text in enumerate(texts, 1):
        held += len(text or "")
        if held >= TOGETHER or end == len(texts):
            yield texts[start:end]
            start, held = end, 0


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The set of a text."""
    return shingle_sets([text], words)[0]


def numbers_of(found: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Two 64-bit numbers (signed) that stand for each of several sets; zeros for empty ones."""
    sizes = np.diff(bounds)
    out = np.zeros((2, len(sizes)), "uint64")
    full = sizes > 0
    begin = bounds[:-1][full]
    if len(begin):
        first = np.add.reduceat(mix(found, 2), begin, dtype="uint64")
        out[0, full] = first ^ sizes[full].astype("uint64")
        out[1, full] = np.bitwise_xor.reduceat(mix(found, 3), begin)
    return out.view("int64")


def set_numbers(found: np.ndarray) -> tuple[int, int]:
    """Two 64-bit numbers (signed) that stand for a set."""
    first, second = numbers_of(found, _bounds([len(found)]))[:, 0].tolist()
    return first, second


def sketches_of(found: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sketches of several sets, one after another, and their bounds; an empty set has none."""
    sizes = np.diff(bounds)
    bits = np.array([n and max(BITS, 1 << (n - 1).bit_length()) for n in sizes.tolist()], "int64")
    at = _bounds(bits)
    own = mix(found, 4) & (np.repeat(bits, sizes) - 1).view("uint64")
    flips = np.bincount(own.view("int64") + np.repeat(at[:-1], sizes), minlength=at[-1])
    return np.packbits(flips.astype("uint8") & 1).view("int64"), at // 64


def sketch(found: np.ndarray) -> np.ndarray:
    """The parity sketch as signed 64-bit words: every shingle flips one bit.

    It has at least as many bits as the set has shingles, a power of two, so that the XOR of its
    halves is the sketch of half the size.
    """
    return sketches_of(found, _bounds([len(found)]))[0]


def _edges(limit: int = 1 << 48) -> list[int]:
    """First sizes of the bands, each about half as large again as the one before."""
    out = [1]
    while out[-1] < limit:
        out.append(max(out[-1] + 1, out[-1] * 3 // 2))
    return out


EDGES = _edges()


def _largest_partner(size: int) -> int:
    kept, of = THRESHOLD
    return size * of // kept


def _least_partner(size: int) -> int:
    kept, of = THRESHOLD
    return -(-size * kept // of)


@lru_cache(maxsize=None)
def _plan(band: int, joint: bool) -> tuple[int, int, int, int]:
    """(D, P, smallest, largest size) of a band, or of the sets of it and the next that may meet."""
    kept, of = THRESHOLD
    low, high = EDGES[band], EDGES[band + 1] - 1
    if joint:
        least = max(low, _least_partner(high + 1))
        most = min(_largest_partner(high), EDGES[band + 2] - 1)
        both = high + most
    else:
        least, most, both = low, high, 2 * high
    differ = both * (of - kept) // (of + kept)
    # Few enough parts for keys to be selective, enough for more than D of them to be filled.
    wanted = differ + 1 + 0.8 * math.sqrt(least)
    parts = differ + 1
    while parts < 8 * most and parts * (1 - math.exp(-least / parts)) < wanted:
        parts += max(1, parts // 50)
    return differ, parts, least, most


@lru_cache(maxsize=1 << 16)
def band_plans(n: int) -> list[tuple[int, int, int]]:
    """(number of the plan, D, P) of the bands a set of size n takes part in: 2i for band i itself,
    2i + 1 for band i together with the next one."""
    band = bisect.bisect_right(EDGES, n) - 1
    out = []
    for number, joint in ((band, False), (band, True), (band - 1, True)):
        if number >= 0:
            differ, parts, least, most = _plan(number, joint)
            if least <= n <= most and (differ or joint) and most > (EDGES[number + 1] - 1) * joint:
                out.append((2 * number + joint, differ, parts))
    return out


def keys_of(
    found: np.ndarray, bounds: np.ndarray, frequent: Frequent | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """The pigeonhole keys of several sets, one set's after another's, and their bounds: enough that
    every set with which a set qualifies shares one. Without ``frequent``, the keys of all parts."""
    sizes = np.diff(bounds)
    plans = [(i, *plan) for i, n in enumerate(sizes.tolist()) for plan in band_plans(n)]
    if not plans:
        return np.zeros(0, "uint64"), np.zeros(len(bounds), "int64")
    of = np.array([plan[0] for plan in plans])
    mixed, keys, counts = mix(found, 5), [], []
    # As many plans at a time as have TOGETHER shingles, or the one that has more.
    turn = _bounds(sizes[of])[1:] // TOGETHER
    cuts = np.flatnonzero(np.diff(turn)) + 1
    for start, end in zip([0, *cuts], [*cuts, len(plans)], strict=True):
        own, ends = _parities(found, mixed, bounds, plans[start:end])
        if frequent is not None:
            own, ends = _first_keys(own, ends, found, bounds, plans[start:end], frequent)
        keys.append(own)
        counts.append(np.diff(ends))
    each = np.bincount(of, np.concatenate(counts), len(sizes)).astype("int64")
    return np.concatenate(keys), _bounds(each)


def _parities(
    found: np.ndarray, mixed: np.ndarray, bounds: np.ndarray, plans: list[tuple[int, int, int, int]]
) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the parts that are not empty, for each plan (set, number, D, P), and their bounds.
    Sets are sorted, and so are the parts, which are ranges of hashes."""
    of, number, _, parts = np.array(plans, "int64").T
    sizes = bounds[of + 1] - bounds[of]
    ends = _bounds(sizes)
    at = np.arange(ends[-1]) + np.repeat(bounds[of] - ends[:-1], sizes)
    part = _part(found[at], np.repeat(parts.astype("uint64"), sizes))
    fresh = np.ones(len(part), bool)
    fresh[1:] = part[1:] != part[:-1]
    fresh[ends[:-1]] = True
    first = np.flatnonzero(fresh)
    key_ends = _bounds(fresh)[ends]
    parity = np.bitwise_xor.reduceat(mixed[at], first)
    seed = np.repeat((number * 2).astype("uint64"), np.diff(key_ends))
    return mix(parity + mix(part[first].astype("uint64"), seed), seed), key_ends


def _first_keys(
    keys: np.ndarray,
    ends: np.ndarray,
    found: np.ndarray,
    bounds: np.ndarray,
    plans: list[tuple[int, int, int, int]],
    frequent: Frequent,
) -> tuple[np.ndarray, np.ndarray]:
    """Of the keys of each plan the first D + 1, frequent ones last, and their bounds; of a plan with
    at most D all, and its empty parts."""
    often = frequent.holds(keys)
    rare, common = keys[~often], keys[often]
    rare_ends = _bounds(~often)[ends]
    common_ends = ends - rare_ends
    chosen = []
    for i, (owner, number, differ, parts) in enumerate(plans):
        if ends[i + 1] - ends[i] > differ:
            own = rare[rare_ends[i] : rare_ends[i + 1]]
            if len(own) > differ + 1:
                own.partition(differ)
                own = own[: differ + 1]
            elif len(own) <= differ:
                last = np.sort(common[common_ends[i] : common_ends[i + 1]])
                own = np.concatenate([own, last[: differ + 1 - len(own)]])
        else:
            filled = _part(found[bounds[owner] : bounds[owner + 1]], U(parts))
            empty = np.setdiff1d(np.arange(parts), filled).astype("uint64")
            own = np.concatenate([keys[ends[i] : ends[i + 1]], mix(empty, number * 2 + 1)])
        chosen.append(own)
    return np.concatenate(chosen), _bounds([len(own) for own in chosen])


def part_keys(found: np.ndarray, frequent: Frequent | None = None) -> np.ndarray:
    """The pigeonhole keys of a set."""
    return keys_of(found, _bounds([len(found)]), frequent)[0]


def _part(found: np.ndarray, parts: np.ndarray | np.uint64) -> np.ndarray:
    return (((found >> U(32)) * parts) >> U(32)).astype("int64")


class Frequent:
    """A fixed set of keys, tested by their low bits first."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.sort(keys)
        size = 1 << max(10, (16 * max(1, len(keys))).bit_length())
        self.mask = U(size - 1)
        self.member = np.zeros(size, bool)
        self.member[(self.keys & self.mask).astype("int64")] = True

    def holds(self, keys: np.ndarray) -> np.ndarray:
        maybe = self.member[(keys & self.mask).astype("int64")]
        at = np.flatnonzero(maybe)
        if len(at):
            near = np.minimum(np.searchsorted(self.keys, keys[at]), len(self.keys) - 1)
            maybe[at] = self.keys[near] == keys[at]
        return maybe


def qualifies(shared: int, a: int, b: int) -> bool:
    kept, of = THRESHOLD
    return of * shared >= kept * (a + b - shared)


# --- Spark ------------------------------------------------------------------------------------


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def document_sets(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n, c1, c2 (the set's numbers), sketch and h1, h2 (the text's hash) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, numbers, sketches, lengths = [], [], [], []
            for block in _text_blocks(batch.column(1).to_pylist()):
                found, bounds = shingle_sets(block, words)
                sizes.append(np.diff(bounds))
                numbers.append(numbers_of(found, bounds))
                flat, ends = sketches_of(found, bounds)
                sketches.append(flat)
                lengths.append(np.diff(ends))
            if not sizes:
                continue
            first, second = np.concatenate(numbers, axis=1)
            offsets = _bounds(np.concatenate(lengths)).astype("int32")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.concatenate(sizes)),
                    pa.array(first),
                    pa.array(second),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sketches))),
                    batch.column(2),
                    batch.column(3),
                ],
                names=["doc_id", "n", "c1", "c2", "sketch", "h1", "h2"],
            )

    return (
        _texts(docs)
        .select("doc_id", "text", *hash128("text"))
        .mapInArrow(
            run, "doc_id long, n long, c1 long, c2 long, sketch array<long>, h1 long, h2 long"
        )
    )


def frequent_keys(docs: DataFrame, rows: int, words: int = WORDS) -> np.ndarray:
    """Keys that at least ``FREQUENT`` of a sample of documents have."""
    share = max(1, rows // SAMPLE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in _text_blocks(batch.column(1).to_pylist()):
                keys = keys_of(*shingle_sets(block, words))[0].view("int64")
                yield pa.RecordBatch.from_arrays([pa.array(keys)], names=["key"])

    counted = (
        _texts(docs)
        .where(F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0)
        .mapInArrow(run, "key long")
        .groupBy("key")
        .count()
        .where(F.col("count") >= FREQUENT)
    )
    keys = [r["key"] for r in counted.select("key").collect()]
    return np.array(keys, "int64").view("uint64")


def packed_keys(docs: DataFrame, frequent: np.ndarray, slots: int, words: int) -> DataFrame:
    """Rows (slot, keys, owners): the keys of a batch of documents that fall into one hash slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = Frequent(frequent), set()
        for batch in batches:
            keys, owners = [], []
            for block in _text_blocks(batch.column(1).to_pylist()):
                found, bounds = shingle_sets(block, words)
                numbers, sizes = numbers_of(found, bounds), np.diff(bounds)
                new = sizes > 0
                for i, number in enumerate(zip(*numbers.tolist(), strict=True)):
                    if number in seen:  # copies within a task are sent once
                        new[i] = False
                    elif new[i] and len(seen) < 1_000_000:
                        seen.add(number)
                own, ends = keys_of(found[np.repeat(new, sizes)], _bounds(sizes[new]), known)
                keys.append(own)
                owners.append(np.repeat(numbers[0, new], np.diff(ends)))
            every = np.concatenate(keys) if keys else np.zeros(0, "uint64")
            if not len(every):
                continue
            owner = np.concatenate(owners)
            slot = (every >> U(40)) % U(slots)
            # Numbers of 16 bits are sorted by their digits.
            slot = slot.astype("uint16" if slots <= 1 << 16 else "int64")
            order = np.argsort(slot, kind="stable")
            every, owner, slot = every[order], owner[order], slot[order]
            cuts = np.flatnonzero(np.concatenate(([True], slot[1:] != slot[:-1])))
            five = every.view("uint8").reshape(-1, 8)[:, :5]
            rows = []
            for start, end in zip(cuts, [*cuts[1:], len(every)], strict=True):
                own = owner[start:end]
                first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
                length = np.diff(np.append(first, len(own))).astype("uint32")
                rows.append(
                    (
                        int(slot[start]),
                        five[start:end].tobytes(),
                        own[first].tobytes(),
                        length.tobytes(),
                    )
                )
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), *[pa.array(c, pa.binary()) for c in columns[1:]]],
                names=["slot", "keys", "owners", "lengths"],
            )

    return _texts(docs).mapInArrow(run, "slot long, keys binary, owners binary, lengths binary")


def key_groups(packed: DataFrame, slots: int) -> DataFrame:
    """(key_group, hub, c1) of the classes that share a key, the hub being the smallest of them;
    equal groups have one number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, owners = [], []
        for batch in batches:
            for own_keys, own, lengths in zip(
                *(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True
            ):
                five = np.frombuffer(own_keys, "uint8").reshape(-1, 5)
                wide = np.zeros((len(five), 8), "uint8")
                wide[:, :5] = five
                keys.append(wide.view("uint64").ravel())
                owners.append(
                    np.repeat(np.frombuffer(own, "int64"), np.frombuffer(lengths, "uint32"))
                )
        if not keys:
            return
        keys, owners = np.concatenate(keys), np.concatenate(owners)
        # Most keys are in the slot once: those go before the owners are sorted.
        order = np.argsort(keys)
        keys = keys[order]
        same = keys[1:] == keys[:-1]
        shared = np.zeros(len(keys), bool)
        shared[1:] = same
        shared[:-1] |= same
        keys, owners = keys[shared], owners[order[shared]]
        if not len(keys):
            return
        order = np.lexsort((owners, keys))
        keys, owners = keys[order], owners[order]
        fresh = np.concatenate(([True], (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])))
        keys, owners = keys[fresh], owners[fresh]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        size = np.diff(np.append(first, len(keys)))
        first, size = first[size > 1], size[size > 1]
        if not len(first):
            return
        member = np.repeat(first - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(
            size.sum()
        )
        members = owners[member]
        begin = np.concatenate(([0], np.cumsum(size)[:-1]))
        number = np.add.reduceat(mix(members.view("uint64"), 6), begin) ^ size.astype("uint64")
        _, once = np.unique(number, return_index=True)
        chosen = np.zeros(len(size), bool)
        chosen[once] = True
        keep = np.repeat(chosen, size)
        # Owners of a key are sorted, so the first member is the smallest.
        columns = [
            np.repeat(number.view("int64"), size)[keep],
            np.repeat(members[begin], size)[keep],
            members[keep],
        ]
        for at in range(0, len(columns[0]), 50_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[at : at + 50_000]) for c in columns], names=["key_group", "hub", "c1"]
            )

    return (
        packed.repartition(slots, "slot")
        .mapInArrow(run, "key_group long, hub long, c1 long")
        .distinct()
    )


def wanted_bits(wanted: DataFrame) -> np.ndarray:
    """A Bloom filter (two bits an id) of the ids: at most BLOOM_BITS / 64 rows are collected."""
    places = wanted.select(
        F.explode(
            F.array(
                F.pmod(F.xxhash64("doc_id"), F.lit(BLOOM_BITS)),
                F.pmod(F.xxhash64(F.lit("second"), "doc_id"), F.lit(BLOOM_BITS)),
            )
        ).alias("place")
    )
    words = (
        places.groupBy(F.shiftright("place", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits"))
        .collect()
    )
    out = np.zeros(BLOOM_BITS // 64, "int64")
    if words:
        at, bits = zip(*words, strict=True)
        out[list(at)] = bits
    return out.view("uint64")


def class_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(c1, shingles) of the wanted documents (ids may be passed by chance that are not wanted)."""
    bits = docs.sparkSession.sparkContext.broadcast(wanted_bits(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bits.value
        for batch in batches:
            places = [batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2)]
            may = np.ones(len(places[0]), bool)
            for place in places:
                place = place.astype("uint64")
                may &= (table[(place >> U(6)).astype("int64")] >> (place & U(63))) & U(1) == 1
            texts = batch.column(0).take(pa.array(np.flatnonzero(may))).to_pylist()
            numbers, sets = [], []
            for block in _text_blocks(texts):
                found, bounds = shingle_sets(block, words)
                for number, start, end in zip(
                    numbers_of(found, bounds)[0].tolist(), bounds[:-1], bounds[1:], strict=True
                ):
                    if start < end:
                        numbers.append(number)
                        sets.append(found[start:end].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int64()), pa.array(sets, pa.binary())],
                names=["c1", "shingles"],
            )

    return docs.select(
        F.col("text").cast("string"),
        F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(BLOOM_BITS)).alias("a"),
        F.pmod(F.xxhash64(F.lit("second"), F.col("doc_id").cast("long")), F.lit(BLOOM_BITS)).alias(
            "b"
        ),
    ).mapInArrow(run, "c1 long, shingles binary")


def _xor(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x.bitwiseXOR(y))


def _halved(words: Column, size: Column) -> Column:
    """A sketch folded to ``size`` words, which is its own size or half of it."""
    folded = _xor(F.slice(words, F.lit(1), size), F.slice(words, size + 1, size))
    return F.when(F.size(words) > size, folded).otherwise(words)


def _distance(a: Column, b: Column) -> Column:
    """Hamming distance of two sketches. Sets that may qualify differ less than twofold in size."""
    size = F.least(F.size(a), F.size(b))
    differing = _xor(_halved(a, size), _halved(b, size))
    return F.aggregate(differing, F.lit(0), lambda total, x: total + F.bit_count(x))


def _filtered(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) that pass the size and Hamming filters."""

    def side(name):
        return classes.select(
            F.col("c1").alias(name), F.col("n").alias(f"n_{name}"), F.col("sketch").alias(f"s_{name}")
        )

    kept, of = THRESHOLD
    a, b = F.col("n_a"), F.col("n_b")
    distance = _distance(F.col("s_a"), F.col("s_b"))
    return (
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .where(F.least(a, b) * of >= F.greatest(a, b) * kept)
        .where(distance * (of + kept) <= (a + b) * (of - kept))
        .select("a", "b")
    )


def open_rows(open_: DataFrame, classes: DataFrame) -> DataFrame:
    """The classes of ``open_`` with their sketches, dealt into blocks of bounded size.

    The members of a key group (key_group) are dealt into chunks of at most about ``HUB_ROWS`` rows
    and ``HELD_BYTES`` bytes. In its own chunk a member has turn 0; those outside the group's largest
    component (main) also go to every other chunk, with turn 1. Rows of one (hub, cell) belong to one
    task: a chunk of a large group, or the small groups of one hub in blocks of about ``HUB_ROWS``
    rows, since keys of one hub mostly have the same classes.
    """
    groups = (
        open_.groupBy("key_group", "hub", "part")
        .agg(F.count("*").alias("rows"))
        .groupBy("key_group", "hub")
        .agg(F.sum("rows").alias("rows"), F.max(F.struct("rows", "part"))["part"].alias("main"))
    )
    # Classes that share a key are of one band or the next: a sketch has at most 4.5 bits for each
    # shingle of any of them.
    held = F.lit(HELD_BYTES) / (F.greatest(F.lit(BITS), F.col("n") * 4.5) / 8)
    most = F.greatest(F.lit(1.0), F.least(F.lit(float(HUB_ROWS)), held))
    groups = written(
        groups.join(classes.select(F.col("c1").alias("hub"), "n"), "hub").select(
            "hub", "key_group", "main", "rows", F.ceil(F.col("rows") / most).cast("long").alias("chunks")
        ),
        "open-groups",
    )
    blocks = (
        groups.where("chunks = 1")
        .groupBy("hub")
        .agg(F.ceil(F.sum("rows") / HUB_ROWS).cast("long").alias("blocks"))
    )
    dealt = groups.join(blocks, "hub", "left").select(
        "hub",
        "key_group",
        "main",
        "chunks",
        F.when(F.col("chunks") == 1, F.pmod(F.xxhash64("key_group"), F.col("blocks"))).alias("block"),
    )
    own = F.pmod(F.xxhash64("c1"), F.col("chunks"))
    everywhere = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1),
        lambda x: F.struct(x.alias("chunk"), (x != own).cast("int").alias("turn")),
    )
    alone = F.array(F.struct(own.alias("chunk"), F.lit(0).alias("turn")))
    return (
        open_.drop("hub")
        .join(written(dealt, "open-dealt"), "key_group")
        .join(classes.select("c1", "n", "sketch"), "c1")
        .withColumn("main", F.col("part") == F.col("main"))
        .withColumn("at", F.explode(F.when(F.col("main"), alone).otherwise(everywhere)))
        .withColumn("cell", F.coalesce("block", F.xxhash64("key_group", "at.chunk")))
        .select(
            "hub", "cell", "key_group", "at.chunk", "at.turn", "main", "c1", "part", "n", "sketch"
        )
    )


def open_pairs(open_: DataFrame, classes: DataFrame, limit: int) -> DataFrame:
    """Pairs (a, b) of classes of one key in different components that pass the size and Hamming
    filters: the ``limit`` nearest of each class outside its key group's largest component. ``more``
    numbers the key groups in which a class had others, each at a pair of its own (at most the keys of
    a class); of a key group that is in none, all such pairs are there. ``open_``: key_group, hub, c1
    and part, the component.

    A task holds one chunk of a key group (see ``open_rows``); the members of its other chunks that
    are outside the group's largest component are streamed past it, and ``limit`` holds for each
    chunk. So a round makes at most ``limit`` pairs for a row of ``open_rows``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, count, waiting, words_waiting = [], 0, {}, 0
        group, members, held = None, [], None

        def compare() -> None:
            nonlocal count, words_waiting
            for jobs in waiting.values():
                found.append(_nearest(jobs, limit))
                count += len(found[-1][0])
            waiting.clear()
            words_waiting = 0

        def ask(rows: tuple, others: tuple) -> None:
            """Put down rows of the group to be compared with others; sketches are of one size."""
            nonlocal words_waiting
            # As many rows at a time as HELD_WORDS allow, or one.
            each = others[3].size
            step = max(1, HELD_WORDS // each)
            for at in range(0, len(rows[0]), step):
                some = rows if len(rows[0]) <= step else tuple(c[at : at + step] for c in rows)
                if words_waiting + each * len(some[0]) > HELD_WORDS:
                    compare()
                waiting.setdefault(others[3].shape[1], []).append((group[2], some, others))
                words_waiting += each * len(some[0])

        def hold() -> tuple:
            """The members of the chunk, whose own pairs are put down."""
            if len(members) == 1:
                *columns, sketches = members[0]
                matrix = sketches.folded(sketches.sizes.min())
            else:
                *columns, sketches = zip(*members, strict=True)
                columns = [np.concatenate(c) for c in columns]
                width = min(x.sizes.min() for x in sketches)
                matrix = np.concatenate([x.folded(width) for x in sketches])
            others = (*columns[:3], matrix)
            asking = np.flatnonzero(~columns[3])
            if len(matrix) > 1 and len(asking):
                ask(tuple(c[asking] for c in others), others)
            return others

        names = ("hub", "cell", "key_group", "chunk", "turn", "main", "c1", "part", "n")
        for batch in batches:
            if not batch.num_rows:
                continue
            hub, cell, key_group, chunk, turn, main, c1, part, n = (
                batch.column(c).to_numpy(zero_copy_only=False) for c in names
            )
            sketches = batch.column("sketch")
            offsets, words = sketches.offsets.to_numpy(), sketches.values.to_numpy()
            fresh = np.zeros(len(hub), bool)
            for column in (hub, cell, key_group, chunk, turn):
                fresh[1:] |= column[1:] != column[:-1]
            cuts = [0, *np.flatnonzero(fresh).tolist(), len(hub)]
            starts = np.array(cuts[:-1])
            names_at = zip(*(c[starts].tolist() for c in (hub, cell, key_group, chunk)), strict=True)
            turns = turn[starts].tolist()
            for start, end, name, later in zip(cuts[:-1], cuts[1:], names_at, turns, strict=True):
                if name != group:
                    if members and held is None:
                        hold()
                    group, members, held = name, [], None
                rows = (c1[start:end], part[start:end], n[start:end])
                sketched = _Sketches(words, offsets[start : end + 1])
                if not later:
                    members.append((*rows, main[start:end], sketched))
                elif members:  # else a chunk that got no member of its own
                    if held is None:
                        held = hold()
                    widths = np.minimum(sketched.sizes, held[3].shape[1])
                    for width in np.unique(widths).tolist():
                        at = np.flatnonzero(widths == width)
                        asking = (*(c[at] for c in rows), sketched.folded(width, at))
                        ask(asking, (*held[:3], _folded(held[3], width)))
            compare()
            if count > HELD_PAIRS:
                yield _paired(found)
                found, count = [], 0
        if members and held is None:
            hold()
            compare()
        if found:
            yield _paired(found)

    return (
        open_rows(open_, classes)
        .repartition("hub", "cell")
        .sortWithinPartitions("hub", "cell", "key_group", "chunk", "turn")
        .mapInArrow(run, "a long, b long, more array<long>")
        .groupBy("a", "b")
        .agg(F.array_distinct(F.flatten(F.collect_list("more"))).alias("more"))
    )


def _folded(words: np.ndarray, size: int) -> np.ndarray:
    """Sketches (rows of a matrix) folded to ``size`` words by the XOR of their halves."""
    while words.shape[-1] > size:
        half = words.shape[-1] // 2
        words = words[..., :half] ^ words[..., half:]
    return words


class _Sketches:
    """Sketches of several sizes, one after another."""

    def __init__(self, words: np.ndarray, offsets: np.ndarray):
        self.words, self.offsets, self.sizes = words, offsets, np.diff(offsets)

    def folded(self, size: int, of: np.ndarray | None = None) -> np.ndarray:
        """The sketches (only those at ``of``) as a matrix of ``size`` words a row."""
        if of is None:
            if len(self.sizes) * size == self.offsets[-1] - self.offsets[0]:  # none is larger
                return self.words[self.offsets[0] : self.offsets[-1]].reshape(-1, size)
            of = np.arange(len(self.sizes))
        out = np.zeros((len(of), size), self.words.dtype)
        for width in np.unique(self.sizes[of]).tolist():
            same = self.sizes[of] == width
            at = self.offsets[of[same]][:, None] + np.arange(width)
            out[same] = _folded(self.words[at], size)
        return out


def _nearest(jobs: list[tuple], limit: int) -> tuple:
    """Pairs (a, b) of the rows of each job with the ``limit`` nearest of those it is compared with,
    in another component and near enough to be linked; then places among these pairs and the key
    groups in which a row had more, each job's once.

    A job: key group, rows and others, both as columns c1, part, n and a matrix of sketches. All
    sketches have one size.
    """
    kept, of = THRESHOLD
    groups = np.array([job[0] for job in jobs], "int64")
    asked = np.array([len(job[1][0]) for job in jobs])
    others = np.array([len(job[2][0]) for job in jobs])

    def column(side: int, i: int) -> np.ndarray:
        return jobs[0][side][i] if len(jobs) == 1 else np.concatenate([job[side][i] for job in jobs])

    (c1, part, n, words), (c2, part2, n2, words2) = ([column(s, i) for i in range(4)] for s in (1, 2))
    job = np.repeat(np.arange(len(jobs)), asked)
    begin = _bounds(others[job])
    i = np.repeat(np.arange(len(job)), others[job])
    j = np.arange(begin[-1]) + (_bounds(others)[job] - begin[:-1])[i]
    least, most = np.minimum(n[i], n2[j]), np.maximum(n[i], n2[j])
    may = (part[i] != part2[j]) & (least * of >= most * kept)
    i, j, both = i[may], j[may], (least + most)[may]
    # Unsigned, since the bits of a negative number are counted in its absolute value.
    words, words2 = words.view("uint64"), words2.view("uint64")
    if len(jobs) == 1 and 3 * len(i) > begin[-1]:  # most of them: without a copy for each
        distance = np.bitwise_count(words[:, None] ^ words2).sum(axis=2, dtype="int64")[i, j]
    else:
        distance = np.bitwise_count(words[i] ^ words2[j]).sum(axis=1, dtype="int64")
    near = distance * (of + kept) <= both * (of - kept)
    i, j, distance = i[near], j[near], distance[near]
    # Of equal distances the smallest number, so that many rows choose the same one.
    order = np.lexsort((c2[j], distance, i))
    i, j = i[order], j[order]
    counts = np.bincount(i, minlength=len(job))
    first = _bounds(counts)[:-1]
    taken = np.arange(len(i)) - first[i] < limit
    more = np.flatnonzero(counts > limit)
    of_job, once = np.unique(job[more], return_index=True)
    places = (_bounds(taken)[:-1])[first[more[once]]] if len(more) else more
    i, j = i[taken], j[taken]
    return np.minimum(c1[i], c2[j]), np.maximum(c1[i], c2[j]), places, groups[of_job]


def _paired(found: list[tuple]) -> pa.RecordBatch:
    """The results of ``_nearest``, each pair once with the key groups noted at it."""
    a, b = (np.concatenate([x[i] for x in found]) for i in (0, 1))
    shift = _bounds([len(x[0]) for x in found])[:-1]
    at = np.concatenate([x[2] + begin for x, begin in zip(found, shift, strict=True)])
    groups = np.concatenate([x[3] for x in found])
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    fresh = np.ones(len(a), bool)
    fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    pair = np.zeros(len(a), "int64")
    pair[order] = np.cumsum(fresh) - 1
    pair = pair[at]
    offsets = _bounds(np.bincount(pair, minlength=int(fresh.sum()))).astype("int32")
    noted = groups[np.argsort(pair, kind="stable")]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(a[fresh]),
            pa.array(b[fresh]),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(noted)),
        ],
        names=["a", "b", "more"],
    )


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, words: int) -> DataFrame:
    """The pairs (a, b) whose sets qualify (some may be repeated). Set a meets its partners in
    blocks, streamed.

    Only the sets of classes that are in a pair are worked out again from their texts.
    """
    named = pairs.select(F.col("a").alias("c1")).union(pairs.select(F.col("b").alias("c1")))
    wanted = classes.join(named.distinct(), "c1", "left_semi").select("doc_id")
    sets = written(class_sets(docs, wanted, words), "class-sets")
    partners_of = written(
        pairs.groupBy("a").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("blocks")), "pair-blocks"
    )
    dealt = pairs.join(partners_of, "a").select(
        "a", "b", F.pmod(F.xxhash64("b"), F.col("blocks")).alias("block")
    )
    heads = (
        partners_of.select("a", F.explode(F.expr("sequence(0L, blocks - 1)")).alias("block"))
        .join(sets.withColumnRenamed("c1", "a"), "a")
        .select("a", "block", F.lit(0).alias("turn"), F.lit(0).cast("long").alias("b"), "shingles")
    )
    partners = dealt.join(sets.withColumnRenamed("c1", "b"), "b").select(
        "a", "block", F.lit(1).alias("turn"), "b", "shingles"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, head = None, None
        for batch in batches:
            out = []
            for a, block, turn, b, raw in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                found = np.frombuffer(raw, "uint64")
                if not turn:
                    current, head = (a, block), found
                elif current == (a, block):
                    shared = len(np.intersect1d(head, found, assume_unique=True))
                    if qualifies(shared, len(head), len(found)):
                        out.append((a, b))
            columns = zip(*out, strict=True) if out else ([], [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["a", "b"]
            )

    return (
        heads.union(partners)
        .repartition("a", "block")
        .sortWithinPartitions("a", "block", "turn")
        .mapInArrow(run, "a long, b long")
    )


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from each node of the links (a, b).

    Alternating large-star and small-star steps; every step is written, so lineage stays short.
    """
    edges = written(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v")
        .distinct(),
        "links",
    )
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Written, so that adaptive execution can split a node of very many links below.
        least = written(
            both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "star-least"
        )
        large = (
            both.where("v > u")
            .join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        large = written(large, "large-star")
        # Of these links every node has few.
        joined = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            joined.select("u", F.col("m").alias("v"))
        )
        edges = written(small.where("u <> v").distinct(), "small-star")
        # Done when every node has one link, to a node that has none itself.
        several = edges.groupBy("u").count().where("count > 1").select("u")
        inner = edges.select("u").join(edges.select(F.col("v").alias("u")), "u", "left_semi")
        if not several.union(inner).limit(1).count():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _rooted(nodes: DataFrame, roots: DataFrame, name: str) -> DataFrame:
    """``nodes`` with the root of their c1 (itself without links)."""
    return nodes.join(roots.withColumnRenamed("node", "c1"), "c1", "left").withColumn(
        name, F.coalesce("root", "c1")
    ).drop("root")


def linked_rows(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, h1, h2, n, part (the component's root) and component_id (its least doc_id) of every
    row; without shingles the last two are null."""
    sets = written(document_sets(docs, words), "document-sets")
    totals = sets.agg(F.count("*"), F.sum("n")).first()
    rows, shingle_count = totals[0], totals[1] or 0
    classes = written(
        sets.where("n > 0")
        .groupBy("c1", "c2")
        .agg(F.min("doc_id").alias("doc_id"), F.min("n").alias("n"), F.min("sketch").alias("sketch")),
        "set-classes",
    )
    slots = max(LEAST_SLOTS, shingle_count // SLOT_KEYS)
    frequent = frequent_keys(docs, rows, words)
    groups = written(key_groups(packed_keys(docs, frequent, slots, words), slots), "key-groups")

    # First every class of a key with the smallest one of the key.
    star = (
        groups.where("hub <> c1").select(F.col("hub").alias("a"), F.col("c1").alias("b")).distinct()
    )
    tried = written(_filtered(star, classes), "star-pairs")
    links = written(verified(tried, docs, classes, words), "star-links")
    roots = components(links)

    # Then, where a key's classes are in several components, each class outside the largest one with
    # its nearest in the others, with more of them each round, until no class has others. Components
    # only grow, so a key whose classes had no others needs no further round.
    tried, limit, grown = star, 1, True
    while True:
        if grown:
            labelled = written(_rooted(groups, roots, "part"), "key-parts")
            mixed = (
                labelled.groupBy("key_group")
                .agg(F.min("part").alias("least"), F.max("part").alias("most"))
                .where("least <> most")
                .select("key_group")
            )
            # What is whole by now stays so.
            groups = written(
                labelled.join(mixed, "key_group", "left_semi"), f"open-groups-{limit}"
            )
            if not groups.limit(1).count():
                break
        nearest = written(open_pairs(groups, classes, limit), "open-pairs")
        rest = written(
            nearest.select("a", "b").join(tried.select("a", "b"), ["a", "b"], "left_anti"),
            "open-untried",
        )
        grown = False
        if rest.limit(1).count():
            new = written(verified(rest, docs, classes, words), "open-links")
            grown = bool(new.limit(1).count())
        if grown:
            links = links.union(new)
            roots = components(links)
        unfinished = nearest.select(F.explode("more").alias("key_group"))
        if not unfinished.limit(1).count():
            break
        groups = groups.join(unfinished, "key_group", "left_semi")
        # Without new links the components, and so the parts, are as they were.
        groups = groups.drop("part") if grown else written(groups, f"open-groups-{limit}")
        tried, limit = tried.union(rest), limit * MORE

    rooted = _rooted(classes.select("c1", "c2", "doc_id"), roots, "part")
    named = written(
        rooted.groupBy("part").agg(F.min("doc_id").alias("component_id")), "component-names"
    )
    numbered = written(
        rooted.join(named, "part").select("c1", "c2", "part", "component_id"), "class-components"
    )
    return (
        sets.select("doc_id", "h1", "h2", "n", "c1", "c2")
        .join(numbered, ["c1", "c2"], "left")
        .select("doc_id", "h1", "h2", "n", "part", "component_id")
    )


def linked_documents(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    return linked_rows(docs, words).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id"))
        .otherwise(F.col("doc_id"))
        .alias("component_id"),
    )


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component: the one with the smallest doc_id, of several texts under that
    doc_id the one with the smallest hash. Documents without a doc_id or without words stay."""
    rows = written(
        linked_rows(docs).where("doc_id IS NOT NULL AND n > 0").drop("n"), "linked-rows"
    )
    # A row is known by its doc_id and its text: rows that agree in both are copies.
    first = rows.where("doc_id = component_id")
    heads = first.groupBy("part").agg(F.min(F.struct("h1", "h2")).alias("head"))
    other = first.join(heads, "part").where(F.struct("h1", "h2") != F.col("head"))
    key = ["doc_id", "h1", "h2"]
    gone = rows.where("doc_id <> component_id").select(key).union(other.select(key)).distinct()
    kept = _of_rows(docs, written(gone, "linked-away"), "left_anti")
    repeated = written(
        first.groupBy(key).count().where("count > 1").select(key), "repeated-rows"
    )
    if not repeated.limit(1).count():
        return kept
    name = "_" * (1 + max(len(c) for c in docs.columns))
    once = (
        _of_rows(kept, repeated, "left_semi")
        .withColumn(name, F.struct(F.col("doc_id").cast("long"), *_text_hash()))
        .dropDuplicates([name])
        .drop(name)
    )
    return _of_rows(kept, repeated, "left_anti").union(once)


def _text_hash() -> list[Column]:
    return hash128(F.col("text").cast("string"))


def _of_rows(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """The rows of ``docs`` that are (or are not) among ``rows``: doc_id, h1, h2."""
    h1, h2 = _text_hash()
    named = [F.col(c).alias(f"{c} of row") for c in ("doc_id", "h1", "h2")]
    same = (
        (F.col("doc_id").cast("long") == F.col("doc_id of row"))
        & (h1 == F.col("h1 of row"))
        & (h2 == F.col("h2 of row"))
    )
    return docs.join(rows.select(named), same, how)


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_documents(documents(spark, sf_dir))


QUERIES = {"op10_ngram_join": op10_ngram_join}

ORACLE: dict[str, str] = {}
