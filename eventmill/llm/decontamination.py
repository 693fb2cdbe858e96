"""Benchmark decontamination: benchmark items that stand in documents, up to a few edits.

An item of length n matches a place of a text when both differ by at most ``k = RATE * n`` edits
(and few enough that the lemma below says something). By the q-gram lemma such a place shares at
least ``n + 1 - q - k * q`` q-grams with the item, and all of them lie within ``k + 1`` neighbouring
diagonals (position in the text minus position in the item). So the shared q-grams are counted in
overlapping bands of ``2 (k + 1)`` diagonals; a band that reaches the bound is a region, and every
region is verified by an alignment banded to its diagonals. A band counts each q-gram of the item
once, however often the text repeats it: a match shares that many *different* places of the item. The
filter loses nothing: a match always reaches the bound in some band.

Texts and items are compared lower-cased, every run of ASCII white space as one blank; an item's outer white
space does not count. Places are code points of the text as it stands. The benchmark is read in blocks
of about ``BLOCK_CHARS`` characters, one after the other, each with a job of its own; one block's
q-grams are what the driver and each Python worker hold. Every text is scanned whole, in overlapping
stretches of ``STRETCH`` characters, and a stretch's shared q-grams in slices of about ``POSTINGS``.
A run of one repeated character is one entry per place of an item and band, not one per character.

Defined results: a null or empty text has no match; a null, empty or blank item matches nothing; an
item shorter than q only matches a text that equals it; equal items are reported each; repeated rows
are scanned each; an empty benchmark leaves every document clean; other columns are passed through.
"""

from __future__ import annotations

import bisect
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.llm.common import documents, table
from eventmill.session import written

Q = 12
RATE = 0.05
BLOCK_CHARS = 1_000_000
STRETCH = 1 << 18
POSTINGS = 1 << 21
HITS = "array<struct<item_id:long,start:int,end:int,edits:int>>"
BLANKS = re.compile("  +")
#: Multiplier of the rolling hash (odd, so that it is invertible).
BASE = np.uint64(0x9E3779B97F4A7C15)


def normal(text: str) -> str:
    """Lower-cased, every run of white space as one blank."""
    return squeezed(text)[0]


def squeezed(text: str) -> tuple[str, np.ndarray | None]:
    """:func:`normal` and, where that is shorter than the text, the place of each character in it."""
    lower = text.lower()
    if len(lower) != len(text):
        lower = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    for other in "\t\n\x0b\x0c\r":
        lower = lower.replace(other, " ")
    if "  " not in lower:
        return lower, None
    dropped = np.zeros(len(lower), bool)
    for run in BLANKS.finditer(lower):
        dropped[run.start() + 1 : run.end()] = True
    return BLANKS.sub(" ", lower), np.flatnonzero(~dropped)


def characters(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def gram_hashes(chars: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit hash of every q-gram, built by doubling."""
    if len(chars) < q:
        return np.zeros(0, "uint64")
    part, size = chars.astype("uint64") * BASE, 1
    part ^= part >> np.uint64(29)
    whole, done = None, 0
    power = BASE
    rest = q
    while rest:
        if rest & 1:
            if whole is None:
                whole, done = part, size
            else:
                n = len(chars) - done - size + 1
                whole = whole[:n] * power + part[done : done + n]
                done += size
        rest >>= 1
        if rest:
            n = len(part) - size
            part = part[:n] * power + part[size : size + n]
            power = np.uint64(int(power) ** 2 % (1 << 64))
            size *= 2
    return whole ^ (whole >> np.uint64(32))


def edit_budget(length: int, q: int = Q, rate: float = RATE) -> int:
    """Edits allowed for an item: such that the lemma still asks for one shared q-gram."""
    return max(0, min(int(rate * length), (length - q) // q))


@dataclass
class Index:
    """The q-grams of a block of items."""

    ids: list[int]
    texts: list[str]
    short: dict[str, list[int]]
    grams: np.ndarray  # sorted hashes, one per place in an item
    items: np.ndarray
    places: np.ndarray
    lengths: np.ndarray
    budgets: np.ndarray
    needs: np.ndarray
    member: np.ndarray  # by the low bits of a hash: whether some item may hold it
    mask: np.uint64


def build_index(rows: list[tuple[int, str]], q: int = Q, rate: float = RATE) -> Index:
    ids, texts, short = [], [], {}
    for item_id, text in rows:
        text = normal(text or "").strip()
        if len(text) >= q:
            ids.append(item_id)
            texts.append(text)
        elif text:
            short.setdefault(text, []).append(item_id)
    hashes = [gram_hashes(characters(t), q) for t in texts]
    empty = np.zeros(0, "int64")
    grams = np.concatenate(hashes) if hashes else np.zeros(0, "uint64")
    items = np.concatenate([np.full(len(h), i) for i, h in enumerate(hashes)] or [empty])
    places = np.concatenate([np.arange(len(h)) for h in hashes] or [empty])
    order = np.argsort(grams, kind="stable")
    lengths = np.array([len(t) for t in texts], "int64")
    budgets = np.array([edit_budget(n, q, rate) for n in lengths], "int64")
    size = 1 << max(16, math.ceil(math.log2(max(1, 16 * len(grams)))))
    member = np.zeros(size, bool)
    mask = np.uint64(size - 1)
    member[grams & mask] = True
    return Index(
        ids, texts, short, grams[order], items[order], places[order], lengths, budgets,
        lengths + 1 - q - budgets * q, member, mask,
    )


def _ends(pattern: np.ndarray, text: np.ndarray, low: int, high: int, first: np.ndarray):
    """Costs of the whole pattern by its last diagonal; ``first`` are the costs before it."""
    diagonals = np.arange(low, high + 1)
    padded = np.full(len(text) + len(pattern) + len(diagonals) * 2 + 2, 0xFFFFFFFF, "uint32")
    shift = len(diagonals) + max(0, -low) + 1
    if shift + len(text) > len(padded):
        padded = np.concatenate([padded, np.full(shift + len(text), 0xFFFFFFFF, "uint32")])
    padded[shift : shift + len(text)] = text
    ramp = np.arange(len(diagonals))
    costs = first.astype("int64")
    beyond = np.int64(1 << 40)
    for i, c in enumerate(pattern):
        at = shift + i + low
        same = padded[at : at + len(diagonals)] == c
        inside = (diagonals + i >= 0) & (diagonals + i < len(text))
        straight = np.where(inside, costs + ~same, beyond)
        skipped = np.append(costs[1:], beyond) + 1  # a character of the pattern without partner
        best = np.minimum(straight, skipped)
        costs = np.minimum.accumulate(best - ramp) + ramp  # characters of the text without partner
    return costs, diagonals


def align(pattern: str, text: str, low: int, high: int, budget: int) -> tuple[int, int, int] | None:
    """(start, end, edits) of the best place of ``pattern`` whose path keeps to the diagonals
    ``low`` to ``high`` widened by the budget; None when it takes more edits than the budget."""
    at = text.find(pattern, max(0, low), max(0, high) + len(pattern))
    if at >= 0:
        return at, at + len(pattern), 0
    if not budget:
        return None
    first, last = max(0, low - budget), min(len(text), high + len(pattern) + 2 * budget)
    p, t = characters(pattern), characters(text[first:last])
    low, high = low - budget - first, high + budget - first
    start_free = np.where(np.arange(low, high + 1) >= 0, 0, 1 << 40)
    costs, diagonals = _ends(p, t, low, high, start_free)
    ok = diagonals + len(p) <= len(t)
    costs = np.where(ok, costs, 1 << 40)
    best = int(np.argmin(costs))
    edits = int(costs[best])
    if edits > budget:
        return None
    end = len(p) + int(diagonals[best])
    back = np.arange(-budget, budget + 1)
    fixed = np.where(back >= 0, back, 1 << 40)
    costs, back = _ends(p[::-1], t[:end][::-1], -budget, budget, fixed)
    length = len(p) + int(back[int(np.argmin(np.where(back + len(p) <= end, costs, 1 << 40)))])
    return first + end - length, first + end, edits


def _regions(chars: np.ndarray, index: Index, q: int):
    """(item, lowest diagonal, highest diagonal) of the bands that reach the lemma's bound."""
    hashes = gram_hashes(chars, q)
    if not len(hashes) or not len(index.grams):
        return
    hit = index.member[hashes & index.mask]
    least = int(index.needs.min())
    if np.count_nonzero(hit) < least:
        return
    # No band can reach its bound unless so many q-grams lie within the longest item's reach.
    reach = int((index.lengths + 3 * index.budgets + 2).max())
    total = np.concatenate(([0], np.cumsum(hit)))
    ends = np.minimum(np.arange(len(hit)) + reach, len(hit))
    dense = hit & (total[ends] - total[np.maximum(np.arange(len(hit)) - reach, 0)] >= least)
    at = np.flatnonzero(dense)
    if len(at) < least:
        return
    left = np.searchsorted(index.grams, hashes[at], "left")
    n = np.searchsorted(index.grams, hashes[at], "right") - left
    at, left, n = at[n > 0], left[n > 0], n[n > 0]
    if not len(at):
        return
    # Neighbouring places with one q-gram, as in a run of one character, are one entry.
    new = np.flatnonzero(
        np.concatenate(([True], (np.diff(at) != 1) | (left[1:] != left[:-1])))
    )
    first, last = at[new], at[np.concatenate((new[1:], [len(at)])) - 1]
    left, n = left[new], n[new]
    shift = int(index.lengths.max())
    wide = np.int64(len(chars) + shift + 2)
    slices = np.unique(np.searchsorted(np.cumsum(n), np.arange(0, n.sum(), POSTINGS), "left"))
    met = []
    for low, high in zip(slices, [*slices[1:], len(n)], strict=True):
        met.append(_met(index, first[low:high], last[low:high], left[low:high], n[low:high], shift, wide))
    keys = np.unique(np.concatenate(met)) if len(met) > 1 else met[0]
    keys, counts = np.unique(
        index.items[keys // (wide + 1)] * (wide + 1) + keys % (wide + 1), return_counts=True
    )
    keep = counts >= index.needs[keys // (wide + 1)]
    for key in keys[keep]:
        item, band = int(key // (wide + 1)), int(key % (wide + 1)) - 1
        w = int(index.budgets[item]) + 1
        low = band * w - shift
        yield item, low, low + 2 * w - 1


def _met(index: Index, first, last, left, n, shift: int, wide) -> np.ndarray:
    """Which posting of the index is met in which band: ``posting * (wide + 1) + band + 1``, each
    once. An entry is the places ``first`` to ``last`` of the text with the q-gram of ``n`` postings
    from ``left`` on."""
    posting = np.repeat(left - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
    width = index.budgets[index.items[posting]] + 1
    place = index.places[posting] - shift
    low = (np.repeat(first, n) - place) // width - 1
    bands = (np.repeat(last, n) - place) // width - low + 1
    out = []
    # Of long entries many bands come out, again taken in slices.
    slices = np.unique(np.searchsorted(np.cumsum(bands), np.arange(0, bands.sum(), POSTINGS), "left"))
    for a, b in zip(slices, [*slices[1:], len(bands)], strict=True):
        m = bands[a:b]
        step = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
        out.append(
            np.unique(np.repeat(posting[a:b] * (wide + 1) + low[a:b] + 1, m) + step)
        )
    return np.unique(np.concatenate(out)) if len(out) > 1 else out[0]


def find_items(text: str | None, index: Index, q: int = Q) -> list[tuple[int, int, int, int]]:
    """(item_id, start, end, edits) of all matches: the best place of each run of bands."""
    if not text:
        return []
    length = len(text)
    text, places = squeezed(text)
    out = [(i, 0, length, 0) for i in index.short.get(text.strip(), ())]
    if not index.texts:
        return out
    overlap = int((index.lengths + 4 * index.budgets + 4).max())
    best: dict[int, list[tuple[int, int, int]]] = {}  # per item, in order and disjoint
    for at in range(0, max(1, len(text) - overlap), STRETCH):
        stretch = text[at : at + STRETCH + overlap]
        for item, low, high in _regions(characters(stretch), index, q):
            found = align(index.texts[item], stretch, low, high, int(index.budgets[item]))
            if found:
                _keep(best.setdefault(item, []), found[0] + at, found[1] + at, found[2])
    for item, kept in best.items():
        for start, end, edits in kept:
            if places is not None:
                start, end = int(places[start]), int(places[end - 1]) + 1
            out.append((index.ids[item], start, end, edits))
    return sorted(out, key=lambda h: (h[1], h[0], h[2]))


def _keep(kept: list[tuple[int, int, int]], start: int, end: int, edits: int) -> None:
    """Add a place unless one that overlaps it is as good; worse ones that overlap it go.
    Neighbouring bands find the same place, or one that overlaps it."""
    low = bisect.bisect_right(kept, start, key=lambda k: k[1])
    high = bisect.bisect_left(kept, end, key=lambda k: k[0])
    if all(k[2] > edits for k in kept[low:high]):
        kept[low:high] = [(start, end, edits)]


def benchmark_blocks(items: DataFrame, block_chars: int | None = None) -> Iterator[list[tuple]]:
    """The benchmark in blocks of about ``block_chars`` characters, each collected when its turn
    comes; one empty block for an empty benchmark."""
    rows = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where(
        "text IS NOT NULL"
    )
    chars = rows.agg(F.sum(F.char_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(chars / (block_chars or BLOCK_CHARS)))
    for block in range(blocks):
        of_block = F.pmod(F.xxhash64("text", "item_id"), F.lit(blocks)) == block
        yield [(r["item_id"], r["text"]) for r in rows.where(of_block).collect()]


def matches(text: Column, rows: list[tuple], q: int = Q, rate: float = RATE) -> Column:
    """Array of (item_id, start, end, edits) of the items of one block that stand in a text."""
    index = build_index(rows, q, rate)

    @F.pandas_udf(HITS)
    def hits(texts: pd.Series) -> pd.Series:
        names = ("item_id", "start", "end", "edits")
        return pd.Series(
            [[dict(zip(names, h, strict=True)) for h in find_items(t, index, q)] for t in texts],
            dtype=object,
        )

    return hits(text.cast("string"))


def all_matches(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, item_id, start, end, edits`` of every place of an item in a document; each block of
    the benchmark is one scan of the documents, written before the next one starts."""
    parts = []
    for rows in benchmark_blocks(items):
        found = docs.select("doc_id", F.explode(matches(F.col("text"), rows)).alias("hit"))
        parts.append(written(found.select("doc_id", "hit.*"), "benchmark-hits"))
    return reduce(DataFrame.unionByName, parts)


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no item stands; a block scans what the blocks before it left."""
    for number, rows in enumerate(benchmark_blocks(items)):
        if number:
            docs = written(docs, "benchmark-clean")
        docs = docs.where(F.size(matches(F.col("text"), rows)) == 0)
    return docs


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item stands."""
    return clean(docs, table(spark, sf_dir, "benchmark"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place of a benchmark item in a document."""
    return all_matches(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


QUERIES = {"op4_decontamination": op4_decontamination}

ORACLE: dict[str, str] = {}
