"""Best-fit packing of token pieces into sequences by bin completion.

Documents become token ids (one closing id 0 each); only those longer than a sequence are cut. How
pieces share sequences depends on their lengths alone, so the packing is planned on the histogram
of lengths: at most ``capacity`` numbers, however many documents there are. The plan is bin
completion with branch and bound. Around the longest open length the undominated fillings are
enumerated (a filling is dominated when a swap of one of its pieces for a longer unused one still
fits); a filling is applied as often as its counts allow; a branch is cut when the sequences used,
plus the least number that the rest can need, reach the incumbent. The first incumbent is best-fit
decreasing, so a search that is stopped early still returns a packing at least that good.

Spark does the rest: tokens are counted per task, pieces of one length are numbered by task (a
number within the task plus the offset of the task), and each piece looks its number up in the plan.
The plan has at most a few entries per length.

Python runs in bounded batches. Recovery: a repeated task reads the same rows in the same order and
writes the same numbers; pieces are written to the shared folder before they are numbered.

Defined results: a null or empty text is one piece holding only id 0; a document of exactly the
capacity is one piece; repeated rows are packed each; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventmill.llm.common import documents
from eventmill.session import written

CAPACITY = 2048
END_ID = 0
#: Fillings looked at in the whole search, and per open length; beyond, the incumbent stands.
SEARCH_NODES = 4_000
FILLINGS = 12
VOCABULARY = "word_bpe_49k.json"
#: Words whose ids a worker remembers; the table is emptied when full, which costs time only.
REMEMBERED = 700_000

PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("task", pa.int32()),
        ("place", pa.int64()),
    ]
)
PLACED = pa.schema(
    [*list(PIECES)[:5], pa.field("sequence_id", pa.int64()), pa.field("offset", pa.int64())]
)


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.int32(): "int"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordIds(dict):
    """Little-endian uint32 ids of a white-space free chunk of UTF-8, worked out when missing.

    The tokenizer lower-cases, drops white space and never merges across it, so a text's ids are
    its chunks' ids in turn. ASCII letters are lower-cased before lookup.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.alphabet = byte_alphabet()

    def __missing__(self, chunk: bytes) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        core = chunk.rstrip(b".,;:!?")
        word = core.decode()
        plain = word.isalpha() and max(word) < "ɐ" and "İ" not in word
        if plain and core != chunk:
            ids = self[core] + self[chunk[len(core) :]]
        elif plain:
            letters = word.lower().encode().decode("latin-1").translate(self.alphabet)
            ids = self._packed(t.id for t in self.model.tokenize(letters))
        else:
            text = chunk.decode()
            ids = self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        self[chunk] = ids
        return ids

    @staticmethod
    def _packed(ids) -> bytes:
        return np.fromiter(ids, "<u4").tobytes()

    def of(self, text: str) -> bytes:
        """Ids of a whole text."""
        raw = text.encode()
        if b"<|" in raw:  # the names of special tokens are read before lower-casing
            return self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return b"".join(map(self.__getitem__, raw.lower().replace(b"\n", b" ").split(b" ")))


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in shown}
    hidden = [b for b in range(256) if b not in out]
    return out | {b: chr(256 + i) for i, b in enumerate(hidden)}


_WORD_IDS: dict[str, WordIds] = {}


def _word_ids(path: str) -> WordIds:
    if path not in _WORD_IDS:
        _WORD_IDS[path] = WordIds(path)
    return _WORD_IDS[path]


def cut(text: str, ids: WordIds, capacity: int) -> list[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of a text's pieces."""
    packed = ids.of(text) + END_ID.to_bytes(4, "little")
    step = 4 * capacity
    return [
        (i, at // 4, len(part := packed[at : at + step]) // 4, zlib.crc32(part))
        for i, at in enumerate(range(0, len(packed), step))
    ]


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """The pieces of all documents; ``place`` numbers those of one length within a task."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ids, task = _word_ids(path), TaskContext.get().partitionId()
        counts = [0] * (capacity + 1)
        for batch in batches:
            rows = []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for piece, start, length, crc in cut(text or "", ids, capacity):
                    rows.append((doc_id, piece, start, length, crc, task, counts[length]))
                    counts[length] += 1
            columns = zip(*rows, strict=True) if rows else [[] for _ in PIECES]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, PIECES.types, strict=True)], schema=PIECES
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, _ddl(PIECES)
    )


# --- planning on the histogram ---------------------------------------------------------------


def least_sequences(counts: list[int], capacity: int) -> int:
    """A lower bound: the total length, and the pieces of which no two fit together."""
    best = -(-sum(length * n for length, n in enumerate(counts)) // capacity)
    for limit in (capacity // 3, capacity // 4, capacity // 8, 1):
        large = sum(counts[capacity // 2 + 1 :])
        room = sum(
            (capacity - k) * counts[k] for k in range(capacity // 2 + 1, capacity - limit + 1)
        )
        small = sum(k * counts[k] for k in range(limit, capacity // 2 + 1))
        best = max(best, large + max(0, -(-(small - room) // capacity)))
    return best


def _present(counts: list[int]) -> list[int]:
    return [length for length, n in enumerate(counts) if n]


def fillings(room: int, counts: list[int], most: int = FILLINGS) -> list[tuple[int, ...]]:
    """Undominated fillings of ``room`` from the counts, fullest first."""
    lengths = _present(counts[: room + 1])
    found: list[tuple[int, tuple[int, ...]]] = []
    looked = 0

    def extend(left: int, chosen: list[int]) -> None:
        nonlocal looked
        looked += 1
        if looked > 20 * most or (len(found) >= most and found[-1][0] == 0):
            return
        at = bisect.bisect_right(lengths, min(left, chosen[-1] if chosen else room)) - 1
        grew = 0
        while at >= 0 and grew < 4:
            length = lengths[at]
            if chosen.count(length) < counts[length]:
                chosen.append(length)
                extend(left - length, chosen)
                chosen.pop()
                grew += 1
            at -= 1
        if not grew:
            found.append((left, tuple(chosen)))
            found.sort()
            del found[most:]

    extend(room, [])

    def dominated(left: int, chosen: tuple[int, ...]) -> bool:
        """A longer unused piece would fit in the place of one of the filling."""
        for length in set(chosen):
            at = bisect.bisect_right(lengths, length)
            if at < len(lengths) and lengths[at] <= length + left:
                if chosen.count(lengths[at]) < counts[lengths[at]]:
                    return True
        return False

    kept = [f for f in dict.fromkeys(found) if not dominated(*f)]
    return [chosen for _, chosen in (kept or found[:1])]


Plan = list[tuple[tuple[int, ...], int]]


def _applied(bin_: tuple[int, ...], counts: list[int]) -> int:
    """How often a sequence of these lengths can be filled from the counts."""
    return min(counts[length] // bin_.count(length) for length in set(bin_))


def _take(counts: list[int], bin_: tuple[int, ...], times: int) -> list[int]:
    left = counts.copy()
    for length in bin_:
        left[length] -= times
    return left


def best_fit(counts: list[int], capacity: int) -> Plan:
    """Best-fit decreasing on a histogram: around the longest piece, always the longest that fits."""
    plan: Plan = []
    while lengths := _present(counts):
        chosen = [lengths[-1]]
        left = capacity - chosen[0]
        at = len(lengths) - 1
        while at >= 0:
            if lengths[at] <= left and chosen.count(lengths[at]) < counts[lengths[at]]:
                chosen.append(lengths[at])
                left -= lengths[at]
            else:
                at = min(at - 1, bisect.bisect_right(lengths, left) - 1)
        plan.append((tuple(chosen), _applied(tuple(chosen), counts)))
        counts = _take(counts, *plan[-1])
    return plan


def bin_completion(
    histogram: dict[int, int], capacity: int = CAPACITY, nodes: int = SEARCH_NODES
) -> Plan:
    """(lengths of a sequence, how many such sequences) for a histogram of piece lengths."""
    counts = [0] * (capacity + 1)
    for length, n in histogram.items():
        counts[int(length)] += int(n)
    best = best_fit(counts, capacity)
    best_used = sum(times for _, times in best)
    bound = least_sequences(counts, capacity)
    # Depth first; an entry is the counts before its sequence is taken, the sequences used
    # before, and the plan so far as a linked list whose head is the sequence to take.
    stack: list[tuple[list[int], int, tuple | None]] = [(counts, 0, None)]
    looked = 0
    while stack and best_used > bound and looked < nodes:
        left, used, plan = stack.pop()
        looked += 1
        if plan:
            left, used = _take(left, *plan[0]), used + plan[0][1]
        lengths = _present(left)
        if not lengths:
            if used < best_used:
                best_used, best = used, []
                while plan:
                    best.append(plan[0])
                    plan = plan[1]
                best.reverse()
            continue
        # Waste bound: even without further waste this branch needs so many sequences.
        if used + -(-sum(k * left[k] for k in lengths) // capacity) >= best_used:
            continue
        first = lengths[-1]
        rest = _take(left, (first,), 1)
        for filling in reversed(fillings(capacity - first, rest)):  # the fullest comes first
            bin_ = (first, *filling)
            stack.append((left, used, ((bin_, _applied(bin_, left)), plan)))
    return best


def segments(plan: Plan) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of each length: from which number on, in which first sequence, at which offset."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for bin_, times in plan:
        offset = 0
        for length in bin_:
            number = taken.get(length, 0)
            out.setdefault(length, []).append((number, sequence, offset))
            taken[length] = number + times
            offset += length
        sequence += times
    return {k: tuple(np.array(c, "int64") for c in zip(*v, strict=True)) for k, v in out.items()}


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """The pieces of all documents with sequence_id and offset."""
    cut_up = written(pieces(docs, capacity, path), "pieces")
    per_task = cut_up.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = (
        Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    )
    firsts = per_task.select(
        "task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    )
    histogram = {
        r["length"]: r["n"]
        for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()
    }
    plan = segments(bin_completion(histogram, capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            numbers = batch.column("number").to_numpy()
            sequence, offset = np.zeros(len(lengths), "int64"), np.zeros(len(lengths), "int64")
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                starts, sequences, offsets = plan[int(length)]
                at = np.searchsorted(starts, numbers[rows], side="right") - 1
                sequence[rows] = sequences[at] + numbers[rows] - starts[at]
                offset[rows] = offsets[at]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence), pa.array(offset)], schema=PLACED
            )

    numbered = cut_up.join(firsts, ["task", "length"]).select(
        *PLACED.names[:5], (F.col("first") + F.col("place")).alias("number")
    )
    return numbered.mapInArrow(place, _ddl(PLACED))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))


QUERIES = {"op3_best_fit_packing": op3_best_fit_packing}

ORACLE: dict[str, str] = {}
