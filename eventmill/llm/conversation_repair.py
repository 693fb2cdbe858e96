"""Conversation structure repair: rank-convergence parallel Viterbi.

The cheapest edits that give a conversation's role initials the form ``(s?(ua)+)?`` are a shortest
path through an automaton of four states (nothing yet, after the system turn, after a user turn, after
an assistant turn): keep, rerole and delete read a row, insert does not. Costs to go run from the last
row to the first as vectors of four numbers, and only differences within a vector matter, so a vector
is known by its number in a table of all that can occur, normalised (:func:`_tables`; a few dozen).

A conversation of any length is cut into chunks of rows that are worked on in parallel. A chunk does
not know the vector behind its last row, so it starts from speculative ones: all that can occur, at
once, and it has converged when they differ only by constants, which mostly takes a few rows. Fix-up
passes over the chunks' summaries go on until every vector is known: a chunk whose right neighbour is
known applies itself to the neighbour's vector; one whose neighbour has not converged either takes it
over and looks past it, so passes grow with the logarithm of a run of such chunks. The stitched
vectors drive the trace: at each step the ASCII-least edit on a cheapest path. The state a chunk's trace
starts in comes from the chunks before it, by the same passes from the left.

Rows are ordered by a range shuffle on (conv_id, turn, role, text), so a conversation that holds a
third of all rows is spread over tasks; equal texts are found by an aggregate over hashes. In the end
a conversation's rows stream through one task in order, since a hash of its repaired text and one row
of its audit are asked for: memory is a batch of rows and the audit.

Defined results: a null conv_id is a conversation, a null turn sorts first, null roles and texts are
one blank; rows of one turn are taken by role, text (its first 64 characters, then a hash) and copies
last; repeated rows are rows; a conversation without rows after the damage has zeros, an empty audit
and the hash of the empty text; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventmill.llm.common import hash128, table
from eventmill.session import written

BLANK = " \t\n\v\f\r"
#: Rows of a chunk; a power of two.
CHUNK_ROWS = 4096

#: States: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after an inserted or reroled turn.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
#: Faults of a row, by number.
NONE, IS_BLANK, IS_DUPLICATE, IS_TRUNCATED = range(4)
INITIALS = ("s", "u", "a")
LEGAL = {"su", "ua", "au"}
_FAR = 1 << 20


# --- the automaton -------------------------------------------------------------------------------


def kept_state(state: int, initial: str) -> int | None:
    """The state after keeping a row whose role starts so; None where that is not allowed."""
    if initial == "s" and state == START:
        return SYSTEM
    if initial == "u" and state != USER:
        return USER
    return ASSISTANT if initial == "a" and state == USER else None


def _with_inserts(costs: list[int]) -> tuple[int, ...]:
    user = min(costs[USER], INSERT + costs[ASSISTANT])
    assistant = min(costs[ASSISTANT], INSERT + costs[USER])
    return (min(costs[START], INSERT + user), min(costs[SYSTEM], INSERT + user), user, assistant)


def _edits(kind: tuple[str, int], after: tuple[int, ...], state: int) -> dict[str, tuple[int, int]]:
    """The edits that read a row: (cost to the end, next state) by their initial."""
    initial, fault = kind
    out = {"D": (DELETE + after[state], state)}
    if fault not in (IS_BLANK, IS_DUPLICATE):
        more = TRUNCATED * (fault == IS_TRUNCATED)
        if (kept := kept_state(state, initial)) is not None:
            out["K"] = (more + after[kept], kept)
        out["R"] = (more + REROLE + after[NEXT[state]], NEXT[state])
    return out


def _before(kind: tuple[str, int], after: tuple[int, ...]) -> tuple[int, ...]:
    return _with_inserts(
        [min(cost for cost, _ in _edits(kind, after, state).values()) for state in range(4)]
    )


def _trace(kind: tuple[str, int], after: tuple[int, ...], state: int) -> tuple[str, int]:
    """The ASCII-least edits on a cheapest path up to and with the one that reads the row."""
    costs, done = _before(kind, after), ""
    while True:
        ways = {c: to for c, (cost, to) in _edits(kind, after, state).items() if cost == costs[state]}
        if INSERT + costs[NEXT[state]] == costs[state]:
            ways["I"] = NEXT[state]
        least = min(ways)
        done, state = done + least, ways[least]
        if least != "I":
            return done, state


def kind_number(initial: str, fault: int) -> int:
    return 4 * (INITIALS.index(initial) if initial in INITIALS else 3) + fault


KINDS = [(initial, fault) for initial in (*INITIALS, "") for fault in range(4)]
#: Costs to go behind the last row: the end is allowed with nothing or after an assistant turn.
END = _with_inserts([0, _FAR, _FAR, 0])
#: The inserts behind the last row.
TAIL = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}


@functools.cache
def _tables() -> tuple[list[list[int]], list[list[list[tuple[str, int]]]]]:
    """By kind of row and number of the normalised vector behind it: the number of the one before
    it, and per state the edits and the state behind it. Vector 0 is that of the end."""
    number, vectors, step = {}, [], [[] for _ in KINDS]

    def of(costs):
        normal = tuple(c - min(costs) for c in costs)
        if normal not in number:
            number[normal] = len(vectors)
            vectors.append(normal)
        return number[normal]

    of(END)
    trace = [[] for _ in KINDS]
    at = 0
    while at < len(vectors):
        for k, kind in enumerate(KINDS):
            step[k].append(of(_before(kind, vectors[at])))
            trace[k].append([_trace(kind, vectors[at], state) for state in range(4)])
        at += 1
    return step, trace


# --- rows after the damage -----------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text, copy) after the damage by crc32 of conv_id and turn."""
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")),
        F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), F.lit(" ")),
    )
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    hit = F.col("hit")
    copies = F.when(hit == 0, F.array().cast("array<int>")).when(
        hit == 3, F.array(F.lit(0), F.lit(1))
    )
    return (
        conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                             (F.crc32(key.cast("binary")) % 20).alias("hit"))
        .select(
            "conv_id",
            "turn",
            F.when(hit == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(hit == 1, "")
            .when(hit == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text"))
            .alias("text"),
            F.explode(copies.otherwise(F.array(F.lit(0)))).alias("copy"),
        )
    )


def in_order(rows: DataFrame) -> DataFrame:
    """The rows with ``pos``, a number that grows along each conversation."""
    keys = [
        F.col("conv_id"),
        F.col("turn"),
        F.substring("role", 1, 64),
        F.substring("text", 1, 64),
        F.xxhash64("role", "text"),
        F.col("copy"),
    ]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    numbered = placed.select(
        "conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("pos")
    )
    return written(numbered, "conversation-rows")


def with_kinds(rows: DataFrame) -> DataFrame:
    """(conv_id, pos, initial, fault) of every row; the first fault counts."""
    firsts = (
        rows.select("conv_id", "pos", *hash128("role", "text"))
        .groupBy("conv_id", "h1", "h2")
        .agg(F.min("pos").alias("pos"))
        .select("pos", F.lit(True).alias("first"))
    )
    shown = F.rtrim(F.col("text"), F.lit(BLANK))
    narrow = rows.select(
        "conv_id",
        "pos",
        F.substring("role", 1, 1).alias("initial"),
        (shown == "").alias("blank"),
        (~F.substring(shown, -1, 1).isin(".", "!", "?")).alias("truncated"),
    )
    fault = (
        F.when(F.col("blank"), IS_BLANK)
        .when(F.col("first").isNull(), IS_DUPLICATE)
        .when(F.col("truncated"), IS_TRUNCATED)
        .otherwise(NONE)
    )
    return narrow.join(firsts, "pos", "left").select(
        "conv_id", "pos", "initial", fault.cast("int").alias("fault")
    )


# --- chunks --------------------------------------------------------------------------------------


def _columns(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*[batch.column(name).to_pylist() for name in names], strict=True)


def _chunks(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple[tuple, list[tuple]]]:
    """The rows of each chunk, which stand together; a chunk is at most ``CHUNK_ROWS`` rows."""
    current, rows = None, []
    for batch in batches:
        for row in _columns(batch, "conv_id", "chunk", *names):
            if row[:2] != current:
                if rows:
                    yield current, rows
                current, rows = row[:2], []
            rows.append(row[2:])
    if rows:
        yield current, rows


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = list(zip(*held, strict=True)) or [[] for _ in schema]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
        )

    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield batch()
            held.clear()
    yield batch()


def _speculate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per chunk: the vector before it for every vector that can stand behind it."""
    step, _ = _tables()
    every = list(range(len(step[0])))

    def summaries():
        for (conv, chunk), rows in _chunks(batches, "initial", "fault"):
            front = every
            for initial, fault in reversed(rows):
                by = step[kind_number(initial, fault)]
                if len(set(front)) == 1:  # converged: one vector, up to a constant
                    front = [by[front[0]]] * len(front)
                else:
                    front = [by[v] for v in front]
            yield conv, chunk, front

    yield from _batched(summaries(), _MAPS)


def _schema(*fields: tuple[str, pa.DataType]) -> pa.Schema:
    return pa.schema([("conv_id", pa.int64()), *fields])


_MAPS = _schema(("chunk", pa.int64()), ("map", pa.list_(pa.int32())))


def stitch(maps: DataFrame, neighbour: str, outer: int) -> DataFrame:
    """What comes into every chunk from its ``neighbour`` (the next or the last chunk of the
    conversation; null at the end, where ``outer`` comes in), in fix-up passes.

    ``maps``: (conv_id, chunk, next, last, map); ``map`` says what goes out for what comes in. A pass
    applies a chunk to what is known of its neighbour, or takes its neighbour's map over and
    looks past it.
    """
    ends = F.col(neighbour).isNull()
    constant = F.size(F.array_distinct("map")) == 1
    state = written(
        maps.select(
            "conv_id",
            "chunk",
            F.col(neighbour).alias("at"),
            F.col("map").alias("through"),
            F.when(ends, F.get("map", F.lit(outer)))
            .when(constant, F.get("map", F.lit(0)))
            .alias("out"),
        ),
        "chunk-maps",
    )
    while not state.where(F.col("out").isNull()).isEmpty():
        other = state.select(
            F.col("conv_id").alias("c"),
            F.col("chunk").alias("n"),
            F.col("at").alias("far"),
            F.col("through").alias("beyond"),
            F.col("out").alias("known"),
        )
        joined = state.join(
            other,
            F.col("conv_id").eqNullSafe(F.col("c"))
            & (F.col("at") == F.col("n"))
            & F.col("out").isNull(),
            "left",
        )
        composed = F.transform("beyond", lambda v: F.get("through", v))
        known = F.col("out").isNotNull()
        state = written(
            joined.select(
                "conv_id",
                "chunk",
                F.when(known, F.col("at")).otherwise(F.col("far")).alias("at"),
                F.when(known, F.col("through")).otherwise(composed).alias("through"),
                F.coalesce("out", F.get("through", F.col("known"))).alias("out"),
            ),
            "chunk-maps",
        )
    found = state.select(F.col("conv_id").alias("c"), F.col("chunk").alias("n"), "out")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col(neighbour) == F.col("n"))
    return maps.join(found, same, "left").select(
        "conv_id", "chunk", "next", "last", F.coalesce("out", F.lit(outer)).alias("incoming")
    )


def _trace_chunk(rows: list[tuple], behind: int, state: int) -> tuple[list[str], int]:
    """The edits of each row of a chunk, and the state behind it."""
    step, trace = _tables()
    kinds = [kind_number(initial, fault) for initial, fault in rows]
    after = [behind] * len(kinds)
    for i in range(len(kinds) - 1, 0, -1):
        after[i - 1] = step[kinds[i]][after[i]]
    out = []
    for kind, vector in zip(kinds, after, strict=True):
        edits, state = trace[kind][vector][state]
        out.append(edits)
    return out, state


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per chunk with its vector known: the state behind it for every state before it."""

    def summaries():
        for (conv, chunk), rows in _chunks(batches, "initial", "fault", "incoming"):
            kinds, behind = [row[:2] for row in rows], rows[0][2]
            yield conv, chunk, [_trace_chunk(kinds, behind, state)[1] for state in range(4)]

    yield from _batched(summaries(), _MAPS)


def _edit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows_out():
        for (conv, _), rows in _chunks(batches, "initial", "fault", "pos", "incoming", "state"):
            kinds = [row[:2] for row in rows]
            edits, _ = _trace_chunk(kinds, rows[0][3], rows[0][4])
            for (_, fault, pos, _, _), done in zip(rows, edits, strict=True):
                yield conv, pos, fault, done

    schema = _schema(("pos", pa.int64()), ("fault", pa.int32()), ("edits", pa.string()))
    yield from _batched(rows_out(), schema)


def edits(kinds: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(conv_id, pos, fault, edits): the cheapest edits up to and with that of each row."""
    rows = kinds.withColumn("chunk", F.floor(F.col("pos") / chunk_rows))

    def grouped(df: DataFrame) -> DataFrame:
        return df.repartition("conv_id", "chunk").sortWithinPartitions("conv_id", "chunk", "pos")

    def by_chunk(run, df: DataFrame) -> DataFrame:
        return grouped(df).mapInArrow(run, "conv_id long, chunk long, map array<int>")

    # Only conversations of several chunks need what lies outside a chunk.
    longer = (
        rows.groupBy("conv_id")
        .agg(F.min("chunk").alias("low"), F.max("chunk").alias("high"))
        .where("low < high")
        .select(F.col("conv_id").alias("c"))
    )
    parts = written(
        rows.join(longer, F.col("conv_id").eqNullSafe(F.col("c")), "left_semi"), "long-conversations"
    )
    places = W.partitionBy("conv_id").orderBy("chunk")
    maps = by_chunk(_speculate, parts).select(
        "conv_id",
        "chunk",
        F.lead("chunk").over(places).alias("next"),
        F.lag("chunk").over(places).alias("last"),
        "map",
    )
    behind = written(stitch(written(maps, "chunk-vectors"), "next", 0), "chunk-ends")
    on = ["conv_id", "chunk"]

    def add(df: DataFrame, found: DataFrame, *names: str) -> DataFrame:
        right = found.select(F.col("conv_id").alias("c"), F.col("chunk").alias("n"), *names)
        same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("chunk") == F.col("n"))
        return df.join(right, same, "left").drop("c", "n")

    walked = by_chunk(_walk, add(parts, behind, "incoming"))
    states = add(walked, behind, "next", "last")
    starts = stitch(written(states, "chunk-states"), "last", START)
    known = add(behind.select(*on, "incoming"), starts.withColumnRenamed("incoming", "state"), "state")
    full = add(rows, known, "incoming", "state").select(
        "conv_id", "chunk", "pos", "initial", "fault",
        F.coalesce("incoming", F.lit(0)).alias("incoming"),
        F.coalesce("state", F.lit(START)).alias("state"),
    )
    return grouped(full).mapInArrow(_edit_rows, "conv_id long, pos long, fault int, edits string")


# --- the report ----------------------------------------------------------------------------------


class _Report:
    """What is asked of one conversation, gathered as its rows pass in order."""

    def __init__(self) -> None:
        self.faults = [0, 0, 0, 0]
        self.low = self.high = self.turn = self.initial = None
        self.turns = self.illegal = self.cost = 0
        self.state, self.audit, self.lines, self.hash = START, [], 0, hashlib.sha256()

    def _line(self, role: str, text: str) -> None:
        if self.lines:
            self.hash.update(b"\n")
        self.hash.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.lines += 1

    def _insert(self) -> None:
        self.state = NEXT[self.state]
        self._line(ROLE[self.state], "")
        self.cost += INSERT

    def row(self, turn, role: str, text: str, fault: int, done: str) -> None:
        self.faults[fault] += 1
        if turn is not None:
            if turn != self.turn:
                self.turns, self.turn = self.turns + 1, turn
            self.low = turn if self.low is None else self.low
            self.high = turn
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.illegal += 1
        self.initial = initial
        self.audit.append(done)
        for _ in done[:-1]:
            self._insert()
        if done[-1] == "D":
            self.cost += DELETE
            return
        self.cost += TRUNCATED * (fault == IS_TRUNCATED) + REROLE * (done[-1] == "R")
        if done[-1] == "K":
            self.state = kept_state(self.state, initial)
        else:
            self.state = NEXT[self.state]
            role = ROLE[self.state]
        self._line(role, text)

    def end(self) -> tuple:
        tail = TAIL[self.state]
        self.audit.append(tail)
        for _ in tail:
            self._insert()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (gaps, *self.faults[1:], self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())


_REPORT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation, position and part: a marker of each conversation first, then of
    each row its edits and its text."""

    def reports():
        begun, current, report, found = False, None, None, None
        for batch in batches:
            names = ("conv_id", "part", "turn", "role", "text", "fault", "edits")
            for conv, part, turn, role, text, fault, done in _columns(batch, *names):
                if not begun or conv != current:
                    if begun:
                        yield current, *report.end()
                    begun, current, report = True, conv, _Report()
                if part == 1:
                    found = fault, done
                elif part == 2:
                    report.row(turn, role, text, *found)
        if begun:
            yield current, *report.end()

    numbers = [(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    schema = _schema(*numbers, ("audit", pa.string()), ("repaired_sha256", pa.string()))
    yield from _batched(reports(), schema, 200)


def repair(conversations: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Faults, cheapest edits and the hash of the repaired text of every conversation of
    (conv_id, turn, role, text)."""
    source = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        "role", "text",
    )
    rows = in_order(damaged(source))
    done = edits(with_kinds(rows), chunk_rows)
    parts = (
        source.select("conv_id")
        .distinct()
        .select("conv_id", F.lit(-1).cast("long").alias("pos"), F.lit(0).alias("part"))
        .unionByName(done.withColumn("part", F.lit(1)), allowMissingColumns=True)
        .unionByName(rows.withColumn("part", F.lit(2)), allowMissingColumns=True)
    )
    ordered = parts.repartition("conv_id").sortWithinPartitions("conv_id", "pos", "part")
    kept = ordered.select("conv_id", "part", "turn", "role", "text", "fault", "edits")
    return kept.mapInArrow(_report, _REPORT)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(table(spark, sf_dir, "conversations"))


QUERIES = {"op13_conversation_repair": op13_conversation_repair}
ORACLE: dict[str, str] = {}
