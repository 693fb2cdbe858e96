"""Hard-negative mining with angular triangle filtering.

Vectors become whole numbers (``floor(256 * x)``) and are stored with their norm and their angles to
``REFERENCES`` directions. For a row and an anchor with angles t and u to a direction, their own angle
lies between ``|t - u|`` and ``t + u`` (or ``2 pi`` less that), so their cosine lies between
``cos(t + u)`` and ``cos(t - u)``: one interval per direction, of which the narrowest bounds count.
Times both norms, and widened by more than all rounding, they bound the integer score. A row is scored
only where its interval overlaps a window still open: for positives from the anchor's fifth best score
so far upwards; for negatives of a positive with score p the window [0.3 p, 0.9 p], from the tenth
best so far upwards. Scores are exact, so pruning and directions never change a result.

Rows are stored in blocks of one label, sorted by nearest direction and angle to it, so that a block's
angles lie close together; anchors likewise. A pair of an anchor block and a row block whose extremes
already rule out an overlap is dropped before a vector is moved. The other pairs are shuffled by
anchor block and ``LANES`` lanes, the most promising first; a task holds one anchor block, one row
block and the best rows so far, whatever the size of a label. Positives meet only blocks of their own
label, negatives only the others.

Bounds: the directions are chosen on the driver from ``SAMPLE`` rows at most, those with the smallest
hashes. Anchors are a stated query set, one row in ``ANCHOR_EVERY``; they grow with the table and are
never collected nor broadcast.

Defined results: rows with a null label or vector, or a component that is null or not finite, take no
part; vectors of different lengths are filled up with zeros; a zero vector scores 0 with everything;
components beyond 2^53 / 256 count as that bound, and scores beyond 64 bits, though compared exactly,
are returned as the nearest 64-bit number; a null vec_id is no anchor and comes after all others;
every row is a row of its own, so of repeated rows each is an anchor, a positive and a negative; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import decimal
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventmill.llm.common import table
from eventmill.session import written

ANCHOR_EVERY, SHIFT_EVERY, LABELS = 100, 7, 10
POSITIVES, NEGATIVES = 5, 10
SCALE = 256
REFERENCES = 8
SAMPLE = 2048
BLOCK_ROWS, ANCHOR_ROWS = 1024, 256
LANES = 8
#: More than all rounding of an angle, a cosine and a product, relative to the norms.
SLACK = 1e-6
_LONG = 2**63 - 1
_LIMIT = float(2**53)


def prepared(embeddings: DataFrame) -> DataFrame:
    """The rows that take part: (rid, vec_id, label, q); ``rid`` tells rows apart."""
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    usable = embeddings.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    shifted = F.when(
        F.col("vec_id") % SHIFT_EVERY == 0, (F.col("label").cast("long") + 1) % LABELS
    ).otherwise(F.col("label").cast("long"))
    whole = F.transform(
        "embedding",
        lambda x: F.floor(
            F.least(F.greatest(x.cast("double") * SCALE, F.lit(-_LIMIT)), F.lit(_LIMIT))
        ).cast("long"),
    )
    return written(
        usable.select(
            F.monotonically_increasing_id().alias("rid"),
            F.col("vec_id").cast("long").alias("vec_id"),
            shifted.alias("label"),
            whole.alias("q"),
        ),
        "vectors",
    )


# --- whole-number vectors -----------------------------------------------------------------------


def matrix(column: pa.Array, width: int = 0) -> np.ndarray:
    """Vectors as rows of a matrix of whole numbers, filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy()
    width = max(width, int(lengths.max(initial=0)))
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def _same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (a, b))


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products, exactly: in doubles while every sum is below 2^53, else in whole numbers
    of any size."""
    a, b = _same_width(a, b)
    largest = [float(np.abs(m).max(initial=0)) for m in (a, b)]
    if largest[0] * largest[1] * max(a.shape[1], 1) < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a.astype(object) @ b.T.astype(object)


def directions(sample: np.ndarray, count: int = REFERENCES) -> np.ndarray:
    """Directions far apart: each next one is the sampled row farthest from those before it."""
    rows = sample.astype(np.float64)
    norms = np.linalg.norm(rows, axis=1)
    rows = rows[norms > 0] / norms[norms > 0, None]
    if not len(rows):
        return np.zeros((0, sample.shape[1]))
    chosen = [rows[0]]
    nearest = rows @ rows[0]
    while len(chosen) < min(count, len(rows)):
        chosen.append(rows[int(nearest.argmin())])
        nearest = np.maximum(nearest, rows @ chosen[-1])
    return np.array(chosen)


def angles(q: np.ndarray, references: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and the angle of each row to each direction."""
    rows, refs = _same_width(q.astype(np.float64), references)
    norms = np.linalg.norm(rows, axis=1)
    cosines = (rows @ refs.T) / np.where(norms > 0, norms, 1)[:, None]
    return norms, np.arccos(np.clip(cosines, -1, 1))


def score_bounds(
    norms: np.ndarray, theta: np.ndarray, other_norms: np.ndarray, other: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score of every pair, by the triangle inequality on each direction."""
    shape = (len(norms), len(other_norms))
    low, high = np.full(shape, -1.0), np.ones(shape)
    for k in range(theta.shape[1]):
        both = np.outer(np.cos(theta[:, k]), np.cos(other[:, k]))
        cross = np.outer(np.sin(theta[:, k]), np.sin(other[:, k]))
        np.minimum(high, both + cross, out=high)
        np.maximum(low, both - cross, out=low)
    product = np.outer(norms, other_norms)
    return np.floor(product * (low - SLACK)), np.ceil(product * (high + SLACK))


# --- blocks ---------------------------------------------------------------------------------------

_ROWS = pa.schema(
    [("rid", pa.int64()), ("vec_id", pa.int64()), ("label", pa.int64()), ("q", pa.list_(pa.int64()))]
)
_ANGLED = "rid long, vec_id long, label long, q array<long>, norm double, theta array<double>"


def with_angles(rows: DataFrame, references: np.ndarray) -> DataFrame:
    """The rows with norm and angles, and the nearest direction (``cell``) with its angle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            norms, theta = angles(matrix(batch.column("q")), references)
            columns = [batch.column(name) for name in _ROWS.names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(norms), pa.array(list(theta), pa.list_(pa.float64()))],
                [*_ROWS.names, "norm", "theta"],
            )

    found = rows.mapInArrow(run, _ANGLED)
    nearest = F.array_min("theta")
    return found.withColumn("near", F.coalesce(nearest, F.lit(0.0))).withColumn(
        "cell", F.coalesce(F.array_position("theta", nearest), F.lit(0))
    )


def _pack(batch: pa.RecordBatch) -> bytes:
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue()


def unpack(payload: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(payload) as stream:
        return pa.Table.from_batches(stream, stream.schema).combine_chunks().to_batches()[0]


_BLOCK = (
    "label long, least_norm double, largest_norm double, least array<double>, "
    "largest array<double>, payload binary"
)


def blocks(angled: DataFrame, size: int) -> DataFrame:
    """Rows packed by label and direction, ``size`` to a block at most, with a number and extremes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column("label").to_numpy()
            cuts = {0, len(label), *(np.flatnonzero(label[1:] != label[:-1]) + 1).tolist()}
            cuts = sorted(cuts | set(range(0, len(label), size)))
            parts = [batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:])]
            theta = [np.array(p.column("theta").to_pylist(), np.float64) for p in parts]
            norms = [p.column("norm").to_numpy() for p in parts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([p.column("label")[0].as_py() for p in parts], pa.int64()),
                    pa.array([float(n.min()) for n in norms], pa.float64()),
                    pa.array([float(n.max()) for n in norms], pa.float64()),
                    pa.array([t.min(axis=0) for t in theta], pa.list_(pa.float64())),
                    pa.array([t.max(axis=0) for t in theta], pa.list_(pa.float64())),
                    pa.array([_pack(p) for p in parts], pa.binary()),
                ],
                ["label", "least_norm", "largest_norm", "least", "largest", "payload"],
            )

    keys = ["label", "cell", "near", "rid"]
    ordered = angled.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("near", "cell")
    numbered = F.monotonically_increasing_id().alias("block")
    return written(ordered.mapInArrow(run, _BLOCK).select(numbered, "*"), "vector-blocks")


def extreme_bounds(a: str, b: str) -> tuple[Column, Column]:
    """Least and largest score of any pair of two blocks, from their extremes (native)."""
    pi = float(np.pi)

    def each_direction(of) -> Column:
        others = [F.col(f"{a}.largest"), F.col(f"{b}.least"), F.col(f"{b}.largest")]
        return F.transform(
            F.col(f"{a}.least"), lambda x, i: of(x, *[F.get(other, i) for other in others])
        )

    apart = F.array_max(
        each_direction(lambda al, ah, bl, bh: F.greatest(F.lit(0.0), al - bh, bl - ah))
    )
    # The angle of a pair is at most t + u, and at most 2 pi - (t + u).
    wide = F.array_min(
        each_direction(
            lambda al, ah, bl, bh: F.when(ah + bh <= pi, ah + bh)
            .when(al + bl >= pi, 2 * pi - (al + bl))
            .otherwise(F.lit(pi))
        )
    )
    high = F.cos(F.coalesce(apart, F.lit(0.0))) + SLACK
    low = F.cos(F.coalesce(wide, F.lit(pi))) - SLACK
    least = F.col(f"{a}.least_norm") * F.col(f"{b}.least_norm")
    largest = F.col(f"{a}.largest_norm") * F.col(f"{b}.largest_norm")
    return (
        F.when(low < 0, low * largest).otherwise(low * least) - 1,
        F.when(high < 0, high * least).otherwise(high * largest) + 1,
    )


# --- the search -----------------------------------------------------------------------------------


class Best:
    """The best rows of one window: higher scores first, ties by smaller vec_id."""

    def __init__(self, size: int) -> None:
        self.size, self.rows = size, []

    @property
    def least(self):
        """The score below which nothing can enter; None while there is room."""
        return self.rows[-1][0] if len(self.rows) == self.size else None

    def add(self, scores: np.ndarray, ids: np.ndarray, rids: np.ndarray) -> None:
        if len(scores) > 4 * self.size and scores.dtype != object:
            cut = np.partition(scores, len(scores) - self.size)[len(scores) - self.size]
            keep = scores >= cut
            scores, ids, rids = scores[keep], ids[keep], rids[keep]
        found = list(zip(scores.tolist(), ids.tolist(), rids.tolist(), strict=True))
        self.rows = sorted(self.rows + found, key=lambda r: (-r[0], r[1], r[2]))[: self.size]


class Anchors:
    """An anchor block, and per anchor the windows with the best rows found for each."""

    def __init__(self, payload: bytes, size: int) -> None:
        batch = unpack(payload)
        self.rid = batch.column("rid").to_pylist()
        self.vec_id = batch.column("vec_id").to_pylist()
        self.q = matrix(batch.column("q"))
        self.norm = batch.column("norm").to_numpy()
        self.theta = np.array(batch.column("theta").to_pylist(), np.float64)
        if "positives" in batch.schema.names:
            self.windows = [
                [(p["vec_id"], int(p["score"])) for p in found]
                for found in batch.column("positives").to_pylist()
            ]
        else:
            self.windows = [[None] for _ in self.rid]
        self.best = [[Best(size) for _ in w] for w in self.windows]

    @staticmethod
    def limits(window) -> tuple[int | None, int | None]:
        """Least and largest score of a window, ends included."""
        if window is None:
            return None, None
        score = window[1]
        return -((-3 * score) // 10), (9 * score) // 10

    def search(self, payload: bytes) -> None:
        rows = unpack(payload)
        theta = np.array(rows.column("theta").to_pylist(), np.float64)
        low, high = score_bounds(self.norm, self.theta, rows.column("norm").to_numpy(), theta)
        open_ = np.zeros(low.shape, bool)
        for i, windows in enumerate(self.windows):
            for window, best in zip(windows, self.best[i], strict=True):
                least, largest = self.limits(window)
                overlaps = np.ones(low.shape[1], bool)
                if largest is not None:
                    overlaps = (low[i] <= largest) & (high[i] >= least)
                if best.least is not None:
                    overlaps &= high[i] >= best.least
                open_[i] |= overlaps
        columns = np.flatnonzero(open_.any(axis=0))
        if not len(columns):
            return
        rids = rows.column("rid").to_numpy()[columns]
        ids = rows.column("vec_id").fill_null(_LONG).to_numpy()[columns]
        scores = exact_scores(self.q, matrix(rows.column("q"))[columns])
        for i, windows in enumerate(self.windows):
            wanted = open_[i, columns] & (rids != self.rid[i])
            for window, best in zip(windows, self.best[i], strict=True):
                least, largest = self.limits(window)
                mine = wanted
                if largest is not None:
                    mine = mine & (scores[i] >= least) & (scores[i] <= largest)
                if best.least is not None:
                    mine = mine & (scores[i] >= best.least)
                if mine.any():
                    best.add(scores[i][mine], ids[mine], rids[mine])

    def rows(self) -> Iterator[tuple]:
        for i, windows in enumerate(self.windows):
            for number, (window, best) in enumerate(zip(windows, self.best[i], strict=True)):
                positive, score = window or (None, None)
                for found, vec_id, rid in best.rows:
                    yield (
                        self.rid[i], self.vec_id[i], number, positive, score,
                        None if vec_id == _LONG else vec_id, str(found), rid,
                    )


_FOUND = pa.schema(
    [
        ("anchor_block", pa.int64()),
        ("arid", pa.int64()),
        ("anchor_id", pa.int64()),
        ("number", pa.int32()),
        ("positive_id", pa.int64()),
        ("positive_score", pa.decimal128(38, 0)),
        ("vec_id", pa.int64()),
        ("score", pa.decimal128(38, 0)),
        ("rid", pa.int64()),
    ]
)
_FOUND_SQL = (
    "anchor_block long, arid long, anchor_id long, number int, positive_id long, positive_score decimal(38,0), "
    "vec_id long, score decimal(38,0), rid long"
)


def best_rows(pairs: DataFrame, anchor_blocks: DataFrame, row_blocks: DataFrame, size: int) -> DataFrame:
    """The best ``size`` rows of every window over all pairs (anchor_block, block, high)."""
    lane = F.pmod(F.xxhash64("block"), F.lit(LANES)).cast("int").alias("lane")
    moved = pairs.join(row_blocks.select("block", "payload"), "block").select(
        "anchor_block", lane, F.col("high").alias("promise"), "block", "payload"
    )
    heads = anchor_blocks.select(
        F.col("block").alias("anchor_block"),
        F.explode(F.sequence(F.lit(0), F.lit(LANES - 1))).alias("lane"),
        F.lit(float("inf")).alias("promise"),
        F.lit(-1).cast("long").alias("block"),
        "payload",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = None

        def found(block: int, anchors: Anchors) -> pa.RecordBatch:
            rows = [(block, *row) for row in anchors.rows()]
            columns = list(zip(*rows, strict=True)) or [[] for _ in _FOUND]
            for k in (5, 7):
                columns[k] = [None if v is None else decimal.Decimal(v) for v in columns[k]]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _FOUND, strict=True)], schema=_FOUND
            )

        for batch in batches:
            names = ("anchor_block", "block", "payload")
            for anchor_block, block, payload in zip(*map(batch.column, names), strict=True):
                if block.as_py() == -1:
                    if current is not None:
                        yield found(*current)
                    current = anchor_block.as_py(), Anchors(payload.as_py(), size)
                else:
                    current[1].search(payload.as_py())
        if current is not None:
            yield found(*current)

    dealt = heads.unionByName(moved).repartition("anchor_block", "lane")
    ordered = dealt.sortWithinPartitions("anchor_block", "lane", F.desc("promise"), "block")
    each = ordered.select("anchor_block", "block", "payload").mapInArrow(run, _FOUND_SQL)
    place = F.row_number().over(
        W.partitionBy("arid", "number").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "rid")
    )
    return each.withColumn("place", place).where(F.col("place") <= size)


_EXTREMES = ("block", "label", "least_norm", "largest_norm", "least", "largest")
#: Parts into which anchor blocks are dealt to meet the row blocks of all other labels.
GROUPS = 64

_POSITIVES = pa.list_(pa.struct([("vec_id", pa.int64()), ("score", pa.string())]))


def _attach_positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchor blocks with the positives of each anchor inside, and the span of all their windows."""
    for batch in batches:
        rows = []
        names = ("block", "payload", "found")
        for block, payload, found in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
            anchors = unpack(payload)
            of = {rid: [] for rid in anchors.column("rid").to_pylist()}
            for place, arid, vec_id, score in sorted(
                (f["place"], f["arid"], f["vec_id"], f["score"]) for f in found
            ):
                of[arid].append({"vec_id": vec_id, "score": score})
            limits = [Anchors.limits((None, int(p["score"]))) for ps in of.values() for p in ps]
            limits = [(least, largest) for least, largest in limits if least <= largest]
            if limits:
                low, high = min(least for least, _ in limits), max(most for _, most in limits)
                packed = anchors.append_column("positives", pa.array(list(of.values()), _POSITIVES))
                rows.append((block, low - 1 - abs(low) * 1e-9, high + 1 + abs(high) * 1e-9, _pack(packed)))
        columns = list(zip(*rows, strict=True)) or [[], [], [], []]
        kinds = (pa.int64(), pa.float64(), pa.float64(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
            ["block", "low", "high", "payload"],
        )


def with_positives(anchor_blocks: DataFrame, found: DataFrame) -> DataFrame:
    """The anchor blocks some of whose anchors have a positive; an anchor has few of them."""
    entry = F.struct("place", "arid", F.coalesce("vec_id", F.lit(_LONG)).alias("vec_id"),
                     F.col("score").cast("string").alias("score"))
    lists = found.groupBy("anchor_block").agg(F.collect_list(entry).alias("found"))
    joined = anchor_blocks.join(lists, F.col("block") == F.col("anchor_block"))
    attached = joined.select("block", "payload", "found").mapInArrow(
        _attach_positives, "block long, low double, high double, payload binary"
    )
    return written(attached, "anchor-windows")


def hard_negatives(
    embeddings: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES
) -> DataFrame:
    """The hard negatives of every anchor and positive in (vec_id, embedding, label)."""
    rows = prepared(embeddings.select("vec_id", "embedding", "label"))
    sampled = rows.orderBy(F.xxhash64("q"), "rid").limit(SAMPLE).select("q").toArrow()
    vectors = sampled.column("q").combine_chunks() if sampled.num_rows else pa.array([], pa.list_(pa.int64()))
    angled = written(with_angles(rows, directions(matrix(vectors))), "vector-angles")
    row_blocks = blocks(angled, BLOCK_ROWS)
    anchor_blocks = blocks(angled.where(F.col("vec_id") % ANCHOR_EVERY == 0), ANCHOR_ROWS)
    a, r = anchor_blocks.select(*_EXTREMES).alias("a"), row_blocks.select(*_EXTREMES).alias("r")
    low, high = extreme_bounds("a", "r")
    pair = [F.col("a.block").alias("anchor_block"), F.col("r.block").alias("block")]

    same = a.join(r, F.col("a.label") == F.col("r.label")).select(*pair, high.alias("high"))
    found = best_rows(same, anchor_blocks, row_blocks, positives)
    windowed = with_positives(anchor_blocks, found)

    # The query set against all rows of other labels, in blocks, as far as their extremes overlap.
    group = F.pmod(F.xxhash64("block"), F.lit(GROUPS)).cast("int")
    spans = windowed.select(F.col("block").alias("w"), F.col("low").alias("from"), F.col("high").alias("to"))
    queries = (
        anchor_blocks.select(*_EXTREMES)
        .join(spans, F.col("block") == F.col("w"))
        .withColumn("group", group)
        .alias("a")
    )
    every = F.explode(F.sequence(F.lit(0), F.lit(GROUPS - 1))).alias("group")
    others = (
        queries.join(
            row_blocks.select(*_EXTREMES, every).alias("r"), F.col("a.group") == F.col("r.group")
        )
        .where(F.col("a.label") != F.col("r.label"))
        .where((low <= F.col("to")) & (high >= F.col("from")))
        .select(*pair, high.alias("high"))
    )
    kept = best_rows(others, windowed, row_blocks, negatives)

    def as_long(score: str) -> Column:
        ends = [F.lit(v).cast("decimal(38,0)") for v in (-_LONG, _LONG)]
        return F.least(F.greatest(F.col(score), ends[0]), ends[1]).cast("long")

    positive = F.col("positive_id")
    return kept.select(
        "anchor_id",
        F.when(positive != _LONG, positive).alias("positive_id"),
        F.col("place").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        as_long("positive_score").alias("positive_score"),
        as_long("score").alias("negative_score"),
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


QUERIES = {"op11_hard_negatives": op11_hard_negatives}

ORACLE = {
    "op11_hard_negatives": f"""
WITH usable AS (
  SELECT row_number() OVER () AS rid, vec_id,
         CASE WHEN vec_id % {SHIFT_EVERY} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
         [floor({SCALE} * x::DOUBLE) FOR x IN embedding] AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
scored AS (
  SELECT a.rid AS arid, a.vec_id AS anchor_id, a.label AS anchor_label, b.rid, b.vec_id, b.label,
         CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.rid <> b.rid WHERE a.vec_id % {ANCHOR_EVERY} = 0),
positives AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY arid ORDER BY score DESC, vec_id) AS place
    FROM scored WHERE label = anchor_label)
  WHERE place <= {POSITIVES}),
negatives AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id,
         p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.arid, p.place ORDER BY n.score DESC, n.vec_id) AS rank
  FROM positives p JOIN scored n ON n.arid = p.arid AND n.label <> n.anchor_label
   AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score,
       negative_score
FROM negatives WHERE rank <= {NEGATIVES}"""
}
