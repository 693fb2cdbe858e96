"""Stock allocation: requests take stock in arrival order, a request that does not fit takes none.

The decision for one request depends on all earlier ones of its item, so an item is folded in
order. Ordinary items are each folded in one pass over a sorted partition, with constant
memory. An item with very many requests is cut into blocks (:mod:`hot_keys`); what remains to
be known is the stock at each block's start, and which resubmitted orders hold stock by then.

That is found level by level, for all such items at once. While the stock ``A`` stays in
``[2^k, 2^(k+1))``, every request up to ``2^k`` fits; of an order's several requests the first one
takes stock and the others are errors, so what each row takes is known without a fold: an aggregate
finds the first requests, prefix sums over blocks give the stock at their starts. The level ends in
the first block in which the stock falls below ``2^k`` or a larger request is accepted; only that
block is folded row by row. Stock never grows (a request that is to give its stock back takes none),
so an item needs at most one round per power of two of its opening stock, however many blocks and
resubmitted orders it has. Hot items with a holding request for less than nothing, whose stock may
grow, are streamed through in order instead, as one task each with constant memory. After
that all blocks are folded in parallel, each from its own opening stock. The result is the same as
one fold per item.

Orders that hold stock are a table, never a set in one place; it is joined with salt, so that an
order with very many requests spreads.

A second request of an order for the same item is an error while the first one's reservation is
live, and is decided like any other after a refusal or a release.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from eventmill import constants as C
from eventmill.operators import hot_keys
from eventmill.operators.hot_keys import BLOCK
from eventmill.session import ensure_checkpoint_dir, scratch_path, written

CHUNK = 4096
#: Parts over which the requests of one order are spread where they meet the table of orders.
SALT = 16
ALREADY_RESERVED = "order already reserved"


def _with_resubmitted(requests: DataFrame) -> DataFrame:
    """``_order``: the order id of rows whose order has several requests for the item."""
    if "order_id" not in requests.columns:
        return requests.withColumn("_order", F.lit(None).cast("string"))
    several = (
        requests.filter("order_id IS NOT NULL")
        .groupBy("item", "order_id")
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
        .select("item", "order_id", F.col("order_id").cast("string").alias("_order"))
    )
    return requests.join(several, ["item", "order_id"], "left")


def allocate(
    requests: DataFrame, stock: DataFrame, block_rows: int = hot_keys.BLOCK_ROWS
) -> DataFrame:
    """Decide every request in ``seq`` order within its item.

    ``requests``: ``item, seq, quantity`` and a boolean ``holds`` (false: an accepted request
    gives its stock back before the next one), plus any other columns; ``order_id`` says which
    requests are resubmitted.
    ``stock``: ``item, available_quantity``, one row per item.
    Adds ``available_before`` (NULL for an unknown item), ``reserved`` and ``error``.
    """
    ensure_checkpoint_dir(requests.sparkSession)
    hot = hot_keys.hot_keys(requests, ["item"], "seq", block_rows).checkpoint()
    rows = hot_keys.add_blocks(_with_resubmitted(requests), hot, ["item"], "seq")
    rows = rows.withColumn("_earlier", F.lit(False))
    opening = stock.select(
        "item",
        F.lit(0).cast("bigint").alias(BLOCK),
        F.col("available_quantity").cast("bigint").alias("_open"),
    )
    if not hot.isEmpty():
        entries, holders = _block_openings(rows, hot, opening)
        opening = opening.join(hot.select("item"), "item", "left_anti").unionByName(entries)
        rows = _with_earlier(rows, holders)
    rows = rows.withColumn(BLOCK, F.coalesce(BLOCK, F.lit(0).cast("bigint")))
    decided = [
        T.StructField("available_before", T.LongType()),
        T.StructField("reserved", T.BooleanType()),
        T.StructField("error", T.StringType()),
    ]
    schema = T.StructType([*requests.schema.fields, *decided])
    # The opening stock travels as a row in front of its requests: one shuffle of everything
    # and no join, whatever the size of the stock table. The placement is an explicit
    # repartition, which adaptive execution never splits.
    placed = rows.unionByName(opening, allowMissingColumns=True)
    ordered = placed.repartition("item", BLOCK).sortWithinPartitions(
        "item", BLOCK, F.col("_open").isNull(), F.col("seq").asc_nulls_first()
    )
    kept = ordered.select(*requests.columns, BLOCK, "_order", "_earlier", "_open")
    return kept.mapInArrow(_fold_partition, schema)


class Fold:
    """Stock of one item, and the orders with several requests that hold some of it.

    A row's order is NULL unless it has several requests; ``earlier`` marks rows whose order is
    known to hold stock from before the fold.
    """

    def __init__(self, stock: int | None):
        self.stock = stock
        self.held = set()

    def decide(
        self, quantity: np.ndarray, holds: np.ndarray, orders: np.ndarray, earlier: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Stock before each request, whether it is taken, and whether it is an error."""
        n = len(quantity)
        before, taken = np.empty(n, "int64"), np.zeros(n, bool)
        wrong = np.zeros(n, bool)
        for start in range(0, n, CHUNK):
            part = slice(start, min(n, start + CHUNK))
            q, h, o, e = quantity[part], holds[part], orders[part], earlier[part]
            takes = np.where(h & ~e, q, 0)
            stock = self.stock - (np.cumsum(takes) - takes)
            if (o[~e] != None).any():  # noqa: E711
                fits = self._one_by_one(q, h, o, e, stock, wrong[part])
            elif (stock >= q).all():  # everything fits
                fits, wrong[part] = ~e, e
                self.stock = int(stock[-1] - takes[-1])
            elif (q > self.stock).all():  # nothing fits
                fits, stock = np.zeros(len(q), bool), np.full(len(q), self.stock)
            else:
                fits = self._one_by_one(q, h, o, e, stock, wrong[part])
            before[part], taken[part] = stock, fits
        return before, taken, wrong

    def _one_by_one(self, q, h, o, e, before, wrong) -> np.ndarray:
        """Decide row after row; fills ``before`` and ``wrong``."""
        stock, fits = self.stock, []
        for i, (quantity, holding, order, again) in enumerate(
            zip(q.tolist(), h.tolist(), o.tolist(), e.tolist(), strict=True)
        ):
            before[i] = stock
            fit = stock >= quantity
            if fit and (again or order is not None):
                if again or order in self.held:
                    wrong[i], fit = True, False
                elif holding:
                    self.held.add(order)
            if fit and holding:
                stock -= quantity
            fits.append(fit)
        self.stock = stock
        return np.array(fits, bool)


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Quantity (0 where there is none), holds, resubmitted order and earlier of a batch."""
    quantity = pc.fill_null(batch.column("quantity").cast(pa.int64()), 0).to_numpy()
    holds = pc.fill_null(batch.column("holds"), False).to_numpy(zero_copy_only=False)
    earlier = pc.fill_null(batch.column("_earlier"), False).to_numpy(zero_copy_only=False)
    orders = batch.column("_order")
    if orders.null_count == len(orders):
        return quantity, holds, np.full(len(orders), None, object), earlier
    return quantity, holds, np.array(orders.to_pylist(), object), earlier


def _runs(batch: pa.RecordBatch, *names: str) -> list[tuple[tuple, int, int]]:
    """Values, start and end of each run of rows that agree in the named columns."""
    n = batch.num_rows
    change = np.zeros(n, bool)
    for name in names:
        codes = batch.column(name).dictionary_encode().indices
        codes = pc.fill_null(codes, -1).to_numpy(zero_copy_only=False)
        change[1:] |= codes[1:] != codes[:-1]
    starts = [0, *np.flatnonzero(change).tolist()] if n else []
    return [
        (tuple(batch.column(name)[start].as_py() for name in names), start, end)
        for start, end in zip(starts, [*starts[1:], n], strict=True)
    ]


def _fold_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fold rows sorted by item, block and seq, each group led by its opening row if it has
    one; the fold is carried from batch to batch."""
    current, fold = None, None
    for batch in batches:
        columns = _columns(batch)
        opens = pc.is_valid(batch.column("_open")).to_numpy(zero_copy_only=False)
        before, taken, wrong, known = [], [], [], []
        for group, start, end in _runs(batch, "item", BLOCK):
            if group != current:
                current, fold = group, None
            if opens[start]:
                fold = Fold(batch.column("_open")[start].as_py())
                start += 1
            n = end - start
            if fold is None:
                part = np.zeros(n, "int64"), np.zeros(n, bool), np.zeros(n, bool)
            else:
                part = fold.decide(*[c[start:end] for c in columns])
            known.append(np.full(n, fold is not None))
            for out, values in zip((before, taken, wrong), part, strict=True):
                out.append(values)
        requests = batch.filter(pc.is_null(batch.column("_open")))
        inner = (BLOCK, "_order", "_earlier", "_open")
        kept = [i for i, name in enumerate(batch.schema.names) if name not in inner]
        decided = [np.concatenate(c) if c else np.zeros(0, bool) for c in (before, taken, wrong, known)]
        yield pa.RecordBatch.from_arrays(
            [requests.column(i) for i in kept]
            + [
                pa.array(decided[0].astype("int64"), pa.int64(), mask=~decided[3].astype(bool)),
                pa.array(decided[1].astype(bool)),
                pc.if_else(pa.array(decided[2].astype(bool)), ALREADY_RESERVED, None).cast(
                    pa.string()
                ),
            ],
            names=[batch.schema.names[i] for i in kept]
            + ["available_before", "reserved", "error"],
        )


def _by_order(rows: DataFrame, orders: DataFrame) -> DataFrame:
    """Rows with the columns of their item's and order's row in ``orders``, spread by salt."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("_salt")
    salted = rows.withColumn("_salt", F.pmod(F.col("seq"), F.lit(SALT)).cast("int"))
    return salted.join(orders.select("*", salts), ["item", "_order", "_salt"], "left").drop("_salt")


def _with_earlier(rows: DataFrame, holders: DataFrame) -> DataFrame:
    """Rows in blocks with ``_earlier``: whether an earlier request of the order holds stock."""
    again = F.col(BLOCK).isNotNull() & F.col("_order").isNotNull()
    told = _by_order(rows.filter(again).drop("_earlier"), holders)
    told = told.withColumn("_earlier", F.coalesce(F.col("_at") < F.col("seq"), F.lit(False)))
    told = told.withColumn("_order", F.lit(None).cast("string")).select(*rows.columns)
    return rows.filter(~again).unionByName(told)


def _block_openings(
    rows: DataFrame, hot: DataFrame, opening: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Opening stock of every block of every hot item that is known, and for every resubmitted
    order of a hot item that comes to hold stock the number of the request by which it does."""
    # Only the columns the decision needs are kept, and read again in every round.
    narrow = written(
        rows.filter(F.col(BLOCK).isNotNull())
        .select(
            "item",
            BLOCK,
            "seq",
            F.coalesce(F.col("quantity").cast("bigint"), F.lit(0)).alias("quantity"),
            F.coalesce("holds", F.lit(False)).alias("holds"),
            "_order",
        )
        .repartition("item", BLOCK)
        .sortWithinPartitions("item", BLOCK, "seq"),
        "hot-requests",
    )
    stock = hot.select("item").join(opening.select("item", F.col("_open").alias("stock")), "item")
    growing = narrow.filter("holds AND quantity < 0").select("item").distinct()
    last = F.lit(-1).cast("bigint").alias("after")
    streamed = stock.join(growing, "item", "left_semi").select("item", "stock", last)
    state = written(stock.join(growing, "item", "left_anti").select("item", "stock", last), "levels")
    folds = written(_folded(narrow, streamed), "hot-folds")
    openings = _Log(folds.filter("_open IS NOT NULL").select("item", BLOCK, "_open"), "openings")
    holders = _Log(_holders(folds), "holders")
    while not state.isEmpty():
        walked, first = _walk_level(narrow, state, holders.rows())
        ends = walked.filter("ends").select("item", BLOCK, F.col("_open").alias("stock"))
        openings.add(walked.select("item", BLOCK, "_open"))
        # First requests in blocks that the level passes hold stock now.
        passed = first.join(ends.select("item", F.col(BLOCK).alias("_end")), "item", "left").filter(
            F.col("_end").isNull() | (F.col("_first_block") < F.col("_end"))
        )
        holders.add(passed.select("item", "_order", F.col("_first").alias("_at")))
        block = narrow.join(ends.select("item", BLOCK), ["item", BLOCK], "left_semi")
        known = _with_earlier(block.withColumn("_earlier", F.lit(False)).select(*_FOLDED), holders.rows())
        # Orders first seen in this block are still to be decided in it.
        told = known.join(
            block.select("item", "seq", F.col("_order").alias("_own")), ["item", "seq"]
        ).withColumn("_order", F.when(~F.col("_earlier"), F.col("_own")))
        start = ends.select("item", "stock", (F.col(BLOCK) - 1).alias("after"))
        folds = written(_folded(told.select(*_FOLDED), start), "hot-folds")
        holders.add(_holders(folds))
        state = written(
            folds.filter("_close IS NOT NULL").select(
                "item", F.col("_close").alias("stock"), F.col(BLOCK).alias("after")
            ),
            "levels",
        )
    return openings.rows(), holders.rows()


_FOLDED = ("item", BLOCK, "seq", "quantity", "holds", "_order", "_earlier")


class _Log:
    """A table in the shared folder that every round adds to."""

    def __init__(self, first: DataFrame, name: str) -> None:
        self.spark, self.schema = first.sparkSession, first.schema
        self.path = scratch_path(self.spark, name)
        self.add(first)

    def add(self, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(self.path)

    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)


def _holders(folds: DataFrame) -> DataFrame:
    return folds.filter("_at IS NOT NULL").select("item", "_order", "_at")


def _walk_level(
    narrow: DataFrame, state: DataFrame, holders: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """One level of every item: the opening stock of the blocks up to the one in which the level
    ``ends``, and the first request of each resubmitted order that fits at this level."""
    limit = F.when(F.col("stock") >= 1, F.expr("shiftleft(1L, length(bin(stock)) - 1)")).otherwise(
        F.least("stock", F.lit(0))
    )
    active = narrow.join(
        state.select("item", "stock", "after", limit.cast("bigint").alias("limit")),
        "item",
    ).filter(F.col(BLOCK) > F.col("after"))
    # Rows without several requests need no table of orders.
    alone, several = active.filter("_order IS NULL"), active.filter("_order IS NOT NULL")
    open_orders = _by_order(several, holders).filter("_at IS NULL").drop("_at")
    fits = F.col("holds") & (F.col("quantity") <= F.col("limit"))
    first = written(
        open_orders.filter(fits)
        .groupBy("item", "_order")
        .agg(F.min("seq").alias("_first"), F.min(BLOCK).alias("_first_block")),
        "first-requests",
    )
    told = _by_order(open_orders, first)
    # Up to the first request that fits; later ones are errors and take nothing.
    taking = told.filter(F.col("_first").isNull() | (F.col("seq") <= F.col("_first")))
    rows = alone.unionByName(taking.select(*alone.columns))
    takes = F.when(fits, F.col("quantity")).otherwise(F.lit(0))
    in_block = W.partitionBy("item", BLOCK).orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum(takes).over(in_block), F.lit(0))
    larger = F.col("holds") & ~fits & (F.col("stock") >= 1)
    blocks = (
        rows.withColumn("_takes", takes)
        .withColumn("_needs", F.when(larger, F.col("quantity") + before))
        .groupBy("item", BLOCK)
        .agg(F.sum("_takes").alias("total"), F.min("_needs").alias("needs"))
    )
    # Blocks all of whose rows are errors count too.
    every = active.groupBy("item", BLOCK).agg(F.first("stock").alias("stock"), F.first("limit").alias("limit"))
    along = W.partitionBy("item").orderBy(BLOCK)
    taken = F.coalesce(F.sum("total").over(along.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    total = F.coalesce("total", F.lit(0))
    ends = (F.col("stock") >= 1) & (F.col("_open") - total < F.col("limit"))
    ends = ends | F.coalesce(F.col("needs") <= F.col("_open"), F.lit(False))
    walked = (
        every.join(blocks, ["item", BLOCK], "left")
        .withColumn("_open", F.col("stock") - taken)
        .withColumn("ends", ends)
        .withColumn("_end", F.min(F.when(F.col("ends"), F.col(BLOCK))).over(W.partitionBy("item")))
        .filter(F.col("_end").isNull() | (F.col(BLOCK) <= F.col("_end")))
    )
    return written(walked.select("item", BLOCK, "_open", "ends"), "level-blocks"), first


def _folded(rows: DataFrame, state: DataFrame) -> DataFrame:
    """Fold the rows of each item in ``state`` in order: per block its opening, per resubmitted
    order that comes to hold stock the request, and per item its last block and closing stock."""
    kept = rows if "_earlier" in rows.columns else rows.withColumn("_earlier", F.lit(False))
    item = kept.schema["item"].dataType.simpleString()
    placed = kept.join(state.select("item", F.col("stock").alias("_stock")), "item")
    ordered = placed.repartition("item").sortWithinPartitions("item", BLOCK, "seq")
    schema = f"item {item}, {BLOCK} bigint, _open bigint, _order string, _at bigint, _close bigint"
    return ordered.mapInArrow(_fold_items, schema)


def _fold_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, fold, names = None, None, (BLOCK, "_open", "_order", "_at", "_close")
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())

    def rows(kind: pa.DataType, out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [[]] * 6
        arrays = [pa.array(c, t) for c, t in zip(columns, (kind, *kinds), strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["item", *names])

    kind = None
    for batch in batches:
        kind, out = batch.column("item").type, []
        columns = _columns(batch)
        for group, start, end in _runs(batch, "item", BLOCK):
            if current is None or group[0] != current[0]:
                if current is not None:
                    out.append((*current, None, None, None, fold.stock))
                fold = Fold(batch.column("_stock")[start].as_py())
            if group != current:
                out.append((*group, fold.stock, None, None, None))
            current = group
            _, taken, _ = fold.decide(*[c[start:end] for c in columns])
            holding = np.flatnonzero(taken & columns[1][start:end] & (columns[2][start:end] != None))  # noqa: E711
            for i in (holding + start).tolist():
                out.append((*group, None, columns[2][i], batch.column("seq")[i].as_py(), None))
        yield rows(kind, out)
    if current is not None:
        yield rows(kind, [(*current, None, None, None, fold.stock)])


def reservation_outcome(allocated: DataFrame) -> DataFrame:
    """Event type and reason of each decision; a row with an error has neither."""
    unknown = F.col("available_before").isNull()
    refused = F.col("error").isNull() & ~F.col("reserved")
    return allocated.select(
        "*",
        F.when(F.col("reserved"), C.INVENTORY_RESERVED)
        .when(refused, C.INVENTORY_RESERVATION_FAILED)
        .alias("event_type"),
        F.when(refused & unknown, C.UNKNOWN_ITEM)
        .when(refused, C.INSUFFICIENT_STOCK)
        .alias("reason"),
    )
