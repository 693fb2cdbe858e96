"""Stateful processors: what built-in streaming operators cannot express.

Rows of a key reach a processor in shuffle order, so each sorts its rows of the micro-batch
by ``seq`` first. A row older than one handled in an earlier batch is applied as it comes.
Micro-batches are bounded by the source, and so is what is sorted.

The classes are sent to the workers by value, so they use nothing else of this package.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from eventmill.constants import (
    INSUFFICIENT_STOCK,
    INVENTORY_RELEASED,
    INVENTORY_RESERVATION_FAILED,
    INVENTORY_RESERVED,
    UNKNOWN_ITEM,
)


def _in_order(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(list(rows), ignore_index=True).sort_values("seq", kind="stable")


class CountChanges(StatefulProcessor):
    """One output row per input row: the count of the key after it."""

    SCHEMA = "seq BIGINT, item STRING, order_count BIGINT"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._count = handle.getValueState("count", "n BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        ordered = _in_order(rows)
        before = self._count.get()[0] if self._count.exists() else 0
        self._count.update((before + len(ordered),))
        yield pd.DataFrame(
            {
                "seq": ordered["seq"].to_numpy(),
                "item": [key[0]] * len(ordered),
                "order_count": np.arange(before + 1, before + len(ordered) + 1),
            }
        )

    def close(self) -> None:
        pass


class StockKeeper(StatefulProcessor):
    """Reserve and release stock of the items of one bucket, each in arrival order.

    A key is a bucket of items, not an item, so that a micro-batch is a few large frames. Input:
    ``bucket``, ``item``, ``kind`` ('reserve' or 'release'), ``order_id, seq, quantity`` and
    ``opening``, the item's stock before any order (NULL for an unknown item). State: stock left by
    item, and the quantity of each live reservation; it is asked and written once per item and order
    of a micro-batch, and not asked while it is empty. A reserve for an order that already holds a
    reservation of the item is an error row, a release without one is a no-op. Held in memory: the
    rows of one bucket in one micro-batch.
    """

    SCHEMA = (
        "seq BIGINT, order_id STRING, item STRING, quantity BIGINT, available_before BIGINT, "
        "event_type STRING, reason STRING, error STRING"
    )

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._stock = handle.getMapState("stock", "item STRING", "available BIGINT")
        self._held = handle.getMapState("held", "item STRING, order_id STRING", "quantity BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        ordered = _in_order(rows)
        known, any_held = self._stock.exists(), self._held.exists()
        stocks, held, held_before = {}, {}, {}
        out = []
        columns = ("seq", "kind", "item", "order_id", "quantity", "opening")
        for seq, kind, item, order_id, quantity, opening in zip(
            *(ordered[c].tolist() for c in columns)
        ):
            if item not in stocks:
                kept = self._stock.getValue((item,)) if known else None
                if kept is not None:
                    stocks[item] = kept[0]
                else:
                    stocks[item] = None if pd.isna(opening) else int(opening)
            stock = before = stocks[item]
            place = (item, order_id)
            if place not in held and (kind == "release" or (stock is not None and stock >= quantity)):
                kept = self._held.getValue(place) if any_held else None
                held[place] = held_before[place] = None if kept is None else kept[0]
            event, reason, error = None, None, None
            if kind == "release":
                if held[place] is None:
                    continue
                quantity, held[place] = held[place], None
                stock += quantity
                event = INVENTORY_RELEASED
            elif stock is None:
                event, reason = INVENTORY_RESERVATION_FAILED, UNKNOWN_ITEM
            elif stock < quantity:
                event, reason = INVENTORY_RESERVATION_FAILED, INSUFFICIENT_STOCK
            elif held[place] is not None:
                error = "order already reserved"
            else:
                stock -= quantity
                held[place] = int(quantity)
                event = INVENTORY_RESERVED
            stocks[item] = stock
            out.append((seq, order_id, item, quantity, before, event, reason, error))
        for item, stock in stocks.items():
            if stock is not None:
                self._stock.updateValue((item,), (int(stock),))
        for place, quantity in held.items():
            if quantity == held_before[place]:
                continue
            if quantity is None:
                self._held.removeKey(place)
            else:
                self._held.updateValue(place, (quantity,))
        names = [c.strip().split(" ")[0] for c in self.SCHEMA.split(",")]
        frame = pd.DataFrame(out, columns=names)
        yield frame.astype({"seq": "int64", "quantity": "int64", "available_before": "Int64"})

    def close(self) -> None:
        pass


class SeenIds(StatefulProcessor):
    """What an idempotent consumer does with each record, with the ids it has seen as keyed state.

    A key is a bucket of ids, not an id, so that a micro-batch is a few large frames; the state is
    a map from id to nothing, so a lookup costs the same however many ids there are. It is asked
    once per distinct id of a micro-batch and written once per newly processed one. Held in memory:
    the rows of one bucket in one micro-batch.

    Input: ``bucket``, ``id`` (NULL where the record carries no usable one), ``partition, offset,
    error, event_type`` and any other columns. The outcomes are those of
    :func:`eventmill.operators.reliability.consume`.
    """

    def __init__(self, handled) -> None:
        self._handled = list(handled)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._seen = handle.getMapState("seen", "id STRING", "seen BOOLEAN")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        for event_id in initialState["id"].unique():
            self._seen.updateValue((event_id,), (True,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        ordered = pd.concat(list(rows), ignore_index=True)
        ordered = ordered.sort_values(["partition", "offset"], kind="stable", ignore_index=True)
        ids = ordered["id"]
        known = {i for i in ids.dropna().unique() if self._seen.containsKey((i,))}
        readable, good = ids.notna(), ids.notna() & ordered["error"].isna()
        first = pd.Series(ordered.index[good], index=ids[good]).groupby(level=0).min()
        later = pd.Series(ordered.index, index=ordered.index) > ids.map(first).astype("float64")
        outcome = np.select(
            [
                ~readable,
                ids.isin(known) | later,
                ordered["error"].notna(),
                ordered["event_type"].isin(self._handled),
            ],
            ["dead letter", "duplicate", "dead letter", "effect"],
            "ignored",
        )
        ordered["outcome"] = outcome
        for event_id in ids[np.isin(outcome, ["effect", "ignored"])]:
            self._seen.updateValue((event_id,), (True,))
        yield ordered.drop(columns=["bucket"])

    def close(self) -> None:
        pass


class UserFold(StatefulProcessor):
    """A fold with the user's functions; the state is kept as JSON text per key.

    ``start(key)`` and ``step(key, state, rows)`` are those of
    :func:`eventmill.operators.ordered_fold.fold_in_order`, pickled; the state must be JSON.
    """

    def __init__(self, start: bytes, step: bytes, seq: str) -> None:
        self._code, self._seq, self._start = (start, step), seq, None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getValueState("state", "json STRING")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if self._start is None:  # not in init, which also runs where the package is not shipped
            self._start, self._step = map(cloudpickle.loads, self._code)
        ordered = pd.concat(list(rows), ignore_index=True).sort_values(self._seq, kind="stable")
        state = json.loads(self._state.get()[0]) if self._state.exists() else self._start(key)
        state, out = self._step(key, state, ordered)
        self._state.update((json.dumps(state),))
        yield out

    def close(self) -> None:
        pass


class LateFilter(StatefulProcessor):
    """Keep the rows that are not late when judged record by record within a partition.

    Input: ``seq``, ``at`` (event time in microseconds), ``window_end`` (microseconds, grace
    included). State: the largest event time seen in the partition.
    """

    SCHEMA = "seq BIGINT"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._seen = handle.getValueState("stream_time", "at BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        ordered = _in_order(rows)
        before = self._seen.get()[0] if self._seen.exists() else -(2**62)
        seen = np.maximum(np.maximum.accumulate(ordered["at"].to_numpy()), before)
        self._seen.update((int(seen[-1]),))
        kept = ordered["window_end"].to_numpy() > seen
        yield pd.DataFrame({"seq": ordered["seq"].to_numpy()[kept]})

    def close(self) -> None:
        pass
