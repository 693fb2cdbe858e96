"""Splitting keys that hold too many rows for one task, and ordered work across the splits.

Ordered per-key work (running totals, previous row, stock allocation) normally puts a whole
key in one task. Here a key above ``block_rows`` rows is cut into consecutive blocks of its
order column; each block is handled on its own and a small per-block summary carries the
state from block to block. Block edges depend on the data only, so a re-run task computes
the same ones. Rows with a NULL key are never split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

BLOCK = "_block"
BLOCK_ROWS = 1_000_000
# Memory parameters. Order values are unique whole numbers and roughly dense (an ingest number, an
# offset), so a block this many values wide holds at most as many rows, bursts included.
MAX_WIDTH_FACTOR = 16


def hot_keys(
    df: DataFrame, keys: Sequence[str], seq: str, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Keys with more than ``block_rows`` rows: first order value and width of their blocks.

    There are at most rows / ``block_rows`` of them, and each is returned.
    """
    counts = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.min(seq).alias("_first"), F.max(seq).alias("_last")
    )
    span = F.col("_last") - F.col("_first") + 1
    blocks = F.ceil(F.col("_n") / F.lit(block_rows))
    width = F.least(F.ceil(span / blocks), F.lit(MAX_WIDTH_FACTOR * block_rows))
    return counts.filter(F.col("_n") > block_rows).select(
        *keys, "_first", F.greatest(width, F.lit(1)).cast("bigint").alias("_width")
    )


def add_blocks(df: DataFrame, hot: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """Add the block number; NULL for keys that are not hot."""
    # No hint: Spark broadcasts the hot keys while they are small, and otherwise joins by key.
    marked = df.join(hot, list(keys), "left")
    block = F.expr(f"CAST((`{seq}` - _first) DIV _width AS BIGINT)")
    return marked.withColumn(BLOCK, block).drop("_first", "_width")


def _running(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    block_rows: int,
    in_block: Column,
    block_total: Column,
    carry: Column,
    combine,
    name: str,
) -> DataFrame:
    hot = hot_keys(df, keys, seq, block_rows)
    rows = add_blocks(df, hot, keys, seq)
    # One small row per block of a hot key; a key has at most rows / block_rows of them.
    totals = rows.filter(F.col(BLOCK).isNotNull()).groupBy(*keys, BLOCK).agg(block_total)
    carried = totals.select(*keys, BLOCK, carry.alias("_carry"))
    return (
        rows.withColumn(name, in_block)
        .join(carried, [*keys, BLOCK], "left")
        .withColumn(name, combine(F.col(name), F.col("_carry")))
        .drop("_carry", BLOCK)
    )


def _row_window(keys: Sequence[str], seq: str):
    return W.partitionBy(*keys, BLOCK).orderBy(seq)


def _earlier_blocks(keys: Sequence[str]):
    return W.partitionBy(*keys).orderBy(BLOCK).rowsBetween(W.unboundedPreceding, -1)


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    value: Column,
    name: str,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Sum of ``value`` over the rows of the key up to and including this one, in ``seq`` order."""
    upto = _row_window(keys, seq).rowsBetween(W.unboundedPreceding, W.currentRow)
    return _running(
        df,
        keys,
        seq,
        block_rows,
        in_block=F.sum(value).over(upto),
        block_total=F.sum(value).alias("_total"),
        carry=F.sum("_total").over(_earlier_blocks(keys)),
        combine=lambda own, carry: own + F.coalesce(carry, F.lit(0)),
        name=name,
    )


def running_count(
    df: DataFrame, keys: Sequence[str], seq: str, name: str, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Position of the row within its key, starting at 1."""
    return running_sum(df, keys, seq, F.lit(1).cast("bigint"), name, block_rows)


def running_max(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    value: Column,
    name: str,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Largest ``value`` of the key up to and including this row."""
    upto = _row_window(keys, seq).rowsBetween(W.unboundedPreceding, W.currentRow)
    return _running(
        df,
        keys,
        seq,
        block_rows,
        in_block=F.max(value).over(upto),
        block_total=F.max(value).alias("_total"),
        carry=F.max("_total").over(_earlier_blocks(keys)),
        combine=lambda own, carry: F.greatest(own, carry),
        name=name,
    )


def previous_value(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    value: str,
    name: str,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``value`` of the row before this one in its key; NULL for the first row."""
    # Wrapped, so that a NULL value of the row before differs from no row before.
    held = F.struct(F.col(value).alias("v"))
    return _running(
        df,
        keys,
        seq,
        block_rows,
        in_block=F.lag(held).over(_row_window(keys, seq)),
        block_total=F.max_by(held, seq).alias("_total"),
        # A block without rows has no summary, so the row before is always the last summary.
        carry=F.lag("_total").over(W.partitionBy(*keys).orderBy(BLOCK)),
        combine=lambda own, carry: F.coalesce(own, carry)["v"],
        name=name,
    )
