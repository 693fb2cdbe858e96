"""Shards of near equal bytes: a k-d tree over metadata, split at weighted medians.

Rows with equal texts form one unit with one place in metadata space; a unit heavier than
``1 / UNITS`` of a shard is dealt into parts of that weight, so a group of copies that holds a third
of all bytes is splittable. At every node of the tree the dimension with the widest range (each
scaled to 0..1 over the table) is split at its weighted median. Ties are ordered by a hash, so a
median always exists.

A median is found by descent: the order key of a unit (20 bits of the dimension, 40 of the hash) is
read 12 bits at a time, and each pass sums the weights of one digit for all nodes of the level. Only
these sums reach the driver: at most ``4096`` per node, whatever the table's size. No rows are
sorted or moved while the tree is built.

Everything is DataFrame functions. Defined results: a null text counts 0 bytes plus 1; null
metadata is its own, lowest coordinate; repeated rows are rows of their own; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventmill.llm.common import documents, hash128, whole
from eventmill.session import written

SHARDS = 16
#: A unit holds at most this part of a shard's bytes (or is one row).
UNITS = 100
DIMENSIONS = ("n_chars", "source", "lang")
COORDINATE_BITS, TIE_BITS, DIGIT_BITS = 20, 40, 12
#: A bin of a digit that holds at most this part of its node's bytes is not refined.
BIN_SHARE = 1e-5
#: Rows of one shard are numbered in parts of about this many rows.
SLOT_ROWS = 5000


def _number(df: DataFrame, name: str) -> Column:
    """A column's place on a line: itself for numbers, its first six bytes for text."""
    kind = dict(df.dtypes)[name]
    if kind == "string":
        prefix = F.rpad(F.hex(F.substring(F.encode(F.col(name), "UTF-8"), 1, 6)), 12, "0")
        return F.conv(prefix, 16, 10).cast("double")
    return F.col(name).cast("double")


def _rows(docs: DataFrame) -> DataFrame:
    present = [d for d in DIMENSIONS if d in docs.columns]
    text = whole("text")
    return docs.select(
        "doc_id",
        F.monotonically_increasing_id().alias("row_number"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        *hash128(text),
        *[_number(docs, d).alias(f"x{i}") for i, d in enumerate(present)],
    )


def _dimensions(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c.startswith("x")]


def _with_parts(rows: DataFrame, limit: int) -> DataFrame:
    """Rows with the part of their unit; units heavier than ``limit`` have several parts."""
    heavy = (
        rows.groupBy("h1", "h2")
        .agg(F.sum("size").alias("weight"))
        .where(F.col("weight") > limit)
        .select("h1", "h2", F.ceil(F.col("weight") / limit).cast("long").alias("parts"))
    )
    # Broadcast: fewer than SHARDS * UNITS units can be heavier than the limit.
    joined = rows.join(F.broadcast(heavy), ["h1", "h2"], "left")
    # By the written number of the row, since doc_ids may be null or repeated.
    part = F.pmod(F.xxhash64("row_number"), F.coalesce("parts", F.lit(1)))
    return joined.withColumn("part", part).drop("parts")


def _units(rows: DataFrame) -> DataFrame:
    """One row per unit part: its weight, and its coordinates scaled to COORDINATE_BITS."""
    names = _dimensions(rows)
    ends = rows.agg(
        *[F.min(c).alias(f"{c}_low") for c in names], *[F.max(c).alias(f"{c}_high") for c in names]
    ).first()
    units = rows.groupBy("h1", "h2", "part").agg(
        F.sum("size").alias("weight"), *[F.min(c).alias(c) for c in names]
    )
    top = (1 << COORDINATE_BITS) - 2
    scaled = []
    for c in names:
        low, high = ends[f"{c}_low"], ends[f"{c}_high"]
        span = (high - low) if low is not None and high > low else 1.0
        place = F.floor((F.col(c) - F.lit(low or 0.0)) / F.lit(span) * F.lit(top)) + 1
        scaled.append(F.coalesce(place, F.lit(0)).cast("long").alias(c))
    tie = F.pmod(F.xxhash64("h1", "h2", "part"), F.lit(1 << TIE_BITS)).alias("tie")
    return units.select("h1", "h2", "part", "weight", tie, *scaled)


def _key(name: str) -> Column:
    return F.shiftleft(F.col(name), TIE_BITS) + F.col("tie")


def _at(values: dict[int, int], nodes: int) -> Column:
    """The value of a row's node; 0 where the node has none."""
    listed = F.array(*[F.lit(values.get(n, 0)).cast("long") for n in range(nodes)])
    return F.element_at(listed, F.col("node") + 1)


def _widest(units: DataFrame, names: list[str]) -> tuple[dict[int, int], dict[int, int]]:
    """Of each node: the number of its widest dimension, and its weight."""
    stats = (
        units.groupBy("node")
        .agg(F.sum("weight").alias("weight"), *[(F.max(c) - F.min(c)).alias(c) for c in names])
        .collect()
    )
    widest = {r["node"]: max(range(len(names)), key=lambda i: (r[names[i]], -i)) for r in stats}
    return widest, {r["node"]: r["weight"] for r in stats}


def _medians(units: DataFrame, weights: dict[int, int], nodes: int) -> dict[int, int]:
    """The order key at which each node has half its weight before it."""
    low = dict.fromkeys(weights, 0)  # smallest key of the open bin
    before = dict.fromkeys(weights, 0)  # weight of the smaller keys
    open_nodes, shift = set(weights), COORDINATE_BITS + TIE_BITS
    while shift > 0 and open_nodes:
        width, shift = shift, max(0, shift - DIGIT_BITS)
        first = _at({n: low[n] for n in open_nodes}, nodes)
        last = _at({n: low[n] + (1 << width) for n in open_nodes}, nodes)
        sums = (
            units.where((F.col("key") >= first) & (F.col("key") < last))
            .groupBy("node", F.shiftright("key", shift).alias("bin"))
            .agg(F.sum("weight").alias("weight"))
            .collect()
        )
        for node in list(open_nodes):
            for row in sorted((r for r in sums if r["node"] == node), key=lambda r: r["bin"]):
                low[node] = row["bin"] << shift
                if before[node] + row["weight"] > weights[node] / 2:
                    break
                before[node] += row["weight"]
            if row["weight"] <= BIN_SHARE * weights[node]:
                open_nodes.discard(node)
    return low


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32 and shard (0 to ``shards`` - 1, a power of two) of every row."""
    rows = written(_rows(docs), "shard-rows")
    total = rows.agg(F.sum("size")).first()[0] or 0
    parted = _with_parts(rows, max(1, total // (shards * UNITS)))
    units = written(_units(parted).withColumn("node", F.lit(0)), "shard-units")
    names = _dimensions(units) or ["tie"]
    keys = F.array(*[_key(c) if c != "tie" else F.col("tie") for c in names])
    for level in range(shards.bit_length() - 1):
        widest, weights = _widest(units, names)
        dimension = _at(widest, 1 << level).cast("int") + 1
        at = written(units.withColumn("key", F.element_at(keys, dimension)), f"shard-level-{level}")
        medians = _medians(at, weights, 1 << level)
        later = (F.col("key") >= _at(medians, 1 << level)).cast("int")
        units = at.withColumn("node", F.col("node") * 2 + later).drop("key")
    placed = units.select("h1", "h2", "part", F.col("node").alias("shard"))
    return parted.join(placed, ["h1", "h2", "part"]).select(
        "doc_id", "row_number", "size", "text_crc32", "shard"
    )


def with_slots(placed: DataFrame) -> DataFrame:
    """Number the rows of each shard from 0, in parts that are numbered on their own."""
    placed = written(placed, "shard-placed")
    largest = placed.groupBy("shard").count().agg(F.max("count")).first()[0] or 1
    parts = max(64, largest // SLOT_ROWS)
    dealt = placed.withColumn("deal", F.pmod(F.xxhash64("row_number"), F.lit(parts)))
    before = Window.partitionBy("shard").orderBy("deal").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        dealt.groupBy("shard", "deal")
        .agg(F.count("*").alias("n"))
        .select("shard", "deal", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    )
    own = Window.partitionBy("shard", "deal").orderBy("row_number")
    return (
        dealt.withColumn("place", F.row_number().over(own) - 1)
        .join(firsts, ["shard", "deal"])
        .withColumn("slot", (F.col("first") + F.col("place")).cast("long"))
        .drop("deal", "place", "first", "row_number")
    )


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law ``bytes``: the shards' sizes are near equal; copies of a text stay together unless
    their group is heavier than a hundredth of a shard."""
    return with_slots(shard(documents(spark, sf_dir))).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


QUERIES = {"op8_sharding": op8_sharding}

ORACLE: dict[str, str] = {}
