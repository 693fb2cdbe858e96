"""Personal data: fixed patterns, and identifiers found through contexts learned from them.

Bootstrapped contextual extraction. The base patterns (email, ip, card, phone) give seeds. Every
identifier-like token of the corpus is an instance, the words around it are its patterns ("left
word", "two left words", "left and right word"); distinct pairs of both are the edges of a graph
over all documents. Scores are computed per kind of seed in ``ROUNDS`` rounds: a pattern scores the
mean of its instances' scores, an instance that is no seed the mean of its patterns' scores. Patterns
with at least ``SUPPORT`` different seeds and a score of ``CONFIDENT`` discover the instances that
score ``ACCEPTED``; every place where such a pattern meets such an instance is a span of kind
``context``.

Everything is DataFrame functions. Code point offsets come from the text between matches: ``split``
and ``regexp_extract_all`` on one pattern give gaps and matches in turn. Patterns and instances are
text keys; frequent ones are summed before they are shuffled, and the joins read written tables on
both sides, so adaptive execution can split a key that is hot.

The regular expressions are the base ones with possessive repeats and a look-behind at the start of
a run, which match the same places in time linear in the text.

Defined results: a null or empty text has no spans; repeated rows are scanned each; an instance
within a base span is no discovery; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.llm.common import documents, whole
from eventmill.session import written

#: Kinds in the order in which they are listed, and their patterns.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be tried.
HINTS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
BYTE = "0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"

#: An instance: a phone-like run, or a token with a digit or an @.
INSTANCE = r"\+[0-9][\x20().0-9-]+[0-9]|(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
EDGE_LEFT, EDGE_RIGHT = r"^[^0-9A-Za-z+(]*", r"[^0-9A-Za-z)]*$"
LEAST_DIGITS = 4
#: What every text with an instance holds: as many digits anywhere, or an @.
MAY_HOLD = "[0-9](?:[^0-9]*+[0-9]){%d}|@" % (LEAST_DIGITS - 1)
CONTEXT_CHARS = 80
ROUNDS = 3
SUPPORT = 5
CONFIDENT = 0.8
ACCEPTED = 0.7


def matches(text: Column, pattern: str) -> Column:
    """Array of (start, match) of a pattern's leftmost non-overlapping matches."""
    # The ends of the matches are running sums, made by adding the sums 1, 2, 4, ... places before:
    # n log n, where appending them one by one would copy the array each time.
    ends = F.zip_with(
        F.split(text, pattern, -1),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda gap, match: F.struct(
            (F.char_length(gap) + F.coalesce(F.char_length(match), F.lit(0))).alias("end"),
            match.alias("match"),
        ),
    )
    nothing = F.struct(F.lit(0).alias("end"), F.lit("").alias("match"))

    def summed(sums: Column, by: Column) -> Column:
        before = F.concat(F.array_repeat(nothing, by), F.slice(sums, 1, F.size(sums) - by))
        added = F.zip_with(
            sums,
            before,
            lambda x, y: F.struct((x["end"] + y["end"]).alias("end"), x["match"].alias("match")),
        )
        return F.when(by < F.size(sums), added).otherwise(sums)

    def started(sums: Column) -> Column:
        # The gap after the last match comes without one.
        return F.transform(
            F.filter(sums, lambda m: m["match"].isNotNull()),
            lambda m: F.struct(
                (m["end"] - F.char_length(m["match"])).alias("start"), m["match"].alias("match")
            ),
        )

    return F.aggregate(F.array(*[F.lit(1 << i) for i in range(31)]), ends, summed, started)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    reverse = F.split(F.reverse(value), "")
    total = F.aggregate(
        F.transform(
            reverse,
            lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
                F.element_at(
                    F.array(*[F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]),
                    F.coalesce(d.cast("int"), F.lit(0)) + 1,
                )
            ),
        ),
        F.lit(0),
        lambda a, d: a + F.coalesce(d, F.lit(0)),
    )
    return total % 10 == 0


def holds(kind: str, match: Column) -> Column:
    """Whether a match of a kind's pattern passes its further test."""
    if kind == "ip":
        return match.rlike("^" + r"\.".join([BYTE] * 4) + "$")
    if kind == "card":
        n = F.char_length(digits(match))
        return F.when(n.between(12, 19), luhn(digits(match))).otherwise(False)
    if kind == "phone":
        return F.char_length(digits(match)).between(9, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """Array of (start, end, kind number, kind) of one kind."""
    number = KINDS.index(kind)
    spans = F.transform(
        F.filter(matches(text, PATTERNS[kind]), lambda m: holds(kind, m["match"])),
        lambda m: F.struct(
            m["start"].alias("start"),
            F.lit(number).alias("number"),
            (m["start"] + F.char_length(m["match"])).alias("end"),
            F.lit(kind).alias("kind"),
        ),
    )
    hint = text.contains(HINTS[kind]) if HINTS[kind] else text.rlike("[0-9]{2}|[0-9][ -][0-9]")
    none = F.array().cast("array<struct<start:int,number:int,end:int,kind:string>>")
    return F.when(hint, spans).otherwise(none)


def seed_kind(value: Column) -> Column:
    """The kind of a whole value that a base pattern matches, else null."""
    return F.coalesce(
        *[
            F.when(value.rlike("^(?:" + PATTERNS[k] + ")$") & holds(k, value), F.lit(k))
            for k in KINDS
        ]
    )


def occurrences(docs: DataFrame) -> DataFrame:
    """Every instance in its context: (doc_id, text_hash, start, end, instance, patterns)."""
    text = whole("text")
    gaps = F.split(F.col("text"), INSTANCE, -1)
    tried = docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), text.alias("text")
    ).where(text.rlike(MAY_HOLD))
    # Every match takes along its own surroundings only, not the whole array of gaps.
    led = F.zip_with(
        matches(F.col("text"), INSTANCE),
        F.slice(gaps, 1, F.size(gaps) - 1),
        lambda m, gap: F.struct(
            m["start"].alias("start"),
            m["match"].alias("match"),
            F.substring(gap, -CONTEXT_CHARS, CONTEXT_CHARS).alias("before"),
        ),
    )
    surrounded = F.zip_with(
        led,
        F.slice(gaps, F.lit(2), F.size(gaps) - 1),
        lambda m, gap: F.struct(
            m["start"].alias("start"),
            m["match"].alias("match"),
            m["before"].alias("before"),
            F.substring(gap, 1, CONTEXT_CHARS).alias("after"),
        ),
    )
    split = tried.select("doc_id", "text_hash", F.explode(surrounded).alias("m"))
    lead = F.regexp_extract("m.match", EDGE_LEFT, 0)
    left = F.regexp_extract(
        F.lower(F.concat("m.before", lead)), r"(?:(\S+)\s+)?(\S+)\s*$", 2
    )
    further = F.regexp_extract(
        F.lower("m.before"), r"(\S+)\s+\S+\s*$", 1
    )
    right = F.regexp_extract(F.lower("m.after"), r"\S+", 0)
    cleaned = F.regexp_replace(
        F.substr("m.match", F.char_length(lead) + 1, F.lit(1 << 30)), EDGE_RIGHT, ""
    )
    found = split.select(
        "doc_id",
        "text_hash",
        (F.col("m.start") + F.char_length(lead)).alias("start"),
        cleaned.alias("instance"),
        left.alias("left"),
        further.alias("further"),
        right.alias("right"),
    ).where(
        (F.char_length(digits(F.col("instance"))) >= LEAST_DIGITS)
        | F.col("instance").rlike("[A-Za-z0-9]@[A-Za-z0-9]")
    )
    patterns = F.array_compact(
        F.array(
            F.when(F.col("left") != "", F.concat(F.lit("l:"), "left")),
            F.when(
                F.col("further") != "", F.concat(F.lit("ll:"), "further", F.lit(" "), "left")
            ),
            F.when(
                (F.col("left") != "") & (F.col("right") != ""),
                F.concat(F.lit("lr:"), "left", F.lit(" _ "), "right"),
            ),
        )
    )
    return found.select(
        "doc_id",
        "text_hash",
        "start",
        (F.col("start") + F.char_length("instance")).alias("end"),
        "instance",
        patterns.alias("patterns"),
    )


def discoveries(found: DataFrame) -> DataFrame:
    """(pattern, instance) pairs by which confident patterns meet accepted instances."""
    edges = written(
        found.select(F.explode("patterns").alias("pattern"), "instance")
        .distinct()
        .withColumn("seed", seed_kind(F.col("instance"))),
        "pii-edges",
    )
    instances = None
    for _ in range(ROUNDS):
        scored = edges if instances is None else edges.join(instances, "instance", "left")
        worth = {
            k: F.when(F.col("seed").isNotNull(), (F.col("seed") == k).cast("double")).otherwise(
                F.lit(0.0) if instances is None else F.coalesce(F.col(f"i_{k}"), F.lit(0.0))
            )
            for k in KINDS
        }
        patterns = written(
            scored.groupBy("pattern").agg(
                F.count("seed").alias("seeds"),
                *[F.avg(worth[k]).alias(f"p_{k}") for k in KINDS],
            ),
            "pii-patterns",
        )
        instances = written(
            edges.where("seed IS NULL")
            .join(patterns.where(F.col("seeds") >= SUPPORT), "pattern")
            .groupBy("instance")
            .agg(*[F.avg(f"p_{k}").alias(f"i_{k}") for k in KINDS]),
            "pii-instances",
        )
    accepted = reduce(
        lambda a, b: a | b,
        [(F.col(f"i_{k}") >= ACCEPTED) & (F.col(f"p_{k}") >= CONFIDENT) for k in KINDS],
    )
    confident = reduce(lambda a, b: a | b, [F.col(f"p_{k}") >= CONFIDENT for k in KINDS])
    return (
        edges.where("seed IS NULL")
        .join(patterns.where((F.col("seeds") >= SUPPORT) & confident), "pattern")
        .join(instances, "instance")
        .where(accepted)
        .select("pattern", "instance")
    )


def pii_scan(docs: DataFrame) -> DataFrame:
    """doc_id, base spans and discovered spans of every row of (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    found = written(occurrences(docs), "pii-occurrences")
    met = written(discoveries(found), "pii-discoveries")
    new = (
        found.select(
            "doc_id", "text_hash", "start", "end", "instance", F.explode("patterns").alias("pattern")
        )
        .join(met, ["pattern", "instance"])
        .groupBy("doc_id", "text_hash")
        .agg(
            F.collect_set(
                F.struct(
                    "start", F.lit(len(KINDS)).alias("number"), "end", F.lit("context").alias("kind")
                )
            ).alias("discovered")
        )
    )
    scanned = docs.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        *[base_spans(whole("text"), k).alias(k) for k in KINDS],
    )
    base = F.array_sort(F.concat(*KINDS))
    none = F.array().cast("array<struct<start:int,number:int,end:int,kind:string>>")
    joined = (
        scanned.alias("d")
        .join(
            new.alias("n"),
            F.col("d.doc_id").eqNullSafe(F.col("n.doc_id"))
            & (F.col("d.text_hash") == F.col("n.text_hash")),
            "left",
        )
        .select("d.doc_id", *KINDS, base.alias("base"), F.coalesce("discovered", none).alias("new"))
    )
    outside = F.filter(
        "new",
        lambda s: ~F.exists(
            "base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])
        ),
    )
    return joined.withColumn("spans", F.array_sort(F.concat("base", outside))).drop("new")


def listed(spans: Column | str) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_scan(documents(spark, sf_dir)).select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(listed("base"), 256).alias("base_sha256"),
        listed("spans").alias("spans"),
    )


QUERIES = {"op5_pii": op5_pii}

ORACLE: dict[str, str] = {}
